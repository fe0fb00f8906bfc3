"""Language identification by nearest centroids.

A text is a TF-IDF vector of hashed byte n-grams (1 to 3 bytes, A-Z
lower-cased), scaled to length 1. Document frequencies are counted over all
training texts; each language's centroids are found by k-means on a bounded
sample of its texts, so a language may have several kinds of text. The
prediction is the language of the centroid with the largest cosine. A text
farther from it than nearly all texts that formed the centroid is marked as
rejected, though it keeps its prediction.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

DIMS = 1 << 12
PER_LANG = 1500          # sampled training texts a language, at most
CENTROIDS = 4            # a language
REJECT = 0.005           # share of a centroid's own texts that lie beyond its distance
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of hashed 1- to 3-grams within each text: (texts, DIMS)."""
    n = len(off) - 1
    a = _LOWER[data].astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(off))
    out = np.bincount(doc * DIMS + a, minlength=n * DIMS)
    z = a
    for k, mult in ((1, 2654435761), (2, 40503 * 65537)):
        if len(a) <= k:
            break
        z = (z[:-1] * 257 + a[k:]) if k == 1 else (z[:-1] * 263 + a[k:])
        same = doc[k:] == doc[:-k]
        h = 256 + (z * mult >> 9) % (DIMS - 256)
        out += np.bincount(doc[k:][same] * DIMS + h[same], minlength=n * DIMS)
    return out.reshape(n, DIMS)


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(n > 0, n, 1)


_DF = "feature int, n long, texts long"


def _frequencies(batches):
    schema = C.arrow(_DF)
    df, texts = np.zeros(DIMS, np.int64), 0
    for b in batches:
        for _, _, data, off in C.blocks(b, "text", 1 << 20):
            for lo in range(0, len(off) - 1, 512):
                o = off[lo: lo + 513]
                df += (grams(data[o[0]: o[-1]], o - o[0]) > 0).sum(0)
                texts += len(o) - 1
    if texts:
        yield C.out_batch(schema, feature=np.arange(DIMS, dtype=np.int32), n=df, texts=np.full(DIMS, texts))


class Centroids:
    def __init__(self, idf: np.ndarray, texts: dict[str, list[str]], seed: int = 9):
        self.idf, self.langs, cs, far = idf, [], [], []
        rng = np.random.default_rng(seed)
        for lang in sorted(texts):
            raw = [t.encode() for t in texts[lang]]
            parts = []
            for lo in range(0, len(raw), 256):
                p = raw[lo: lo + 256]
                parts.append(unit(grams(np.frombuffer(b"".join(p), np.uint8), np.cumsum([0, *map(len, p)])), idf).astype(np.float32))
            x = np.concatenate(parts)
            c = x[rng.choice(len(x), min(CENTROIDS, len(x)), replace=False)].copy()
            for _ in range(8):
                near = np.argmax(x @ c.T, 1)
                for k in range(len(c)):
                    if (near == k).any():
                        m = x[near == k].mean(0)
                        c[k] = m / max(1e-9, np.linalg.norm(m))
            sim = x @ c.T
            near = sim.argmax(1)
            for k in range(len(c)):
                own = sim[near == k, k]
                self.langs.append(lang)
                cs.append(c[k])
                far.append(float(np.quantile(own, REJECT)) if len(own) else 0.0)
        self.c = np.array(cs, np.float32).reshape(-1, DIMS)
        self.far = np.array(far)


_PRED = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


def _predict(model_b):
    schema = C.arrow(_PRED)

    def run(batches):
        m = model_b.value
        for b in batches:
            ids, held = b.column(0), b.column(1)
            for at, to, data, off in C.blocks(b, "text", 1 << 20):
                raw = data.tobytes()
                for lo in range(0, to - at, 256):
                    o = off[lo: lo + 257]
                    n = len(o) - 1
                    letters = [any(map(str.isalpha, raw[o[i]: o[i + 1]].decode())) for i in range(n)]
                    if len(m.c):
                        sim = unit(grams(data[o[0]: o[-1]], o - o[0]), m.idf).astype(np.float32) @ m.c.T
                        best = sim.argmax(1)
                        top = np.clip(sim[np.arange(n), best], 0, 1).astype(float)
                    else:
                        letters, best, top = [False] * n, np.zeros(n, int), np.zeros(n)
                    yield C.out_batch(schema, doc_id=ids.slice(at + lo, n), held_out=held.slice(at + lo, n),
                                      lang_pred=[m.langs[k] if ok else "und" for k, ok in zip(best, letters)],
                                      score=[float(s) if ok else 0.0 for s, ok in zip(top, letters)],
                                      rejected=[not ok or bool(s < m.far[k]) for k, s, ok in zip(best, top, letters)])
    return run


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Centroids:
    """Centroids from the texts whose language is known; no such text gives a model that answers ``und``."""
    d = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    rows = d.select("text").mapInArrow(_frequencies, C.struct(_DF)).groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("texts").alias("t")).collect()           # DIMS rows at most
    df, total = np.zeros(DIMS), 0
    for r in rows:
        df[r["feature"]], total = r["n"], r["t"]
    idf = np.log((total + 1) / (df + 1)) + 1
    # copies are one text; the smallest hashes of each language, found among those below a bound that holds about twice as many
    texts = C.stored(d.select("lang", F.xxhash64("text").alias("h")).distinct())
    per = {r[0]: r[1] for r in texts.groupBy("lang").count().collect()}       # a row a language
    sample: dict[str, list[str]] = {}
    if per:
        below = F.create_map(*[F.lit(x) for k, n in per.items() for x in (k, 2.0 * PER_LANG / n)])
        few: dict[str, list[int]] = {}
        for r in texts.filter(F.col("h") / F.lit(2.0 ** 64) + .5 <= below[F.col("lang")]).collect():   # about twice PER_LANG a language
            few.setdefault(r["lang"], []).append(r["h"])
        last = F.create_map(*[F.lit(x).cast(t) for k, h in few.items() for x, t in ((k, "string"), (sorted(h)[:PER_LANG][-1], "long"))])
        picked = (d.withColumn("h", F.xxhash64("text")).filter(F.col("h") <= last[F.col("lang")])
                  .groupBy("lang", "h").agg(F.first("text").alias("text")))
        for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["h"])):   # PER_LANG a language at most
            sample.setdefault(r["lang"], []).append(r["text"])
    return Centroids(idf, sample)


def predict(model: Centroids, docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document; ``und`` with score 0 where the text is null or has no letter."""
    m = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held"), F.col(text).alias("text"))
    return d.mapInArrow(_predict(m), C.struct(_PRED))


def op10_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = C.crc_mod(F.col("doc_id"), 4) == 2
    return predict(train(docs.filter(~held)), docs, held)
