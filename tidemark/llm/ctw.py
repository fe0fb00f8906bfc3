"""Language-model scoring by context-tree weighting over bytes.

Each byte is predicted as eight binary decisions. For every decision node
(the bits already seen of the byte) there is a context tree over the last 0
to ``DEPTH`` bytes; every tree node keeps how often a 0 and a 1 followed, and
estimates with the Krichevsky-Trofimov rule. A node's weighted probability of
the training text is half its own estimate plus half the product of its
children's, so all depths are mixed with exact Bayesian weights, and the
prediction for a bit is the mixture along its context path. Contexts that the
training text never showed are no nodes: the deepest node that exists takes
what weight is left. Learning is order-free, so counting is a plain
distributed aggregation.

A text is scored with the counts of the training texts alone: its UTF-8
bytes, then one end mark (byte 0xFF, which UTF-8 never uses); the contexts of
its first bytes are filled up with that mark. Null is the empty text.

Work at scale:

* counts of (context, byte) grams and of words are combined inside each task
  and shuffled; their number grows with the corpus;
* trees below depth 2 are built per partition of the last two context bytes,
  the rest (at most 255 * 257 nodes) on the driver;
* at most ``LOCAL_GRAMS`` grams and ``LOCAL_WORDS`` words, the most frequent,
  are broadcast (the bound is a count histogram's, not a hope); everything
  else that a text holds is resolved exactly by a join.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

DEPTH = 5                 # context bytes
LOCAL_GRAMS = 1 << 21     # most entries of the broadcast gram table
LOCAL_WORDS = 1 << 18     # most entries of the broadcast word table
CHUNK = 1 << 22           # bytes whose grams are combined before they leave a task
END = 0xFF


def _codes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One code a position (context bytes, oldest first, then the byte): texts in turn, each with its end.

    Returns the codes and where each text's codes start.
    """
    lens = np.diff(off)
    pad = bytes([END]) * DEPTH
    raw = data.tobytes()
    joined = pad + pad.join([raw[off[i]: off[i + 1]] for i in range(len(lens))]) + pad
    a = np.frombuffer(joined, np.uint8).astype(np.uint64)
    z = a.copy()
    for k in range(1, DEPTH + 1):
        z[k:] |= a[:-k] << np.uint64(8 * k)
    at = DEPTH + off[:-1] + DEPTH * np.arange(len(lens))      # start of each text in `joined`
    step = np.zeros(len(a) + 1, np.int8)
    step[at] += 1
    step[at + lens + 1] -= 1
    keep = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    return z[keep], np.concatenate([[0], np.cumsum(lens + 1)])


_COUNTS = "code long, word binary, n long"


def _count(batches):
    """Gram and word counts of the batches' texts, combined per chunk."""
    schema = C.arrow(_COUNTS)
    held, size, words = [], 0, Counter()

    def grams():
        u, n = np.unique(np.concatenate(held), return_counts=True)
        return C.out_batch(schema, code=u.astype(np.int64), word=pa.nulls(len(u), pa.binary()), n=n)

    def counted():
        return C.out_batch(schema, code=pa.nulls(len(words), pa.int64()), word=list(words),
                           n=list(words.values()))

    for batch in batches:
        for _, _, data, off in C.blocks(batch, "text", 1 << 20):
            codes, _ = _codes(data, off)
            held.append(codes)
            size += len(codes)
            words.update(data.tobytes().lower().split() if len(off) == 2 else
                         b"\n".join([data[off[i]: off[i + 1]].tobytes() for i in range(len(off) - 1)]
                                    ).lower().split())
            if size >= CHUNK:
                yield grams()
                held, size = [], 0
            if len(words) > 200_000:
                yield counted()
                words = Counter()
    if held:
        yield grams()
    if words:
        yield counted()


# ------------------------------------------------------------------ the tree

def _lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0 (Stirling's series after eight steps up)."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        shift -= np.where(y < 8, np.log(y), 0)
        y = np.where(y < 8, y + 1, y)
    i = 1 / y
    return shift + (y - .5) * np.log(y) - y + .5 * math.log(2 * math.pi) + i * (1 / 12 - i * i * (1 / 360 - i * i / 1260))


def kt_log(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov probability of a zeros and b ones."""
    return _lgamma(a + .5) + _lgamma(b + .5) - _lgamma(a + b + 1.) - math.log(math.pi)


def _sum_by(key: np.ndarray, *vals: np.ndarray) -> list[np.ndarray]:
    o = np.argsort(key, kind="stable")
    k = key[o]
    st = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
    return [k[st]] + [np.add.reduceat(v[o], st) if len(st) else v for v in vals]


def _bits(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decision node (1..255) and bit of the eight decisions of each code's byte: shape (8, n)."""
    x = code & np.uint64(0xFF)
    k = np.arange(8, dtype=np.uint64)[:, None]
    node = (np.uint64(1) << k) | (x[None] >> (np.uint64(8) - k))
    return node, ((x[None] >> (np.uint64(7) - k)) & np.uint64(1)).astype(bool)


def _key(code: np.ndarray, node: np.ndarray, d: int) -> np.ndarray:
    ctx = (code >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)
    return (ctx << np.uint64(8))[None] | node


def _up(key: np.ndarray, d: int) -> np.ndarray:
    """Key of the same decision one context byte shallower (depth d from d + 1)."""
    return ((key >> np.uint64(8)) & np.uint64((1 << (8 * d)) - 1)) << np.uint64(8) | (key & np.uint64(0xFF))


def _weigh(a, b, child, leaf: bool):
    """(log weighted probability, weight of the node's own estimate)."""
    le = kt_log(a, b)
    if leaf:
        return le, np.ones_like(le)
    lw = np.logaddexp(le, child) - math.log(2)
    return lw, np.exp(le - math.log(2) - lw)


def _levels(code: np.ndarray, n: np.ndarray, low: int):
    """Nodes of depths DEPTH..low: {d: (key, a, b, own weight, log weighted)}; whole subtrees only."""
    node, bit = _bits(code)
    key, n8 = _key(code, node, DEPTH).ravel(), np.broadcast_to(n.astype(float), bit.shape)
    key, a, b = _sum_by(key, np.where(bit, 0., n8).ravel(), np.where(bit, n8, 0.).ravel())
    lw, own = _weigh(a, b, None, True)
    out = {DEPTH: (key, a, b, own, lw)}
    for d in range(DEPTH - 1, low - 1, -1):
        key, a, b, child = _sum_by(_up(key, d), a, b, lw)
        lw, own = _weigh(a, b, child, False)
        out[d] = (key, a, b, own, lw)
    return out


def _read(batches):
    rows = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([r[0] for r in rows]).astype(np.uint64), np.concatenate([r[1] for r in rows])


_TOP = "key long, a double, b double, child double"


def _to_top(batches):
    """Depth-2 nodes of a partition, summed up to their depth-1 parents."""
    schema = C.arrow(_TOP)
    code, n = _read(batches)
    if len(code):
        key, a, b, _, lw = _levels(code, n, 2)[2]
        key, a, b, child = _sum_by(_up(key, 1), a, b, lw)
        yield C.out_batch(schema, key=key.astype(np.int64), a=a, b=b, child=child)


class Top:
    """Depths 0 and 1 of all trees: predictions and the weight left for deeper nodes, by depth-1 key."""

    def __init__(self, key, a, b, child):
        lw, own = _weigh(a, b, child, False)
        k0, a0, b0, c0 = _sum_by(key & np.uint64(0xFF), a, b, lw)
        _, own0 = _weigh(a0, b0, c0, False)
        kt0 = np.full(256, .5)
        w0 = np.zeros(256)
        kt0[k0.astype(int)] = (b0 + .5) / (a0 + b0 + 1)
        w0[k0.astype(int)] = own0
        self.p0 = kt0                          # at depth 0 as the deepest node
        node = (key & np.uint64(0xFF)).astype(int)
        kt = (b + .5) / (a + b + 1)
        acc0, rem0 = w0[node] * kt0[node], 1 - w0[node]
        self.key = key
        self.p = acc0 + rem0 * kt              # at depth 1 as the deepest node
        self.acc = acc0 + rem0 * own * kt
        self.rem = rem0 * (1 - own)


def _find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(q.shape, int), np.zeros(q.shape, bool)
    i = np.minimum(np.searchsorted(keys, q), len(keys) - 1)
    return i, keys[i] == q


def _predict(code: np.ndarray, n: np.ndarray, want: np.ndarray, top: Top) -> np.ndarray:
    """log10 probability of the codes ``want``, given the partition's grams (code, n)."""
    node, bit = _bits(want)
    p = top.p0[node.astype(int)]
    i, hit = _find(top.key, _key(want, node, 1))
    p = np.where(hit, top.p[i], p) if len(top.key) else p
    if len(code):
        levels = _levels(code, n, 2)
        pkey, acc, rem = top.key, top.acc, top.rem
        for d in range(2, DEPTH + 1):
            key, a, b, own, _ = levels[d]
            j = np.searchsorted(pkey, _up(key, d - 1))
            kt = (b + .5) / (a + b + 1)
            deep = acc[j] + rem[j] * kt
            i, hit = _find(key, _key(want, node, d))
            p = np.where(hit, deep[i], p)
            pkey, acc, rem = key, acc[j] + rem[j] * own * kt, rem[j] * (1 - own)
    return np.log10(np.where(bit, p, 1 - p)).sum(axis=0)


_LP = "code long, n long, lp double"


def _predictor(top_b):
    schema = C.arrow(_LP)

    def run(batches):
        """Rows with n > 0 are grams; rows with n = 0 ask for a code. A partition without asked rows predicts its grams."""
        code, n = _read(batches)
        if len(code):
            ask = n == 0
            want = code[ask] if ask.any() else code
            g, gn = code[~ask], n[~ask]
            for s in range(0, len(want), 1 << 18):
                w = want[s: s + (1 << 18)]
                yield C.out_batch(schema, code=w.astype(np.int64),
                                  n=np.zeros(len(w), np.int64) if ask.any() else gn[s: s + (1 << 18)],
                                  lp=_predict(g, gn, w, top_b.value))
    return run


def _ctx2(code: Column) -> Column:
    return F.shiftright(code, 8).bitwiseAND(F.lit(0xFFFF))


class Model:
    """grams (code, n, lp), words (word, c), totals, the top of the trees and the broadcast tables."""

    def __init__(self, spark, grams, words, top, n_tokens, n_types):
        self.spark, self.grams, self.words = spark, grams, words
        self.n_tokens, self.n_types = n_tokens, n_types
        self.top = spark.sparkContext.broadcast(top)

    def base_lp(self, c) -> Column:
        return F.log10((c + F.lit(.5)) / F.lit(self.n_tokens + .5 * (self.n_types + 1)))


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count grams and words of all texts of ``docs`` and weigh the context trees.

    Two passes over the counts, none over the texts beyond the first. An
    empty table gives a model that predicts every bit with 1/2.
    """
    spark = docs.sparkSession
    counts = C.stored(docs.select(F.col(text).alias("text")).mapInArrow(_count, C.struct(_COUNTS)))
    words = C.stored(counts.filter("word is not null").groupBy("word").agg(F.sum("n").alias("c")))
    n_words, n_types = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_docs = docs.count()
    grams = C.stored(counts.filter("code is not null").select("code", "n", _ctx2(F.col("code")).alias("ctx2"))
                     .repartition("ctx2").groupBy("ctx2", "code").agg(F.sum("n").alias("n")))
    parts = grams.repartition("ctx2").select("code", "n")
    # at most 256 * 255 rows: one for each depth-1 context and decision
    rows = (parts.mapInArrow(_to_top, C.struct(_TOP)).groupBy("key")
            .agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("child").alias("child")).toArrow().sort_by("key"))
    top = Top(rows["key"].to_numpy().astype(np.uint64), *(rows[c].to_numpy() for c in ("a", "b", "child")))
    m = Model(spark, grams, words, top, n_words + n_docs, n_types + (n_docs > 0))
    m.n_docs = n_docs
    m.scored = C.stored(parts.mapInArrow(_predictor(m.top), C.struct(_LP)))
    return m


def _most_frequent(df: DataFrame, n: str, limit: int) -> DataFrame:
    """The rows of the largest counts, ``limit`` at most: whole classes of a count histogram (some 1,000 classes)."""
    cls = F.floor(F.log2(F.col(n)) * 16)
    hist = df.groupBy(cls.alias("k")).count().orderBy(F.desc("k")).collect()
    total, low = 0, None
    for r in hist:
        if total + r[1] > limit:
            break
        total, low = total + r[1], r[0]
    return df.filter(cls >= low) if low is not None else df.limit(0)


class _Slots:
    """Open addressing over the local grams; built once in each Python worker."""

    def __init__(self, code: np.ndarray, lp: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(len(code) * 4).bit_length()))
        self.code, self.lp = code, lp
        self.slot = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        at, left = self.hash(code), np.arange(len(code), dtype=np.int32)
        while len(left):
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]          # of several for one slot, the last stays
            again = self.slot[at] != left
            left, at = left[again], (at[again] + 1) & (len(self.slot) - 1)

    def hash(self, code):
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, q: np.ndarray) -> np.ndarray:
        """log10 probabilities, nan for codes that aren't there."""
        if not len(self.code):
            return np.full(len(q), np.nan)
        at = self.hash(q)
        i = self.slot[at]
        out = np.where(i >= 0, self.lp[i], np.nan)
        miss = np.flatnonzero((i >= 0) & (self.code[i] != q))
        while len(miss):
            at_m = (at[miss] + 1) & (len(self.slot) - 1)
            at[miss] = at_m
            i = self.slot[at_m]
            out[miss] = np.where(i >= 0, self.lp[i], np.nan)
            miss = miss[(i >= 0) & (self.code[i] != q[miss])]
        return out


class _Local:
    """The broadcast tables in the form that a Python worker looks them up in, made once a worker."""

    held: tuple = (None,)

    @classmethod
    def of(cls, key, grams_b, words_b):
        if cls.held[0] != key:
            cls.held = (None,)
            t = words_b.value
            cls.held = (key, _Slots(*grams_b.value), dict(zip(t["word"].to_pylist(), t["lp"].to_pylist())))
        return cls.held[1:]


_PART = "uid long, doc_id long, held boolean, n_tokens long, n_known long, base double, score double, word binary, code long, n long"


def _scorer(key, grams_b, words_b, end_lp: float, end_known: int):
    schema = C.arrow(_PART)

    def run(batches):
        slots, words = _Local.of(key, grams_b, words_b)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            held = batch.column(batch.schema.get_field_index("held"))
            for at, to, data, off in C.blocks(batch, "text", 1 << 20):
                n = to - at
                codes, start = _codes(data, off)
                lp = slots.find(codes)
                unknown = np.isnan(lp)
                lp[unknown] = 0
                score = np.add.reduceat(lp, start[:-1])
                where = np.flatnonzero(unknown)
                doc = np.searchsorted(start, where, "right") - 1
                raw = data.tobytes().lower()
                tokens, known, base = np.ones(n, np.int64), np.full(n, end_known), np.full(n, end_lp)
                w_uid, w_word, w_n = [], [], []
                for i in range(n):
                    t = raw[off[i]: off[i + 1]].split()
                    v = [words[x] for x in t if x in words]
                    tokens[i] += len(t)
                    known[i] += len(v)
                    base[i] += math.fsum(v)
                    if len(v) < len(t):
                        c = Counter([x for x in t if x not in words])
                        w_word.extend(c)
                        w_n.extend(c.values())
                        w_uid.extend([uid + i] * len(c))
                z = pa.nulls
                yield C.out_batch(schema, uid=uid + np.arange(n), doc_id=ids.slice(at, n), held=held.slice(at, n),
                                  n_tokens=tokens, n_known=known, base=base, score=score,
                                  word=z(n, pa.binary()), code=z(n, pa.int64()), n=np.diff(off))
                for u, w, c, k in ((np.array(w_uid, np.int64), w_word, None, w_n),
                                   (uid + doc, None, codes[where].astype(np.int64), np.ones(len(where), np.int64))):
                    m = len(u)
                    if m:
                        yield C.out_batch(schema, uid=u, doc_id=z(m, pa.int64()), held=z(m, pa.bool_()),
                                          n_tokens=z(m, pa.int64()), n_known=z(m, pa.int64()),
                                          base=z(m, pa.float64()), score=z(m, pa.float64()),
                                          word=z(m, pa.binary()) if w is None else w,
                                          code=z(m, pa.int64()) if c is None else c, n=k)
                uid += n
    return run


def score(model: Model, docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
          held: Column | None = None) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_bytes, bits_per_byte.

    ``bits_per_byte`` is the code length: bits for the text's ``n_bytes`` UTF-8 bytes and the end mark, over these and the mark.

    Null text is empty (one end mark is scored); rows with the same or a null
    id stay rows of their own.
    """
    spark = model.spark
    sc = spark.sparkContext
    local = _most_frequent(model.scored, "n", LOCAL_GRAMS).select("code", "lp").toArrow()
    grams_b = sc.broadcast((local["code"].to_numpy().astype(np.uint64), local["lp"].to_numpy()))
    frequent = _most_frequent(model.words, "c", LOCAL_WORDS).select("word", model.base_lp(F.col("c")).alias("lp"))
    words_b = sc.broadcast(frequent.toArrow())
    end_lp = math.log10((model.n_docs + .5) / (model.n_tokens + .5 * (model.n_types + 1)))
    d = docs.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("doc_id"),
                    (F.lit(False) if held is None else held).alias("held"))
    parts = C.stored(d.mapInArrow(_scorer(uuid.uuid4().hex, grams_b, words_b, end_lp, int(model.n_docs > 0)), C.struct(_PART)))

    # words outside the local table: counted ones are known, the rest have c = 0
    rest = (parts.filter("word is not null").select("uid", "word", "n")
            .join(model.words, "word", "left")
            .select("uid", F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0).alias("n_known"),
                    (F.col("n") * model.base_lp(F.coalesce("c", F.lit(0)))).alias("base")))
    # grams outside the local table: asked of the trees once each
    far = parts.filter("code is not null").select("uid", "code")
    asked = far.groupBy("code").agg(F.lit(0).cast("long").alias("n"))
    both = (model.grams.select("code", "n").unionByName(asked)
            .repartition(_ctx2(F.col("code"))))
    lp = both.mapInArrow(_asked_only(model.top), C.struct(_LP)).select("code", "lp")
    far = far.join(lp, "code").select("uid", F.col("lp").alias("score"))
    zero, none = F.lit(0).cast("long"), F.lit(None)
    rows = (parts.filter("n_tokens is not null")
            .select("uid", "doc_id", "held", "n_tokens", "n_known", "base", "score", F.col("n").alias("n_bytes"))
            .unionByName(rest.groupBy("uid").agg(F.sum("n_known").alias("n_known"), F.sum("base").alias("base"))
                         .select("uid", none.cast("long").alias("doc_id"), none.cast("boolean").alias("held"),
                                 zero.alias("n_tokens"), F.col("n_known").cast("long").alias("n_known"), "base",
                                 F.lit(0.).alias("score"), zero.alias("n_bytes")))
            .unionByName(far.groupBy("uid").agg(F.sum("score").alias("score"))
                         .select("uid", none.cast("long").alias("doc_id"), none.cast("boolean").alias("held"),
                                 zero.alias("n_tokens"), zero.alias("n_known"), F.lit(0.).alias("base"), "score", zero.alias("n_bytes"))))
    return (rows.groupBy("uid")
            .agg(F.max("doc_id").alias("doc_id"), F.max("held").alias("held_out"),
                 F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
                 F.sum("base").alias("base_score"), F.sum("score").alias("score"), F.sum("n_bytes").alias("n_bytes"))
            .select("doc_id", "held_out", "n_tokens", "n_known",
                    F.lit(int(model.n_tokens)).cast("long").alias("train_tokens"), "base_score", "score", "n_bytes",
                    (F.col("score") * F.lit(-math.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte")))


def _asked_only(top_b):
    run = _predictor(top_b)

    def only(batches):
        code, n = _read(batches)
        if (n == 0).any():
            yield from run([pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n)], names=["code", "n"])])
    return only


def op1_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents; learn from those whose crc32(doc_id) mod 5 is not 1."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = C.crc_mod(F.col("doc_id"), 5) == 1
    return score(train(docs.filter(~held)), docs, held=held)
