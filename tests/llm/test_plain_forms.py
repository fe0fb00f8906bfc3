"""Whole results against plain Python forms, and edge rows of the stages, pages and vectors."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tidemark.llm import common as C, language, mincut, mixing, multi_index, packing, pii

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, key long, rep long, _row long, _group long"
ROWS = [(1, "one two three four five six seven", "en", "a"), (2, "one two three four five six seven", "en", "a"),
        (2, "one two three four five six seven", "en", "a"), (3, None, None, None), (4, "", "en", "a"), (None, " \t\n", None, "b"),
        (5, "word", "de", None), (6, "mail a.b@c.org, 4111 1111 1111 1111 +1 (743) 555-3824 é 1.2.3.4", "en", "b"),
        (7, "x y z " * 30000, "en", "a")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, 0, 0, 0, 0, 0) for r in ROWS], SCHEMA).cache()


def _stage(spark, name, d):
    out = dict(P.STAGES)[name](spark, d, SF)
    assert name == "pack" or out.columns == C.DOC_COLS
    return out.collect()


# ---------------------------------------------------------------- stages: nulls, empty and long texts, repeated rows, clashing names

@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_on_empty_tables(spark, edge, name):
    assert _stage(spark, name, edge.limit(0)) == []


def test_quality_stage_drops_short_and_repeating_texts(spark, edge):
    assert _stage(spark, "quality", edge) == []                   # all have under 50 words or repeat themselves


def test_near_duplicate_stage_keeps_one_of_each_group(spark, edge):
    assert Counter(r.doc_id for r in _stage(spark, "near_duplicates", edge)) == Counter([1, 3, 4, None, 5, 6, 7])


def test_personal_data_stage_keeps_every_row(spark, edge):
    out = _stage(spark, "personal_data", edge)
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in ROWS)
    by = {r.doc_id: r for r in out}
    assert by[3].text is None and by[6].text == "mail [EMAIL], [CARD] [PHONE] é [IP]" and by[6].n_chars == len(by[6].text)
    assert by[7].text == ROWS[-1][1]


def test_mix_stage_repeats_no_document_more_than_three_times(spark, edge):
    n = Counter(r.doc_id for r in _stage(spark, "mix", edge))
    assert n[3] == n[4] == n[None] == 0 and all(k <= 3 * (2 if i == 2 else 1) for i, k in n.items())


def test_pack_stage_holds_every_token(spark, edge):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    want = Counter()
    for i, t, *_ in ROWS:
        want[i] += len(whole.encode(t or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in _stage(spark, "pack", edge):
        got[r.doc_id] += r.length
    assert got == want


# ---------------------------------------------------------------- pages and vectors

def test_pages_of_any_kind(spark):
    long = "<article>" + "<p>A paragraph of this article that has some words in it.</p>" * 3000 + "</article>"
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, "v", long), (3, "w", long), (3, "w", long), (4, "x", "<<>"), (5, "y", "\x00 &#0; <p")]
    d = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars long")
    got = mincut.main_text(d).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((r[0], r[1]) for r in rows)
    assert all(r.n_chars == len(r.text) for r in got) and all(r.text == "" for r in got if r.page_id in (1, None))
    assert all(r.text.count("A paragraph") == 3000 for r in got if r.page_id in (2, 3))
    assert mincut.main_text(d.limit(0)).count() == 0


def test_vectors_of_any_kind(spark):
    v = [1.0, 0.0, 0.0, 0.0]
    rows = [(1, v), (1, v), (2, [2.0, 0, 0, 0]), (None, v), (3, None), (4, []), (5, [0.0] * 4), (6, [float("inf"), 1, 1, 1]), (7, [1.0, None, 0, 0]),
            (8, [0, 1.0, 0, 0]), (9, [1.0]), (10, [1e300, 0, 0, 0]), (11, [0.9, 19 ** .5 / 10, 0, 0]), (12, [0.0, 0.0, -5.0, 0.0])]
    d = spark.createDataFrame([(i, x and [c if c is None else float(c) for c in x], 0, 0, 0, 0) for i, x in rows], "vec_id long, embedding array<double>, rep long, home long, cell long, seen long")
    got = multi_index.near_duplicates(d).collect()
    assert Counter(r.vec_id for r in got) == Counter(r[0] for r in rows)
    same = [r for r in got if r.vec_id in (1, 2, None, 10)]
    assert len(same) == 5 and all(r.n_links in (4, 5) and r.component_id == 1 for r in same)    # 11 lies at 0.9, on either side of rounding
    assert all(r.n_links == 0 and r.component_id == r.vec_id and r.kept for r in got if r.vec_id in (3, 4, 5, 6, 7, 8, 9, 12))
    assert multi_index.near_duplicates(d.limit(0)).count() == 0


# ---------------------------------------------------------------- 2: the mix by walking its schedule

def test_mix_equals_walking_the_schedule(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.expr("if(doc_id % 9 = 0, 'tiny', if(doc_id % 7 = 0, null, 'big'))"))
    m = mixing.mix(d)
    docs = sorted(m.docs.collect(), key=lambda r: (r.key, r.doc_id, r["size"]))
    assert len(docs) <= C.PER_BUCKET                                  # one bucket a source, so its order is that of the keys
    size = [sum(r["size"] for r in docs if r.src == s["src"]) for s in m.sources]
    assert [s["source"] for s in m.sources] == ["big", "tiny", None] and size == [s["source_size"] for s in m.sources]
    target = mixing.targets(size, [1.0, 2.0, 3.0])
    edges, slots = np.cumsum(target) / sum(target), Counter()
    for s in range(int(-(-sum(target) // m.block))):
        slots[next(i for i, e in enumerate([*edges[:-1], 2.0]) if (s + 1) * mixing.GOLDEN % 2 ** 32 / 2 ** 32 < e)] += 1
    want = defaultdict(int)
    for src in range(3):
        left = slots[src] * m.block                                   # the source's blocks are its first words, repeated
        for _ in range(mixing.MOST):
            for r in (r for r in docs if r.src == src):
                n = min(left, r["size"])
                want[r.doc_id] += n
                left -= n
        assert abs(slots[src] * m.block - target[src]) < 8 * m.block      # what the filter on lo allows for
    assert {r.doc_id: r.taken for r in mixing.taken(m).collect()} == {r.doc_id: want[r.doc_id] for r in docs}


# ---------------------------------------------------------------- 3: whole texts through the tokenizers library

def test_ids_of_whole_texts_equal_tokenizers(spark):
    from tokenizers import Tokenizer
    whole, own = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json")), packing.Tokens(packing.tokenizer_path())
    rng = random.Random(8)
    alphabet = [chr(c) for c in (*range(128), 0xa0, 0x85, 0xe9, 0x301, 0x2028, 0x3000, 0x65e5, 0x1f600, 0x200d, 0x0416, 0x5d0)]
    odd = ["", " ", "\n\n  \n", "a" * 50_000, " " * 20_000, "ab " * 20_000, "é日本" * 5_000, "<|endoftext|>" * 50, "1234567890" * 2_000,
           *("".join(rng.choices(alphabet, k=20_000)) for _ in range(5))]
    texts = odd + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for t in texts:
        assert np.frombuffer(own.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


# ---------------------------------------------------------------- 10: predictions by dictionaries

def test_predictions_equal_plain_counts(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language.train(d)
    rows = [(r.doc_id, r.text) for r in d.limit(40).collect()] + [(90001, None), (90002, "12 !"), (90003, "é"), (90004, "A" * 300), (90005, "")]
    got = {r.doc_id: r for r in language.predict(model, spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()}
    for i, t in rows:
        if not any(c.isalpha() for c in t or ""):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        b = [x + 32 if 65 <= x <= 90 else x for x in t.encode()]
        n = Counter(b)
        n.update(256 + ((x * 257 + y) * 2654435761 >> 9) % (language.DIMS - 256) for x, y in zip(b, b[1:]))
        n.update(256 + (((x * 257 + y) * 263 + z) * 40503 * 65537 >> 9) % (language.DIMS - 256) for x, y, z in zip(b, b[1:], b[2:]))
        w = {k: np.log1p(c) * model.idf[k] for k, c in n.items()}
        length = sum(x * x for x in w.values()) ** .5
        cos = [sum(x * float(c[k]) for k, x in w.items()) / length for c in model.c]
        assert got[i].lang_pred in {model.langs[k] for k in range(len(cos)) if cos[k] > max(cos) - 1e-5}
        assert abs(got[i].score - min(1, max(0, max(cos)))) < 1e-4
