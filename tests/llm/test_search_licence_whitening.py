"""Ranked search, licence scans and whitening against brute force, and their edge rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import licences, ranked, whitening

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, row long, m long, term string, key long, tf int, block long"
ROWS = [(1, "the cat sat on the mat"), (2, "the cat sat on the mat"), (2, "the cat sat on the mat"), (3, None), (4, ""),
        (5, "?!,. \n"), (None, "the cat sat on the mat"), (7, "Cat " * 20000 + "é日本"), (8, "dog"), (9, "a MIT-License, apache\nlicense")]
ASK = [(1, "cat mat mat"), (2, None), (3, "zebra"), (4, "THE dog é日本"), (4, "THE dog é日本"), (None, "license")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 0, 0, "x", 0, 0, 0) for r in ROWS], DOCS).cache()


# ---------------------------------------------------------------- 11

def _terms(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def _brute_search(rows, items, k):
    rows = [(i, Counter(_terms(t))) for i, t in rows]
    rows = [r for r in rows if r[1]]
    n, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in rows:
            m = 75 + (25 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in _terms(text) if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r + 1, f[2], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("k,docs_a_block", [(2, 8192), (20, 2)])
def test_search_equals_scoring_every_row(spark, docs, monkeypatch, k, docs_a_block):
    monkeypatch.setattr(ranked, "DOCS", docs_a_block)
    monkeypatch.setattr(ranked, "ITEMS", docs_a_block)
    ask = spark.createDataFrame([(*a, 0) for a in ASK], "item_id long, text string, row long")
    got = ranked.search(ranked.build(docs), ask, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == _brute_search(ROWS, ASK, k)


def test_search_of_empty_tables(spark, docs):
    ask = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert ranked.search(ranked.build(docs.limit(0)), ask).count() == 0
    assert ranked.search(ranked.build(docs.filter("doc_id = 3")), ask).count() == 0
    assert ranked.search(ranked.build(docs), ask.limit(0)).count() == 0


def test_index_holds_every_term_of_every_document(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter()
    ids = {}
    rows = ranked.build(d).postings.collect()
    for r in rows:
        if r.term is None:
            ids[r.key] = r.ids
    assert sum(r.term is None for r in rows) == len(ids)
    for r in rows:
        if r.term is not None:
            got.update({(ids[r.key][p], r.term): r.tf for p in r.docs})
    want = Counter((r.doc_id, t) for r in d.collect() for t in _terms(r.text))
    assert got == want


def test_terms_do_not_cross_texts():
    data = np.frombuffer("ab1cdé".encode(), np.uint8)
    low, start, end, doc = ranked._terms(data, np.array([0, 2, 2, 5, 7]))
    assert [bytes(low[a:b]).decode() for a, b in zip(start, end)] == ["ab", "1cd", "é"] and doc.tolist() == [0, 2, 3]


# ---------------------------------------------------------------- 12

def _brute_base(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = sorted((i, label) for phrase, label in licences.BASE.items() for i in range(len(words))
                if words[i:i + len(phrase.split())] == phrase.split())
    return (len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None,
            ",".join(sorted({label for _, label in at})))


def test_base_places_equal_brute_force(spark, docs):
    odd = ["mit license mit license", "MIT_license", "xmit license", "mit licenses", "GNU General\n\tPublic--License é",
           "general public license, version 2; Apache License; mit license", "mitlicense mit", "mit license"]
    some = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    rows = ROWS + [(100 + i, t) for i, t in enumerate(odd)] + some
    d = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, labels string, score string")
    got = sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels)
                 for r in licences.licences(d).collect())
    assert got == sorted((str(i), b[0], b[1], str(b[2]), str(b[3]), b[4]) for i, t in rows for b in [_brute_base(t)])
    assert licences.licences(d.limit(0)).count() == 0


def _scan(text):
    return licences.scan(text.encode(), licences.automaton())


@pytest.mark.parametrize("expression,want,labels,free", [
    ("MIT", "mit", "mit", 0.9),
    ("GPL-2.0-only OR MIT AND Zlib", "(gpl-2.0-only OR (mit AND zlib))", "gpl-2.0-only,mit,zlib", 0.9),
    ("(GPL-2.0 OR MIT) AND CC-BY-NC-4.0", "((gpl-2.0 OR mit) AND cc-by-nc-4.0)", "cc-by-nc-4.0,gpl-2.0,mit", 0.2),
    ("GPL-2.0+ WITH Classpath-exception-2.0 AND MIT", "((gpl-2.0+ WITH classpath-exception-2.0) AND mit)", "gpl-2.0+,mit", 0.5),
    ("MIT OR", "mit", "mit", 0.9), ("MIT) AND ISC", "mit", "mit", 0.9), ("((MIT OR ISC", "(mit OR isc)", "isc,mit", 0.9),
    ("LicenseRef-own", "licenseref-own", "licenseref-own", 0.5), ("MIT ISC", "mit", "mit", 0.9),
    ("(MIT\n // OR ISC)", "(mit OR isc)", "isc,mit", 0.9), ("MIT\nAND ISC", "mit", "mit", 0.9),
])
def test_expressions(expression, want, labels, free):
    got = _scan(f"// SPDX-License-Identifier: {expression}\n")
    assert (got["expressions"], got["labels"], got["n_base"]) == (want, labels, 0)
    assert math.isclose(got["openness"], free) and math.isclose(got["score"], 0.95)


@pytest.mark.parametrize("text,labels,expressions", [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0", "cc-by-nc-4.0"),
    ("This work is licensed under the GNU General Public License, version 3 of the License, or (at your option) any later version.",
     "gpl,gpl-3.0-or-later", "gpl-3.0-or-later"),
    ("Use it under the MIT License or the Apache License, Version 2.0.", "apache,apache-2.0,mit", "(mit OR apache-2.0)"),
    ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1", "lgpl-2.1"),
    ("The MIT License. Another thing. Apache License", "apache,mit", "mit; apache"),
    ("SPDX-License-Identifier without a colon", "", ""), ("a licence of ours", "", ""), ("", "", ""),
])
def test_notices(text, labels, expressions):
    got = _scan(text)
    assert (got["labels"], got["expressions"]) == (labels, expressions)
    assert (got["score"] > 0) == bool(labels) and 0 <= got["score"] <= 1


def test_hostile_texts_take_linear_time():
    import time
    t = time.time()
    for part in ("spdx-license-identifier: (", "mit license or ", "spdx-license-identifier: mit or ", "(mit ", "cc by "):
        _scan(part * (600_000 // len(part)))
    _scan("SPDX-License-Identifier: " + "(" * 200_000 + "mit" + " or mit)" * 100_000)
    assert time.time() - t < 60


# ---------------------------------------------------------------- 13

def _table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, 0) for i, v in rows],
                                 "vec_id long, embedding array<double>, component int, n int")


def _brute_whiten(vectors):
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    y = x - s / n
    v = y.T @ y / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1], p[:, ::-1]
    return ((n * x - s) ** 2).sum(1), y @ p / np.sqrt(e), e / np.trace(v)


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(5)
    v = (rng.standard_normal((400, 40)) * np.geomspace(30, 0.1, 40)) @ np.linalg.qr(rng.standard_normal((40, 40)))[0]
    bad = [(900, None), (901, [1.0] * 39 + [None]), (902, [math.nan] * 40), (903, [math.inf] + [0.0] * 39)]
    got = whitening.whiten(_table(spark, [(i, r) for i, r in enumerate(v.tolist())] + bad)).toPandas()
    dev, w, share = _brute_whiten(v)
    assert len(got) == 400 * 32 and set(got.n) == {400} and got.identity_error.nunique() == 1
    assert got.identity_error.max() < 1e-9
    got = got.sort_values(["vec_id", "component"])
    assert got.deviation.to_numpy().reshape(400, 32)[:, 0].tolist() == dev.tolist()
    mine = got.whitened.to_numpy().reshape(400, 32)
    sign = np.sign((mine * w[:, :32]).sum(0))
    assert np.allclose(mine * sign, w[:, :32], atol=1e-7)
    assert np.allclose(got.explained.to_numpy().reshape(400, 32)[7], share[:32], rtol=1e-9)


def test_whitening_edge_tables(spark):
    one = _table(spark, [(1, [1.0, 2.0])])
    assert whitening.whiten(one).count() == 0 and whitening.whiten(one.limit(0)).count() == 0
    # rank 1 of 3, repeated rows, a null id, and vectors of another length with a fit of their own
    rows = [(1, [1, 2, 3]), (1, [1, 2, 3]), (None, [2, 4, 6]), (4, [0, 0, 0]), (5, [1, 0]), (6, [0, 1]), (7, [1, 1]), (8, [0, 0]), (9, [])]
    got = whitening.whiten(_table(spark, rows)).toPandas()
    assert sorted(got.groupby("n").size().items()) == [(4, 4 + 8)] and len(got[got.vec_id.isna()]) == 1
    assert got.identity_error.max() < 1e-9


def test_deviation_is_exact_or_null():
    f = whitening.Fit(3, np.array([0, 0]))
    big = np.array([[2 ** 30, 1], [3, 4], [2 ** 31, 2 ** 31]], np.int64)
    want = [(3 * a) ** 2 + (3 * b) ** 2 for a, b in big.tolist()]
    assert whitening._deviation(f, big).to_pylist() == [w if w < 2 ** 63 else None for w in want]


@pytest.mark.parametrize("case", ["random", "repeated", "clustered", "diagonal", "indefinite"])
def test_slicing_and_counts(case):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    e = {"random": rng.uniform(1, 9, 24), "repeated": np.array([5.0] * 4 + [3.0] * 3 + [1.0] * 17),
         "clustered": 4 + np.arange(24) * 1e-9, "diagonal": np.arange(24.0), "indefinite": rng.standard_normal(24)}[case]
    v = np.diag(e) if case == "diagonal" else (q * e) @ q.T
    v = (v + v.T) / 2
    for s in (-1.0, 0.5, 2.0, 4.5):
        assert whitening.inertia(v - s * np.eye(24)) == ((e > s).sum(), (e < s).sum())
    if case == "indefinite":
        return
    values, vectors = whitening.leading(v, 16)
    assert np.allclose(values, np.sort(e)[::-1][:16], atol=1e-12 * 24)
    assert np.abs(vectors @ vectors.T - np.eye(16)).max() < (1e-5 if case == "clustered" else 1e-9)
    assert np.abs(vectors @ v - values[:, None] * vectors).max() < 1e-12


def test_queries_over_whole_tables(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = whitening.op13_spectrum_slices(spark, SF)
    d = e.select(F.size("embedding")).first()[0]
    assert got.count() == e.count() * min(32, d) and got.agg(F.max("identity_error")).first()[0] < 1e-6
    got = licences.op12_licence_expressions(spark, "/root/testdata/sf0.01")
    assert got.count() == 1000 and got.filter("n_base > 0 and base_labels = ''").count() == 0
