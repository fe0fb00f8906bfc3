"""Minimum covariance determinant against NumPy on small groups, and the verdict against its distances."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import outliers as O

K = len(O.STATS)


def _rows(seed, n, bad):
    rng = np.random.default_rng(seed)
    mix = np.tril(rng.uniform(-1, 1, (K, K))) + 2 * np.eye(K)
    x = rng.standard_normal((n, K)) @ mix.T + rng.uniform(-5, 5, K)
    x[:bad] += rng.uniform(15, 25, K)
    return x


def _step(x, m, l, inflate):
    y = np.linalg.solve(l, (x - m).T)
    d = (y ** 2).sum(0)
    h = np.sort(d)[int(np.ceil(O.COVER * len(x))) - 1]
    core = x[d <= h]
    c = np.atleast_2d(np.cov(core.T, bias=True)) * inflate + np.diag(np.square(O.FLOOR))
    return core.mean(0), np.linalg.cholesky(c), np.linalg.slogdet(c)[1]


def _starts(x):
    q = [np.sort(x, 0)[int(np.ceil(p * len(x))) - 1] for p in (.25, .5, .75)]
    s = np.sqrt(((q[2] - q[0]) / 1.349) ** 2 + np.square(O.FLOOR))
    z = (x - q[1]) / s
    with np.errstate(invalid="ignore"):
        u = z / np.sqrt((z ** 2).sum(1, keepdims=True))
    for a in (None, np.tanh(z), u):
        if a is not None and not np.isfinite(a).all():
            continue                              # a group of one point has no directions
        r = np.eye(K) if a is None else (a.T @ a) / np.sqrt(np.outer((a ** 2).sum(0), (a ** 2).sum(0)))
        yield q[1], np.linalg.cholesky(r * np.outer(s, s) + np.diag(np.square(O.FLOOR)))


def _numpy_mcd(x):
    inflate = O.consistency(O.COVER, K)
    best = None
    for m, l in _starts(x):
        det = np.inf
        while True:
            new = _step(x, m, l, inflate)
            gain = det - new[2]
            if new[2] < det:
                m, l, det = new
            if not gain > 0.001:
                break
        if best is None or det < best[2]:
            best = (m, l, det)
    return best


def test_mcd_equals_numpy(spark):
    groups = {"a": _rows(1, 200, 30), "b": _rows(2, 77, 10), "c": np.repeat(_rows(3, 60, 0), 3, axis=0), "same": np.ones((50, K))}
    d = spark.createDataFrame([(g, *map(float, r)) for g, x in groups.items() for r in x], ["g", *O.STATS])
    got = {r.g: r for r in O.mcd(d, "g").collect()}
    assert set(got) == set(groups)
    for g, x in groups.items():
        m, l, det = _numpy_mcd(x)
        mine = np.array([[got[g][f"l_{i}_{j}"] if j <= i else 0 for j in range(K)] for i in range(K)])
        assert np.allclose([got[g][f"m_{i}"] for i in range(K)], m) and np.isclose(got[g].logdet, det)
        assert np.allclose(mine, l, atol=1e-9)
        y = np.linalg.solve(l, (x - m).T)
        e = spark.createDataFrame([tuple(map(float, r)) for r in x], O.STATS).crossJoin(
            spark.createDataFrame([got[g]])) if g == "b" else None
        if e is not None:
            assert np.allclose(sorted(r._d2 for r in O._distance(e, "_d2").collect()), np.sort((y ** 2).sum(0)))
            assert ((y ** 2).sum(0)[:10] > O.CUT).all() and ((y ** 2).sum(0)[10:] < O.CUT).all()


def test_consistency_factor():
    x = np.random.default_rng(0).standard_normal((400_000, 5))
    d = (x ** 2).sum(1)
    core = x[d <= np.quantile(d, .75)]
    assert abs(O.consistency(.75, 5) * core.var() - 1) < 0.01 and abs(O.consistency(.75, 5) - 1.414) < 0.002


def test_verdict_follows_distances_and_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = O.op7_mcd_outliers(spark, sf)
    assert got.filter("kept != coalesce(not base_failed and distance2 <= %f, false)" % O.CUT).count() == 0
    lab = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert lab.filter("quality = 1 and not base_failed and not kept").count() == 0
    assert lab.filter("quality = 0 and kept").count() == 0
    assert got.filter(F.col("base_failed") & F.col("kept")).count() == 0


def test_steps_and_rounds_have_small_plans(spark, monkeypatch):
    """A concentration step doesn't join the groups to the rows again, and a round of components is one star a plan."""
    from pyspark.sql import functions as F
    from tidemark.llm import common as C
    plans, plain = [], C.stored
    monkeypatch.setattr(C, "stored", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), plain(df))[1])
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
                                   F.expr("array_join(transform(sequence(1, 60 + id % 7), i -> concat('w', (i * (id + 3)) % 101)), ' ')").alias("text"))
    O.judge(docs, ["doc_id"]).collect()
    steps = [p for p in plans if "_d2" in p]
    assert len(steps) > 3 and not any("Generate explode" in p for p in steps)
    plans.clear()
    edges = spark.createDataFrame([(1, 2), (2, 3), (4, 3), (7, 8), (9, 9)], "a long, b long")
    got = {tuple(r) for r in C.components(edges).select("id", "component").collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7)}
    assert all(p.count("FileScan") <= 2 and p.count("Join ") <= 1 for p in plans)
