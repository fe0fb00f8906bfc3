"""Second-order trees against a NumPy brute force; staged AUC and patience."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import newton as NT

FEATURES = ["a", "b", "c", "d"]


def _table(n=400, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([np.round(rng.normal(size=n), 4), rng.integers(0, 3, n).astype(float), np.round(rng.exponential(size=n), 2),
                  rng.integers(0, 2, n).astype(float)], 1)
    x[rng.random(n) < 0.05, 2] = np.nan
    z = 1.5 * x[:, 0] + (x[:, 1] == 2) - np.nan_to_num(x[:, 2]) + rng.normal(size=n)
    y = (z > 0.3).astype(int)
    split = np.where(np.arange(n) % 5 == 4, "validation", np.where(np.arange(n) % 11 == 0, "test", "train"))
    return x, y, split


def _frame(spark, x, y, split):
    rows = [(f"k{i}", *[None if (math.isnan(v) and i % 2) else float(v) for v in r], int(t), str(s))
            for i, (r, t, s) in enumerate(zip(x, y, split))]
    return spark.createDataFrame(rows, "subscriber_id string, a double, b double, c double, d double, churned_30d int, split string")


def _units(x):
    return np.where(np.isnan(x), NT.MISSING, np.nan_to_num(np.floor(np.abs(x) * NT.SCALE + 0.5) * np.sign(x))).astype(np.int64)


def _cuts(x, bins):
    out = []
    for f in range(x.shape[1]):
        v = np.sort(x[:, f])
        qs = {int(v[max(1, -(-len(v) * k // bins)) - 1]) for k in range(1, bins)}
        out.append(sorted(q for q in qs if q < v[-1]))
    return out


def _brute_tree(x, g, h, cuts, features, p):
    """Every split of every node tried on the rows themselves."""
    tree, todo = {}, [(0, np.arange(len(g)), 0)]
    gain_of = lambda a, b: a * a / (b + p.ridge)
    while todo:
        i, rows, depth = todo.pop(0)
        gt, ht = int(g[rows].sum()), int(h[rows].sum())
        tree[i] = [-p.rate * (gt / NT.UNIT) / (ht / NT.UNIT + p.ridge), -1, 0]
        if depth == p.depth:
            continue
        best = None
        for f, c in ((f, c) for f in features for c in cuts[f]):
            left = rows[x[rows, f] <= c]
            gl, hl = int(g[left].sum()), int(h[left].sum())
            if min(hl, ht - hl) < int(p.least_hessian * NT.UNIT):
                continue
            u = NT.UNIT
            gain = (gain_of(gl / u, hl / u) + gain_of((gt / u - gl / u), (ht / u - hl / u)) - gain_of(gt / u, ht / u)) / 2
            if gain > 1e-9 and (best is None or gain > best[0]):
                best = (gain, f, c)
        if best:
            tree[i][1:] = best[1:]
            low = x[rows, best[1]] <= best[2]
            todo += [(2 * i + 1, rows[low], depth + 1), (2 * i + 2, rows[~low], depth + 1)]
    return tree


def _brute_value(tree, row):
    i = 0
    while tree[i][1] >= 0:
        i = 2 * i + (1 if row[tree[i][1]] <= tree[i][2] else 2)
    return tree[i][0]


def _auc(y, s):
    won = sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(s[y == 1], s[y == 0]))
    return won / ((y == 1).sum() * (y == 0).sum())


@pytest.fixture(scope="module")
def trained(spark):
    x, y, split = _table()
    p = NT.Params(trees=8, depth=3, rate=0.4, row_share=1.0, column_share=0.75, bins=8, patience=50, block=3)
    return x, y, split, p, NT.train(_frame(spark, x, y, split), FEATURES, p)


def test_trees_equal_brute_force(trained):
    x, y, split, p, model = trained
    u = _units(x)
    fit, watch = split == "train", split == "validation"
    cuts = _cuts(u[fit], p.bins)
    z, zv, stages = np.zeros(fit.sum()), np.zeros(watch.sum()), []
    trees = []
    for t in range(p.trees):
        pr = 1 / (1 + np.exp(-z))
        w = np.where(y[fit] == 1, p.positive_weight, 1.0)
        g = np.floor(np.abs(w * (pr - y[fit]) * NT.UNIT) + 0.5) * np.sign(pr - y[fit])
        h = np.floor(w * pr * (1 - pr) * NT.UNIT + 0.5)
        tree = _brute_tree(u[fit], g.astype(np.int64), h.astype(np.int64), cuts, NT.sampled_features(p, t, 4), p)
        trees.append(tree)
        z = z + np.array([_brute_value(tree, r) for r in u[fit]])
        zv = zv + np.array([_brute_value(tree, r) for r in u[watch]])
        stages.append(_auc(y[watch], zv))
    assert np.allclose(model.stages, stages, atol=1e-12)
    assert model.kept == int(np.argmax(np.round(stages, 12))) + 1
    for mine, want in zip(model.trees, trees):
        assert {i: (n.feature, n.cut) for i, n in mine.items()} == {i: (n[1], n[2]) for i, n in want.items()}
        assert all(abs(n.value - want[i][0]) < 1e-6 for i, n in mine.items())


def test_scores_and_storage(spark, trained, tmp_dir):
    x, y, split, p, model = trained
    df = _frame(spark, x, y, split)
    got = {r.subscriber_id: r.probability for r in NT.score(df, model).collect()}
    u = _units(x)
    flat = [{i: [n.value, n.feature, n.cut] for i, n in t.items()} for t in model.trees]
    for i in range(0, 400, 37):
        m = sum(_brute_value(t, u[i]) for t in flat)
        assert abs(got[f"k{i}"] - 1 / (1 + math.exp(-m))) < 1e-12
    assert NT.load(spark, f"{tmp_dir}/m") is None
    NT.save(spark, NT.Model(FEATURES, p), f"{tmp_dir}/m")
    NT.save(spark, model, f"{tmp_dir}/m")
    again, backup = NT.load(spark, f"{tmp_dir}/m"), NT.load(spark, f"{tmp_dir}/m", back=1)
    assert (again.trees, again.params, again.features) == (model.trees, p, FEATURES) and backup.trees == []
    assert {r.probability for r in NT.score(df, backup).collect()} == {0.5}
    imp = {r.feature: r.importance for r in NT.importance(spark, model).collect()}
    assert set(imp) == set(FEATURES) and abs(sum(imp.values()) - 1) < 1e-9 and imp["a"] == max(imp.values())


def test_patience_fires_and_keeps_the_best_prefix(spark):
    x, y, split = _table(250, 4)
    y = np.where(np.random.default_rng(9).random(250) < 0.25, 1 - y, y)       # noise, so that more trees soon do harm
    p = NT.Params(trees=60, depth=2, rate=0.8, bins=8, patience=5, block=5, least_hessian=1.0)
    model = NT.train(_frame(spark, x, y, split), FEATURES, p)
    assert model.stopped and len(model.stages) < 60
    best = max(model.stages)
    assert model.kept == model.stages.index(best) + 1
    assert len(model.stages) - model.kept >= p.patience


@pytest.mark.parametrize("aucs,patience,want", [
    ([0.5, 0.7, 0.7, 0.6], 2, (2, True)), ([0.5, 0.7, 0.6], 2, (2, False)), ([0.5, 0.6, 0.7], 1, (3, False)),
    ([], 3, (0, False)), ([None, None], 1, (2, False)), ([0.9, 0.1, 0.2, 0.95], 3, (4, False)), ([0.9, 0.1, 0.2, 0.3, 0.95], 3, (1, True))])
def test_kept_trees(aucs, patience, want):
    assert NT.kept_trees(aucs, patience) == want


def test_no_python_workers_and_samples(spark, trained):
    x, y, split, p, _ = trained
    rows = NT._prepared(_frame(spark, x, y, split), "subscriber_id", "churned_30d", FEATURES, [[0], [10_000], [], [0]])
    g, h = NT.gradients(F.col("y"), F.col("z"), 3.0)
    table = NT.split_table(rows.select("b", g.alias("g"), h.alias("h"), F.lit(0).alias("node")), [0, 1, 3], 1.0)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "partial_sum" in plan
    q = NT.Params(row_share=0.8)
    share = rows.where(NT._sampled_rows(q, 3)).count() / 400
    assert 0.7 < share < 0.9
    assert NT.sampled_features(q, 1, 15) == NT.sampled_features(q, 1, 15) and len(NT.sampled_features(q, 1, 15)) == 12
    assert NT.train(_frame(spark, x, y, split).where("split = 'test'"), FEATURES, p).trees == []
