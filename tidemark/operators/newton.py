"""Second-order boosted trees as grouped aggregations (M3-M5, M7).

Each row has a margin z, a gradient g = w (p - y) and a Hessian h = w p (1 - p).
A level of a tree is one aggregation: the sums of g and h per (node, feature,
bin), combined before the shuffle, then running sums over the few bins of each
(node, feature) give the gain of every split, and one best split a node comes
to the driver. Rows and columns are sampled per tree, a child needs a least
Hessian weight, and leaves are -G / (H + ridge).

g and h are summed as whole numbers in units of 2^-24, so sums don't depend on
the order of rows: a run repeats exactly, and equal gains go to the first
feature and the lowest cut. Cuts are exact quantiles of the training rows, on
values in units of ``SCALE``; NULL and NaN lie below all cuts.

Early stopping watches the AUC on the validation rows. After each block of
trees the margins of all its prefixes are laid out in one pass, and one set of
running totals over (prefix, score) gives the AUC of every prefix.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..session import cut_lineage
from ..sources import tables as TB
from .quantiles import exact_quantiles
from .ranking import running_totals

UNIT = 1 << 24            # of summed gradients and Hessians
SCALE = 10_000            # features are compared in 1/10,000
MISSING = -(1 << 62)


@dataclass(frozen=True)
class Params:
    trees: int = 200
    depth: int = 6
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    least_hessian: float = 3.0
    positive_weight: float = 3.0
    ridge: float = 1.0
    bins: int = 32
    patience: int = 20
    block: int = 5            # trees between two looks at the validation rows
    seed: int = 42


@dataclass
class Node:
    """Of a complete binary layout: children of i are 2 i + 1 (value <= cut) and 2 i + 2."""

    value: float
    cover: float
    feature: int = -1
    cut: int = 0
    gain: float = 0.0


@dataclass
class Model:
    features: list[str]
    params: Params
    trees: list[dict[int, Node]] = field(default_factory=list)
    stages: list[float] = field(default_factory=list)      # validation AUC after each tree grown
    stopped: bool = False                                   # patience ran out

    @property
    def kept(self) -> int:
        return len(self.trees)


# --- cuts and rows ---------------------------------------------------------------------------

def scaled(feature: str) -> F.Column:
    """A feature in whole units; NULL and NaN below everything."""
    x = R.nan_to_null(feature)
    return F.coalesce(F.round(x * SCALE).cast(T.LongType()), F.lit(MISSING))


def feature_cuts(train: DataFrame, features: list[str], bins: int) -> list[list[int]]:
    """Ascending cuts of each feature: its distinct exact quantiles k / bins, without those at its end.

    At most ``bins - 1`` numbers a feature reach the driver.
    """
    long = train.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("f"), scaled(name).alias("x")) for i, name in enumerate(features)])).alias("_c")).select("_c.*")
    shares = {f"q{k}": Fraction(k, bins) for k in range(1, bins)} | {"top": Fraction(1)}
    cuts: list[list[int]] = [[] for _ in features]
    for r in exact_quantiles(long, ["f"], "x", shares).collect():
        cuts[r.f] = sorted({r[q] for q in shares if r[q] < r["top"]})
    return cuts


def _prepared(df: DataFrame, key: str, label: str, features: list[str], cuts: list[list[int]]) -> DataFrame:
    """key, y, split, x (whole units), b (bins: cuts below the value), z (margin)."""
    x = F.array(*[scaled(f) for f in features])

    def bin_of(i: int, cs: list[int]) -> F.Column:
        value = F.get("x", F.lit(i))
        return F.size(F.filter(F.array(*[F.lit(c) for c in cs]), lambda c: c < value)) if cs else F.lit(0)

    bins = [bin_of(i, cs) for i, cs in enumerate(cuts)]
    return (df.select(F.col(key).cast(T.StringType()).alias("key"), F.col(label).cast(T.IntegerType()).alias("y"),
                      "split", x.alias("x"))
            .withColumn("b", F.array(*[b.cast(T.IntegerType()) for b in bins])).withColumn("z", F.lit(0.0)))


# --- one tree --------------------------------------------------------------------------------

def gradients(y: F.Column, z: F.Column, positive_weight: float) -> tuple[F.Column, F.Column]:
    """Weighted logistic gradient and Hessian in whole units."""
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    w = F.when(y == 1, F.lit(float(positive_weight))).otherwise(F.lit(1.0))
    return (F.round(w * (p - y) * UNIT).cast(T.LongType()), F.round(w * p * (F.lit(1.0) - p) * UNIT).cast(T.LongType()))


def _gain(g: F.Column, h: F.Column, ridge: float) -> F.Column:
    return g * g / (h + F.lit(float(ridge)))


def split_table(rows: DataFrame, features: list[int], ridge: float) -> DataFrame:
    """Sums and gain left of every bin: rows (node, g, h, b) -> (node, f, bin, gl, hl, gt, ht, gain).

    Sums are in units of UNIT, the gain is not.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.get("b", F.lit(f)).alias("bin")) for f in features]))
    hist = (rows.select("node", "g", "h", pairs.alias("_p")).groupBy("node", "_p.f", "_p.bin")
            .agg(F.sum("g").alias("g"), F.sum("h").alias("h")))
    # as many rows a window as a feature has bins
    whole = Window.partitionBy("node", "f")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = hist.select("node", "f", "bin", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
                       F.sum("g").over(whole).alias("gt"), F.sum("h").over(whole).alias("ht"))
    u = F.lit(float(UNIT))
    gl, hl, gt, ht = (F.col(c) / u for c in ("gl", "hl", "gt", "ht"))
    gain = (_gain(gl, hl, ridge) + _gain(gt - gl, ht - hl, ridge) - _gain(gt, ht, ridge)) / 2
    return sums.withColumn("gain", gain)


def best_splits(table: DataFrame, least_hessian: float) -> DataFrame:
    """One row a node: its sums and its best allowed split (NULL where none gains)."""
    least = F.lit(int(least_hessian * UNIT))
    allowed = (F.col("hl") >= least) & (F.col("ht") - F.col("hl") >= least) & (F.col("gain") > 1e-9)
    order = F.when(allowed, F.struct("gain", -F.col("f"), -F.col("bin")))
    return table.groupBy("node").agg(F.max("gt").alias("gt"), F.max("ht").alias("ht"),
                                     F.max_by(F.when(allowed, F.struct("f", "bin", "gl", "hl", "gain")), order).alias("s"))


def _walk(tree: dict[int, Node], node: int, leaf, cuts: list[list[int]]) -> F.Column:
    """Nested conditions on the bins, ``leaf(node id)`` at their ends."""
    n = tree[node]
    if n.feature < 0:
        return leaf(node)
    below = F.get("b", F.lit(n.feature)) <= cuts[n.feature].index(n.cut)
    return F.when(below, _walk(tree, 2 * node + 1, leaf, cuts)).otherwise(_walk(tree, 2 * node + 2, leaf, cuts))


def grow(rows: DataFrame, cuts: list[list[int]], features: list[int], p: Params) -> dict[int, Node]:
    """One tree on rows (g, h, b): ``depth`` aggregations."""
    def node(g: int, h: int) -> Node:
        return Node(-p.rate * (g / UNIT) / (h / UNIT + p.ridge), h / UNIT)

    tree: dict[int, Node] = {0: Node(0.0, 0.0)}
    open_ = [0]
    for level in range(p.depth):
        at = rows.withColumn("node", _walk(tree, 0, lambda i: F.lit(i), cuts)).where(F.col("node").isin(open_))
        found = best_splits(split_table(at, features, p.ridge), p.least_hessian).collect()
        open_ = []
        for r in sorted(found, key=lambda r: r.node):
            if level == 0:
                tree[0] = node(r.gt, r.ht)
            if r.s is None:
                continue
            n = tree[r.node]
            n.feature, n.cut, n.gain = r.s.f, cuts[r.s.f][r.s.bin], r.s.gain
            tree[2 * r.node + 1] = node(r.s.gl, r.s.hl)
            tree[2 * r.node + 2] = node(r.gt - r.s.gl, r.ht - r.s.hl)
            open_ += [2 * r.node + 1, 2 * r.node + 2]
        if not open_:
            break
    return tree


def sampled_features(p: Params, tree: int, n: int) -> list[int]:
    """Columns of a tree: drawn without replacement by the seed and the tree's number."""
    return sorted(random.Random(f"{p.seed}:{tree}").sample(range(n), max(1, round(p.column_share * n))))


def _sampled_rows(p: Params, tree: int) -> F.Column:
    if p.row_share >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64("key", F.lit(p.seed), F.lit(tree)), F.lit(10_000)) < int(p.row_share * 10_000)


# --- prefixes --------------------------------------------------------------------------------

def _literal_trees(trees: list[dict[int, Node]]) -> F.Column:
    """Trees as one constant: arrays f (-1 at leaves), c, v by node id."""
    out = []
    for t in trees:
        size = max(t) + 1
        at = [t.get(i, Node(0.0, 0.0)) for i in range(size)]
        out.append({"f": [n.feature for n in at], "c": [n.cut for n in at], "v": [n.value for n in at]})
    return F.from_json(F.lit(json.dumps(out)), "array<struct<f:array<int>,c:array<bigint>,v:array<double>>>")


def tree_values(x: str, trees: list[dict[int, Node]], depth: int) -> F.Column:
    """array<double>: the leaf value of every tree for the row's values ``x`` (whole units)."""
    def leaf(t):
        def step(i, _):
            f = F.get(t["f"], i)
            return F.when(f < 0, i).when(F.get(F.col(x), f) <= F.get(t["c"], i), 2 * i + 1).otherwise(2 * i + 2)
        end = F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), step)
        return F.get(t["v"], end)
    return F.transform(_literal_trees(trees), leaf)


def prefix_margins(rows: DataFrame, trees: list[dict[int, Node]], depth: int) -> DataFrame:
    """(y, trees, score): the margin after each of ``trees``, on top of z, in one pass."""
    sums = F.aggregate(tree_values("x", trees, depth), F.array(F.col("z")),
                       lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))
    return rows.select("y", F.posexplode(sums).alias("trees", "score")).where("trees > 0")


def staged_auc(margins: DataFrame) -> DataFrame:
    """(trees, auc) of every prefix from one set of running totals over (prefix, score).

    Every prefix scores the same rows, so what lies before a prefix is its
    number times the negatives. NULL where a class is missing.
    """
    counts = margins.groupBy(F.struct("trees", "score").alias("_k")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"))
    rt = running_totals(counts, "_k", ["neg"], with_grand_total=False).select("_k.trees", "pos", "neg", "cum_neg")
    per = rt.groupBy("trees").agg(
        F.sum("pos").alias("p"), F.sum("neg").alias("n"),
        # pairs won, counted from the first prefix on
        F.sum(F.col("pos") * (2 * (F.col("cum_neg") - F.col("neg")) + F.col("neg"))).alias("u2"))
    won = F.col("u2") - 2 * F.col("p") * F.col("n") * (F.col("trees") - 1)
    pairs = 2.0 * F.col("p") * F.col("n")
    return per.select("trees", F.when(pairs > 0, won.cast(T.DoubleType()) / pairs).alias("auc"))


def kept_trees(aucs: list[float], patience: int) -> tuple[int, bool]:
    """Trees up to the first best AUC, and whether ``patience`` trees went by without a better one."""
    best, at = float("-inf"), -1
    for i, a in enumerate(aucs):
        if a is not None and a > best:
            best, at = a, i
        elif a is not None and i - at >= patience:
            return at + 1, True
    return at + 1 if at >= 0 else len(aucs), False


# --- training, scoring, storing ----------------------------------------------------------------

def train(df: DataFrame, features: list[str], params: Params = Params(), key: str = "subscriber_id",
          label: str = "churned_30d") -> Model:
    """Fit on ``split = 'train'``, stop by the AUC on ``split = 'validation'`` (none: all trees are grown).

    Rows of other splits are not used. An empty training part gives a model
    without trees, which scores 0.5.
    """
    p, model = params, Model(list(features), params)
    fit = df.where(F.col("split") == "train")
    cuts = feature_cuts(fit, features, p.bins)
    rows = cut_lineage(_prepared(df.where(F.col("split").isin("train", "validation")), key, label, features, cuts))
    if not rows.where("split = 'train'").limit(1).count():
        return model
    watch = rows.where("split = 'validation'").limit(1).count() > 0
    while model.kept < p.trees and not model.stopped:
        block: list[dict[int, Node]] = []
        z = F.col("z")
        for _ in range(min(p.block, p.trees - model.kept)):
            t = model.kept + len(block)
            g, h = gradients(F.col("y"), z, p.positive_weight)
            tree = grow(rows.where((F.col("split") == "train") & _sampled_rows(p, t)).select("b", g.alias("g"), h.alias("h")),
                        cuts, sampled_features(p, t, len(features)), p)
            block.append(tree)
            z = z + _walk(tree, 0, lambda i, tree=tree: F.lit(tree[i].value), cuts)
        if watch:
            stages = staged_auc(prefix_margins(rows.where("split = 'validation'"), block, p.depth)).collect()
            model.stages += [r.auc for r in sorted(stages, key=lambda r: r.trees)]
        model.trees += block
        rows = cut_lineage(rows.withColumn("z", z))
        if watch:
            model.stopped = kept_trees(model.stages, p.patience)[1]
    if watch:
        model.trees = model.trees[:kept_trees(model.stages, p.patience)[0]]
    return model


def score(df: DataFrame, model: Model, out: str = "probability") -> DataFrame:
    """``df`` with the model's probability."""
    margin = F.lit(0.0)
    if model.trees:
        margin = F.aggregate(tree_values("_x", model.trees, model.params.depth), F.lit(0.0), lambda a, v: a + v)
    return (df.withColumn("_x", F.array(*[scaled(f) for f in model.features]))
            .withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).drop("_x"))


NODES = ("tree int, node int, feature string, threshold double, cut bigint, gain double, cover double, value double")


def node_table(spark: SparkSession, model: Model) -> DataFrame:
    """The model as a table: one row a node."""
    rows = []
    for k, t in enumerate(model.trees):
        for i, n in sorted(t.items()):
            inner = n.feature >= 0
            rows.append((k, i, model.features[n.feature] if inner else None, n.cut / SCALE if inner else None,
                         n.cut if inner else None, n.gain, n.cover, n.value))
    return spark.createDataFrame(rows, NODES)


def importance(spark: SparkSession, model: Model) -> DataFrame:
    """Share of each feature in the whole gain (M7); features that split nothing have 0."""
    named = R.literal_table(spark, [(f,) for f in model.features], "feature string")
    gains = node_table(spark, model).where("feature is not null").groupBy("feature").agg(F.sum("gain").alias("g"))
    total = Window.partitionBy()           # one row a feature
    return named.join(gains, "feature", "left").select(
        "feature", F.coalesce(F.col("g") / F.sum("g").over(total), F.lit(0.0)).alias("importance"))


def save(spark: SparkSession, model: Model, root: str) -> str:
    """Store the node table as a new version; the one before stays as the backup."""
    note = json.dumps({"features": model.features, "params": model.params.__dict__})
    return TB.write_version(node_table(spark, model), root, note)


def load(spark: SparkSession, root: str, back: int = 0) -> Model | None:
    """The current (or an earlier) version; None where none was saved."""
    v = TB.versions(spark, root)
    if v is None:
        return None
    listed = v.orderBy(F.col("written_at").desc(), F.col("version").desc()).limit(back + 1).collect()
    if len(listed) <= back:
        return None
    said = json.loads(listed[back]["note"])
    model = Model(said["features"], Params(**said["params"]))
    at = {f: i for i, f in enumerate(model.features)}
    rows = spark.read.parquet(listed[back]["path"]).orderBy("tree", "node").collect()     # the model's nodes
    model.trees = [{} for _ in range(1 + max((r.tree for r in rows), default=-1))]
    for r in rows:
        model.trees[r.tree][r.node] = Node(r.value, r.cover, at[r.feature] if r.feature else -1, r.cut or 0, r.gain)
    return model
