"""Quality rules: robust multivariate outliers of text statistics.

DataFrame functions only. Each text gives counts; fixed base rules reject on
them, and the rest is judged by a vector of transformed statistics: for every
(language, source) a minimum-covariance-determinant estimate of location and
scatter is found by concentration steps, and texts whose Mahalanobis distance
is too large are rejected.

Concentration starts from medians and quartile spreads with three correlation
estimates; each step takes the ``COVER`` share of the group nearest by the
current distance and re-estimates mean and covariance on it, until the
determinant stands still. The least determinant of the three wins, scaled by
the chi-square law so that normal rows have distances as ``CUT`` states. All
of this is grouped aggregation with partial results (moments, percentile
sketches), so a group that holds a third of all rows is never gathered; one
small row a group is joined back, broadcast where the groups are few.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

STATS = ["z_words", "z_wordlen", "z_symbols", "z_lines", "z_repeats"]
COVER = 0.75          # share of a group that the estimate rests on
MOST_STEPS = 30       # concentration steps; they end when no determinant falls any more
FEW_GROUPS = 20_000   # groups up to which the estimates (one row each, some 250 bytes) are broadcast
MIN_GROUP = 50        # texts a group needs for an estimate of its own; smaller ones use the language's, then all
#: Least standard deviation of each transformed statistic: what ordinary texts may differ by even where a group is uniform.
FLOOR = [0.6, 0.12, 0.25, 0.2, 0.2]
#: Squared distance beyond which a text is rejected (chi-square, 5 degrees of freedom: less than once in 100 million).
CUT = 45.0


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed; null text counts as none.

    n_repeat_words counts the words inside some 3-word window that the text
    holds twice or more (each word once, all occurrences).
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, C.SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.rtrim(F.translate(x, "\t\n\x0b\x0c\r", "     ")) != "")
    d = docs.withColumn("_w", words).withColumn("n_words", F.size("_w").cast("long"))
    w = F.col("_w")
    windows = F.when(F.col("n_words") >= 3, F.transform(
        F.sequence(F.lit(1), (F.col("n_words") - 2).cast("int")),
        lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("_h", windows)
    # (hash, place) in order: a window is repeated if its neighbour there has the same hash
    order = F.array_sort(F.transform(F.col("_h"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_o", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), order))
    o = F.col("_o")
    twice = F.array_sort(F.transform(
        F.filter(o, lambda x, k: (x["h"] == F.get(o, k - 1)["h"]) | (x["h"] == F.get(o, k + 1)["h"])),
        lambda x: x["i"]))
    d = d.withColumn("_p", twice)
    p = F.col("_p")
    # places in order: each repeated window adds the words that the one before it did not cover
    covered = F.aggregate(F.transform(p, lambda i, k: F.when(k == 0, F.lit(3)).otherwise(
        F.least(F.lit(3), i - F.get(p, k - 1)))), F.lit(0), lambda a, x: a + x)
    return (d.withColumn("word_chars", F.aggregate("_w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)))
            .withColumn("n_symbols", F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"))
            .withColumn("_l", lines)
            .withColumn("n_lines", F.size("_l").cast("long"))
            .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
            .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .drop("_w", "_h", "_o", "_p", "_l"))


def transformed(d: DataFrame) -> DataFrame:
    """The statistics on scales where ordinary texts are roughly normal.

    All but the length are shares, so a long text with a few repeated lines is
    as near as a short one; copies alone reach ``CUT`` where they are over half
    of the lines that hold a word.
    """
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return (d.withColumn("z_words", F.log1p("n_words"))
            .withColumn("z_wordlen", F.log1p(F.col("word_chars") / n))
            .withColumn("z_symbols", F.log1p(20 * F.col("n_symbols") / n))
            .withColumn("z_lines", F.log1p(5 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))))
            .withColumn("z_repeats", F.asin(F.sqrt(F.least(F.lit(1.), F.col("n_repeat_words") / n)))))


def _cholesky(cov: dict[tuple[int, int], str], d: DataFrame, size: int) -> DataFrame:
    """Adds the lower factor's cells l_i_j of the covariance columns."""
    def rest(i: int, j: int) -> Column:
        s = F.col(cov[i, j])
        for k in range(j):
            s = s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        return s

    for j in range(size):
        d = d.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(rest(j, j), F.lit(1e-12))))
        if j + 1 < size:
            d = d.withColumns({f"l_{i}_{j}": rest(i, j) / F.col(f"l_{j}_{j}") for i in range(j + 1, size)})
    return d


def _distance(d: DataFrame, out: str) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution (columns m_i and l_i_j at hand)."""
    total = F.lit(0.)
    for i, z in enumerate(STATS):
        s = F.col(z) - F.col(f"m_{i}")
        for k in range(i):
            s = s - F.col(f"l_{i}_{k}") * F.col(f"_y{k}")
        d = d.withColumn(f"_y{i}", s / F.col(f"l_{i}_{i}"))
        total = total + F.col(f"_y{i}") ** 2
    return d.withColumn(out, total).drop(*[f"_y{i}" for i in range(len(STATS))])


def _factored(d: DataFrame, inflate: float) -> DataFrame:
    """Covariance columns c_i_j -> floor added to the variances, lower factor l_i_j and log determinant."""
    k = len(STATS)
    pair = [(i, j) for i in range(k) for j in range(i + 1)]
    d = d.withColumns({f"c_{i}_{j}": F.col(f"c_{i}_{j}") * inflate + (FLOOR[i] ** 2 if i == j else 0.) for i, j in pair})
    d = _cholesky({(i, j): f"c_{i}_{j}" for i, j in pair}, d, k).drop(*[f"c_{i}_{j}" for i, j in pair])
    return d.withColumn("logdet", sum((2 * F.log(f"l_{i}_{i}") for i in range(k)), F.lit(0.)))


def _moments(d: DataFrame, groups: list[str], inflate: float) -> DataFrame:
    """Mean and factored covariance of each group."""
    k = len(STATS)
    g = d.groupBy(*groups).agg(
        *[F.avg(z).alias(f"m_{i}") for i, z in enumerate(STATS)],
        *[F.coalesce(F.covar_pop(STATS[i], STATS[j]), F.lit(0.)).alias(f"c_{i}_{j}") for i in range(k) for j in range(i + 1)])
    return _factored(g, inflate)


def _chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function for an odd number of degrees of freedom."""
    p = math.erf(math.sqrt(x / 2))
    for n in range(1, k, 2):
        p -= (x / 2) ** (n / 2) * math.exp(-x / 2) / math.gamma(n / 2 + 1)
    return p


def consistency(cover: float, k: int) -> float:
    """What the covariance of the nearest ``cover`` share of normal rows is to be multiplied by (k odd)."""
    lo, hi = 0.0, 200.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, k) < cover else (lo, mid)
    return cover / _chi2_cdf(lo, k + 2)


def _starts(d: DataFrame, group: str, few: bool) -> DataFrame:
    """First estimates of each group, rows (group, start): medians, quartile spreads, and three correlations.

    "none": uncorrelated; "tanh": correlation of the squashed scores; "sign":
    that of the spatial signs (scores on the unit sphere).
    """
    k = len(STATS)
    q = d.groupBy(group).agg(*[F.percentile_approx(z, [.25, .5, .75], 1000).alias(f"q_{i}") for i, z in enumerate(STATS)])
    q = q.select(group, *[F.col(f"q_{i}")[1].alias(f"m_{i}") for i in range(k)],
                 *[F.sqrt(((F.col(f"q_{i}")[2] - F.col(f"q_{i}")[0]) / F.lit(1.349)) ** 2 + FLOOR[i] ** 2).alias(f"s_{i}")
                   for i in range(k)])
    q = C.stored(q)
    z = [(F.col(STATS[i]) - F.col(f"m_{i}")) / F.col(f"s_{i}") for i in range(k)]
    norm = F.sqrt(F.greatest(sum((c ** 2 for c in z), F.lit(0.)), F.lit(1e-12)))
    scored = (d.join(_small(q, few), group)
              .select(group, *[F.tanh(c).alias(f"t_{i}") for i, c in enumerate(z)], *[(c / norm).alias(f"u_{i}") for i, c in enumerate(z)]))
    pair = [(i, j) for i in range(k) for j in range(i + 1)]
    means = scored.groupBy(group).agg(*[F.avg(F.col(f"{a}_{i}") * F.col(f"{a}_{j}")).alias(f"{a}_{i}_{j}") for a in "tu" for i, j in pair])

    def corr(a: str, i: int, j: int) -> Column:
        if i == j:
            return F.lit(1.)
        return F.col(f"{a}_{i}_{j}") / F.sqrt(F.greatest(F.col(f"{a}_{i}_{i}") * F.col(f"{a}_{j}_{j}"), F.lit(1e-12)))

    both = q.join(means, group)
    cell = {"none": lambda i, j: F.lit(float(i == j)), "tanh": lambda i, j: corr("t", i, j), "sign": lambda i, j: corr("u", i, j)}
    out = None
    for name, c in cell.items():
        e = both.select(group, F.lit(name).alias("start"), *[f"m_{i}" for i in range(k)],
                        *[(c(i, j) * F.col(f"s_{i}") * F.col(f"s_{j}")).alias(f"c_{i}_{j}") for i, j in pair])
        out = e if out is None else out.unionByName(e)
    return _factored(out, 1.0)


def _small(d: DataFrame, few: bool) -> DataFrame:
    """A table of one row a group or start: broadcast where the groups were counted and are few."""
    return F.broadcast(d) if few else d


def mcd(d: DataFrame, group: str, few: bool = False) -> DataFrame:
    """One row a group: location m_i and factor l_i_j of the least determinant found, with its logdet and start.

    From each start, concentration steps go on while the determinant falls by
    more than one in a thousand (a step that doesn't lower it is not taken).
    """
    inflate = consistency(COVER, len(STATS))
    key = [group, "start"]
    state = C.stored(_starts(d, group, few))
    # the starts' own determinants are of other estimators: the first step is taken in any case
    state = C.stored(state.withColumn("logdet", F.lit(float("inf"))).withColumn("going", F.lit(True)))
    for _ in range(MOST_STEPS):
        now = state.filter("going").drop("going", "logdet")
        e = _distance(d.join(_small(now, few), group), "_d2")
        near = C.stored(e.groupBy(*key).agg(F.percentile_approx("_d2", COVER, 10000).alias("_h")))
        inner = e.join(_small(near, few), key).filter(F.col("_d2") <= F.col("_h"))
        new = _moments(inner, key, inflate).withColumnRenamed("logdet", "new")
        cols = [c for c in now.columns if c not in key]
        lower = F.col("new") < F.col("logdet")
        state = C.stored(
            state.alias("a").join(new.alias("b"), key, "left").select(
                *key, *[F.when(lower, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in cols],
                F.when(lower, F.col("new")).otherwise(F.col("logdet")).alias("logdet"),
                F.coalesce(F.col("logdet") - F.col("new") > 0.001, F.lit(False)).alias("going")))
        if not state.filter("going").head(1):
            break
    return state.drop("going").groupBy(group).agg(F.min_by(F.struct("*"), F.struct("logdet", "start")).alias("_e")).select("_e.*")


def judge(docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The columns ``keep`` of ``docs`` with the base statistics, base_failed, distance2 and kept.

    Null languages and sources are groups like any other. A group with fewer
    than ``MIN_GROUP`` texts is judged with its language's estimate, and a
    language with fewer with that of all texts. Base-failed texts are
    rejected and take no part in the estimates. Repeated rows stay rows and
    count as often as they occur; equal distances are judged alike. Empty
    tables give no rows.
    """
    d = docs.select(F.struct(*keep).alias("_keep"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    d = C.stored(transformed(statistics(d)).drop("text"))
    lang, source = "lang", "source"
    ls = F.to_json(F.struct(F.col(lang).alias("l"), F.col(source).alias("s")))
    lg = F.to_json(F.struct(F.col(lang).alias("l")))
    d = d.withColumn("_ls", ls).withColumn("_l", lg)
    good = d.filter(~F.col("base_failed"))
    size = good.groupBy("_l", "_ls").agg(F.count(F.lit(1)).alias("_n"))
    per_l = size.groupBy("_l").agg(F.sum("_n").alias("_nl"))
    level = C.stored(size.join(per_l, "_l")
                     .select("_ls", F.when(F.col("_n") >= MIN_GROUP, F.col("_ls"))
                             .when(F.col("_nl") >= MIN_GROUP, F.col("_l")).otherwise(F.lit("")).alias("_g")))
    few = level.count() <= FEW_GROUPS
    # a text counts for its own group, its language and all; one estimate each
    fan = good.select(F.explode(F.array("_ls", "_l", F.lit(""))).alias("_g"), *STATS)
    # stored: each step reads it twice, and its join would be in the plan of every step
    fan = C.stored(fan.join(_small(level.select("_g").distinct(), few), "_g"))
    est = C.stored(mcd(fan, "_g", few))
    judged = _distance(good.join(_small(level, few), "_ls").join(_small(est, few), "_g"), "distance2")
    out = [*[F.col("_keep")[c].alias(c) for c in keep], *COUNTS, "base_failed"]
    far = judged.select(*out, "distance2", (F.col("distance2") <= CUT).alias("kept"))
    failed = d.filter("base_failed").select(*out, F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept"))
    return far.unionByName(failed)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def op7_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(C.table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", *COUNTS, "base_failed", "kept", "distance2")
