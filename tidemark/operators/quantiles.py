"""Exact order statistics of many groups at once, without sorting a group.

Every (group, quantile) keeps the range of values that holds its rank;
quantiles of a group that share a range share its counts. A round cuts all ranges into equal parts, counts the values of each part in one
grouped aggregation (combined before the shuffle) and keeps the part that the
rank falls into. Ranges shrink by ``PARTS`` a round, so whole numbers of 64
bits end after seven rounds at most, whatever the size of a group; a group
that holds a third of all rows costs a few thousand counters like any other.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..session import cut_lineage
from .kpis import latency_micros, latency_window

PARTS = 1024


def exact_quantiles(df: DataFrame, groups: list[str], value: str, shares: dict[str, Fraction | str]) -> DataFrame:
    """One row a group: ``n`` values and, per name in ``shares``, the smallest
    value that at least that share of the values does not exceed.

    ``value`` is a whole number; NULL values don't count, and a group without
    another value has no row. Shares are fractions (``Fraction(99, 100)`` or
    ``"0.99"``), so ranks are exact. Group columns may be NULL. The number of
    rounds follows the widest range; one number a round reaches the driver.
    """
    v = F.col("_v")
    # read once: the rounds below count these rows again and again
    rows = cut_lineage(df.select(F.struct(*groups).alias("_g"), F.col(value).cast("long").alias("_v"))
                       .where(v.isNotNull()))
    bounds = rows.groupBy("_g").agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
    ranks = F.array(*[
        F.struct(F.lit(name).alias("q"), F.greatest(F.lit(1).cast("long"), _rank(F.col("n"), Fraction(s))).alias("rank"))
        for name, s in shares.items()])
    ranges = cut_lineage(bounds.withColumn("_r", F.explode(ranks))
                         .select(F.col("_g").alias("_h"), "n", "lo", "hi", "_r.q", "_r.rank"))
    part_of = ["_h", "lo", "hi"]
    before = Window.partitionBy(*part_of).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    big = "decimal(20,0)"              # the width of a range may not fit 64 bits
    width = F.expr(f"(cast(hi as {big}) - cast(lo as {big}) + {PARTS}) div {PARTS}")
    while True:
        open_ = cut_lineage(ranges.where("hi > lo").withColumn("width", width))
        if not open_.limit(1).count():
            break
        # ranges of a group are the same or apart, so a value is in one at most
        listed = (open_.groupBy("_h").agg(F.collect_set(F.struct("lo", "hi", "width")).alias("_in")))
        held = rows.join(listed, F.col("_g").eqNullSafe(F.col("_h"))).select(
            "_h", "_v", F.explode(F.filter("_in", lambda r: v.between(r["lo"], r["hi"]))).alias("_r")).select("_h", "_v", "_r.*")
        part = F.expr(f"(cast(_v as {big}) - cast(lo as {big})) div cast(width as {big})")
        counts = held.groupBy(*part_of, part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
        below = (counts.withColumn("below", F.coalesce(F.sum("c").over(before), F.lit(0)))
                 .withColumnsRenamed({"_h": "_h2", "lo": "lo2", "hi": "hi2"}))
        found = (below.join(open_, F.col("_h2").eqNullSafe(F.col("_h")) & (F.col("lo2") == F.col("lo")) & (F.col("hi2") == F.col("hi")))
                 .where((F.col("below") < F.col("rank")) & (F.col("rank") <= F.col("below") + F.col("c"))))
        start = f"cast(lo as {big}) + cast(part as {big}) * cast(width as {big})"
        closer = found.select("_h", "n", F.expr(f"cast({start} as long)").alias("lo"),
                              F.expr(f"cast(least(cast(hi as {big}), {start} + width - 1) as long)").alias("hi"),
                              "q", (F.col("rank") - F.col("below")).alias("rank"))
        ranges = cut_lineage(ranges.where("hi = lo").unionByName(closer))
    one = ranges.groupBy(F.col("_h").alias("_g"), "n").agg(
        *[F.max(F.when(F.col("q") == name, F.col("lo"))).alias(name) for name in shares])
    return one.select("_g.*", "n", *shares)


def _rank(n, share: Fraction):
    """ceil(n * share) in whole numbers."""
    return F.expr(f"cast((cast(n as decimal(20,0)) * {share.numerator} + {share.denominator - 1}) div {share.denominator} as long)")


def latency_quantiles(bronze: DataFrame, window: str = "15 minutes") -> DataFrame:
    """Exact median and 99th percentile of the latency per ingest window."""
    d = (bronze.where(F.col("event_timestamp").isNotNull())
         .select(latency_window(window).alias("window_start"), latency_micros().alias("_us")))
    q = exact_quantiles(d, ["window_start"], "_us", {"p50": Fraction(1, 2), "p99": Fraction(99, 100)})
    return q.select("window_start", F.col("n").alias("events"),
                    R.round_half_up(F.col("p50") / F.lit(1e6), 6).alias("p50_latency_s"),
                    R.round_half_up(F.col("p99") / F.lit(1e6), 6).alias("p99_latency_s"))
