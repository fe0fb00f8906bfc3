"""Distributed running totals over a global order.

A window with ``orderBy`` and no ``partitionBy`` runs in one task. Here the
rows are range-partitioned on the order key instead; each range gets a local
running sum, and the totals of the ranges before it (one row per range, a
bounded table) are added through a broadcast join. Equal keys always land in
the same range, so ties never straddle two ranges.

The range id comes from the physical partition, so the range-partitioned
rows are materialised once with a reliable ``checkpoint()`` before the two
branches (local sums, range totals) read them: both then see the same ids,
whatever AQE does to either branch, and the input is computed only once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def running_totals(df: DataFrame, order_col: str, value_cols: list[str],
                   descending: bool = False, ranges: int | None = None,
                   prefix: str = "cum_", with_grand_total: bool = True,
                   neighbours: list[str] | None = None) -> DataFrame:
    """Add ``cum_<c>`` = sum of ``c`` over all rows up to and including this
    one in ``order_col`` order, and ``total_<c>`` (grand total) per column.

    ``order_col`` should be unique (aggregate ties first) for a strict order.
    ``neighbours``: columns of which the next row's value is added as
    ``next_<c>`` (NULL in the last row), also across the borders of ranges.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    ranged = cut_lineage(df.repartitionByRange(n, key).withColumn("_rng", F.spark_partition_id()))

    local_w = Window.partitionBy("_rng").orderBy(key).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    follow = Window.partitionBy("_rng").orderBy(key)
    local = ranged.select("*", *[F.lead(c).over(follow).alias(f"_lead_{c}") for c in neighbours or []], *[F.sum(c).over(local_w).alias(f"_loc_{c}") for c in value_cols])

    near = neighbours or []
    first_of = (F.min_by if not descending else F.max_by)
    totals = ranged.groupBy("_rng").agg(*[F.sum(c).alias(f"_tot_{c}") for c in value_cols],
                                        *[first_of(c, order_col).alias(f"_first_{c}") for c in near])
    # one row per range: a bounded table, so the global window here is cheap
    before = Window.orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "_rng",
        # the next range that holds rows: totals have no row for an empty one
        *[F.lead(f"_first_{c}").over(Window.orderBy("_rng")).alias(f"_then_{c}") for c in near],
        *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
          for c in value_cols],
        *([F.sum(f"_tot_{c}").over(everything).alias(f"total_{c}") for c in value_cols]
          if with_grand_total else []))

    out = local.join(F.broadcast(offsets), "_rng")
    cols = [c for c in df.columns]
    cols += [(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}") for c in value_cols]
    # values of ``neighbours`` are not NULL, so a NULL lead is a range's last row
    cols += [F.coalesce(f"_lead_{c}", f"_then_{c}").alias(f"next_{c}") for c in near]
    if with_grand_total:
        cols += [F.col(f"total_{c}") for c in value_cols]
    return out.select(*cols)
