"""Exploratory summaries of the training frame (A11-A13) and top-k (L1-L3).

The data behind the reference's charts, as tables; all are aggregations
with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R

CLASS_NAMES = {0: "Retained", 1: "Churned"}
SUMMARY_FEATURES = ["total_sessions_30d", "total_watch_time_h",
                    "avg_completion_rate", "days_since_last_watch"]


def _class_name(label: str):
    return F.when(F.col(label) == 1, CLASS_NAMES[1]).otherwise(CLASS_NAMES[0])


def means_by_label(df: DataFrame, label: str = "churned_30d",
                   features=SUMMARY_FEATURES) -> DataFrame:
    """Mean of each feature per class, 2 decimals."""
    return df.groupBy(_class_name(label).alias("churn_status")).agg(
        *[R.round_half_up(F.avg(R.nan_to_null(f)), 2).alias(f) for f in features])


def class_share(df: DataFrame, label: str = "churned_30d") -> DataFrame:
    """Rows per class and their share of all rows."""
    counts = df.groupBy(_class_name(label).alias("churn_status")).agg(
        F.count(F.lit(1)).alias("subscribers"))
    # one row per class: the total over them is a bounded window
    total = F.sum("subscribers").over(Window.partitionBy())
    return counts.select("churn_status", "subscribers",
                         R.round_half_up(F.col("subscribers") / total, 4).alias("share"))


def histogram(df: DataFrame, value: str = "total_sessions_30d", label: str = "churned_30d",
              bins: int = 30) -> DataFrame:
    """Counts per (class, bin) over ``bins`` equal-width bins of one shared
    [min, max] range (A13). The top edge falls in the last bin.

    Fractions keep their value (a rate spreads over all bins). The range is a
    one-row aggregate; rows are counted per (class, bin) with partial sums.
    """
    x = F.col(value).cast(T.DoubleType())
    rows = df.where(F.col(value).isNotNull()).select(_class_name(label).alias("churn_status"), x.alias("_x"))
    ends = rows.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi")).alias("_e"))
    binned = rows.withColumn("_e", ends.scalar())
    lo, span = F.col("_e.lo"), F.col("_e.hi") - F.col("_e.lo")
    step = F.floor((F.col("_x") - lo) * F.lit(float(bins)) / span)
    b = F.when(span > 0, F.least(step + 1, F.lit(bins))).otherwise(F.lit(1))
    return (binned.select("churn_status", b.cast(T.LongType()).alias("bin"))
                  .groupBy("churn_status", "bin").agg(F.count(F.lit(1)).alias("subscribers")))


def top_k(df: DataFrame, value: str, k: int, ascending_display: bool = False,
          tie: str | None = None) -> DataFrame:
    """The ``k`` largest rows by ``value`` (L2); ties broken by ``tie``.
    With ``ascending_display`` they are re-sorted ascending (L3)."""
    order = [F.col(value).desc()] + ([F.col(tie).asc()] if tie else [])
    top = df.orderBy(*order).limit(k)
    if ascending_display:
        top = top.orderBy(F.col(value).asc(), *([F.col(tie).desc()] if tie else []))
    return top
