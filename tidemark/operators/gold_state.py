"""Incremental gold: a stored state of mergeable daily partials (A4-A4k, S7).

The state holds, per (subscriber, plan, country) and event day, one row of
sums and counts, one row a device with its sessions, and one row a content
item. Sums are whole numbers (completions in 1/10,000, engagement in 1/100),
so they merge exactly in any order. It is partitioned by ``event_date``:

* an update recomputes only the days that a silver run touched, from those
  silver partitions, and swaps them in (late rows touch their own day);
* gold merges the 30 days before the clock from the state, without reading
  an event. The distinct counts become counts of merged rows, so no plan
  expands its input and no group is gathered.

Every refreshed day also gets a marker row, so that a day that lost all its
events is overwritten too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..sources import tables as TB
from . import gold as G

DAY, DEVICE, CONTENT, MARKER = 0, 1, 2, 3
COMPLETION_UNIT, ENGAGEMENT_UNIT = 10_000, 100

_SUMS = ["n", "watch", "c_sum", "c_n", "c_sq", "e_sum", "e_n", "n_completed", "n_abandoned"]


def daily_partials(silver: DataFrame) -> DataFrame:
    """State rows of all days in ``silver``: grain, event_date, kind, key and the sums.

    One aggregation per (grain, day, device, content) comes first; only its
    rows, not the events, are copied to the three kinds of key.
    """
    c = F.round(F.col("completion_pct") * COMPLETION_UNIT).cast(T.LongType())
    e = F.round(F.col("engagement_score") * ENGAGEMENT_UNIT).cast(T.LongType())
    fine = silver.groupBy(*G.GRAIN, "event_date", "device_type", "content_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("watch_duration_s").cast(T.LongType())).alias("watch"),
        F.sum(c).alias("c_sum"), F.count(c).alias("c_n"), F.sum(c * c).alias("c_sq"),
        F.sum(e).alias("e_sum"), F.count(e).alias("e_n"),
        F.max("event_timestamp").alias("last_ts"),
        F.count_if(F.col("watch_category") == "completed").alias("n_completed"),
        F.count_if(F.col("watch_category") == "abandoned").alias("n_abandoned"))
    kinds = F.array(
        F.struct(F.lit(DAY).alias("kind"), F.lit(None).cast(T.StringType()).alias("key")),
        F.struct(F.lit(DEVICE).alias("kind"), F.col("device_type").alias("key")),
        F.struct(F.lit(CONTENT).alias("kind"), F.col("content_id").alias("key")))
    fanned = fine.withColumn("_k", F.explode(kinds)).select("*", "_k.kind", "_k.key")
    day = F.col("kind") == DAY
    # devices and content items need their sessions only
    sums = [F.sum("n").alias("n")] + [F.sum(F.when(day, F.col(s))).alias(s) for s in _SUMS[1:]]
    return fanned.groupBy(*G.GRAIN, "event_date", "kind", "key").agg(
        *sums, F.max(F.when(day, F.col("last_ts"))).alias("last_ts"))


def write_state(spark: SparkSession, silver: DataFrame, path: str, days: list | None = None) -> None:
    """Refresh the state at ``path``: the given event days only, or all of it.

    ``days`` are literals, so only their silver partitions are read, and only
    their state partitions are replaced.
    """
    if days is not None and not days:
        return
    if days is None:
        (daily_partials(silver).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("event_date").parquet(path))
        return
    rows = daily_partials(silver.where(F.col("event_date").isin(days)))
    marks = R.literal_table(spark, [(d, MARKER) for d in days], "event_date date, kind int")
    (rows.unionByName(marks, allowMissingColumns=True).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path))


def activity_from_state(state: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """The unrounded aggregates of :func:`gold.subscriber_activity`, merged from the state."""
    d = R.as_of_date(as_of)
    recent = state.where((F.col("event_date") >= F.date_sub(d, days)) & (F.col("kind") < MARKER))
    last7 = F.col("event_date") >= F.date_sub(d, 7)
    per_key = recent.groupBy(*G.GRAIN, "kind", "key").agg(
        *[F.sum(s).alias(s) for s in _SUMS], F.max("last_ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n_days"), F.coalesce(F.sum(F.when(last7, F.col("n"))), F.lit(0)).alias("n_7d"))

    def of(kind: int, c: str):
        return F.sum(F.when(F.col("kind") == kind, F.col(c)))

    device = F.col("kind") == DEVICE
    merged = per_key.groupBy(*G.GRAIN).agg(
        *[of(DAY, s).alias(s) for s in _SUMS], of(DAY, "n_days").alias("n_days"), of(DAY, "n_7d").alias("n_7d"),
        F.max("last_ts").alias("last_ts"),
        # most sessions; ties go to the smallest device name
        F.min_by(F.when(device, F.col("key")),
                 F.when(device & F.col("key").isNotNull(), F.struct((-F.col("n")).alias("a"), F.col("key").alias("b"))))
         .alias("favourite_device"),
        F.count_if((F.col("kind") == CONTENT) & F.col("key").isNotNull()).alias("n_content"))
    wide = T.DecimalType(38, 0)
    spread = (F.col("c_sq").cast(wide) * F.col("c_n").cast(T.DecimalType(18, 0))
              - F.col("c_sum").cast(T.DecimalType(18, 0)) * F.col("c_sum").cast(T.DecimalType(18, 0)))
    pairs = F.col("c_n").cast(T.DoubleType()) * (F.col("c_n") - 1)
    return merged.select(
        *G.GRAIN,
        F.col("n").alias("total_sessions_30d"), F.col("n_days").alias("active_days_30d"),
        (F.col("watch").cast(T.DoubleType()) / F.lit(3600.0)).alias("total_watch_time_h"),
        (F.col("c_sum") / F.col("c_n") / F.lit(float(COMPLETION_UNIT))).alias("avg_completion_rate"),
        (F.col("e_sum") / F.col("e_n") / F.lit(float(ENGAGEMENT_UNIT))).alias("avg_engagement_score"),
        F.when(F.col("c_n") > 1, F.sqrt(spread.cast(T.DoubleType()) / pairs) / COMPLETION_UNIT)
         .alias("completion_rate_stddev"),
        F.col("last_ts").alias("last_watch_at"),
        R.whole_days_between(R.as_of_literal(as_of), F.col("last_ts")).alias("days_since_last_watch"),
        "favourite_device",
        (F.col("n_completed") / F.col("n")).alias("completion_rate"),
        (F.col("n_abandoned") / F.col("n")).alias("abandonment_rate"),
        F.col("n_7d").alias("sessions_last_7d"), F.col("n_content").alias("unique_content_count"))


def gold_from_state(state: DataFrame, as_of=None) -> DataFrame:
    """gold_churn_features merged from the stored state; no event is read."""
    return G.project_gold(G.with_labels(activity_from_state(state, as_of), as_of))


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    return TB.read_if_exists(spark, path)
