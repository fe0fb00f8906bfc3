"""Silver -> gold churn features (A4*, F19, F20, P5, P9, G2, S10, A5, A6, X4, X5).

One aggregation at the (subscriber, plan, country) grain over the 30 days
before ``as_of``. Aggregates are partial-then-final, so a subscriber that
holds a large share of the rows is combined map-side before the shuffle;
the set of active days and the mode keep bounded buffers, and the one distinct
count (content) is spread by its value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R

GRAIN = ["subscriber_id", "plan_type", "country"]


def recent_window(silver: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """``event_date >= as_of_date - days`` (P5); a literal, so it prunes
    ``event_date`` partitions and reaches the scan."""
    return silver.where(F.col("event_date") >= F.date_sub(R.as_of_date(as_of), days))


def _activity_aggs(as_of=None):
    d = R.as_of_date(as_of)
    return [
        F.count(F.lit(1)).alias("total_sessions_30d"),
        # a set of days is bounded; as a second distinct count it would cost an Expand of every event
        F.size(F.collect_set("event_date")).cast(T.LongType()).alias("active_days_30d"),
        (F.sum("watch_duration_s").cast(T.DoubleType()) / F.lit(3600.0)).alias("total_watch_time_h"),
        F.avg("completion_pct").alias("avg_completion_rate"),
        F.avg("engagement_score").alias("avg_engagement_score"),
        F.stddev_samp("completion_pct").alias("completion_rate_stddev"),
        F.max("event_timestamp").alias("last_watch_at"),
        R.whole_days_between(R.as_of_literal(as_of), F.max("event_timestamp"))
         .alias("days_since_last_watch"),
        F.mode("device_type", deterministic=True).alias("favourite_device"),
        F.avg(F.when(F.col("watch_category") == "completed", 1.0).otherwise(0.0)).alias("completion_rate"),
        F.avg(F.when(F.col("watch_category") == "abandoned", 1.0).otherwise(0.0)).alias("abandonment_rate"),
        F.count_if(F.col("event_date") >= F.date_sub(d, 7)).alias("sessions_last_7d"),
        F.count_distinct("content_id").alias("unique_content_count"),
    ]


def subscriber_activity(silver: DataFrame, as_of=None, grain=GRAIN) -> DataFrame:
    """Unrounded aggregates per ``grain`` (includes stddev and last watch)."""
    return recent_window(silver, as_of).groupBy(*grain).agg(*_activity_aggs(as_of))


def with_labels(activity: DataFrame, as_of=None) -> DataFrame:
    """Trend and risk labels on the unrounded aggregates."""
    return activity.select(
        "*",
        R.activity_trend().alias("activity_trend"),
        R.churn_risk_label().alias("churn_risk_label"),
        R.as_of_literal(as_of).alias("computed_at"),
    )


def project_gold(labelled: DataFrame) -> DataFrame:
    """Final rounded projection; drops stddev and last watch."""
    return labelled.select(
        "subscriber_id", "plan_type", "country",
        "total_sessions_30d", "active_days_30d",
        R.round_half_up("total_watch_time_h", 2).alias("total_watch_time_h"),
        R.round_half_up("avg_completion_rate", 4).alias("avg_completion_rate"),
        R.round_half_up("avg_engagement_score", 2).alias("avg_engagement_score"),
        "days_since_last_watch", "favourite_device",
        R.round_half_up("completion_rate", 4).alias("completion_rate"),
        R.round_half_up("abandonment_rate", 4).alias("abandonment_rate"),
        "sessions_last_7d", "unique_content_count",
        "activity_trend", "churn_risk_label", "computed_at",
    )


def gold(silver: DataFrame, as_of=None) -> DataFrame:
    """gold_churn_features: one row per (subscriber, plan, country)."""
    return project_gold(with_labels(subscriber_activity(silver, as_of), as_of))


def gold_by_subscriber(silver: DataFrame, as_of=None) -> DataFrame:
    """One row per subscriber (G2): the same features over all of the
    subscriber's events, with plan and country of the latest event."""
    recent = recent_window(silver, as_of)
    latest = F.struct("event_timestamp", "ingested_at", "event_id")
    act = recent.groupBy("subscriber_id").agg(
        F.max_by("plan_type", latest).alias("plan_type"),
        F.max_by("country", latest).alias("country"),
        *_activity_aggs(as_of))
    return project_gold(with_labels(act, as_of))


def gold_dag_columns(gold_df: DataFrame) -> DataFrame:
    """The DAG's gold table shape (X4 in ``completion_rate_trend`` is added
    by :func:`completion_trend`; X5 ``sessions_last_30d`` is an alias)."""
    return gold_df.withColumn("sessions_last_30d", F.col("total_sessions_30d"))


def completion_trend(silver: DataFrame, as_of=None) -> DataFrame:
    """Average completion of the last 7 days minus that of the 23 days
    before, per (subscriber, plan, country). NULL when either side is empty."""
    d = R.as_of_date(as_of)
    last7 = F.col("event_date") >= F.date_sub(d, 7)
    out = recent_window(silver, as_of).groupBy(*GRAIN).agg(
        F.avg(F.when(last7, F.col("completion_pct"))).alias("_a"),
        F.avg(F.when(~last7, F.col("completion_pct"))).alias("_b"))
    return out.select(*GRAIN, R.round_half_up(F.col("_a") - F.col("_b"), 4)
                      .alias("completion_rate_trend"))


# --- gold over a series of days ---------------------------------------------------------

def gold_snapshots(silver: DataFrame, first_day, last_day, days: int = 30) -> DataFrame:
    """Gold as it would have been computed at midnight of every day in
    [first_day, last_day]: each snapshot sees the events before its clock
    and within its ``days``-day window.

    One scan: every event fans out to three partial keys - the day itself,
    its device, its content item - and one aggregation reduces them to one
    partial row per (grain, day, kind, key). Only those partials are copied
    to the snapshot days they belong to (at most ``days`` copies each), then
    summed per (snapshot, grain, kind, key) and finished per (snapshot, grain)
    with conditional aggregates: day totals give the sums and counts, device
    counts give the mode, content rows give the distinct count. No join.
    """
    lo = F.to_date(F.lit(str(first_day)))
    hi = F.to_date(F.lit(str(last_day)))
    # only days that reach some snapshot; literals, so partitions are pruned
    src = silver.where((F.col("event_date") >= F.date_sub(lo, days))
                       & (F.col("event_date") < hi))

    DAY, DEVICE, CONTENT = 0, 1, 2
    kinds = F.array(
        F.struct(F.lit(DAY).alias("kind"), F.lit(None).cast(T.StringType()).alias("key")),
        F.struct(F.lit(DEVICE).alias("kind"), F.col("device_type").alias("key")),
        F.struct(F.lit(CONTENT).alias("kind"), F.col("content_id").alias("key")))
    fanned = src.select(*GRAIN, "event_date", "watch_duration_s", "completion_pct",
                        "engagement_score", "event_timestamp", "watch_category",
                        F.explode(kinds).alias("k")).select("*", "k.kind", "k.key").drop("k")
    day_row = F.col("kind") == DAY
    partial = fanned.groupBy(*GRAIN, "event_date", "kind", "key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(day_row, F.col("watch_duration_s"))).alias("watch"),
        F.sum(F.when(day_row, F.col("completion_pct"))).alias("c_sum"),
        F.count(F.when(day_row, F.col("completion_pct"))).alias("c_n"),
        F.sum(F.when(day_row, F.col("engagement_score"))).alias("e_sum"),
        F.count(F.when(day_row, F.col("engagement_score"))).alias("e_n"),
        F.max(F.when(day_row, F.col("event_timestamp"))).alias("last_ts"),
        F.count_if(day_row & (F.col("watch_category") == "completed")).alias("n_completed"),
        F.count_if(day_row & (F.col("watch_category") == "abandoned")).alias("n_abandoned"))

    start = F.greatest(F.date_add("event_date", 1), lo)
    stop = F.least(F.date_add("event_date", days), hi)
    keys = ["snapshot_date", *GRAIN]
    copied = (partial.where(start <= stop)
                     .select("*", F.explode(F.sequence(start, stop)).alias("snapshot_date")))
    recent7 = F.col("event_date") >= F.date_sub("snapshot_date", 7)
    per_key = copied.groupBy(*keys, "kind", "key").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_days"),
        F.sum("watch").alias("watch"), F.sum("c_sum").alias("c_sum"), F.sum("c_n").alias("c_n"),
        F.sum("e_sum").alias("e_sum"), F.sum("e_n").alias("e_n"), F.max("last_ts").alias("last_ts"),
        F.sum("n_completed").alias("n_completed"), F.sum("n_abandoned").alias("n_abandoned"),
        F.sum(F.when(recent7, F.col("n"))).alias("n_7d"))

    day_k, dev_k, con_k = (F.col("kind") == DAY), (F.col("kind") == DEVICE), (F.col("kind") == CONTENT)
    total = F.sum(F.when(day_k, F.col("n")))
    act = per_key.groupBy(*keys).agg(
        total.alias("total_sessions_30d"),
        F.sum(F.when(day_k, F.col("n_days"))).alias("active_days_30d"),
        (F.sum(F.when(day_k, F.col("watch"))).cast(T.DoubleType()) / F.lit(3600.0))
         .alias("total_watch_time_h"),
        (F.sum(F.when(day_k, F.col("c_sum"))) / F.sum(F.when(day_k, F.col("c_n"))))
         .alias("avg_completion_rate"),
        (F.sum(F.when(day_k, F.col("e_sum"))) / F.sum(F.when(day_k, F.col("e_n"))))
         .alias("avg_engagement_score"),
        F.max(F.when(day_k, F.col("last_ts"))).alias("last_watch_at"),
        (F.sum(F.when(day_k, F.col("n_completed"))) / total).alias("completion_rate"),
        (F.sum(F.when(day_k, F.col("n_abandoned"))) / total).alias("abandonment_rate"),
        F.coalesce(F.sum(F.when(day_k, F.col("n_7d"))), F.lit(0)).alias("sessions_last_7d"),
        # most sessions; ties go to the smallest device name
        F.min_by(F.when(dev_k, F.col("key")),
                 F.when(dev_k, F.struct((-F.col("n")).alias("neg_n"), F.col("key").alias("k"))))
         .alias("favourite_device"),
        F.count_if(con_k).alias("unique_content_count"))

    snap_at = F.col("snapshot_date").cast(T.TimestampNTZType())
    act = (act.withColumn("snapshot_at", snap_at)
              .withColumn("days_since_last_watch",
                          R.whole_days_between(snap_at, F.col("last_watch_at"))))
    return project_gold_by(with_labels(act, F.col("snapshot_at")), ["snapshot_date"])


def project_gold_by(labelled: DataFrame, keys: list[str]) -> DataFrame:
    """The gold projection with extra leading key columns."""
    return _round_gold(labelled.select(*keys, *project_gold(labelled).columns))


def _round_gold(df: DataFrame) -> DataFrame:
    spec = {"total_watch_time_h": 2, "avg_completion_rate": 4, "avg_engagement_score": 2,
            "completion_rate": 4, "abandonment_rate": 4}
    return df.select(*[R.round_half_up(c, spec[c]).alias(c) if c in spec else F.col(c)
                       for c in df.columns])


# --- S10 / J2 ---------------------------------------------------------------------------------

def upsert_columns(target: DataFrame, source: DataFrame, key: str,
                   update_cols: list[str], stamp_col: str | None = "computed_at",
                   as_of=None) -> DataFrame:
    """``INSERT .. ON CONFLICT (key) DO UPDATE SET update_cols, stamp = now``.

    New keys come in whole; matched keys take ``update_cols`` from the
    source and keep every other column; unmatched target rows stay. One
    full-outer join on the key.
    """
    cols = target.columns
    t = target.alias("t")
    s = source.alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    in_src = F.col(f"s.{key}").isNotNull()
    in_tgt = F.col(f"t.{key}").isNotNull()
    out = []
    for c in cols:
        if c == key:
            out.append(F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c))
        elif c == stamp_col:
            out.append(F.when(in_src, R.as_of_literal(as_of)).otherwise(F.col(f"t.{c}")).alias(c))
        elif c in update_cols or c in source.columns:
            src_wins = (in_src & ~in_tgt) | (in_src & F.lit(c in update_cols))
            src_val = F.col(f"s.{c}") if c in source.columns else F.lit(None)
            out.append(F.when(src_wins, src_val).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return joined.select(*out)


# --- A5 / A6 / L4 --------------------------------------------------------------------------------

def risk_distribution(gold_df: DataFrame) -> DataFrame:
    return gold_df.groupBy("churn_risk_label").agg(F.count(F.lit(1)).alias("subscribers"))


def distinct_subscribers(silver: DataFrame, limit: int | None = None) -> DataFrame:
    """Distinct (subscriber, plan, country); an optional, ordered limit (L4)."""
    d = silver.select(*GRAIN).distinct()
    if limit is not None:
        d = d.orderBy(*GRAIN).limit(limit)
    return d
