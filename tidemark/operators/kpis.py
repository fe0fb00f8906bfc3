"""Pipeline and business indicators, and the alert table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import rules as R

LATENCY_ALERT_S = 15 * 60


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def window_seconds(window: str) -> int:
    """Length of a window duration such as ``'15 minutes'`` or ``'1 hour'``."""
    n, unit = window.split()
    return int(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def latency_micros(ingested="ingested_at", event="event_timestamp") -> F.Column:
    """End-to-end latency in whole microseconds."""
    return F.timestamp_diff("MICROSECOND", F.col(event), F.col(ingested))


def latency_window(window: str = "15 minutes", ingested="ingested_at") -> F.Column:
    """Start of the ingest window of a row."""
    return F.window(F.col(ingested), window)["start"]


def latency_seconds(ingested="ingested_at", event="event_timestamp") -> F.Column:
    """End-to-end latency in seconds (microsecond exact, no time zone)."""
    return latency_micros(ingested, event).cast(T.DoubleType()) / F.lit(1e6)


def daily_kpis(silver: DataFrame) -> DataFrame:
    """Per event day, active subscribers, events and viewing hours."""
    return silver.groupBy("event_date").agg(
        F.count_distinct("subscriber_id").alias("active_subscribers"),
        F.count(F.lit(1)).alias("events"),
        R.round_half_up(F.sum("watch_duration_s").cast(T.DoubleType()) / F.lit(3600.0), 2)
         .alias("viewing_hours"))


def latency_kpis(bronze: DataFrame, window: str = "15 minutes",
                 alert_s: int = LATENCY_ALERT_S) -> DataFrame:
    """Per ingest window, events, events per second, mean and max
    latency, events later than ``alert_s`` and an alert flag."""
    lat = latency_seconds()
    w = F.window(F.col("ingested_at"), window)
    df = bronze.where(F.col("event_timestamp").isNotNull())
    out = df.groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("events"),
        F.avg(lat).alias("_avg"), F.max(lat).alias("max_latency_s"),
        F.count_if(lat > alert_s).alias("late_events"))
    span = F.lit(float(window_seconds(window)))
    return out.select(
        F.col("w.start").alias("window_start"),
        "events",
        R.round_half_up(F.col("events") / span, 4).alias("events_per_sec"),
        R.round_half_up("_avg", 3).alias("avg_latency_s"),
        R.round_half_up("max_latency_s", 3).alias("max_latency_s"),
        "late_events",
        (F.col("max_latency_s") > alert_s).alias("latency_alert"))


def latency_percentiles(bronze: DataFrame, window: str = "15 minutes",
                        accuracy: int = 10000) -> DataFrame:
    """p50/p99 latency per ingest window (approximate quantile sketch,
    bounded memory per group)."""
    lat = latency_seconds()
    w = F.window(F.col("ingested_at"), window)
    return (bronze.where(F.col("event_timestamp").isNotNull())
                  .groupBy(w.alias("w"))
                  .agg(F.percentile_approx(lat, [0.5, 0.99], accuracy).alias("q"))
                  .select(F.col("w.start").alias("window_start"),
                          F.col("q")[0].alias("p50_latency_s"), F.col("q")[1].alias("p99_latency_s")))


def alerts(quality: DataFrame | None = None, drift: DataFrame | None = None,
           latency: DataFrame | None = None, as_of=None) -> DataFrame:
    """One row per fired rule: quality below threshold, drift alert,
    latency above 15 minutes."""
    parts = []
    at = R.as_of_literal(as_of)
    if quality is not None:
        parts.append(quality.where(~F.col("passed")).select(
            F.lit("quality").alias("alert_type"), F.lit("HIGH").alias("severity"),
            F.concat(F.lit("quality score "), F.col("quality_score").cast(T.StringType()),
                     F.lit(f"% below {S.QUALITY_THRESHOLD}%")).alias("message"),
            at.alias("raised_at")))
    if drift is not None:
        key = [c for c in ("snapshot_date",) if c in drift.columns]
        parts.append(drift.where("overall_alert").select(
            F.lit("drift").alias("alert_type"), F.col("alert_level").alias("severity"),
            (F.concat(F.col(key[0]).cast(T.StringType()), F.lit(": "), F.col("recommendation"))
             if key else F.col("recommendation")).alias("message"),
            at.alias("raised_at")))
    if latency is not None:
        parts.append(latency.where("latency_alert").select(
            F.lit("latency").alias("alert_type"), F.lit("HIGH").alias("severity"),
            F.concat(F.lit("window "), F.date_format("window_start", "yyyy-MM-dd HH:mm"),
                     F.lit(": max latency "), F.col("max_latency_s").cast(T.StringType()),
                     F.lit(" s")).alias("message"),
            at.alias("raised_at")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
