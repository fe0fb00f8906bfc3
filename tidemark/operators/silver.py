"""Bronze -> silver: admit, de-duplicate, clean, enrich.

The chain mirrors the four steps of the reference model, each a lazy
DataFrame so Catalyst sees one plan: the admission filter and the high-water
filter reach the Parquet scan, and the ``row_number() = 1`` cut is planned as
a partial ``WindowGroupLimit`` before the shuffle on ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R


# --- P1 / P2 ---------------------------------------------------------------------

def admit(bronze: DataFrame, require_timestamp: bool = True) -> DataFrame:
    """Rows fit for silver: subscriber present, completion in [0, 1]
    (NULL and NaN fail), and, unless ``require_timestamp`` is off (P2), a
    timestamp."""
    cond = F.col("subscriber_id").isNotNull() & F.col("completion_pct").between(0, 1)
    if require_timestamp:
        cond = cond & F.col("event_timestamp").isNotNull()
    return bronze.where(cond)


# --- W1 / P4 ------------------------------------------------------------------------

def keep_latest(df: DataFrame, key: str = "event_id",
                order_col: str = "ingested_at") -> DataFrame:
    """One row per ``key``: the latest by ``order_col``.

    Ties, which the reference leaves open, go to the higher run id and then
    to a hash of the whole row, so the result never depends on file order.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    w = Window.partitionBy(key).orderBy(
        F.col(order_col).desc_nulls_last(),
        F.col("pipeline_run_id").desc_nulls_last() if "pipeline_run_id" in df.columns else F.lit(0),
        tie.desc())
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


# --- F1-F6 ----------------------------------------------------------------------------

def clean(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "subscriber_id", "content_id",
        R.clean_device("device_type").alias("device_type"),
        F.lower("event_type").alias("event_type"),
        R.non_negative("watch_duration_s").cast(T.IntegerType()).alias("watch_duration_s"),
        R.round_half_up("completion_pct", 4).alias("completion_pct"),
        F.lower("plan_type").alias("plan_type"),
        F.upper("country").alias("country"),
        "event_timestamp", "app_version", "ingested_at", "pipeline_run_id",
    )


# --- F7-F18 -----------------------------------------------------------------------------

def enrich(df: DataFrame, as_of=None) -> DataFrame:
    ts = F.col("event_timestamp")
    dow = R.day_of_week_sun0(ts)
    return df.select(
        "*",
        R.watch_category("completion_pct").alias("watch_category"),
        R.session_length_category("watch_duration_s").alias("session_length_category"),
        F.to_date(ts).alias("event_date"),
        F.hour(ts).cast(T.IntegerType()).alias("event_hour"),
        dow.alias("day_of_week"),
        dow.isin(0, 6).alias("is_weekend"),
        R.engagement_score("completion_pct", "watch_duration_s").alias("engagement_score"),
        R.as_of_literal(as_of).alias("transformed_at"),
    )


def silver(bronze: DataFrame, as_of=None) -> DataFrame:
    """Full silver build from bronze (dbt model, first run)."""
    return enrich(clean(keep_latest(admit(bronze))), as_of)


def silver_dag_variant(bronze: DataFrame, as_of=None) -> DataFrame:
    """The DAG's silver: no timestamp test, no dedup, no cleaning, fewer
    derived columns (P2). Kept as a projection for users of that table."""
    ts = F.col("event_timestamp")
    return admit(bronze, require_timestamp=False).select(
        "event_id", "subscriber_id", "content_id", "device_type", "event_type",
        "watch_duration_s", "completion_pct", "plan_type", "country",
        "event_timestamp", "app_version",
        R.watch_category("completion_pct").alias("watch_category"),
        R.session_length_category("watch_duration_s").alias("session_length_category"),
        F.to_date(ts).alias("event_date"),
        F.hour(ts).cast(T.IntegerType()).alias("event_hour"),
        R.as_of_literal(as_of).alias("transformed_at"),
    )


# --- A7 / P3 / J3: incremental load ------------------------------------------------------

def high_water_mark(target: DataFrame | None, col: str = "transformed_at"):
    """Largest ``col`` in the target, or None when there is no target or it
    is empty (then everything loads, D12). One scalar reaches the driver."""
    if target is None:
        return None
    return target.agg(F.max(col).alias("m")).first()["m"]


def new_since(bronze: DataFrame, mark) -> DataFrame:
    """Bronze rows ingested strictly after ``mark`` (a literal, so it is
    pushed to the scan). When bronze is partitioned by ``ingest_date``, the
    implied day bound prunes whole partitions as well."""
    if mark is None:
        return bronze
    out = bronze.where(F.col("ingested_at") > R.as_of_literal(mark))
    if "ingest_date" in bronze.columns:
        out = out.where(F.col("ingest_date") >= R.as_of_date(mark))
    return out


def merge_by_key(target: DataFrame, updates: DataFrame, key: str = "event_id") -> DataFrame:
    """Upsert: rows of ``updates`` replace target rows with the same key.

    Where Spark finds the updates' keys small it broadcasts them, and the target
    side of the anti-join is filtered where it is read instead of shuffled."""
    keys = updates.select(key).distinct()
    return target.join(keys, on=key, how="left_anti").unionByName(updates)


def silver_incremental(bronze: DataFrame, target: DataFrame | None, as_of=None) -> DataFrame:
    """Next state of silver after one incremental run.

    Only bronze rows newer than the target's last transform are processed;
    they are de-duplicated among themselves and replace existing rows by
    ``event_id``.
    """
    mark = high_water_mark(target)
    updates = silver(new_since(bronze, mark), as_of)
    if target is None:
        return updates
    return merge_by_key(sync_columns(target, updates), updates)


# --- S8 ---------------------------------------------------------------------------------------

def sync_columns(target: DataFrame, new: DataFrame) -> DataFrame:
    """Give ``target`` exactly the columns of ``new``: added columns are
    NULL in old rows, dropped columns disappear (``sync_all_columns``)."""
    out = target
    for f in new.schema.fields:
        if f.name not in target.columns:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in new.schema.fields])


def empty_like(df: DataFrame) -> DataFrame:
    """``CREATE TABLE .. AS SELECT .. LIMIT 0`` (S5, L5): schema only."""
    return df.limit(0)
