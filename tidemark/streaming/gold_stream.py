"""Sliding 30-day gold as a stream.

A sliding window is merged from day panes: the stored daily partials of
``operators.gold_state``. A micro-batch of bronze rows is upserted into silver by
event id, only the days it touches get their pane computed again, and the gold
of any day is merged from the 30 panes before it. An event is held once, not
once a window it slides through, and no event is read to answer for a day.

Files may come in any order. No row is dropped for being late: a late row
changes the pane of its own day, and so every window over that day. Rows older
than ``late_days`` before the latest event day of the batches before theirs are
counted, per batch and event day, in a side table, so that a consumer who has
already used a window knows which ones changed.

Every step may be repeated: the days of a batch are noted before silver changes
and refreshed after it, and all tables are written by batch id or by day. A
batch that died at any point is done again with the same result.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..functions import rules as R
from ..operators import gold_state as GS
from ..operators import silver as SV
from ..session import cut_lineage
from ..sources import tables as TB
from . import streams as ST

_NOTED = f"event_date date, {ST.BATCH_COL} bigint"


def paths(root: str) -> dict:
    r = root.rstrip("/")
    return {"silver": f"{r}/silver", "panes": f"{r}/panes", "noted": f"{r}/noted_days",
            "late": f"{r}/late_rows", "seen": f"{r}/latest_day"}


def _by_batch(rows: DataFrame, batch_id: int, path: str, mode: str = "overwrite") -> None:
    (rows.withColumn(ST.BATCH_COL, F.lit(batch_id).cast(T.LongType())).coalesce(1)
         .write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(ST.BATCH_COL).parquet(path))


def merge_batch(spark: SparkSession, batch: DataFrame, batch_id: int, root: str, as_of=None, late_days: int = 2) -> list[_dt.date]:
    """One micro-batch of bronze rows into silver and the panes; the days refreshed."""
    p = paths(root)
    updates = cut_lineage(SV.silver(batch, as_of))
    seen = TB.read_if_exists(spark, p["seen"])
    latest = None if seen is None else seen.where(F.col(ST.BATCH_COL) < batch_id).agg(F.max("event_date")).first()[0]
    if latest is not None:
        late = updates.where(F.col("event_date") < F.lit(latest - _dt.timedelta(days=late_days)))
        _by_batch(late.groupBy("event_date").agg(F.count(F.lit(1)).alias("late_rows")), batch_id, p["late"])

    def note(days: list[_dt.date]) -> None:
        if days:
            _by_batch(R.literal_table(spark, [(d,) for d in days], "event_date date"), batch_id, p["noted"], mode="append")

    ST.upsert_latest(spark, updates, p["silver"], before_swap=note)
    noted = TB.read_if_exists(spark, p["noted"])
    days = [] if noted is None else sorted(
        r[0] for r in noted.where(F.col(ST.BATCH_COL) == batch_id).select("event_date").distinct().collect())
    if days:
        GS.write_state(spark, spark.read.parquet(p["silver"]), p["panes"], days)
    _by_batch(updates.agg(F.max("event_date").alias("event_date")), batch_id, p["seen"])
    return days


def start_gold_stream(spark: SparkSession, bronze_source: str, root: str, checkpoint: str, as_of=None, late_days: int = 2,
                      trigger: str | None = None, max_files_per_trigger: int | None = None,
                      schema: T.StructType = S.BRONZE_SCHEMA) -> StreamingQuery:
    """Keep silver and the day panes under ``root`` up to date with a stream of bronze files."""
    src = ST.read_events_stream(spark, bronze_source, schema, max_files_per_trigger=max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch.sparkSession, batch, batch_id, root, as_of, late_days)

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return ST._trigger(w, trigger).start()


def gold_of_day(spark: SparkSession, root: str, day: _dt.date) -> DataFrame:
    """Gold at midnight of ``day``: the 30 panes before it."""
    panes = spark.read.parquet(paths(root)["panes"]).where(F.col("event_date") < F.lit(day))
    out = GS.gold_from_state(panes, f"{day} 00:00:00")
    return out.select(F.lit(day).alias("snapshot_date"), *out.columns)


def late_rows(spark: SparkSession, root: str) -> DataFrame | None:
    """Late rows by event day, over all batches (None before the second batch)."""
    late = TB.read_if_exists(spark, paths(root)["late"])
    return None if late is None else late.groupBy("event_date").agg(F.sum("late_rows").alias("late_rows"))
