"""Structured Streaming ingest and silver.

* Bronze stream (T2, T3): files (or a topic, by configuration) with a fixed
  schema -> ``foreachBatch`` anti-join against the stored keys: exact
  insert-if-absent across any delay, nothing lost. De-duplication in state
  (``dropDuplicatesWithinWatermark``) can be added and is off by default.
* Silver stream (T4, T5): bronze files -> ``foreachBatch``: the batch's
  quality score gates it (a failing batch is written to quarantine and the
  query stops), then it is upserted into silver by ``event_id``, rewriting
  only the ``event_date`` partitions it touches; late events therefore
  update their own day.

Both sinks are idempotent by batch id: a replayed batch rewrites its own
output instead of adding to it, so a lost executor or a restarted query
leaves no duplicates. State and progress live in the checkpoint location,
which must be on shared storage.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import ingest as IN
from ..operators import quality as QU
from ..operators import silver as SV
from ..operators.joins import stored_matches
from ..sources import tables as TB
from ..session import cut_lineage

BATCH_COL = "_batch_id"


def read_events_stream(spark: SparkSession, source: str | None, schema: T.StructType = S.BRONZE_SCHEMA,
                       fmt: str = "parquet", max_files_per_trigger: int | None = None,
                       options: dict | None = None) -> DataFrame:
    """Event stream.

    Files: Parquet (or another file format) under ``source`` with a fixed
    schema. Topic: ``fmt='kafka'`` with the broker and topic in ``options``
    (the connector jar must be on the classpath); each message value is a
    JSON event record, parsed with :func:`events_from_text`, and the broker
    timestamp is the ingest time."""
    r = spark.readStream.format(fmt)
    if fmt != "kafka":
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if fmt == "kafka":
        raw = r.load()
        return events_from_text(raw.select(F.col("value").cast(T.StringType()).alias("value"),
                                           F.col("timestamp").alias("_arrived")))
    return r.load(source)


def events_from_text(text: DataFrame) -> DataFrame:
    """JSON event records (``value``) plus their arrival time (``_arrived``)
    as bronze-shaped rows; unparsable records keep ``_corrupt_record`` and
    are routed to quarantine by the bronze writer."""
    parsed = IN.parse_events_json(text, "value", keep=["_arrived"])
    return parsed.select(
        *[c for c in parsed.columns if c not in ("_arrived",)],
        F.col("_arrived").cast(T.TimestampNTZType()).alias("ingested_at"),
        F.lit(None).cast(T.StringType()).alias("pipeline_run_id"))


def _trigger(writer, trigger: str | None):
    """``None``/``'available_now'`` drains what is there and stops; any other
    text is a processing-time interval such as ``'15 minutes'`` (T1)."""
    if trigger in (None, "available_now"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


# --- bronze ---------------------------------------------------------------------------------

def _bronze_batch_writer(sink: str, run_id: str, horizon_batches: int | None,
                         quarantine: str | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = None
        if "_corrupt_record" in batch.columns:
            # records that did not parse go to quarantine, by batch id (idempotent)
            batch = held = batch.persist()
            bad = batch.where(F.col("_corrupt_record").isNotNull())
            (bad.select("_corrupt_record").withColumn(BATCH_COL, F.lit(batch_id).cast(T.LongType()))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(BATCH_COL).parquet(quarantine))
            batch = batch.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
        stored = TB.read_if_exists(spark, sink)
        # the batch's own earlier attempt is not "stored": replays stay exact
        existing = stored.where(F.col(BATCH_COL) != batch_id) if stored is not None else None
        if existing is not None and horizon_batches is not None:
            # batch ids are partition values: older batches are pruned, not read
            existing = existing.where(F.col(BATCH_COL) >= batch_id - horizon_batches)
        rows = IN.ingest_to_bronze(batch, existing, run_id=run_id, stamp_ingested_at=False,
                                   count=False).rows
        (rows.withColumn(BATCH_COL, F.lit(batch_id).cast(T.LongType()))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(BATCH_COL).parquet(sink))
        if held is not None:
            held.unpersist()
    return write


def start_bronze_stream(events: DataFrame, sink: str, checkpoint: str, run_id: str = "stream",
                        dedup_delay: str | None = None,
                        trigger: str | None = None,
                        horizon_batches: int | None = None,
                        quarantine: str | None = None) -> StreamingQuery:
    """Idempotent bronze ingest from an event stream.

    The anti-join in ``foreachBatch`` drops every copy of a stored event,
    whatever the order of arrival, and loses nothing. ``dedup_delay`` also
    drops copies in state, by a watermark on ``ingested_at``; Spark then drops
    rows older than the watermark, so set it only where arrivals are in order.
    A stream that may hold records that do not parse needs ``quarantine``.

    The anti-join reads the key column of every stored batch (exact for
    ever); ``horizon_batches`` limits it to the last N batches, which bounds
    the cost per micro-batch for sources whose re-deliveries are known to
    arrive within that horizon.
    """
    if "_corrupt_record" in events.columns and quarantine is None:
        raise ValueError("name a quarantine path: the stream may hold records that do not parse")
    deduped = events
    if dedup_delay:
        # watermarks need TIMESTAMP (not _NTZ); the cast only orders arrivals
        deduped = (events.withColumn("_arrival", F.col("ingested_at").cast(T.TimestampType()))
                         .withWatermark("_arrival", dedup_delay)
                         .dropDuplicatesWithinWatermark(["event_id"])
                         .drop("_arrival"))
    w = (deduped.writeStream.foreachBatch(_bronze_batch_writer(sink, run_id, horizon_batches,
                                                               quarantine))
                .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


# --- silver ---------------------------------------------------------------------------------

class QualityGateStop(RuntimeError):
    pass


def _silver_batch_writer(sink: str, quarantine: str, as_of, gate: bool, threshold: float,
                         lookback_days: int | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # read twice (gate, then silver); a lost executor recomputes from the files
        batch = (batch.drop(BATCH_COL) if BATCH_COL in batch.columns else batch).persist()
        try:
            if gate:
                report = QU.quality_report(batch, as_of, threshold).first()
                if report["total_rows"] and not report["passed"]:
                    (batch.withColumn(BATCH_COL, F.lit(batch_id).cast(T.LongType()))
                          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                          .partitionBy(BATCH_COL).parquet(quarantine))
                    raise QualityGateStop(
                        f"batch {batch_id}: quality score {report['quality_score']}% "
                        f"below {threshold}%")
            upsert_latest(spark, SV.silver(batch, as_of), sink, lookback_days)
        finally:
            batch.unpersist()
    return write


def upsert_latest(spark: SparkSession, updates: DataFrame, path: str,
                  lookback_days: int | None = None, before_swap=None) -> None:
    """Merge ``updates`` into the event_date-partitioned table at ``path``:
    per ``event_id`` the latest ingested row wins, whichever side it is on,
    so replays and out-of-order batches converge to the same table.

    Earlier copies of the batch's keys are looked for in all partitions
    (exact), or only within ``lookback_days`` of the batch's days.
    ``before_swap`` is called with the touched days before any of them changes."""
    updates = cut_lineage(updates)
    target = TB.read_if_exists(spark, path)
    if target is None:
        if before_swap is not None:
            before_swap([r[0] for r in updates.select("event_date").distinct().collect()])
        updates.write.mode("overwrite").partitionBy("event_date").parquet(path)
        return
    scope = target
    if lookback_days is not None:
        lo, hi = updates.agg(F.min("event_date"), F.max("event_date")).first()
        scope = scope.where(F.col("event_date").between(
            lo - _dt.timedelta(days=lookback_days), hi + _dt.timedelta(days=lookback_days)))
    # earlier copies of the batch's keys, found through the broadcast batch keys
    moved = stored_matches(scope, updates, "event_id", ["event_date"]).select("event_date")
    # one value per touched day: a small list, used as literals to prune
    touched = [r[0] for r in updates.select("event_date").unionByName(moved).distinct().collect()]
    if before_swap is not None:
        before_swap(touched)
    affected = target.where(F.col("event_date").isin(touched))
    merged = SV.keep_latest(SV.sync_columns(affected, updates).unionByName(updates))
    TB.swap_partitions(cut_lineage(merged), path, ["event_date"], [(d,) for d in touched])


def start_silver_stream(spark: SparkSession, bronze_path: str, sink: str, quarantine: str,
                        checkpoint: str, as_of=None, gate: bool = True,
                        threshold: float = S.QUALITY_THRESHOLD, trigger: str | None = None,
                        max_files_per_trigger: int | None = None,
                        moved_keys_lookback_days: int | None = None) -> StreamingQuery:
    """Gated, upserting silver stream over the bronze table (T4, T5)."""
    schema = T.StructType(S.BRONZE_SCHEMA.fields + [T.StructField(BATCH_COL, T.LongType())])
    src = read_events_stream(spark, bronze_path, schema, max_files_per_trigger=max_files_per_trigger)
    writer = _silver_batch_writer(sink, quarantine, as_of, gate, threshold, moved_keys_lookback_days)
    w = (src.writeStream.foreachBatch(writer)
            .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def land_by_day(bronze: DataFrame, root: str) -> str:
    """Write bronze as one folder per ingest day (stream input fixture) in
    one job; returns the glob a file stream reads."""
    (bronze.withColumn("ingest_day", F.to_date("ingested_at"))
           .write.mode("overwrite").partitionBy("ingest_day").parquet(root))
    return f"{root.rstrip('/')}/*"


# --- X7 as a stream: windowed latency KPIs -----------------------------------------------------

def start_latency_stream(events: DataFrame, sink: str, checkpoint: str,
                         window: str = "15 minutes", delay: str = "1 hour",
                         alert_s: int = 15 * 60, trigger: str | None = None) -> StreamingQuery:
    """Events and end-to-end latency per ingest window (X7), kept up to date by a stream.

    A micro-batch is reduced to mergeable partials (count, sum, maximum, alerts)
    per window, stored under its batch id; ``read_latency_sink`` merges the
    partials of a window. No row is dropped for being late and no state grows in
    the store's memory: a late row is one more partial of its window. Rows that
    arrive more than ``delay`` behind the newest arrival of the batches before
    theirs are counted as ``beyond_delay``, so that a consumer who has used a
    window knows that it changed. A replayed batch writes the same partitions again.
    """
    from ..operators.kpis import latency_seconds
    lat = latency_seconds()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = TB.read_if_exists(spark, sink)
        newest = None if seen is None else seen.where(F.col(BATCH_COL) < batch_id).agg(F.max("newest")).first()[0]
        late = F.lit(False) if newest is None else F.col("ingested_at") < F.lit(newest) - F.expr(f"INTERVAL {delay}")
        (batch.where(F.col("event_timestamp").isNotNull())
              .groupBy(F.window("ingested_at", window).alias("w"))
              .agg(F.count(F.lit(1)).alias("events"), F.sum(lat).alias("_lat_sum"), F.max(lat).alias("_max"),
                   F.count_if(lat > alert_s).alias("late_events"), F.count_if(late).alias("beyond_delay"),
                   F.max("ingested_at").alias("newest"))
              .select(F.col("w.start").alias("window_start"), F.to_date(F.col("w.start")).alias("window_date"),
                      "events", "_lat_sum", "_max", "late_events", "beyond_delay", "newest",
                      F.lit(batch_id).cast(T.LongType()).alias(BATCH_COL))
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("window_date", BATCH_COL).parquet(sink))

    w = events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def _latency_windows(spark: SparkSession, sink: str) -> DataFrame:
    """One row a window: its partials merged."""
    return spark.read.parquet(sink).groupBy("window_start").agg(
        F.sum("events").alias("events"), (F.sum("_lat_sum") / F.sum("events")).alias("_avg"), F.max("_max").alias("_max"),
        F.sum("late_events").alias("late_events"), F.sum("beyond_delay").alias("beyond_delay"))


def latency_beyond_delay(spark: SparkSession, sink: str) -> DataFrame:
    """Windows that rows changed after their delay, and how many rows."""
    return _latency_windows(spark, sink).where("beyond_delay > 0").select("window_start", "beyond_delay")


def read_latency_sink(spark: SparkSession, sink: str, window: str = "15 minutes",
                      alert_s: int = 15 * 60) -> DataFrame:
    """The latency sink in the shape of ``kpis.latency_kpis``."""
    from ..functions import rules as R
    from ..operators.kpis import window_seconds
    window_s = window_seconds(window)
    t = _latency_windows(spark, sink)
    return t.select(
        "window_start", "events",
        R.round_half_up(F.col("events") / F.lit(float(window_s)), 4).alias("events_per_sec"),
        R.round_half_up("_avg", 3).alias("avg_latency_s"),
        R.round_half_up("_max", 3).alias("max_latency_s"),
        "late_events",
        (F.col("_max") > alert_s).alias("latency_alert"))
