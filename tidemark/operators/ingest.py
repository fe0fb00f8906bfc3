"""Bronze ingest.

Insert-if-absent on ``event_id``: the incoming batch is de-duplicated among
itself (first arrival wins), anti-joined with the keys already stored, then
stamped with the run id and ingest time. Only the key column of the target
is read, filtered by the batch's broadcast keys; the target never shuffles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import rules as R
from . import key_index as KI
from .joins import absent_from


@dataclass
class IngestResult:
    rows: DataFrame          # rows to append (lazy, or kept)
    received: int
    inserted: int
    skipped: int


def conform(df: DataFrame, schema: T.StructType = S.BRONZE_SCHEMA,
            defaults: dict | None = None) -> DataFrame:
    """Shape a frame to the bronze schema: missing columns become NULL,
    DDL defaults fill NULLs, types are cast (S4)."""
    defaults = S.BRONZE_DEFAULTS if defaults is None else defaults
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def first_arrival(df: DataFrame, key: str = "event_id",
                  order: list[str] | None = None) -> DataFrame:
    """One row per key inside a batch: the first by ``order`` (default
    ``ingested_at`` then a row hash, so the pick never depends on file order)."""
    order = order if order is not None else (["ingested_at"] if "ingested_at" in df.columns else [])
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order], tie)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def absent_keys(batch: DataFrame, existing_keys: DataFrame | None,
                key: str = "event_id") -> DataFrame:
    """Rows of ``batch`` whose key is not stored yet (J1, ``left_anti``).

    Only the key column of the store is scanned. Where Spark finds the batch's
    keys small it broadcasts them, and the stored keys are filtered where they
    are read (``joins.absent_from``)."""
    if existing_keys is None:
        return batch
    return absent_from(batch, existing_keys, key)


def ingest_to_bronze(batch: DataFrame, existing: DataFrame | None, run_id: str,
                     as_of=None, stamp_ingested_at: bool = True,
                     count: bool = True, index: DataFrame | None = None,
                     unindexed: list | None = (),
                     keep: Callable[[DataFrame, str], DataFrame] | None = None) -> IngestResult:
    """Append-ready rows for ``batch`` and true inserted/skipped counts (D3).

    ``keep`` (frame, name) stores a frame and returns what reads it: the
    batch without repeats, asked for its keys and then for its rows, and the rows
    to append are computed once each then.

    With a stored-key ``index`` (``key_index``) only the days of ``existing``
    (``ingest_date``) that may hold a key of the batch are read."""
    rows = conform(batch)
    deduped = first_arrival(rows)
    if keep is not None and existing is not None:
        deduped = keep(deduped, "batch")
    if existing is not None and index is not None:
        new = KI.absent_by_index(deduped, existing, index, unindexed)
    else:
        new = absent_keys(deduped, existing.select("event_id") if existing is not None else None)
    stamped = new.withColumn("pipeline_run_id", F.lit(run_id))
    if stamp_ingested_at:
        stamped = stamped.withColumn("ingested_at", R.as_of_literal(as_of))
    stamped = stamped.select(*S.BRONZE_COLS)
    if keep is not None:
        stamped = keep(stamped, "rows")
    if not count:
        return IngestResult(stamped, -1, -1, -1)
    counts = rows.select(F.count(F.lit(1)).alias("n")).first()["n"]
    inserted = stamped.count()
    return IngestResult(stamped, counts, inserted, counts - inserted)


def append(rows: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """``INSERT INTO`` as a set write (S6): append Parquet files."""
    w = rows.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# --- S12: event records as JSON text ------------------------------------------------------

EVENT_JSON_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType, True)
    for f in S.BRONZE_SCHEMA.fields if f.name not in ("ingested_at", "pipeline_run_id")
] + [T.StructField("_corrupt_record", T.StringType(), True)])


def parse_events_json(text: DataFrame, column: str = "value",
                      keep: list[str] | None = None) -> DataFrame:
    """Parse JSON event records (ISO-8601 times) into typed rows; records
    that do not parse keep their text in ``_corrupt_record`` (quarantine).
    ``keep`` columns of ``text`` pass through unchanged."""
    keep = keep or []
    parsed = text.select(F.from_json(F.col(column), EVENT_JSON_SCHEMA,
                                     {"mode": "PERMISSIVE",
                                      "columnNameOfCorruptRecord": "_corrupt_record"}).alias("e"),
                         F.col(column).alias("_raw"), *keep)
    fields = [f.name for f in EVENT_JSON_SCHEMA.fields]
    ts = F.col("e.event_timestamp").try_cast(T.TimestampNTZType())
    bad = (F.col("e._corrupt_record").isNotNull()
           | (F.col("e.event_timestamp").isNotNull() & ts.isNull()))
    return parsed.select(
        *[F.col(f"e.{c}").alias(c) for c in fields if c not in ("event_timestamp", "_corrupt_record")],
        ts.alias("event_timestamp"),
        F.when(bad, F.coalesce("e._corrupt_record", "_raw")).alias("_corrupt_record"),
        *keep)


def events_to_json(df: DataFrame) -> DataFrame:
    """Event rows as JSON text with ISO-8601 times (the landing format)."""
    cols = [c for c in df.columns if c not in ("ingested_at", "pipeline_run_id")]
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for c in cols
           if isinstance(df.schema[c].dataType, (T.TimestampNTZType, T.TimestampType))}
    return df.select(F.to_json(F.struct(*[iso.get(c, F.col(c)).alias(c) for c in cols])).alias("value"))


def sample(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows for a log line (L6), in a fixed order."""
    return df.orderBy(*(order or ["event_id"])).limit(n)
