"""Parquet table store: partition-swap upsert, versioned overwrite, landing scan
(S7, S9, S11, S15, S16).

There is no table format (Delta/Iceberg) here, so writes that replace data
never overwrite a path the plan is still reading: inputs are first written as
Parquet to a scratch folder (below the cluster's shared checkpoint folder), partitioned tables are rewritten partition by partition with dynamic
partition overwrite, and unpartitioned tables are written to a new version
directory and switched by a pointer row.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import silver as SV
from ..operators.joins import stored_matches
from ..session import ensure_checkpoint_dir


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    # hidden names don't count, partition folders do, whatever their column is called
    return any("=" in n or not n.startswith(("_", ".")) for n in names)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | None = None):
    if not _exists(spark, path):
        return None
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def swap_partitions(rows: DataFrame, path: str, cols: list[str], touched: list[tuple]) -> None:
    """Replace the ``touched`` partitions of the table at ``path`` by ``rows``.

    ``rows`` must not read the table (cut their lineage first). A touched
    partition that gets no row is removed: dynamic overwrite alone would
    leave its old rows in place. The removal comes last, so a run that dies
    before it finds the same partition again."""
    spark = rows.sparkSession
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*cols).parquet(path))
    filled = {tuple(r) for r in rows.select(*cols).distinct().collect()}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for values in set(touched) - filled:
        folder = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(cols, values))
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{folder}")
        p.getFileSystem(conf).delete(p, True)


# --- S7: incremental silver, partition swap ------------------------------------------------

_UNSET = object()


def write_silver_incremental(spark: SparkSession, bronze: DataFrame, path: str,
                             as_of=None, check_moved_keys: bool = True,
                             moved_keys_lookback_days: int | None = None,
                             mark=_UNSET,
                             partition_cols: tuple[str, ...] = ("event_date",),
                             before_swap=None) -> dict:
    """One incremental silver run against the table at ``path``.

    Reads only bronze rows newer than the table's last transform, rewrites
    only the partitions those rows touch (plus the old partitions of keys
    that moved) and leaves the rest in place. Returns counters.

    ``partition_cols``: ``("event_date",)`` by default; ``("event_date",
    "event_hour")`` makes a 15-minute batch rewrite hours instead of days.
    ``mark``: the last transform time when the caller knows it (a run log),
    which spares the scan of the table for its maximum. ``check_moved_keys``
    looks for earlier copies of the batch's keys in other partitions; it
    reads the key and partition columns of the table, all partitions by
    default, or only days within ``moved_keys_lookback_days`` of the batch's.
    ``before_swap`` is called with the touched partitions before any of them
    changes, so that what depends on them can be noted first.
    """
    target = read_if_exists(spark, path)
    if mark is _UNSET:
        mark = SV.high_water_mark(target)
    updates = SV.silver(SV.new_since(bronze, mark), as_of)
    cols = list(partition_cols)
    if target is None:      # nothing to merge with: written once, where it belongs
        updates.write.mode("overwrite").partitionBy(*cols).parquet(path)
        written = spark.read.schema(updates.schema).parquet(path).count()
        return {"high_water_mark": None, "rows_written": written, "partitions": None}
    with scratch(spark, "silver") as folder:
        return _merge_silver(spark, updates, target, path, folder, cols, mark, check_moved_keys,
                             moved_keys_lookback_days, before_swap)


def _merge_silver(spark: SparkSession, updates: DataFrame, target: DataFrame, path: str, folder: str, cols: list[str],
                  mark, check_moved_keys: bool, moved_keys_lookback_days: int | None, before_swap) -> dict:
    updates = stored(updates, f"{folder}/updates")
    n_updates = updates.count()
    if n_updates == 0:
        return {"high_water_mark": mark, "rows_written": 0, "partitions": []}

    parts = updates.select(*cols)
    if check_moved_keys:
        # partitions holding earlier copies of the batch's keys: the key and
        # partition columns of the table, filtered by the broadcast batch keys
        scope = target
        if moved_keys_lookback_days is not None:
            lo, hi = updates.agg(F.min("event_date"), F.max("event_date")).first()
            scope = scope.where(F.col("event_date").between(
                lo - _dt.timedelta(days=moved_keys_lookback_days),
                hi + _dt.timedelta(days=moved_keys_lookback_days)))
        moved = stored_matches(scope, updates, "event_id", cols).select(*cols)
        parts = parts.unionByName(moved)
    # one value per touched partition: a small, bounded list; as literals
    # they prune partitions at the scan
    touched = [tuple(r) for r in parts.distinct().collect()]
    if before_swap is not None:
        before_swap(touched)
    affected = target.where(F.col(cols[0]).isin(sorted({t[0] for t in touched})))
    if len(cols) > 1:      # as many rows as partitions were listed above
        affected = affected.join(F.broadcast(parts.distinct()), cols, "left_semi")
    merged = SV.merge_by_key(SV.sync_columns(affected, updates), updates)
    merged = stored(merged, f"{folder}/merged")
    swap_partitions(merged, path, cols, touched)
    listed = sorted(t[0] for t in touched) if len(cols) == 1 else sorted(touched)
    return {"high_water_mark": mark, "rows_written": n_updates, "partitions": listed}


# --- S9 / S15: versioned full refresh ---------------------------------------------------------

def pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def write_version(df: DataFrame, root: str, note: str = "") -> str:
    """Full refresh without overwriting what readers use: write a new
    version directory, then append a pointer row naming it current."""
    spark = df.sparkSession
    version = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    vpath = f"{root.rstrip('/')}/v={version}"
    df.write.mode("errorifexists").parquet(vpath)
    from ..functions.rules import literal_table
    literal_table(spark, [(version, vpath, _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None), note)],
                  "version string, path string, written_at timestamp_ntz, note string") \
        .coalesce(1).write.mode("append").parquet(pointer_path(root))
    return vpath


def versions(spark: SparkSession, root: str) -> DataFrame | None:
    return read_if_exists(spark, pointer_path(root))


def current_path(spark: SparkSession, root: str, back: int = 0) -> str | None:
    """Path of the current version (``back=1``: the one before, the backup)."""
    v = versions(spark, root)
    if v is None:
        return None
    rows = v.orderBy(F.col("written_at").desc(), F.col("version").desc()).limit(back + 1).collect()
    return rows[back]["path"] if len(rows) > back else None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    p = current_path(spark, root)
    return spark.read.parquet(p) if p else None


# --- S11: landing-zone scan --------------------------------------------------------------------

def read_landing(spark: SparkSession, root: str, schema: T.StructType | None = None,
                 merge_schema: bool = True) -> DataFrame:
    """Scan a landing folder with partition discovery (``key=value`` dirs)
    and schema merging across files, as a crawler would; a fixed schema
    skips inference."""
    r = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(root)


def write_landing_by_day(bronze: DataFrame, root: str) -> None:
    """Land bronze as one folder per ingest day (``ingest_date=...``)."""
    (bronze.withColumn("ingest_date", F.to_date("ingested_at"))
           .write.mode("overwrite").partitionBy("ingest_date").parquet(root))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tidemark", f"{name}-{uuid.uuid4().hex[:12]}")


@contextlib.contextmanager
def scratch(spark: SparkSession, name: str):
    """A scratch folder for the time of a block; its files go when the block ends, also by an error."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet to ``path`` and read from there: computed once, however often
    it is used, and a later use reads the columns it needs."""
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
