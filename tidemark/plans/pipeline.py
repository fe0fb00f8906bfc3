"""One pipeline run: ingest -> quality gate -> silver -> gold -> summary.

The reference schedules six tasks every 15 minutes; here a run is one
driver program over a table root. Only counters and the verdict reach the
driver; every table operation is a distributed set write.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import rules as R
from ..operators import gold_state as GS
from ..operators import ingest as IN
from ..operators import key_index as KI
from ..operators import quality as QU
from ..sources import lease as LE
from ..sources import tables as TB


@dataclass
class RunSummary:
    run_id: str
    bronze_inserted: int = 0
    bronze_skipped: int = 0
    quality_score: float = 0.0
    silver_rows: int = 0
    gold_rows: int = 0
    status: str = "started"


def paths(root: str) -> dict:
    r = root.rstrip("/")
    return {"bronze": f"{r}/bronze", "silver": f"{r}/silver", "gold": f"{r}/gold",
            "runs": f"{r}/pipeline_runs", "quarantine": f"{r}/quarantine",
            "admitted": f"{r}/admitted_runs", "gold_state": f"{r}/gold_state",
            "gold_pending": f"{r}/gold_pending", "key_index": f"{r}/key_index"}


def run_pipeline(spark: SparkSession, batch: DataFrame, root: str, run_id: str | None = None,
                 as_of=None, threshold: float = S.QUALITY_THRESHOLD,
                 gate_on: str = "batch",
                 silver_partition_cols: tuple[str, ...] = ("event_date",),
                 lease_seconds: float | None = 2 * 3600) -> RunSummary:
    """Ingest ``batch`` into bronze, gate, update silver and refresh gold.

    ``gate_on='batch'`` scores the incoming rows (a bad batch never lands in
    bronze or silver); ``'table'`` scores all of bronze as the reference does. A
    failing gate quarantines the batch, records the run and raises.

    One run is active on a root at a time: a second one raises ``LeaseHeld``
    and changes nothing. A lease not given back ends after ``lease_seconds``,
    which must exceed the longest run (``None``: no lease).
    """
    run_id = run_id or str(uuid.uuid4())          # one id per run (F31)
    with LE.held(spark, root, run_id, lease_seconds), TB.scratch(spark, "run") as folder:
        return _run(spark, batch, root, run_id, as_of, threshold, gate_on, silver_partition_cols, folder)


def _run(spark: SparkSession, batch: DataFrame, root: str, run_id: str, as_of, threshold: float, gate_on: str,
         silver_partition_cols: tuple[str, ...], folder: str) -> RunSummary:
    p = paths(root)
    as_of = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    summary = RunSummary(run_id)

    # only rows of admitted runs count as stored: what a failed or interrupted
    # run left behind neither hides a corrected delivery nor reaches silver
    admitted = TB.read_if_exists(spark, p["admitted"], ADMITTED)
    bronze = TB.read_if_exists(spark, p["bronze"])
    existing = None if bronze is None or admitted is None else _of_runs(bronze, admitted)
    # filters of the stored keys name the days that the anti-join reads
    index = TB.read_if_exists(spark, p["key_index"])
    unindexed = () if existing is None or index is None else KI.unindexed_days(index, admitted)
    res = IN.ingest_to_bronze(batch, existing, run_id, as_of, index=index, unindexed=unindexed,
                              keep=lambda df, name: TB.stored(df, f"{folder}/{name}"))
    rows = res.rows.withColumn("ingest_date", F.to_date("ingested_at"))
    summary.bronze_inserted, summary.bronze_skipped = res.inserted, res.skipped

    # the gate comes before bronze: a failing batch goes to quarantine only
    scope = rows if gate_on == "batch" or existing is None else existing.unionByName(rows)
    report = QU.quality_report(scope, as_of, threshold).first()
    summary.quality_score = report["quality_score"]
    if report["total_rows"] and not report["passed"]:
        rows.write.mode("append").parquet(p["quarantine"])
        summary.status = "failed_quality_gate"
        _record(spark, summary, p["runs"], as_of)
        raise QU.QualityGateError(
            f"run {run_id}: quality score {summary.quality_score}% below {threshold}%")

    # bronze is partitioned by ingest day; the days a run landed in (one, as its
    # rows are stamped with the clock) are kept with its admission
    landed = [r[0] for r in rows.select("ingest_date").distinct().collect()] or [R.day_of(as_of)]
    KI.write(rows, p["key_index"], run_id, landed)
    IN.append(rows, p["bronze"], partition_by=["ingest_date"])
    R.literal_table(spark, [(run_id, d) for d in landed], ADMITTED).coalesce(1).write.mode("append").parquet(p["admitted"])

    # silver takes the runs that are admitted and not yet in it, by run id: equal
    # or earlier clocks (backfills) lose nothing, and an interrupted run is redone
    hist = TB.read_if_exists(spark, p["runs"])
    pending = _unfinished(spark.read.schema(ADMITTED).parquet(p["admitted"]), hist)

    def note(partitions: list[tuple]) -> None:
        """The days about to change, kept until a run succeeds: an interrupted run leaves no day stale."""
        R.literal_table(spark, [(run_id, d) for d in sorted({t[0] for t in partitions})], PENDING) \
            .coalesce(1).write.mode("append").parquet(p["gold_pending"])

    done = TB.write_silver_incremental(spark, pending_rows(spark.read.parquet(p["bronze"]), pending), p["silver"], as_of,
                                       partition_cols=silver_partition_cols, mark=_dt.datetime(1970, 1, 1),
                                       before_swap=note)
    silver = spark.read.parquet(p["silver"])
    summary.silver_rows = silver.count()

    # gold merges stored daily partials; only the touched days are computed again
    days = None
    if done["partitions"] is not None and GS.read_state(spark, p["gold_state"]) is not None:
        noted = TB.read_if_exists(spark, p["gold_pending"])
        days = [] if noted is None else sorted(
            r[0] for r in _unfinished(noted, hist).select("event_date").distinct().collect())
    GS.write_state(spark, silver, p["gold_state"], days)
    gold = GS.gold_from_state(spark.read.parquet(p["gold_state"]), as_of)
    TB.write_version(gold, p["gold"], note=run_id)
    summary.gold_rows = TB.read_current(spark, p["gold"]).count()
    summary.status = "succeeded"
    _record(spark, summary, p["runs"], as_of)
    return summary


ADMITTED = "run_id string, ingest_date date"
PENDING = "run_id string, event_date date"


def _unfinished(runs: DataFrame, history: DataFrame | None) -> DataFrame:
    """Rows of runs that are not recorded as succeeded."""
    if history is None:
        return runs
    done = history.where(F.col("status") == "succeeded").select("run_id")
    return runs.join(done, "run_id", "left_anti")


def pending_rows(bronze: DataFrame, pending: DataFrame) -> DataFrame:
    """Bronze rows of the pending runs. Their ingest days (a few) are literals,
    so other days are pruned; a run admitted without its day is looked for in all."""
    days = [r[0] for r in pending.select("ingest_date").distinct().collect()]
    if None not in days:
        bronze = bronze.where(F.col("ingest_date").isin(days) if days else F.lit(False))
    return _of_runs(bronze, pending)


def _of_runs(bronze: DataFrame, runs: DataFrame) -> DataFrame:
    """Bronze rows of the listed runs (one short id a run)."""
    ids = runs.select(F.col("run_id").alias("pipeline_run_id")).distinct()
    return bronze.join(ids, "pipeline_run_id", "left_semi")


def _record(spark: SparkSession, summary: RunSummary, path: str, as_of) -> None:
    row = asdict(summary)
    row["finished_at"] = as_of
    from ..functions.rules import literal_table
    literal_table(
        spark, [row], "run_id string, bronze_inserted bigint, bronze_skipped bigint, "
               "quality_score double, silver_rows bigint, gold_rows bigint, status string, "
               "finished_at timestamp_ntz").coalesce(1).write.mode("append").parquet(path)


def run_history(spark: SparkSession, root: str) -> DataFrame | None:
    """Recorded runs; a counter a run never reached reads 0."""
    runs = TB.read_if_exists(spark, paths(root)["runs"])
    if runs is None:
        return None
    return runs.fillna(0, subset=["bronze_inserted", "bronze_skipped", "silver_rows", "gold_rows"]) \
               .fillna(0.0, subset=["quality_score"])
