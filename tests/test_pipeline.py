"""End-to-end pipeline runs on a table root."""

import pytest

from tidemark.operators import gold as G
from tidemark.operators import quality as QU
from tidemark.operators import silver as SV
from tidemark.plans import pipeline as PL
from tidemark.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_two_runs_then_gate(spark, tmp_dir):
    clean = FX.bronze_clean(spark, SF)
    first = clean.where("ingested_at <= timestamp_ntz'2024-01-25 00:10:00'")
    second = clean.where("ingested_at > timestamp_ntz'2024-01-25 00:10:00'")
    s1 = PL.run_pipeline(spark, first, tmp_dir, "run-a", FX.BATCH_CUT)
    assert s1.status == "succeeded" and s1.quality_score == 100.0
    s2 = PL.run_pipeline(spark, second, tmp_dir, "run-b", FX.AS_OF)
    assert s2.status == "succeeded"
    assert s1.bronze_inserted + s2.bronze_inserted == clean.select("event_id").distinct().count()
    # same rows again: nothing new lands
    s3 = PL.run_pipeline(spark, second, tmp_dir, "run-c", FX.AS_OF)
    assert s3.bronze_inserted == 0 and s3.bronze_skipped > 0
    # a dirty batch stops the run
    with pytest.raises(QU.QualityGateError):
        PL.run_pipeline(spark, FX.bronze(spark, "/root/testdata/sf0.01"), tmp_dir, "run-d", FX.AS_OF)
    hist = {r.run_id: r.status for r in PL.run_history(spark, tmp_dir).collect()}
    assert hist == {"run-a": "succeeded", "run-b": "succeeded", "run-c": "succeeded",
                    "run-d": "failed_quality_gate"}
    gold = G.gold(spark.read.parquet(f"{tmp_dir}/silver"), FX.AS_OF)
    assert s2.gold_rows == gold.count()
    # a later clean run does not carry the quarantined rows into silver
    s5 = PL.run_pipeline(spark, first.limit(0), tmp_dir, "run-e", FX.AS_OF)
    assert s5.silver_rows == s2.silver_rows


def _bad(df):
    from pyspark.sql import functions as F
    return df.withColumn("completion_pct", F.lit(500).cast(df.schema["completion_pct"].dataType))


def test_nothing_is_lost_or_let_through(spark, tmp_dir):
    """Corrected re-delivery after a failed gate, rows of an interrupted run, and an equal or earlier clock."""
    from pyspark.sql import functions as F
    clean = FX.bronze_clean(spark, SF).dropDuplicates(["event_id"])
    ids = [r[0] for r in clean.select("event_id").orderBy("event_id").limit(6).collect()]
    part = [clean.where(F.col("event_id") == i) for i in ids]
    PL.run_pipeline(spark, part[0], tmp_dir, "r1", FX.AS_OF)

    with pytest.raises(QU.QualityGateError):
        PL.run_pipeline(spark, _bad(part[1]), tmp_dir, "r2", FX.AS_OF, threshold=100.0)
    s3 = PL.run_pipeline(spark, part[1], tmp_dir, "r3", FX.AS_OF)     # corrected, same id, same clock
    assert (s3.bronze_inserted, s3.bronze_skipped) == (1, 0)

    # an interrupted run: bronze rows without an admission
    (_bad(part[2]).withColumn("pipeline_run_id", F.lit("crashed"))
     .withColumn("ingest_date", F.to_date("ingested_at"))
     .write.mode("append").partitionBy("ingest_date").parquet(f"{tmp_dir}/bronze"))
    PL.run_pipeline(spark, part[3], tmp_dir, "r4", FX.BATCH_CUT)      # an earlier clock
    silver = {r[0] for r in spark.read.parquet(f"{tmp_dir}/silver").select("event_id").collect()}
    admitted = {r[0] for r in SV.silver(clean.where(F.col("event_id").isin(ids)), FX.AS_OF).select("event_id").collect()}
    assert silver == admitted & {ids[0], ids[1], ids[3]} and silver
