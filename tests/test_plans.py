"""Plan shape: the properties the design relies on, read from explain()."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark.plans import catalog
from tidemark.operators import gold as G
from tidemark.operators import silver as SV
from tidemark.sources import fixtures as FX
from tidemark.sources import tables as TB

SF = "/root/testdata/sf0.001"
# queries that run side effects (files, streams, model fits) when built
SIDE_EFFECTS = {"gbt_scores", "top_features", "stream_bronze", "stream_silver", "stream_latency",
                "landing_scan", "gold_incremental", "pipeline_run", "stream_quarantine", "newton_stages",
                "newton_scores", "silver_ctas_append", "model_run_log", "landing_evolved"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SIDE_EFFECTS))
def test_no_python_udf_no_cross_join(spark, name):
    p = plan_of(E.queries()[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name} plans {bad}"


def test_dedup_cut_before_shuffle(spark):
    p = plan_of(SV.silver(FX.bronze(spark, SF), FX.AS_OF))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_gold_window_prunes_partitions(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    TB.write_silver_incremental(spark, FX.bronze(spark, SF), path, FX.AS_OF)
    silver = spark.read.parquet(path)
    p = plan_of(G.gold(silver, FX.AS_OF))
    assert "PartitionFilters: [isnotnull(event_date" in p and "2024-01-03" in p
    # only the columns gold needs are read
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "app_version" not in scan and "pipeline_run_id" not in scan


def test_high_water_filter_reaches_scan(spark, tmp_dir):
    path = f"{tmp_dir}/bronze"
    FX.bronze(spark, SF).write.parquet(path)
    b = spark.read.parquet(path)
    p = plan_of(SV.new_since(b, FX.BATCH_CUT))
    assert "PushedFilters: [IsNotNull(ingested_at), GreaterThan(ingested_at" in p


def test_gold_aggregates_partially(spark):
    p = plan_of(G.gold(SV.silver(FX.bronze(spark, SF), FX.AS_OF), FX.AS_OF))
    assert "partial_count" in p and "partial_mode" in p


@pytest.mark.parametrize("name, scans", [("gold_features", 1), ("drift_report", 1), ("retrain_decision", 1), ("alerts", 3)])
def test_gold_queries_read_the_table_once_without_expand(spark, name, scans):
    """One scan of events each (alerts: one a rule), and no copy of the events for a second distinct count."""
    p = plan_of(E.queries()[name](spark, SF))
    assert p.count("FileScan parquet") == scans
    assert "Expand" not in p and "SortAggregate(key=[subscriber" not in p    # a sort of one row, for a text maximum, is fine


def test_one_pass_report_equals_the_two_table_report(spark):
    from tidemark.operators import drift as DR
    from tidemark.operators import scoring as SC
    gold = G.gold(SV.silver(FX.bronze(spark, SF), FX.AS_OF), FX.AS_OF).drop("computed_at")
    for g in (gold, gold.limit(0), gold.withColumn("country", F.when(F.col("churn_risk_label") == "HIGH", "ZZ").otherwise(F.col("country")))):
        one = DR.drift_report_scored(SC.with_probability(g), FX.AS_OF).collect()
        assert one == DR.drift_report(g, SC.score_heuristic(g, FX.AS_OF), FX.AS_OF).collect()


def test_high_water_prunes_ingest_days(spark, tmp_dir):
    from pyspark.sql import functions as F
    path = f"{tmp_dir}/bronze_by_day"
    (FX.bronze(spark, SF).withColumn("ingest_date", F.to_date("ingested_at"))
        .write.partitionBy("ingest_date").parquet(path))
    p = plan_of(SV.new_since(spark.read.parquet(path), FX.BATCH_CUT))
    assert "PartitionFilters: [isnotnull(ingest_date" in p and "2024-01-25" in p


def test_key_lookup_keeps_the_store_in_place(spark, tmp_dir):
    """Insert-if-absent: the batch's keys are broadcast and the stored key
    column is semi-joined where it is read (no shuffle of the store)."""
    from tidemark.operators.joins import absent_from
    path = f"{tmp_dir}/store"
    FX.bronze(spark, SF).write.parquet(path)
    stored = spark.read.parquet(path)
    _, batch = FX.bronze_batches(spark, SF)
    p = plan_of(absent_from(batch, stored, "event_id"))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    semi = [line for line in p.splitlines() if "LeftSemi" in line][0]
    assert "BroadcastHashJoin" in semi
