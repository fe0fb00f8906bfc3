"""Bloom filters of stored keys: no key missed, few let through, only named days read."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ingest as IN
from tidemark.operators import key_index as KI
from tidemark.plans import pipeline as PL
from tidemark.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _rows(spark, n, day="2024-01-01", run="r", prefix="k"):
    return spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("event_id"),
                                 F.lit(day).cast("date").alias("ingest_date"), F.lit(run).alias("pipeline_run_id"))


@pytest.mark.parametrize("n", [1, 1000, 200_000])
def test_no_stored_key_is_missed_and_few_pass(spark, tmp_dir, n):
    KI.build(_rows(spark, n)).write.parquet(f"{tmp_dir}/i")
    index = spark.read.parquet(f"{tmp_dir}/i")
    sizes = {r[0] for r in index.select("n_blocks").distinct().collect()}
    assert len(sizes) == 1 and n * KI.BITS_A_KEY <= sizes.pop() * KI.BLOCK_BITS < max(2 * n * KI.BITS_A_KEY, 2 * KI.BLOCK_BITS)
    stored = _rows(spark, n).select("event_id")
    assert KI.candidates(index, stored).count() == n
    # strangers: expected well under one among 200,000
    assert KI.candidates(index, _rows(spark, 200_000, prefix="other")).count() <= 2


def test_days_of_different_sizes(spark, tmp_dir):
    parts = [_rows(spark, 10, "2024-01-01", "a", "x"), _rows(spark, 30_000, "2024-01-02", "b", "y"),
             _rows(spark, 10, "2024-01-02", "c", "z")]
    for i, part in enumerate(parts):
        KI.write(part, f"{tmp_dir}/i", "abc"[i], [part.first()["ingest_date"]])
    index = spark.read.parquet(f"{tmp_dir}/i")
    asked = spark.createDataFrame([("x1",), ("y29999",), ("z9",), ("x10",), (None,), ("x1",)], "event_id string")
    got = {(r[0], str(r[1])) for r in KI.candidates(index, asked).collect()}
    assert got == {("x1", "2024-01-01"), ("y29999", "2024-01-02"), ("z9", "2024-01-02")}


def test_empty_index_and_null_keys(spark, tmp_dir):
    rows = _rows(spark, 3).withColumn("event_id", F.lit(None).cast("string"))
    KI.write(rows, f"{tmp_dir}/i", "r", [])
    index = spark.read.schema("run_id string, ingest_date date, n_blocks bigint, block bigint, bits binary").parquet(f"{tmp_dir}/i")
    assert KI.candidates(index, _rows(spark, 3)).count() == 0
    out = KI.absent_by_index(_rows(spark, 3), rows, index)
    assert out.count() == 3


def test_same_rows_as_the_plain_anti_join_and_days_pruned(spark, tmp_dir):
    bronze = FX.bronze(spark, SF).dropDuplicates(["event_id"]).withColumn("ingest_date", F.to_date("ingested_at"))
    IN.append(bronze, f"{tmp_dir}/b", partition_by=["ingest_date"])
    KI.build(bronze).write.parquet(f"{tmp_dir}/i")
    stored, index = spark.read.parquet(f"{tmp_dir}/b"), spark.read.parquet(f"{tmp_dir}/i")
    day = bronze.select(F.max("ingest_date")).first()[0]
    batch = (bronze.where(F.col("ingest_date") == day).limit(5)
             .unionByName(bronze.limit(7).withColumn("event_id", F.concat(F.lit("new-"), "event_id"))).drop("ingest_date"))
    batch = spark.createDataFrame(batch.collect(), batch.schema)
    plain = IN.absent_keys(batch, stored.select("event_id"))
    by_index = KI.absent_by_index(batch, stored, index)
    assert sorted(r[0] for r in by_index.select("event_id").collect()) == sorted(r[0] for r in plain.select("event_id").collect())
    plan = by_index._jdf.queryExecution().executedPlan().toString()
    filters = [f.split("PushedFilters")[0] for f in plan.split("PartitionFilters")[1:]]
    assert any(f"= {day}" in f for f in filters)          # of all days only the one that holds keys of the batch
    assert KI.absent_by_index(batch, stored.where("false"), index).count() == 12


def test_runs_without_filters_are_still_found(spark, tmp_dir):
    """A table root from before the index: its days are read as ever; the index serves what came later."""
    clean = FX.bronze_clean(spark, SF).dropDuplicates(["event_id"])
    first, second = clean.where("ingested_at <= timestamp_ntz'2024-01-25 00:10:00'"), clean.where(
        "ingested_at > timestamp_ntz'2024-01-25 00:10:00'")
    PL.run_pipeline(spark, first, tmp_dir, "old", FX.BATCH_CUT)
    p = PL.paths(tmp_dir)
    index = spark.read.parquet(p["key_index"])
    admitted = spark.read.schema(PL.ADMITTED).parquet(p["admitted"])
    assert KI.unindexed_days(index, admitted) == []
    # as if the run had left no filters
    spark.read.parquet(p["key_index"]).where("false").write.parquet(f"{tmp_dir}/none")
    none = spark.read.schema(index.schema).parquet(f"{tmp_dir}/none")
    none.write.mode("overwrite").parquet(p["key_index"])
    assert KI.unindexed_days(spark.read.schema(index.schema).parquet(p["key_index"]), admitted) == [
        admitted.first()["ingest_date"]]
    s2 = PL.run_pipeline(spark, clean, tmp_dir, "new", FX.AS_OF)
    assert s2.bronze_inserted == second.count() and s2.bronze_skipped == first.count()
    s3 = PL.run_pipeline(spark, clean, tmp_dir, "again", FX.AS_OF)
    assert s3.bronze_inserted == 0


def test_index_build_sends_each_key_once(spark):
    """No bitmap is shuffled: a bitmap a block and task grows with the square of the keys."""
    plan = KI.build(_rows(spark, 1000))._jdf.queryExecution().executedPlan().toString()
    sends = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and ("block" in x or "_at" in x)]
    assert len(sends) == 1 and "REPARTITION_BY_COL" in sends[0]
    days = KI.candidate_days(KI.build(_rows(spark, 1000)), _rows(spark, 5))
    assert [str(d) for d in days] == ["2024-01-01"]


def test_a_run_dedupes_and_anti_joins_once_and_leaves_no_scratch(spark, tmp_dir, monkeypatch):
    """The batch without repeats and the new rows are computed once each, however often they are read."""
    from tidemark.session import ensure_checkpoint_dir
    from tidemark.sources import tables as TB
    kept = []
    plain = TB.stored
    monkeypatch.setattr(TB, "stored", lambda df, path: (kept.append(path.split("/")[-1]), plain(df, path))[1])
    clean = FX.bronze_clean(spark, SF)
    PL.run_pipeline(spark, clean.where("event_id < '3'"), tmp_dir, "a", FX.BATCH_CUT)
    assert kept == ["rows"]
    seen = []
    plain_days = KI.candidate_days
    monkeypatch.setattr(KI, "candidate_days", lambda index, batch, key="event_id": (
        seen.append(batch._jdf.queryExecution().executedPlan().toString()), plain_days(index, batch, key))[1])
    s = PL.run_pipeline(spark, clean, tmp_dir, "b", FX.AS_OF)
    assert kept == ["rows", "batch", "rows", "updates", "merged"]
    assert len(seen) == 1 and "Window" not in seen[0]
    assert s.bronze_inserted == clean.where("event_id >= '3'").select("event_id").distinct().count()
    assert not TB._exists(spark, f"{ensure_checkpoint_dir(spark)}/tidemark") or not [
        n for n in _names(spark, f"{ensure_checkpoint_dir(spark)}/tidemark") if n.startswith("run-")]


def _names(spark, path):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return [x.getPath().getName() for x in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
