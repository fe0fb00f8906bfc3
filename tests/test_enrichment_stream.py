"""Enrichment by micro-batches: always the batch join of all rows with the current dimensions."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.operators import silver as SV
from tidemark.operators import warehouse as WH
from tidemark.sources import fixtures as FX
from tidemark.sources import tables as TB
from tidemark.streaming import enrichment as EN
from tidemark.streaming import streams as ST

SF = "/root/testdata/sf0.001"
COLS = ["event_id", "event_date", "subscriber_id", "content_id", "email", "signup_date", "genre"]


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*COLS).collect())


def _table(spark, root):
    return spark.read.parquet(EN.paths(root)["enriched"])


def _expected(spark, silver, dims):
    subs, content = (TB.read_current(spark, f"{dims}/{d}") for d in ("subscribers", "content"))
    return _rows(WH.enrich_events(silver, subs, content))


def _data_files(path):
    return {d: set(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("event_date=")}


def test_changed_dimensions_reach_stored_rows(spark, tmp_dir):
    silver = SV.silver(FX.bronze(spark, SF), FX.AS_OF).cache()
    root, dims = f"{tmp_dir}/t", f"{tmp_dir}/dims"
    EN.write_dimensions(dims, WH.dim_subscriber(silver), WH.dim_content(silver))
    odd = F.xxhash64("event_id") % 2 == 0
    EN.merge_enriched(spark, silver.where(odd), root, dims)
    assert _rows(_table(spark, root)) == _expected(spark, silver.where(odd), dims)

    # one subscriber's email changes: only days with their events are rewritten
    one = silver.where(odd).select(F.min("subscriber_id")).first()[0]
    subs = WH.dim_subscriber(silver).withColumn("email", F.when(F.col("subscriber_id") == one, "new@example.com"))
    EN.write_dimensions(dims, subscribers=subs)
    before = _data_files(EN.paths(root)["enriched"])
    days = EN.refresh_enriched(spark, root, dims)
    theirs = {r[0] for r in silver.where(odd & (F.col("subscriber_id") == one)).select("event_date").collect()}
    assert set(days) == theirs
    after = _data_files(EN.paths(root)["enriched"])
    assert {d for d in before if before[d] != after[d]} == {f"event_date={d}" for d in theirs}
    assert _rows(_table(spark, root)) == _expected(spark, silver.where(odd), dims)
    assert EN.refresh_enriched(spark, root, dims) == []            # nothing changed since

    # the rest arrives, with a replay of rows already stored, and titles change
    EN.write_dimensions(dims, content=WH.dim_content(silver, FX.read_table(spark, SF, "part")))
    EN.merge_enriched(spark, silver, root, dims)
    EN.merge_enriched(spark, silver.where(odd), root, dims)
    assert _rows(_table(spark, root)) == _expected(spark, silver, dims)

    # an attempt that died before its record is made again with the same result
    spark.read.parquet(EN.paths(root)["applied"]).where("seq = 0").write.parquet(f"{tmp_dir}/older")
    (spark.read.parquet(f"{tmp_dir}/older").write.mode("overwrite").parquet(EN.paths(root)["applied"]))
    EN.refresh_enriched(spark, root, dims)
    assert _rows(_table(spark, root)) == _expected(spark, silver, dims)


def test_changed_keys(spark):
    old = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z"), ("e", None)], "k string, v string")
    new = spark.createDataFrame([("a", "x"), ("b", "y"), ("d", "w"), ("e", None)], "k string, v string")
    assert {r[0] for r in EN.changed_keys(old, new, "k", ["v"]).collect()} == {"b", "c", "d"}


def test_a_day_that_loses_its_last_row_is_removed(spark, tmp_dir):
    """A later delivery moves an event to another day; its old day held nothing else."""
    silver = SV.silver(FX.bronze(spark, SF), FX.AS_OF)
    row = silver.limit(1).cache()
    day = row.first()["event_date"]
    moved = (row.withColumn("event_date", F.date_add("event_date", 1))
             .withColumn("ingested_at", F.col("ingested_at") + F.expr("interval 1 hour")))
    ST.upsert_latest(spark, row, f"{tmp_dir}/s")
    ST.upsert_latest(spark, moved, f"{tmp_dir}/s")
    got = spark.read.parquet(f"{tmp_dir}/s").select("event_id", "event_date").collect()
    assert [r["event_date"] for r in got] == [day + dt.timedelta(days=1)]
