"""Sliding gold by micro-batches: every day's gold equals the batch, whatever the order of arrival."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold as G
from tidemark.operators import gold_state as GS
from tidemark.operators import silver as SV
from tidemark.sources import fixtures as FX
from tidemark.sources import tables as TB
from tidemark.streaming import gold_stream as GO
from tidemark.streaming import streams as ST

SF = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 25)


def _rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(sorted(set(df.columns) - {"computed_at"})).collect())


def _batches(bronze, n):
    """Copies of an event are spread over the batches, and so are all days."""
    return [bronze.where(F.pmod(F.xxhash64("event_id", "ingested_at"), F.lit(n)) == i) for i in range(n)]


def test_any_order_any_day_and_a_batch_that_died(spark, tmp_dir, monkeypatch):
    bronze = FX.bronze(spark, SF).cache()
    first, second = _batches(bronze, 2)
    GO.merge_batch(spark, first, 0, tmp_dir, FX.AS_OF)
    silver = SV.silver(first, FX.AS_OF)
    assert _rows(GO.gold_of_day(spark, tmp_dir, DAY)) == _rows(G.gold_snapshots(silver, DAY, DAY))

    # silver is swapped, then the driver dies before the panes are refreshed
    with monkeypatch.context() as m:
        m.setattr(GS, "write_state", lambda *a: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            GO.merge_batch(spark, second, 1, tmp_dir, FX.AS_OF)
    GO.merge_batch(spark, second, 1, tmp_dir, FX.AS_OF)
    silver = SV.silver(bronze, FX.AS_OF)
    for day in (DAY, dt.date(2024, 2, 2)):
        assert _rows(GO.gold_of_day(spark, tmp_dir, day)) == _rows(G.gold_snapshots(silver, day, day))


def test_late_rows_are_counted_once_and_kept(spark, tmp_dir):
    bronze = FX.bronze(spark, SF).dropDuplicates(["event_id"])
    silver = SV.silver(bronze, FX.AS_OF).cache()
    last = silver.agg(F.max("event_date")).first()[0]
    edge = F.lit(last - dt.timedelta(days=2))
    is_new = F.to_date("event_timestamp") >= F.lit(last)
    GO.merge_batch(spark, bronze.where(is_new), 0, tmp_dir, FX.AS_OF)
    assert GO.late_rows(spark, tmp_dir) is None
    for _ in range(2):          # a replayed batch counts once
        GO.merge_batch(spark, bronze.where(~is_new | is_new.isNull()), 1, tmp_dir, FX.AS_OF)
    want = {r[0]: r[1] for r in silver.where(F.col("event_date") < edge).groupBy("event_date").count().collect()}
    assert {r[0]: r[1] for r in GO.late_rows(spark, tmp_dir).collect()} == want and want
    day = last + dt.timedelta(days=1)
    assert _rows(GO.gold_of_day(spark, tmp_dir, day)) == _rows(G.gold_snapshots(silver, day, day))


def test_only_touched_days_are_refreshed(spark, tmp_dir):
    silver_days = SV.silver(FX.bronze(spark, SF), FX.AS_OF)
    GO.merge_batch(spark, FX.bronze(spark, SF), 0, tmp_dir, FX.AS_OF)
    one = silver_days.agg(F.max("event_date")).first()[0]
    again = FX.bronze(spark, SF).where(F.to_date("event_timestamp") == F.lit(one))
    days = GO.merge_batch(spark, again, 1, tmp_dir, FX.AS_OF)
    assert one in days and len(days) < silver_days.select("event_date").distinct().count()


def test_bronze_stream_finds_keys_of_earlier_batches(spark, tmp_dir):
    """A key stored by one batch is not stored again by a later one."""
    bronze = FX.bronze(spark, SF).dropDuplicates(["event_id"]).cache()
    for i in range(2):
        bronze.write.parquet(f"{tmp_dir}/in/drop={i}")
        ST.start_bronze_stream(ST.read_events_stream(spark, f"{tmp_dir}/in/*"), f"{tmp_dir}/bronze",
                               f"{tmp_dir}/_ckpt").awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == bronze.count()
    assert TB.read_if_exists(spark, f"{tmp_dir}/bronze") is not None
