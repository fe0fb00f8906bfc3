"""Stored daily partials, pruned runs and exact quantiles."""

import glob
import math
import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gold as G
from tidemark.operators import gold_state as GS
from tidemark.operators import quantiles as QN
from tidemark.operators import silver as SV
from tidemark.plans import catalog
from tidemark.plans import pipeline as PL
from tidemark.sources import fixtures as FX
from tidemark.sources import tables as TB

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.collect()))


def _files(path):
    return {d: sorted(os.path.basename(f) for f in glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/event_date=*")}


def test_state_follows_silver_day_by_day(spark, tmp_dir):
    silver, state = f"{tmp_dir}/silver", f"{tmp_dir}/state"
    first, second = catalog._late_batches(FX.bronze(spark, SF))
    TB.write_silver_incremental(spark, first, silver, FX.BATCH_CUT)
    GS.write_state(spark, spark.read.parquet(silver), state)
    before = _files(state)
    noted = []
    done = TB.write_silver_incremental(spark, second, silver, FX.AS_OF, mark=None, before_swap=noted.extend)
    assert sorted(t[0] for t in noted) == done["partitions"]
    days = {str(d) for d in done["partitions"]}
    assert set(catalog.LATE_DAYS) <= days and len(days) < len(before) + 8
    GS.write_state(spark, spark.read.parquet(silver), state, done["partitions"])
    # only the touched days have new files
    after = _files(state)
    changed = {d.rpartition("=")[2] for d in after if after[d] != before.get(d)}
    assert changed == days
    for as_of in (FX.AS_OF, "2024-01-20 06:00:00", "2024-03-30 00:00:00"):
        s = spark.read.parquet(silver)
        assert _rows(GS.gold_from_state(spark.read.parquet(state), as_of)) == _rows(G.gold(s, as_of).select(
            *GS.gold_from_state(spark.read.parquet(state), as_of).columns))


def test_a_day_that_lost_its_events_is_emptied(spark, tmp_dir):
    s = SV.silver(FX.bronze(spark, SF), FX.AS_OF)
    day = s.agg(F.min("event_date")).first()[0]
    GS.write_state(spark, s, f"{tmp_dir}/state")
    rest = s.where(F.col("event_date") != day)
    GS.write_state(spark, rest, f"{tmp_dir}/state", [day])
    GS.write_state(spark, rest, f"{tmp_dir}/state", [])
    state = spark.read.parquet(f"{tmp_dir}/state")
    assert state.where((F.col("event_date") == day) & (F.col("kind") < GS.MARKER)).count() == 0
    assert _rows(GS.activity_from_state(state, FX.AS_OF).select(*G.GRAIN, "total_sessions_30d")) == _rows(
        G.subscriber_activity(rest, FX.AS_OF).select(*G.GRAIN, "total_sessions_30d"))


def test_empty_state(spark, tmp_dir):
    GS.write_state(spark, SV.silver(FX.bronze(spark, SF).limit(0), FX.AS_OF), f"{tmp_dir}/state")
    assert GS.daily_partials(SV.silver(FX.bronze(spark, SF).limit(0), FX.AS_OF)).count() == 0


def test_plans_read_touched_days_and_no_expand(spark, tmp_dir):
    silver, state = f"{tmp_dir}/silver", f"{tmp_dir}/state"
    TB.write_silver_incremental(spark, FX.bronze(spark, SF), silver, FX.AS_OF)
    s = spark.read.parquet(silver)
    GS.write_state(spark, s, state)
    days = [r[0] for r in s.select("event_date").distinct().orderBy("event_date").limit(2).collect()]
    p = GS.daily_partials(s.where(F.col("event_date").isin(days)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [event_date" in p and "Expand" not in p and p.count("FileScan") == 1
    p = GS.gold_from_state(spark.read.parquet(state), FX.AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in p and "2024-01-03" in p
    assert "Expand" not in p and "Window" not in p and p.count("Exchange hashpartitioning") == 2


def test_a_run_reads_its_ingest_days_only(spark, tmp_dir):
    clean = FX.bronze_clean(spark, SF)
    first, second = catalog._late_batches(clean)
    PL.run_pipeline(spark, first, tmp_dir, "a", FX.BATCH_CUT)
    PL.run_pipeline(spark, second, tmp_dir, "b", FX.AS_OF)
    p = PL.paths(tmp_dir)
    admitted = spark.read.schema(PL.ADMITTED).parquet(p["admitted"])
    assert {(r.run_id, str(r.ingest_date)) for r in admitted.collect()} == {("a", "2024-01-25"), ("b", "2024-02-02")}
    pending = admitted.where("run_id = 'b'")
    rows = PL.pending_rows(spark.read.parquet(p["bronze"]), pending)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "2024-02-02" in plan
    assert rows.count() == spark.read.parquet(p["bronze"]).where("pipeline_run_id = 'b'").count() > 0
    # a run admitted before days were kept is looked for in all
    old = spark.createDataFrame([("a", None)], PL.ADMITTED)
    assert PL.pending_rows(spark.read.parquet(p["bronze"]), old).count() > 0


def test_an_interrupted_run_leaves_no_day_stale(spark, tmp_dir, monkeypatch):
    """Silver is swapped, then the run dies before the state is refreshed; the redelivery is empty."""
    first, second = catalog._late_batches(FX.bronze_clean(spark, SF))
    PL.run_pipeline(spark, first, tmp_dir, "a", FX.BATCH_CUT)
    write = GS.write_state
    monkeypatch.setattr(GS, "write_state", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        PL.run_pipeline(spark, second, tmp_dir, "b", FX.AS_OF)
    monkeypatch.setattr(GS, "write_state", write)
    PL.run_pipeline(spark, second.limit(0), tmp_dir, "c", FX.AS_OF)
    p = PL.paths(tmp_dir)
    silver = spark.read.parquet(p["silver"])
    assert _rows(TB.read_current(spark, p["gold"])) == _rows(G.gold(silver, FX.AS_OF))


# ---------------------------------------------------------------- exact quantiles

def _brute(values, share):
    v = sorted(values)
    return v[max(1, math.ceil(len(v) * share)) - 1]


def test_quantiles_equal_sorting(spark):
    rng = random.Random(7)
    groups = {
        "one": [5], "same": [9] * 40, "negative": [rng.randint(-10 ** 6, 10 ** 6) for _ in range(301)],
        "wide": [rng.randint(-2 ** 63, 2 ** 63 - 1) for _ in range(100)] + [-2 ** 63, 2 ** 63 - 1],
        "skewed": [int(rng.paretovariate(0.3)) % 10 ** 15 for _ in range(2000)], None: [1, 2, 3, 4],
        "boundary": [10 ** 12 * k - 1 for k in range(200)] + [10 ** 12 * k for k in range(200)],
    }
    rows = [(g, v, 0) for g, vs in groups.items() for v in vs] + [("void", None, 0), ("one", None, 0)]
    rng.shuffle(rows)
    shares = {"min": Fraction(0), "p1": Fraction(1, 100), "p50": Fraction(1, 2), "third": Fraction(1, 3),
              "p99": Fraction("0.99"), "max": Fraction(1)}
    df = spark.createDataFrame(rows, "g string, v long, lo long")
    got = {r.g: r for r in QN.exact_quantiles(df, ["g"], "v", shares).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g].n == len(vs)
        for name, s in shares.items():
            assert got[g][name] == _brute(vs, s), (g, name)
    assert QN.exact_quantiles(df.limit(0), ["g"], "v", shares).count() == 0
