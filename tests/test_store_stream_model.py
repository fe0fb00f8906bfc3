"""Writes (partition swap, versions), streams and the model lifecycle."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import features as FE
from tidemark.operators import gold as G
from tidemark.operators import ingest as IN
from tidemark.operators import model as MO
from tidemark.operators import silver as SV
from tidemark.sources import fixtures as FX
from tidemark.sources import tables as TB
from tidemark.streaming import streams as ST

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_silver_table_incremental_write(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    first, _ = FX.bronze_batches(spark, SF)
    r1 = TB.write_silver_incremental(spark, first, path, FX.BATCH_CUT)
    assert r1["high_water_mark"] is None
    full = FX.bronze(spark, SF)
    r2 = TB.write_silver_incremental(spark, full, path, FX.AS_OF)
    assert r2["high_water_mark"] == FX.BATCH_CUT and r2["rows_written"] > 0
    r3 = TB.write_silver_incremental(spark, full, path, dt.datetime(2024, 2, 3))
    assert r3["rows_written"] == 0                     # nothing new: no change
    table = spark.read.parquet(path).drop("transformed_at")
    expected = SV.silver(full, FX.AS_OF).drop("transformed_at")
    cols = sorted(expected.columns)
    assert _rows(table.select(*cols)) == _rows(expected.select(*cols))


def test_versioned_write_and_backup(spark, tmp_dir):
    root = f"{tmp_dir}/gold"
    g = G.gold(SV.silver(FX.bronze(spark, SF), FX.AS_OF), FX.AS_OF)
    p1 = TB.write_version(g, root)
    p2 = TB.write_version(g.limit(10), root)
    assert TB.current_path(spark, root) == p2
    assert TB.current_path(spark, root, back=1) == p1
    assert TB.read_current(spark, root).count() == 10


def test_ingest_insert_if_absent(spark):
    first, second = FX.bronze_batches(spark, SF)
    res = IN.ingest_to_bronze(second, first, "run-3", FX.AS_OF)
    assert res.inserted + res.skipped == res.received
    again = IN.ingest_to_bronze(second, first.unionByName(res.rows), "run-4", FX.AS_OF)
    assert again.inserted == 0                         # second delivery adds nothing


def test_json_round_trip_and_quarantine(spark):
    b = FX.bronze(spark, SF).limit(20)
    text = IN.events_to_json(b).unionByName(spark.createDataFrame([("{not json",)], "value string"))
    parsed = IN.parse_events_json(text)
    assert parsed.where("_corrupt_record IS NOT NULL").count() == 1
    good = parsed.where("_corrupt_record IS NULL").drop("_corrupt_record")
    cols = [c for c in good.columns]
    assert _rows(good.select(*cols)) == _rows(b.select(*cols))


def test_stream_equals_batch(spark, tmp_dir):
    clean = FX.bronze_clean(spark, SF)
    src = ST.land_by_day(clean, f"{tmp_dir}/landing")
    q = ST.start_bronze_stream(ST.read_events_stream(spark, src), f"{tmp_dir}/bronze",
                               f"{tmp_dir}/ck_b", run_id="run-1")
    q.awaitTermination()
    bronze = spark.read.parquet(f"{tmp_dir}/bronze").drop(ST.BATCH_COL)
    assert bronze.count() == clean.select("event_id").distinct().count()
    s = ST.start_silver_stream(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                               f"{tmp_dir}/quarantine", f"{tmp_dir}/ck_s", as_of=FX.AS_OF)
    s.awaitTermination()
    streamed = spark.read.parquet(f"{tmp_dir}/silver").drop("transformed_at", "pipeline_run_id")
    batch = SV.silver(IN.first_arrival(clean), FX.AS_OF).drop("transformed_at", "pipeline_run_id")
    cols = sorted(batch.columns)
    assert _rows(streamed.select(*cols)) == _rows(batch.select(*cols))


def test_stream_gate_stops_failing_batch(spark, tmp_dir):
    src = ST.land_by_day(FX.bronze(spark, SF), f"{tmp_dir}/landing")
    q = ST.start_bronze_stream(ST.read_events_stream(spark, src), f"{tmp_dir}/bronze",
                               f"{tmp_dir}/ck_b")
    q.awaitTermination()
    s = ST.start_silver_stream(spark, f"{tmp_dir}/bronze", f"{tmp_dir}/silver",
                               f"{tmp_dir}/quarantine", f"{tmp_dir}/ck_s", as_of=FX.AS_OF)
    try:
        s.awaitTermination()
        raise AssertionError("gate did not stop the stream")
    except Exception as e:  # the query fails with the gate's message
        assert "quality score" in str(e)
    assert spark.read.parquet(f"{tmp_dir}/quarantine").count() > 0
    assert TB.read_if_exists(spark, f"{tmp_dir}/silver") is None


def test_stratified_split_exact(spark):
    g = G.gold(SV.silver(FX.bronze(spark, "/root/testdata/sf0.01"), FX.AS_OF), FX.AS_OF)
    t = FE.training_frame(g)
    s = MO.stratified_split(t)
    got = {(r[0], r[1]): r[2] for r in s.groupBy("churned_30d", "split").count().collect()}
    for label in (0, 1):
        n = t.where(F.col("churned_30d") == label).count()
        assert got[(label, "train")] == int(n * 0.8 + 0.5)
        assert got[(label, "train")] + got.get((label, "test"), 0) == n


def test_best_iterations():
    assert MO.best_iterations([5, 4, 3, 3.5, 3.4], patience=20) == 3
    losses = [1.0] + [0.5] + [0.6] * 25 + [0.1]
    assert MO.best_iterations(losses, patience=20) == 2


def test_train_gate_save_load(spark, tmp_dir):
    g = G.gold(SV.silver(FX.bronze(spark, "/root/testdata/sf0.01"), FX.AS_OF), FX.AS_OF)
    frame = FE.training_frame(g)
    out = MO.retrain(frame, tmp_dir, params={"maxIter": 5, "maxDepth": 3}, force=True)
    assert out["status"] in ("promoted", "promoted_forced")
    assert out["auc_roc"] > 0.6
    model = MO.load_model(spark, tmp_dir)
    assert model is not None
    runs = spark.read.parquet(MO.runs_path(tmp_dir))
    assert runs.count() == 1 and runs.first().status == out["status"]
    from tidemark.operators.scoring import score
    from tidemark import schemas as S
    scored = score(g.select(*S.SCORING_INPUT_COLS), model, FX.AS_OF)
    assert scored.where("churn_probability < 0 OR churn_probability > 1").count() == 0
    assert MO.load_model(spark, f"{tmp_dir}/none") is None


def test_moved_key_leaves_old_partition(spark, tmp_dir):
    from tidemark import schemas as S
    import datetime as dt

    def row(eid, ts, ing):
        return (eid, "sub_00000001", "content_0001", "web", "play", 600, 0.5, "plus", "FR",
                ts, "4.3.0", ing, "run-1")
    b1 = spark.createDataFrame([row("x", dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 1, 6)),
                                row("y", dt.datetime(2024, 1, 1, 7), dt.datetime(2024, 1, 1, 8))],
                               S.BRONZE_SCHEMA)
    b2 = spark.createDataFrame([row("x", dt.datetime(2024, 1, 5, 5), dt.datetime(2024, 1, 5, 6))],
                               S.BRONZE_SCHEMA)
    for lookback in (None, 7):
        path = f"{tmp_dir}/silver-{lookback}"
        TB.write_silver_incremental(spark, b1, path, dt.datetime(2024, 1, 2))
        r = TB.write_silver_incremental(spark, b1.unionByName(b2), path, dt.datetime(2024, 1, 6),
                                        moved_keys_lookback_days=lookback)
        assert sorted(r["partitions"]) == [dt.date(2024, 1, 1), dt.date(2024, 1, 5)]
        got = sorted((x.event_id, x.event_date) for x in spark.read.parquet(path).collect())
        assert got == [("x", dt.date(2024, 1, 5)), ("y", dt.date(2024, 1, 1))]


def test_auc_equals_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from tidemark.operators import metrics as ME
    from tidemark.operators.scoring import heuristic_probability
    g = G.gold(SV.silver(FX.bronze(spark, "/root/testdata/sf0.01"), FX.AS_OF), FX.AS_OF)
    t = FE.training_frame(g)
    lab = t.select(F.col("churned_30d").cast("double").alias("label"),
                   heuristic_probability().alias("probability"))
    ours = ME.auc(lab).first()["auc_roc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label",
                                       metricName="areaUnderROC", numBins=0)
    assert abs(ours - ev.evaluate(lab)) < 1e-6


def test_latency_stream_equals_batch(spark, tmp_dir):
    from tidemark.operators import kpis as KP
    bronze = FX.bronze(spark, SF)
    src = ST.land_by_day(bronze, f"{tmp_dir}/landing")
    # several micro-batches, in whatever order the file source takes them
    q = ST.start_latency_stream(ST.read_events_stream(spark, src, max_files_per_trigger=3),
                                f"{tmp_dir}/lat", f"{tmp_dir}/ck_lat")
    q.awaitTermination()
    streamed = ST.read_latency_sink(spark, f"{tmp_dir}/lat")
    batch = KP.latency_kpis(bronze)
    cols = sorted(batch.columns)
    assert _rows(streamed.select(*cols)) == _rows(batch.select(*cols))


def test_latency_stream_counts_late_rows(spark, tmp_dir):
    """Rows far behind the newest arrival are merged into their window and counted, also when a batch runs again."""
    from tidemark.operators import kpis as KP
    bronze = FX.bronze(spark, SF)
    old = F.to_date("ingested_at") < F.lit("2024-01-11").cast("date")
    for i, part in enumerate((~old, old)):                      # the oldest days arrive last
        bronze.where(part).write.parquet(f"{tmp_dir}/landing/drop={i}")
        ST.start_latency_stream(ST.read_events_stream(spark, f"{tmp_dir}/landing/*"), f"{tmp_dir}/lat",
                                f"{tmp_dir}/ck").awaitTermination()
    streamed, batch = ST.read_latency_sink(spark, f"{tmp_dir}/lat"), KP.latency_kpis(bronze)
    cols = sorted(batch.columns)
    assert _rows(streamed.select(*cols)) == _rows(batch.select(*cols))
    counted = ST.latency_beyond_delay(spark, f"{tmp_dir}/lat").agg(F.sum("beyond_delay")).first()[0]
    assert counted == bronze.where(old).where("event_timestamp is not null").count() > 0


def test_incremental_write_by_hour(spark, tmp_dir):
    """Day-and-hour partitions: the second run rewrites only the hours it
    touches, and the table equals a full load."""
    path = f"{tmp_dir}/silver_hourly"
    cols = ("event_date", "event_hour")
    first, _ = FX.bronze_batches(spark, SF)
    TB.write_silver_incremental(spark, first, path, FX.BATCH_CUT, partition_cols=cols)
    full = FX.bronze(spark, SF)
    r = TB.write_silver_incremental(spark, full, path, FX.AS_OF, partition_cols=cols)
    assert r["partitions"] and all(len(t) == 2 for t in r["partitions"])
    table = spark.read.parquet(path).drop("transformed_at")
    expected = SV.silver(full, FX.AS_OF).drop("transformed_at")
    names = sorted(expected.columns)
    assert _rows(table.select(*names)) == _rows(expected.select(*names))
    p = spark.read.parquet(path).where(
        (F.col("event_date") == F.lit("2024-01-05").cast("date")) & (F.col("event_hour") == 3))
    assert "PartitionFilters" in p._jdf.queryExecution().executedPlan().toString()


def test_text_event_stream_with_quarantine(spark, tmp_dir):
    """Topic-shaped input (JSON value + arrival time), fed from files here:
    good records land in bronze, a broken one in quarantine."""
    from pyspark.sql import types as T
    b = FX.bronze_clean(spark, SF)
    text = IN.events_to_json(b).withColumn(
        "_arrived", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    broken = spark.createDataFrame([("{oops", None)], "value string, _arrived timestamp")
    text.unionByName(broken.withColumn("_arrived", F.lit("2024-02-01 00:00:00").cast("timestamp"))) \
        .write.parquet(f"{tmp_dir}/topic")
    schema = T.StructType([T.StructField("value", T.StringType()),
                           T.StructField("_arrived", T.TimestampType())])
    src = spark.readStream.schema(schema).parquet(f"{tmp_dir}/topic")
    q = ST.start_bronze_stream(ST.events_from_text(src), f"{tmp_dir}/bronze", f"{tmp_dir}/ck",
                               quarantine=f"{tmp_dir}/quarantine")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/quarantine").count() == 1
    landed = spark.read.parquet(f"{tmp_dir}/bronze")
    assert landed.count() == b.select("event_id").distinct().count()
    assert landed.where("ingested_at = timestamp_ntz'2024-02-01 00:00:00'").count() == landed.count()
