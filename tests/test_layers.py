"""Edge rows through silver, gold and quality (FIXTURES §2 additions)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators import gold as G
from tidemark.operators import quality as QU
from tidemark.operators import silver as SV

AS_OF = dt.datetime(2024, 2, 2)


def bronze_rows(spark, rows):
    """rows: dicts with some bronze fields; the rest get plain values."""
    base = dict(subscriber_id="sub_00000001", content_id="content_0001", device_type="web",
                event_type="play", watch_duration_s=600, completion_pct=0.5, plan_type="plus",
                country="FR", event_timestamp=dt.datetime(2024, 1, 30, 12), app_version="4.3.0",
                ingested_at=dt.datetime(2024, 1, 30, 12, 10), pipeline_run_id="run-1")
    full = []
    for i, r in enumerate(rows):
        d = dict(base, event_id=str(i))
        d.update(r)
        full.append(tuple(d[c] for c in S.BRONZE_COLS))
    return spark.createDataFrame(full, S.BRONZE_SCHEMA)


def test_admission_null_and_nan(spark):
    b = bronze_rows(spark, [dict(completion_pct=None), dict(completion_pct=math.nan),
                            dict(completion_pct=1.0), dict(subscriber_id=None),
                            dict(event_timestamp=None)])
    assert [r.event_id for r in SV.admit(b).collect()] == ["2"]
    assert sorted(r.event_id for r in SV.admit(b, require_timestamp=False).collect()) == ["2", "4"]


def test_dedup_latest_wins(spark):
    b = bronze_rows(spark, [dict(event_id="x", device_type="tablet"),
                            dict(event_id="x", device_type="web",
                                 ingested_at=dt.datetime(2024, 1, 30, 12, 40), pipeline_run_id="run-2")])
    out = SV.silver(b, AS_OF).collect()
    assert len(out) == 1 and out[0].device_type == "web"


def test_cleaning(spark):
    b = bronze_rows(spark, [dict(device_type=None, event_type="PLAY", watch_duration_s=-5,
                                 plan_type="ELITE", country="fr", completion_pct=0.123456)])
    r = SV.silver(b, AS_OF).first()
    assert (r.device_type, r.event_type, r.watch_duration_s, r.plan_type, r.country) == \
        ("unknown", "play", 0, "elite", "FR")
    assert r.completion_pct == 0.1235
    assert r.event_date == dt.date(2024, 1, 30) and r.event_hour == 12
    assert r.day_of_week == 2 and r.is_weekend is False


def test_null_country_not_counted(spark):
    b = bronze_rows(spark, [dict(country=None), dict(country="US"), dict(country="FR")])
    r = QU.quality_report(b, AS_OF).first()
    assert r.unknown_countries == 1


def test_empty_bronze_scores_zero(spark):
    b = spark.createDataFrame([], S.BRONZE_SCHEMA)
    r = QU.quality_report(b, AS_OF).first()
    assert r.total_rows == 0 and r.quality_score == 0.0 and r.passed is False


def test_gate_raises(spark):
    b = bronze_rows(spark, [dict(subscriber_id=None), dict()])
    try:
        QU.quality_gate(QU.quality_report(b, AS_OF))
    except QU.QualityGateError:
        pass
    else:
        raise AssertionError("gate did not raise")


def test_gold_tie_one_row_and_days(spark):
    b = bronze_rows(spark, [
        dict(event_id="1", device_type="web", event_timestamp=dt.datetime(2024, 1, 31, 2)),
        dict(event_id="2", device_type="mobile", event_timestamp=dt.datetime(2024, 1, 30, 2)),
        dict(event_id="3", subscriber_id="sub_00000002", device_type="tablet",
             event_timestamp=dt.datetime(2024, 1, 20)),
    ])
    g = {r.subscriber_id: r for r in G.gold(SV.silver(b, AS_OF), AS_OF).collect()}
    one = g["sub_00000001"]
    assert one.favourite_device == "mobile"            # tie: smallest name
    assert one.days_since_last_watch == 1              # 1 day 22 hours -> 1
    assert one.total_sessions_30d == 2 and one.sessions_last_7d == 2
    act = {r.subscriber_id: r for r in G.subscriber_activity(SV.silver(b, AS_OF), AS_OF).collect()}
    assert act["sub_00000002"].completion_rate_stddev is None   # one row -> NULL
    assert g["sub_00000002"].days_since_last_watch == 13
    assert g["sub_00000002"].churn_risk_label == "high"


def test_incremental_empty_target_loads_all(spark):
    b = bronze_rows(spark, [dict(event_id="1"), dict(event_id="2")])
    empty = spark.createDataFrame([], SV.silver(b, AS_OF).schema)
    assert SV.high_water_mark(empty) is None
    assert SV.silver_incremental(b, empty, AS_OF).count() == 2


def test_incremental_twice_is_idempotent(spark):
    b = bronze_rows(spark, [dict(event_id=str(i)) for i in range(5)])
    first = SV.silver_incremental(b, None, AS_OF)
    first_rows = sorted(tuple(r) for r in first.collect())
    second = SV.silver_incremental(b, first, dt.datetime(2024, 2, 3))
    assert sorted(tuple(r) for r in second.collect()) == first_rows


def test_upsert_columns(spark):
    t = spark.createDataFrame([("a", 1, "x", None), ("b", 2, "y", None)],
                              "k string, n int, s string, computed_at timestamp_ntz")
    s = spark.createDataFrame([("a", 10, "X", None), ("c", 30, "Z", None)],
                              "k string, n int, s string, computed_at timestamp_ntz")
    out = {r.k: r for r in G.upsert_columns(t, s, "k", ["n"], as_of=AS_OF).collect()}
    assert (out["a"].n, out["a"].s, out["a"].computed_at) == (10, "x", AS_OF)
    assert (out["b"].n, out["b"].s, out["b"].computed_at) == (2, "y", None)
    assert (out["c"].n, out["c"].s) == (30, "Z")


def test_schema_sync(spark):
    t = spark.createDataFrame([("a", 1, "old")], "event_id string, n int, gone string")
    new = spark.createDataFrame([("b", 2, True)], "event_id string, n int, added boolean")
    out = SV.merge_by_key(SV.sync_columns(t, new), new)
    assert out.columns == ["event_id", "n", "added"]
    assert sorted((r.event_id, r.added) for r in out.collect()) == [("a", None), ("b", True)]


def test_column_tests(spark):
    b = bronze_rows(spark, [dict(event_id="1"), dict(event_id="1"), dict(event_id="2", country="US"),
                            dict(event_id="3", completion_pct=1.5)])
    res = {(r.column_name, r.test_name): r.failures
           for r in QU.run_column_tests(b, QU.BRONZE_TESTS).collect()}
    assert res[("event_id", "unique")] == 1
    assert res[("country", "accepted_values")] == 1
    assert res[("completion_pct", "accepted_range")] == 1
    assert res[("subscriber_id", "not_null")] == 0
