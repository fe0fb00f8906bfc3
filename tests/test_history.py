"""Validity intervals, as-of join and schema history against brute force."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import types as T

from tidemark.operators import history as HI
from tidemark.sources import landing as LA

EVENTS = ("subscriber_id string, plan_type string, country string, event_timestamp timestamp_ntz, "
          "ingested_at timestamp_ntz, event_id string")
T0 = dt.datetime(2024, 1, 1)


def _events(seed=3, n=600):
    """One subscriber holds a third of all rows; equal times, NULL states, keys and times occur."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        sub = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        t = None if rng.random() < 0.03 else T0 + dt.timedelta(hours=rng.randint(0, 300))
        out.append((sub, rng.choice(["basic", "plus", None]), rng.choice(["FR", "BE"]), t, T0 + dt.timedelta(hours=rng.randint(0, 9)), f"e{i}"))
    return out


def _brute_versions(rows):
    out = {}
    for sub in {r[0] for r in rows if r[0] is not None}:
        at = {}
        for r in sorted((r for r in rows if r[0] == sub and r[3] is not None), key=lambda r: (r[4], r[5])):
            at[r[3]] = (r[1], r[2])
        last = object()
        out[sub] = []
        for t in sorted(at):
            if at[t] != last:
                out[sub].append((t, at[t]))
                last = at[t]
    return out


def test_versions_and_as_of_equal_brute_force(spark):
    rows = _events()
    df = spark.createDataFrame(rows, EVENTS)
    want = _brute_versions(rows)
    v = HI.versions(df)
    got = sorted(map(repr, map(tuple, v.collect())))
    assert got == sorted(repr((s, *state, t, vs[i + 1][0] if i + 1 < len(vs) else None))
                         for s, vs in want.items() for i, (t, state) in enumerate(vs))

    def in_force(sub, t):
        hit = [x for x in want.get(sub, []) if t is not None and x[0] <= t]
        return (*hit[-1][1], hit[-1][0]) if hit else (None, None, None)
    facts = _events(4, 300) + [("unknown", "x", "y", T0, T0, "u"), ("hot", "x", "y", T0 - dt.timedelta(days=9), T0, "early")]
    facts += facts[:5]
    f = spark.createDataFrame(facts, EVENTS)
    got = sorted(map(repr, map(tuple, HI.as_of_join(f, v).collect())))
    assert got == sorted(repr((*r, *in_force(r[0], r[3]))) for r in facts)
    assert HI.as_of_join(f, v.limit(0)).count() == len(facts) and HI.as_of_join(f.limit(0), v).count() == 0


def test_hot_key_is_split_by_day(spark):
    v = HI.versions(spark.createDataFrame(_events(), EVENTS))
    plan = HI.as_of_join(spark.createDataFrame(_events(4), EVENTS), v)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Window [last(_v" in plan and "hashpartitioning(_k" in plan


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("smallint", "int", "int"), ("bigint", "double", "double"), ("float", "int", "double"),
    ("double", "string", "string"), ("date", "date", "date"), ("date", "string", None), ("boolean", "int", None),
    ("array<string>", "string", None)])
def test_widening(a, b, want):
    parse = T._parse_datatype_string
    for x, y in ((a, b), (b, a)):
        got = LA.widen(parse(x), parse(y))
        assert (got.simpleString() if got else None) == want


def test_evolved_folders(spark, tmp_dir):
    spark.range(3).selectExpr("cast(id as int) x", "'a' k").write.parquet(f"{tmp_dir}/1")
    spark.range(2).selectExpr("id + 5000000000 x", "'b' k", "true extra").write.parquet(f"{tmp_dir}/2")
    spark.range(2).selectExpr("cast(id as int) x", "'c' k").write.parquet(f"{tmp_dir}/3")
    spark.range(2).selectExpr("array(id) x", "'d' k").write.parquet(f"{tmp_dir}/4")
    spark.range(1).selectExpr("0.5D x", "cast(null as string) k", "false extra").write.parquet(f"{tmp_dir}/5")
    spark.range(1).selectExpr("current_date() k").write.parquet(f"{tmp_dir}/6")
    rows, bad = LA.read_evolved(spark, tmp_dir)
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema.fields] == [("x", "double"), ("k", "string"), ("extra", "boolean")]
    assert sorted(map(repr, map(tuple, rows.collect()))) == sorted(map(repr, [
        (0.0, "a", None), (1.0, "a", None), (2.0, "a", None), (5e9, "b", True), (5e9 + 1, "b", True), (0.0, "c", None),
        (1.0, "c", None), (0.5, None, False)]))
    got = sorted((r.folder, r.reason, json.loads(r.record)["k"][:1]) for r in bad.collect())
    assert [g[:2] for g in got] == [("4", "x: array<bigint> against bigint")] * 2 + [("6", "k: date against string")]
