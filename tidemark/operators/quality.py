"""Quality measures and gates.

The bronze report computes all its counters in **one** aggregation pass
(the reference ran five scans). Declarative column tests are grouped per
table: the row tests (not-null, accepted values, accepted range) and the
first ``unique`` test of a table share one grouped pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import rules as R


class QualityGateError(ValueError):
    """Raised when a quality score is below its threshold."""


# --- P6-P8 -----------------------------------------------------------------------

def out_of_range(c, lo, hi):
    """``c < lo OR c > hi``: NULL is not a violation."""
    c = R.as_column(c)
    return (c < lo) | (c > hi)


def not_in_domain(c, values):
    """``c NOT IN (...)``: NULL stays unknown and is not counted."""
    return ~R.as_column(c).isin(*values)


def is_fresh(ts, as_of=None, hours: int = 2):
    """``ts >= as_of - hours``."""
    return R.as_column(ts) >= R.as_of_literal(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


def score_expr(issues, total):
    """round((1 - issues/total) * 100, 2); 0 for an empty table (A3)."""
    raw = (F.lit(1.0) - issues.cast(T.DoubleType()) / total.cast(T.DoubleType())) * F.lit(100.0)
    return F.when(total > 0, R.round_half_up(raw, 2)).otherwise(F.lit(0.0))


# --- A1-A3 -------------------------------------------------------------------------

def quality_report(bronze: DataFrame, as_of=None,
                   threshold: float = S.QUALITY_THRESHOLD) -> DataFrame:
    """One-row report over bronze.

    The score counts null subscribers, out-of-range completions and unknown
    countries (a row with two faults counts twice, as in the reference).
    Freshness and duplicate ids are reported beside it, not scored (D7).
    """
    agg = bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("subscriber_id").isNull()).alias("null_subscribers"),
        F.count_if(out_of_range("completion_pct", 0, 1)).alias("invalid_completion"),
        F.count_if(not_in_domain("country", S.COUNTRIES)).alias("unknown_countries"),
        F.count_if(is_fresh("event_timestamp", as_of)).alias("fresh_rows"),
        F.count_distinct("event_id").alias("_distinct_ids"),
        F.count("event_id").alias("_ids"),
    )
    issues = F.col("null_subscribers") + F.col("invalid_completion") + F.col("unknown_countries")
    score = score_expr(issues, F.col("total_rows"))
    return agg.select(
        "total_rows", "null_subscribers", "invalid_completion", "unknown_countries",
        "fresh_rows",
        (F.col("_ids") - F.col("_distinct_ids")).alias("duplicate_rows"),
        score.alias("quality_score"),
        (score >= F.lit(threshold)).alias("passed"),
    )


def quality_gate(report: DataFrame) -> float:
    """Action: return the score, or raise when the report did not pass."""
    row = report.select("quality_score", "passed").first()
    if not row["passed"]:
        raise QualityGateError(
            f"quality score {row['quality_score']}% is below the threshold; run stopped")
    return row["quality_score"]


# --- A21-A24: declarative column tests ---------------------------------------------------

@dataclass(frozen=True)
class ColumnTest:
    column: str
    test: str                      # unique | not_null | accepted_values | accepted_range
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None


@dataclass
class TableTests:
    table: str
    tests: list[ColumnTest] = field(default_factory=list)


# The reference's declared tests, per layer.
BRONZE_TESTS = TableTests("bronze_viewing_events", [
    ColumnTest("event_id", "unique"), ColumnTest("event_id", "not_null"),
    ColumnTest("subscriber_id", "not_null"),
    ColumnTest("completion_pct", "not_null"),
    ColumnTest("completion_pct", "accepted_range", min_value=0, max_value=1),
    ColumnTest("country", "accepted_values", values=tuple(S.COUNTRIES)),
])
SILVER_TESTS = TableTests("stg_viewing_events", [
    ColumnTest("event_id", "unique"), ColumnTest("event_id", "not_null"),
    ColumnTest("subscriber_id", "not_null"),
    ColumnTest("watch_category", "accepted_values",
               values=("completed", "partial", "abandoned", "no_watch")),
    ColumnTest("engagement_score", "accepted_range", min_value=0, max_value=100),
])
GOLD_TESTS = TableTests("gold_churn_features", [
    ColumnTest("subscriber_id", "unique"), ColumnTest("subscriber_id", "not_null"),
    ColumnTest("churn_risk_label", "accepted_values", values=("low", "medium", "high")),
    ColumnTest("avg_completion_rate", "accepted_range", min_value=0, max_value=1),
])


def _failing(t: ColumnTest):
    c = F.col(t.column)
    if t.test == "not_null":
        return c.isNull()
    if t.test == "accepted_values":
        return ~c.isin(*t.values)
    if t.test == "accepted_range":
        cond = F.lit(True)
        if t.min_value is not None:
            cond = cond & (c >= t.min_value)
        if t.max_value is not None:
            cond = cond & (c <= t.max_value)
        return ~cond
    raise ValueError(t.test)


def run_column_tests(df: DataFrame, spec: TableTests) -> DataFrame:
    """Rows (table_name, column_name, test_name, failures, status).

    ``failures`` counts failing rows; for ``unique`` it counts values that
    occur more than once, as the dbt test does. The first ``unique`` test and
    all row tests share one pass: rows are grouped by the unique column with
    per-group failure counts (partial aggregation), then summed; any further
    ``unique`` test is one more group-by.
    """
    simple = [t for t in spec.tests if t.test != "unique"]
    uniques = [t for t in spec.tests if t.test == "unique"]
    fails = [F.count_if(_failing(t)).alias(f"t{i}") for i, t in enumerate(simple)]
    names = [(t.column, t.test) for t in simple]
    if uniques:
        u = uniques[0].column
        per_value = df.groupBy(u).agg(F.count(F.lit(1)).alias("_c"), *fails)
        row = per_value.agg(
            *[F.coalesce(F.sum(f"t{i}"), F.lit(0)).alias(f"t{i}") for i in range(len(simple))],
            F.count_if(F.col(u).isNotNull() & (F.col("_c") > 1)).alias(f"t{len(simple)}"))
        names.append((u, "unique"))
    else:
        row = df.agg(*fails)
    stack = ", ".join(f"'{c}', '{t}', t{i}" for i, (c, t) in enumerate(names))
    out = row.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, test_name, failures)")
    for t in uniques[1:]:
        dup = (df.where(F.col(t.column).isNotNull()).groupBy(t.column).count()
                 .agg(F.count_if(F.col("count") > 1).alias("failures")))
        out = out.unionByName(dup.select(F.lit(t.column).alias("column_name"),
                                         F.lit("unique").alias("test_name"), "failures"))
    return out.select(
        F.lit(spec.table).alias("table_name"), "column_name", "test_name",
        F.col("failures").cast(T.LongType()).alias("failures"),
        F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))


def layer_scores(results: DataFrame) -> DataFrame:
    """Per table, tests run, tests failed and the share passed (in %)."""
    return results.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if(F.col("status") == "fail").alias("failed_tests"),
        R.round_half_up(F.avg(F.when(F.col("status") == "pass", 1.0).otherwise(0.0)) * 100.0, 2)
         .alias("pass_pct"))
