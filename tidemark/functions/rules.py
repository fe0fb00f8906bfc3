"""Column-level business rules (scalar functions F1-F33).

All of these return ``Column`` expressions, so they stay inside whole-stage
codegen; none needs a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time -------------------------------------------------------------------

def as_of_literal(as_of=None) -> Column:
    """The run clock as a ``timestamp_ntz`` column.

    ``as_of`` may be a ``datetime``, an ISO string or ``None`` (local now).
    A literal folds to a constant, so filters on it reach the scan.
    """
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast(T.TimestampNTZType())
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(as_of, _dt.date):
        as_of = as_of.isoformat()
    return F.lit(str(as_of)).cast(T.TimestampNTZType())


def as_of_date(as_of=None) -> Column:
    return F.to_date(as_of_literal(as_of))


def day_of(as_of) -> _dt.date:
    """Calendar day of a clock given as datetime, date or ISO text."""
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    return as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])


def whole_days_between(later, earlier) -> Column:
    """Day part of ``later - earlier`` as an interval (A4g, F14, F15).

    Whole elapsed days, not calendar-day boundaries: 1 day 22 hours is 1.
    """
    diff = (as_column(later).cast(T.TimestampNTZType())
            - as_column(earlier).cast(T.TimestampNTZType()))
    return F.extract(F.lit("DAY"), diff).cast(T.IntegerType())


def day_of_week_sun0(ts) -> Column:
    """Day of week with Sunday = 0 (F10); Spark's own ``dayofweek`` has Sunday = 1."""
    return (F.dayofweek(as_column(ts)) - 1).cast(T.IntegerType())


# --- rounding -----------------------------------------------------------------

def round_half_up(c, digits: int) -> Column:
    """Decimal rounding, half away from zero.

    The value is first fixed to 8 decimals so that the result does not depend
    on the last binary digits of a double; both Spark and DuckDB then agree.
    """
    return F.round(as_column(c).cast(T.DecimalType(30, 8)), digits).cast(T.DoubleType())


# --- cleaning (F1-F5, F29) --------------------------------------------------------

def clean_device(c="device_type") -> Column:
    return F.coalesce(as_column(c), F.lit("unknown"))


def non_negative(c) -> Column:
    """``GREATEST(x, 0)``: NULL becomes 0, as GREATEST skips NULL."""
    return F.greatest(as_column(c), F.lit(0))


def completion_from_duration(duration_s, full_s: float = 3600.0) -> Column:
    """min(d / 3600, 1), clipped at 0."""
    ratio = as_column(duration_s).cast(T.DoubleType()) / F.lit(full_s)
    return F.greatest(F.least(ratio, F.lit(1.0)), F.lit(0.0))


# --- categories (F16, F17, F19, F20, F27) -----------------------------------------------

def watch_category(completion="completion_pct") -> Column:
    c = as_column(completion)
    return (F.when(c >= 0.9, "completed")
            .when(c >= 0.5, "partial")
            .when(c > 0, "abandoned")
            .otherwise("no_watch"))


def session_length_category(duration="watch_duration_s") -> Column:
    d = as_column(duration)
    return (F.when(d >= 3600, "long")
            .when(d >= 600, "medium")
            .when(d > 0, "short")
            .otherwise("none"))


def engagement_score(completion="completion_pct", duration="watch_duration_s") -> Column:
    """round(completion*60 + min(duration/3600, 1)*40, 2)."""
    c = as_column(completion).cast(T.DoubleType())
    d = as_column(duration).cast(T.DoubleType())
    raw = c * F.lit(60.0) + F.least(d / F.lit(3600.0), F.lit(1.0)) * F.lit(40.0)
    return round_half_up(raw, 2)


def activity_trend(sessions_7d="sessions_last_7d", sessions_30d="total_sessions_30d") -> Column:
    """7d > total/4 increasing, 7d < total/8 decreasing, else stable.

    Written on integers (7d*4 > total) so that no division rounds.
    """
    s7, s30 = as_column(sessions_7d), as_column(sessions_30d)
    return (F.when(s7 * 4 > s30, "increasing")
            .when(s7 * 8 < s30, "decreasing")
            .otherwise("stable"))


def churn_risk_label(days="days_since_last_watch", sessions="total_sessions_30d") -> Column:
    d, s = as_column(days), as_column(sessions)
    return (F.when((d > 20) | (s < 3), "high")
            .when((d > 10) | (s < 10), "medium")
            .otherwise("low"))


def risk_band(p="churn_probability") -> Column:
    p = as_column(p)
    return (F.when(p >= S.RISK_HIGH, "HIGH")
            .when(p >= S.RISK_MEDIUM, "MEDIUM")
            .otherwise("LOW"))


def recommendation(band="churn_risk") -> Column:
    b = as_column(band)
    out = None
    for k, text in S.RECOMMENDATIONS.items():
        out = (F.when(b == k, text) if out is None else out.when(b == k, text))
    return out


# --- codes (F24, F25) --------------------------------------------------------------

def code_of(c, mapping: dict, default: int) -> Column:
    """Fixed-map lookup with a default for unknown/NULL values."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[as_column(c)], F.lit(default)).cast(T.IntegerType())


def flag(cond: Column) -> Column:
    return cond.cast(T.IntegerType())


# --- drift (F28) ------------------------------------------------------------------

def nan_to_null(c) -> Column:
    c = as_column(c)
    return F.nanvl(c.cast(T.DoubleType()), F.lit(None).cast(T.DoubleType()))


def relative_deviation(current, baseline) -> Column:
    """|cur - base| / |base|, or |cur| when base is 0."""
    cur, base = as_column(current), as_column(baseline)
    return F.when(base != 0, F.abs(cur - base) / F.abs(base)).otherwise(F.abs(cur))


def is_drifted(deviation, threshold: float = S.DRIFT_THRESHOLD) -> Column:
    """Strictly above the threshold; an unknown deviation is not drift."""
    return F.coalesce(as_column(deviation) > F.lit(threshold), F.lit(False))


# --- ids (F30) ----------------------------------------------------------------------

def format_id(prefix: str, n, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(as_column(n).cast(T.StringType()), width, "0"))


# --- small literal tables -------------------------------------------------------------

def literal_table(spark, rows: list, schema: str):
    """A small constant table built from literals on the JVM side (a local
    relation; no Python worker and no RDD). ``schema`` is a DDL string."""
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)

    def value(v, dtype):
        if isinstance(dtype, T.MapType):
            if not v:
                return F.lit(None).cast(dtype)
            return F.create_map(*[x for k, val in v.items() for x in (F.lit(k), F.lit(val))]).cast(dtype)
        if isinstance(v, _dt.datetime):          # wall clock as text: no zone conversion
            return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dtype)
        return F.lit(v).cast(dtype)

    structs = []
    for row in rows:
        vals = row.values() if isinstance(row, dict) else row
        structs.append(F.struct(*[value(v, f.dataType).alias(f.name)
                                  for f, v in zip(st.fields, vals)]))
    if not structs:
        return spark.createDataFrame([], st)
    return spark.range(1).select(F.inline(F.array(*structs)))
