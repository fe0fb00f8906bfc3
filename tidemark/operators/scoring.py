"""Scoring (M9-M11, F27, P12, A14, P13).

Whole tables are scored on the executors: validation, features, model (or
the heuristic fallback) and banding are one narrow plan with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import rules as R
from .features import engineer_features

HEURISTIC_VERSION = "heuristic-fallback"


# --- P12 -------------------------------------------------------------------------

def validation_reasons() -> F.Column:
    """Array of reasons a scoring row is invalid (empty when valid)."""
    checks = []
    for c in S.SCORING_INPUT_COLS:
        checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}:missing")))
    for c, (lo, hi) in S.SCORING_RANGES.items():
        if lo is not None:
            checks.append(F.when(F.col(c) < lo, F.lit(f"{c}:below_{lo}")))
        if hi is not None:
            checks.append(F.when(F.col(c) > hi, F.lit(f"{c}:above_{hi}")))
    checks.append(F.when(~F.col("plan_type").isin(*S.PLAN_TYPES), F.lit("plan_type:unknown")))
    checks.append(F.when(~F.col("country").isin(*S.COUNTRIES), F.lit("country:unknown")))
    return F.array_compact(F.array(*checks))


def validate_input(df: DataFrame) -> DataFrame:
    """Tag rows with ``reasons`` and ``is_valid``; nothing is dropped."""
    return (df.withColumn("reasons", validation_reasons())
              .withColumn("is_valid", F.size("reasons") == 0))


def split_valid(df: DataFrame):
    """(valid, quarantine) views of one validated plan."""
    v = validate_input(df)
    return v.where("is_valid").drop("reasons", "is_valid"), v.where(~F.col("is_valid"))


def check_batch_size(df: DataFrame, max_rows: int | None = S.BATCH_MAX_ROWS) -> None:
    """Optional request-size cap (P13): an action, for request-style callers."""
    if max_rows is not None and df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"batch larger than {max_rows} rows")


# --- M9 ------------------------------------------------------------------------------

def heuristic_probability() -> F.Column:
    """Rule score used when no model is available (M9)."""
    score = F.lit(S.HEURISTIC_START)
    for cond, w in ((F.col("days_since_last_watch") > 15, 0.25),
                    (F.col("total_sessions_30d") < 3, 0.20),
                    (F.col("avg_completion_rate") < 0.3, 0.15),
                    (F.col("plan_type") == "basic", 0.05)):
        score = score + F.when(cond, F.lit(w)).otherwise(F.lit(0.0))
    return F.least(score, F.lit(S.HEURISTIC_CAP))


# --- M10 / M11 -------------------------------------------------------------------------

def _finish(scored: DataFrame, prob_col: str, as_of, model_version: str) -> DataFrame:
    p = F.col(prob_col)
    band = R.risk_band(p)
    return scored.select(
        "subscriber_id",
        R.round_half_up(p, 4).alias("churn_probability"),
        band.alias("churn_risk"),
        R.recommendation(band).alias("recommendation"),
        R.as_of_literal(as_of).alias("predicted_at"),
        F.lit(model_version).alias("model_version"),
    )


def score_heuristic(df: DataFrame, as_of=None, validate: bool = True) -> DataFrame:
    """Score every valid row with the fallback rules."""
    if validate:
        df, _ = split_valid(df)
    return _finish(df.withColumn("_p", heuristic_probability()), "_p", as_of, HEURISTIC_VERSION)


def with_probability(df: DataFrame) -> DataFrame:
    """All rows with the fallback rules' ``churn_probability``, NULL where a row fails the validation."""
    valid = F.size(validation_reasons()) == 0
    return df.withColumn("churn_probability", F.when(valid, R.round_half_up(heuristic_probability(), 4)))


def score_model(df: DataFrame, model, as_of=None, model_version: str = "1.0.0",
                validate: bool = True) -> DataFrame:
    """Score with a fitted ``PipelineModel`` whose input is the 15 features."""
    from pyspark.ml.functions import vector_to_array
    if validate:
        df, _ = split_valid(df)
    feats = engineer_features(df, keep=["subscriber_id"])
    out = model.transform(feats)
    out = out.withColumn("_p", vector_to_array("probability")[1])
    return _finish(out, "_p", as_of, model_version)


def score(df: DataFrame, model=None, as_of=None, model_version: str = "1.0.0") -> DataFrame:
    """Model scores when a model is given, else the heuristic (S16 fallback)."""
    if model is None:
        return score_heuristic(df, as_of)
    return score_model(df, model, as_of, model_version)


def batch_summary(predictions: DataFrame) -> DataFrame:
    """Rows and HIGH-risk count of a scored batch."""
    return predictions.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("churn_risk") == "HIGH").alias("high_risk_count"))
