"""Model features (M1, F21-F26, J4, P10) and the training frame.

All derived features are column expressions in one ``select``; the category
codes are fixed-map lookups (``create_map``), so no join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import rules as R

NUMERIC_INPUTS = [
    "total_sessions_30d", "total_watch_time_h", "avg_completion_rate",
    "avg_engagement_score", "days_since_last_watch", "sessions_last_7d",
    "unique_content_count",
]


def engineer_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Add the 8 derived features; the result has ``keep`` + the 15 features."""
    total = F.col("total_sessions_30d").cast(T.DoubleType())
    watch = F.col("total_watch_time_h").cast(T.DoubleType())
    days = F.col("days_since_last_watch").cast(T.DoubleType())
    keep = keep if keep is not None else [c for c in df.columns if c not in S.FEATURE_COLS]
    derived = {
        "plan_type_enc": R.code_of("plan_type", S.PLAN_ENC, S.PLAN_DEFAULT),
        "country_enc": R.code_of("country", S.COUNTRY_ENC, S.COUNTRY_DEFAULT),
        "device_enc": R.code_of("favourite_device", S.DEVICE_ENC, S.DEVICE_DEFAULT),
        "sessions_per_day": R.round_half_up(total / F.lit(30.0), 4),
        "watch_per_session_h": F.when(total > 0, R.round_half_up(watch / total, 4))
                                .otherwise(F.lit(0.0)),
        "recency_x_frequency": R.round_half_up((F.lit(1.0) / (days + F.lit(1.0))) * total, 4),
        "is_elite": R.flag(F.col("plan_type") == "elite"),
        "is_mobile_first": R.flag(F.col("favourite_device") == "mobile"),
    }
    cols = [F.col(c) for c in keep]
    for name in S.FEATURE_COLS:
        if name in derived:
            cols.append(derived[name].alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def label_sorted_codes(df: DataFrame, columns=("plan_type", "country", "favourite_device"),
                       suffix: str = "_idx") -> DataFrame:
    """Codes learnt from the data in sorted order (F26): the k-th smallest
    distinct value gets k, as a label encoder does. Spark ML's
    ``StringIndexer`` learns the (small) value list with one aggregation."""
    from pyspark.ml.feature import StringIndexer
    ix = StringIndexer(inputCols=list(columns), outputCols=[c + suffix for c in columns],
                       stringOrderType="alphabetAsc", handleInvalid="keep")
    return ix.fit(df).transform(df)


def subscriber_number(col="subscriber_id"):
    """Numeric part of ``sub_%08d``."""
    return F.regexp_extract(R.as_column(col), r"(\d+)$", 1).try_cast(T.LongType())


def training_frame(gold_df: DataFrame) -> DataFrame:
    """Gold features plus a label: high risk, flipped for every tenth
    subscriber (label noise, so the classes overlap)."""
    high = F.col("churn_risk_label") == "high"
    flip = (subscriber_number() % 10) == 0
    label = F.when(flip, ~high).otherwise(high).cast(T.IntegerType())
    return gold_df.select("subscriber_id", *NUMERIC_INPUTS, "plan_type", "country",
                          "favourite_device", label.alias("churned_30d"))
