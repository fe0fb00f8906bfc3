"""Table schemas, domains and fixed values shared by every layer."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Domains of the event source.
DEVICE_TYPES = ["smart_tv", "mobile", "web", "tablet", "set_top_box"]
EVENT_TYPES = ["play", "pause", "stop", "completion", "seek"]
PLAN_TYPES = ["basic", "plus", "elite"]
COUNTRIES = ["FR", "BE", "CH", "LU"]

# Category codes used by scoring and retraining, with the serving defaults
# for unknown values (plan 0, country 2, device 3).
PLAN_ENC = {"basic": 0, "plus": 1, "elite": 2}
COUNTRY_ENC = {"BE": 0, "CH": 1, "FR": 2, "LU": 3}
DEVICE_ENC = {"mobile": 0, "smart_tv": 1, "tablet": 2, "web": 3}
PLAN_DEFAULT, COUNTRY_DEFAULT, DEVICE_DEFAULT = 0, 2, 3

# Model input, in this order.
FEATURE_COLS = [
    "total_sessions_30d", "total_watch_time_h", "avg_completion_rate",
    "avg_engagement_score", "days_since_last_watch", "sessions_last_7d",
    "unique_content_count", "plan_type_enc", "country_enc", "device_enc",
    "sessions_per_day", "watch_per_session_h", "recency_x_frequency",
    "is_elite", "is_mobile_first",
]

# Drift baseline (feature -> mean, std, min, max), churn rate and threshold.
BASELINE_STATS = {
    "total_sessions_30d": (14.2, 9.8, 0.0, 100.0),
    "avg_completion_rate": (0.68, 0.22, 0.0, 1.0),
    "days_since_last_watch": (5.3, 6.1, 0.0, 30.0),
    "avg_engagement_score": (60.1, 22.4, 0.0, 100.0),
}
BASELINE_CHURN_RATE = 0.25
AUC_BASELINE = 0.87
DRIFT_THRESHOLD = 0.15

# Gates.
QUALITY_THRESHOLD = 99.0
AUC_THRESHOLD = 0.80
BATCH_MAX_ROWS = 1000

# Risk bands for a probability, with their advice text.
RISK_HIGH, RISK_MEDIUM = 0.7, 0.4
RECOMMENDATIONS = {
    "HIGH": "🚨 Trigger immediate retention campaign — offer 1-month free",
    "MEDIUM": "⚠️  Send personalised content recommendation this week",
    "LOW": "✅ No action needed — subscriber is engaged",
}
# Drift report texts.
DRIFT_STATUS = {True: "🚨 DRIFT", False: "✅ OK"}
RETRAIN_TEXT = "🚨 RETRAIN MODEL — significant drift detected in: "
HEALTHY_TEXT = "✅ Model is healthy — no retraining needed"
# Heuristic fallback score: start, rule weights, cap.
HEURISTIC_START = 0.5
HEURISTIC_CAP = 0.98
# Scoring-input ranges: field -> (min, max); None is open.
SCORING_RANGES = {
    "total_sessions_30d": (0, 500),
    "total_watch_time_h": (0, None),
    "avg_completion_rate": (0, 1),
    "avg_engagement_score": (0, 100),
    "days_since_last_watch": (0, 30),
    "sessions_last_7d": (0, 100),
    "unique_content_count": (0, None),
}
# Business impact constants.
SUBSCRIBERS = 8_000_000
MONTHLY_REVENUE = 12
CHURN_RATE = 0.25
RETENTION_RATE = 0.30
# ---------------------------------------------------------------------------

BRONZE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("subscriber_id", T.StringType(), True),
    T.StructField("content_id", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("watch_duration_s", T.IntegerType(), True),
    T.StructField("completion_pct", T.DoubleType(), True),
    T.StructField("plan_type", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("event_timestamp", T.TimestampNTZType(), True),
    T.StructField("app_version", T.StringType(), True),
    T.StructField("ingested_at", T.TimestampNTZType(), True),
    T.StructField("pipeline_run_id", T.StringType(), True),
])
BRONZE_COLS = [f.name for f in BRONZE_SCHEMA.fields]

# Column defaults of the bronze DDL (applied when a source lacks them).
BRONZE_DEFAULTS = {"watch_duration_s": 0, "completion_pct": 0.0}

SILVER_SCHEMA = T.StructType(BRONZE_SCHEMA.fields + [
    T.StructField("watch_category", T.StringType(), False),
    T.StructField("session_length_category", T.StringType(), False),
    T.StructField("event_date", T.DateType(), True),
    T.StructField("event_hour", T.IntegerType(), True),
    T.StructField("day_of_week", T.IntegerType(), True),
    T.StructField("is_weekend", T.BooleanType(), True),
    T.StructField("engagement_score", T.DoubleType(), True),
    T.StructField("transformed_at", T.TimestampNTZType(), True),
])
SILVER_COLS = [f.name for f in SILVER_SCHEMA.fields]

GOLD_COLS = [
    "subscriber_id", "plan_type", "country", "total_sessions_30d",
    "active_days_30d", "total_watch_time_h", "avg_completion_rate",
    "avg_engagement_score", "days_since_last_watch", "favourite_device",
    "completion_rate", "abandonment_rate", "sessions_last_7d",
    "unique_content_count", "activity_trend", "churn_risk_label",
    "computed_at",
]

# Scoring input: the training frame without its label.
SCORING_INPUT_COLS = [
    "subscriber_id", "total_sessions_30d", "total_watch_time_h",
    "avg_completion_rate", "avg_engagement_score", "days_since_last_watch",
    "sessions_last_7d", "unique_content_count", "plan_type", "country",
    "favourite_device",
]
