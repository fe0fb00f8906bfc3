"""Star schema and enrichment.

Dimensions are keyed by their natural text ids (the ids are already unique
and stable), so the fact table needs no join at all to get its keys: it is
a narrow projection of silver. Attribute lookups (email, genre) join on the
key; a dimension is broadcast only after a row-count check, otherwise the
join shuffles on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from . import gold as G

def date_key(d) -> F.Column:
    """yyyymmdd as an integer."""
    d = R.as_column(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast(T.IntegerType())


def _number(col: str) -> F.Column:
    return F.regexp_extract(F.col(col), r"(\d+)$", 1).try_cast(T.LongType())


def dim_subscriber(silver: DataFrame, customer: DataFrame | None = None) -> DataFrame:
    """One row per subscriber: plan and country of the latest event, signup
    date = first event date, email from the customer with the same number
    (NULL when there is none), churn_score empty until scoring fills it."""
    latest = F.struct("event_timestamp", "ingested_at", "event_id")
    base = silver.groupBy("subscriber_id").agg(
        F.max_by("plan_type", latest).alias("plan_type"),
        F.max_by("country", latest).alias("country"),
        F.min("event_date").alias("signup_date"))
    if customer is not None:
        emails = customer.select(
            F.col("c_custkey").cast(T.LongType()).alias("_n"),
            F.concat(F.lower(F.regexp_replace("c_name", "[^A-Za-z0-9]", "")),
                     F.lit("@example.com")).alias("email"))
        base = (base.withColumn("_n", _number("subscriber_id"))
                    .join(emails, "_n", "left").drop("_n"))
    else:
        base = base.withColumn("email", F.lit(None).cast(T.StringType()))
    return base.select("subscriber_id", "email", "plan_type", "country", "signup_date",
                       F.lit(None).cast(T.DoubleType()).alias("churn_score"))


def dim_content(silver: DataFrame, part: DataFrame | None = None) -> DataFrame:
    """One row per content id; genre from the part with the same number
    (first word of its type, lower case), 'unknown' when none."""
    base = silver.select("content_id").distinct()
    if part is None:
        return base.withColumn("genre", F.lit("unknown"))
    genres = part.select(F.col("p_partkey").cast(T.LongType()).alias("_n"),
                         F.lower(F.split("p_type", " ").getItem(0)).alias("genre"))
    return (base.withColumn("_n", _number("content_id"))
                .join(genres, "_n", "left").drop("_n")
                .select("content_id", F.coalesce("genre", F.lit("unknown")).alias("genre")))


def dim_device(silver: DataFrame) -> DataFrame:
    return silver.select(F.col("device_type").alias("device_id")).distinct().select(
        "device_id", F.when(F.col("device_id").isin("mobile", "tablet"), "handheld")
                      .when(F.col("device_id").isin("smart_tv", "set_top_box"), "living_room")
                      .when(F.col("device_id") == "web", "browser")
                      .otherwise("other").alias("device_class"))


def dim_date(silver: DataFrame) -> DataFrame:
    """Every day between the first and last event date (``sequence`` +
    ``explode`` from a one-row range: a bounded list of days)."""
    bounds = silver.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi")).alias("date"))
    dow = R.day_of_week_sun0("date")
    return days.select(date_key("date").alias("date_id"), "date",
                       F.year("date").alias("year"), F.month("date").alias("month"),
                       F.dayofmonth("date").alias("day"), dow.alias("day_of_week"),
                       dow.isin(0, 6).alias("is_weekend"))


def fact_viewing_events(silver: DataFrame) -> DataFrame:
    """One row per event with its dimension keys (no join: keys are the ids)."""
    return silver.select(
        "event_id", "subscriber_id", "content_id",
        F.col("device_type").alias("device_id"),
        date_key("event_date").alias("date_id"),
        "watch_duration_s", "completion_pct",
        F.col("event_timestamp").alias("created_at"))


def enrich_events(silver: DataFrame, subscribers: DataFrame, content: DataFrame) -> DataFrame:
    """Silver with subscriber (email, signup date) and content (genre)
    attributes. Content is broadcast after a size check; subscribers grow
    with the business, so that join shuffles unless the check passes."""
    sub = subscribers.select("subscriber_id", "email", "signup_date")
    return (silver.join(content, "content_id", "left")
                  .join(sub, "subscriber_id", "left"))


def write_scores(dim: DataFrame, scores: DataFrame) -> DataFrame:
    """``churn_score`` of scored subscribers into dim_subscriber
    (upsert of one column; unscored subscribers keep theirs)."""
    s = scores.select("subscriber_id", F.col("churn_probability").alias("churn_score"))
    return G.upsert_columns(dim, s, "subscriber_id", ["churn_score"], stamp_col=None)


def favourite_genre(enriched: DataFrame, as_of=None) -> DataFrame:
    """Most watched genre per subscriber over the gold window (ties:
    smallest name)."""
    recent = G.recent_window(enriched, as_of)
    return recent.groupBy("subscriber_id").agg(
        F.mode("genre", deterministic=True).alias("favourite_genre"))
