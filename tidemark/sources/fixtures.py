"""Bronze event tables derived from the driver's ``events`` table.

The recipe is fixed (integer arithmetic only) so that Spark and an
independent SQL engine start from equal rows. Every row of ``events`` feeds
the result; the late events of two rule-defined sets of users go to other
subscribers, which leaves idle ones (FIXTURES section 3, step 1).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.rules import format_id

# Frozen clock for every fixture-driven query.
AS_OF = _dt.datetime(2024, 2, 2, 0, 0, 0)
# Second-batch boundary for the upsert fixture, on ``ingested_at``: events
# from 2024-01-25 on (first copies land 10 minutes after the event) are held
# back. The first silver run happens at this instant.
BATCH_CUT = _dt.datetime(2024, 1, 25, 0, 10, 0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(s: str):
    return F.lit(s).cast(T.TimestampNTZType())


def bronze_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` onto the bronze schema, with faults and duplicates."""
    e = F.col("event_id")
    uid = F.col("user_id")
    ts = F.col("ts").cast(T.TimestampNTZType())

    # late events of users ending in 7 or 8 go to the user of that ten ending in 0
    idle = ((((uid % 10) == 7) & (ts >= _ntz("2024-01-09")))
            | (((uid % 10) == 8) & (ts >= _ntz("2024-01-17"))))

    v = F.round(F.col("value") * 100).cast(T.LongType())
    n = (F.when(e % 3 == 0, F.when(idle, uid - uid % 10).otherwise(uid))
         .when(e % 3 == 1, F.lit(1000) + e % 500)
         .otherwise(F.lit(10000) + e % 3000))

    device = (F.when(e % 7 == 0, "smart_tv").when(e % 7 == 1, "mobile")
              .when(e % 7 == 2, "web").when(e % 7 == 3, "tablet")
              .when(e % 7 == 4, "set_top_box").when(e % 7 == 5, "smart_tv"))
    etype = F.col("event_type")
    event_type = (F.when(etype == "view", "PLAY").when(etype == "click", "Pause")
                  .when(etype == "error", "stop").when(etype == "purchase", "completion")
                  .otherwise("seek"))
    watch = (F.when(e % 53 == 0, -5).when(e % 11 == 0, 0)
             .otherwise(v * 13 % 7201)).cast(T.IntegerType())
    completion = (F.when(e % 89 == 0, 1.2).when(e % 83 == 0, -0.1)
                  .when(e % 13 == 0, 0.0)
                  .otherwise((v * 17 % 10001).cast(T.DoubleType()) / 10000.0))
    plan = F.when(n % 3 == 0, "Basic").when(n % 3 == 1, "plus").otherwise("ELITE")
    country = (F.when(e % 211 == 0, "US").when(n % 4 == 0, "fr").when(n % 4 == 1, "BE")
               .when(n % 4 == 2, "CH").otherwise("LU"))

    # every 20th event arrives twice: one scan, and a generator emits the copy
    copy = F.explode(F.when(e % 20 == 0, F.array(F.lit(1), F.lit(2)))
                      .otherwise(F.array(F.lit(1)))).alias("_copy")
    second = F.col("_copy") == 2
    return events.select("*", copy).select(
        e.cast(T.StringType()).alias("event_id"),
        F.when(e % 97 == 0, F.lit(None).cast(T.StringType()))
         .otherwise(format_id("sub_", n, 8)).alias("subscriber_id"),
        format_id("content_", e * 7 % 100 + 1, 4).alias("content_id"),
        F.when(second, F.lit("web")).otherwise(device).alias("device_type"),
        event_type.alias("event_type"),
        watch.alias("watch_duration_s"),
        completion.alias("completion_pct"),
        plan.alias("plan_type"),
        country.alias("country"),
        F.when(e % 101 == 0, F.lit(None).cast(T.TimestampNTZType()))
         .otherwise(ts).alias("event_timestamp"),
        F.lit("4.3.0").alias("app_version"),
        F.when(second, ts + F.expr("INTERVAL 40 MINUTES"))
         .otherwise(ts + F.expr("INTERVAL 10 MINUTES")).alias("ingested_at"),
        F.when(second, F.lit("run-2")).otherwise(F.lit("run-1")).alias("pipeline_run_id"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_events(read_table(spark, sf_dir, "events"))


def bronze_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passing variant: subscriber present, completion in 0..1, known country."""
    b = bronze(spark, sf_dir)
    return (b.where(F.col("subscriber_id").isNotNull()
                    & F.col("completion_pct").between(0, 1)
                    & F.upper("country").isin(*S.COUNTRIES))
             .withColumn("country", F.upper("country")))


def bronze_batches(spark: SparkSession, sf_dir: str):
    """(first, second): bronze split at ``BATCH_CUT`` by ``ingested_at``."""
    b = bronze(spark, sf_dir)
    cut = _ntz(BATCH_CUT.strftime("%Y-%m-%d %H:%M:%S"))
    return b.where(F.col("ingested_at") <= cut), b.where(F.col("ingested_at") > cut)
