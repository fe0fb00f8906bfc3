"""Subscriber history: validity intervals from changes, and facts joined to the
version in force (X1, X3).

Both work on (key, day): changes inside a day are found there, and what holds
at the start of a day comes from one row a day, carried over the days of a
key. So a key that holds a third of all rows is split over its days, no
interval is compared with another key's, and there is no range join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def versions(events: DataFrame, key: str = "subscriber_id", state: tuple[str, ...] = ("plan_type", "country"),
             ts: str = "event_timestamp", tie: tuple[str, ...] = ("ingested_at", "event_id")) -> DataFrame:
    """(key, state columns, valid_from, valid_to): one row whenever the state of a key changes.

    ``valid_to`` is the next version's ``valid_from``, NULL for the current
    one. Of several states at one instant the one latest by ``tie`` counts.
    NULL states are states like others; rows without key or time are no
    changes.
    """
    at = (events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(ts).alias("_t"))
          .agg(F.max_by(F.struct(*state), F.struct(*tie)).alias("_s")).withColumn("_d", F.to_date("_t")))
    inside = Window.partitionBy("_k", "_d").orderBy("_t")
    over_days = Window.partitionBy("_k").orderBy("_d")
    # one row a day: its last state, and that of the day before it
    days = (at.groupBy("_k", "_d").agg(F.max_by("_s", "_t").alias("_last"))
            .select("_k", "_d", F.lag("_last").over(over_days).alias("_carried")))
    previous = F.coalesce(F.lag("_s").over(inside), F.col("_carried"))
    changed = (at.join(days, ["_k", "_d"]).withColumn("_p", previous)
               .where(~F.col("_s").eqNullSafe(F.col("_p"))).select("_k", "_d", "_t", "_s"))
    starts = (changed.groupBy("_k", "_d").agg(F.min("_t").alias("_first"))
              .select("_k", "_d", F.lead("_first").over(over_days).alias("_next")))
    return (changed.join(starts, ["_k", "_d"])
            .select(F.col("_k").alias(key), "_s.*", F.col("_t").alias("valid_from"),
                    F.coalesce(F.lead("_t").over(inside), F.col("_next")).alias("valid_to")))


def as_of_join(facts: DataFrame, history: DataFrame, key: str = "subscriber_id", ts: str = "event_timestamp",
               state: tuple[str, ...] = ("plan_type", "country"), prefix: str = "v_") -> DataFrame:
    """``facts`` with the state columns (and ``valid_from``) of the version in force at ``ts``, prefixed.

    A version counts from its first instant on. NULL where none is in force
    yet, or key or time are missing; every fact stays, repeated ones too.
    """
    version = F.struct(*[F.col(s) for s in (*state, "valid_from")])
    kind = T.StructType([T.StructField(s, history.schema[s].dataType) for s in (*state, "valid_from")])
    usable = F.col(key).isNotNull() & F.col(ts).isNotNull()
    row = F.struct(*[F.col(c) for c in facts.columns])
    f = facts.where(usable).select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.lit(1).alias("_o"),
                                   F.lit(None).cast(kind).alias("_v"), row.alias("_f"))
    v = history.select(F.col(key).alias("_k"), F.col("valid_from").alias("_t"), F.lit(0).alias("_o"),
                       version.cast(kind).alias("_v"), F.lit(None).cast(f.schema["_f"].dataType).alias("_f"))
    both = f.unionByName(v).withColumn("_d", F.to_date("_t"))
    days = both.groupBy("_k", "_d").agg(F.max_by("_v", F.when(F.col("_o") == 0, F.col("_t"))).alias("_last"))
    earlier = Window.partitionBy("_k").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_k", "_d", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    # a version comes before the facts of its own instant
    so_far = Window.partitionBy("_k", "_d").orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = (both.join(days, ["_k", "_d"])
              .withColumn("_n", F.coalesce(F.last("_v", ignorenulls=True).over(so_far), F.col("_carried")))
              .where(F.col("_o") == 1).select("_f", "_n"))
    rest = facts.where(~usable).select(row.alias("_f"), F.lit(None).cast(kind).alias("_n"))
    return joined.unionByName(rest).select("_f.*", *[F.col(f"_n.{s}").alias(prefix + s) for s in (*state, "valid_from")])
