"""Enrichment as a stream (X2, T2): silver rows joined with dimension versions
that are read anew in every micro-batch.

Dimensions are versioned tables (``tables.write_version``). A micro-batch joins
its rows with the versions that are current when it runs. Where a version has
changed since the last micro-batch, the stored rows whose attributes it changes
are joined again, so after every micro-batch the table equals the batch join
of all rows with the current dimensions:

* the changed keys come from one full-outer join of the old and the new version;
* the days that hold rows with such keys, or earlier copies of the batch's
  events, are found from the key columns alone; only these days are rewritten;
* the versions used are recorded after the swap. An attempt that died before
  that compares with the older versions again and ends with the same table.

Rows are kept by ``event_id``, latest arrival first, so replayed and
out-of-order batches converge. A subscriber or title that holds a large share
of the rows touches its days only; the joins are left to adaptive execution,
which splits a hot key or broadcasts a small dimension.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import rules as R
from ..operators import silver as SV
from ..operators import warehouse as WH
from ..operators.joins import stored_matches
from ..session import cut_lineage
from ..sources import tables as TB
from . import streams as ST

SUBSCRIBER_ATTRS, CONTENT_ATTRS = ["email", "signup_date"], ["genre"]
_APPLIED = "seq bigint, subscribers string, content string"


def paths(root: str) -> dict:
    r = root.rstrip("/")
    return {"enriched": f"{r}/enriched", "applied": f"{r}/applied_versions"}


def write_dimensions(dims_root: str, subscribers: DataFrame | None = None, content: DataFrame | None = None) -> None:
    """New versions of the given dimensions; running streams take them with their next micro-batch."""
    if subscribers is not None:
        TB.write_version(subscribers.select("subscriber_id", *SUBSCRIBER_ATTRS), f"{dims_root}/subscribers")
    if content is not None:
        TB.write_version(content.select("content_id", *CONTENT_ATTRS), f"{dims_root}/content")


def changed_keys(old: DataFrame, new: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Keys whose attributes differ between two versions, or that only one of them has."""
    a = old.select(key, F.struct(*attrs).alias("_old"))
    b = new.select(key, F.struct(*attrs).alias("_new"))
    return a.join(b, key, "full").where(~F.col("_old").eqNullSafe(F.col("_new"))).select(key)


def _last_applied(spark: SparkSession, path: str):
    log = TB.read_if_exists(spark, path)
    return None if log is None else log.orderBy(F.col("seq").desc()).first()


def merge_enriched(spark: SparkSession, batch: DataFrame, root: str, dims_root: str) -> list[_dt.date]:
    """Merge ``batch`` (silver rows, may be empty) into the enriched table and bring
    rows of changed dimension keys up to date. Returns the days rewritten."""
    p = paths(root)
    now = [TB.current_path(spark, f"{dims_root}/{d}") for d in ("subscribers", "content")]
    if None in now:
        raise ValueError("write both dimensions before the stream starts")
    subs, content = (spark.read.parquet(v) for v in now)
    last = _last_applied(spark, p["applied"])
    batch = cut_lineage(batch)
    target = TB.read_if_exists(spark, p["enriched"])

    days = batch.select("event_date")
    if target is not None:
        days = days.unionByName(stored_matches(target, batch, "event_id", ["event_date"]).select("event_date"))
        for name, key, attrs, cur in (("subscribers", "subscriber_id", SUBSCRIBER_ATTRS, subs),
                                      ("content", "content_id", CONTENT_ATTRS, content)):
            path = now[0] if name == "subscribers" else now[1]
            if last is None:           # died before its first record: nothing is known to be current
                days = days.unionByName(target.select("event_date"))
            elif last[name] != path:
                keys = changed_keys(spark.read.parquet(last[name]), cur, key, attrs)
                days = days.unionByName(stored_matches(target, keys, key, ["event_date"]).select("event_date"))
    # one value a touched day: a small list, used as literals to prune
    touched = sorted(r[0] for r in days.distinct().collect())
    if touched:
        rows = batch
        if target is not None:
            stored = target.where(F.col("event_date").isin(touched)).drop(*SUBSCRIBER_ATTRS, *CONTENT_ATTRS)
            rows = SV.sync_columns(stored, batch).unionByName(batch)
        rows = cut_lineage(WH.enrich_events(SV.keep_latest(rows), subs, content))
        TB.swap_partitions(rows, p["enriched"], ["event_date"], [(d,) for d in touched])
    if last is None or [last["subscribers"], last["content"]] != now:
        R.literal_table(spark, [(0 if last is None else last["seq"] + 1, *now)], _APPLIED) \
            .coalesce(1).write.mode("append").parquet(p["applied"])
    return touched


def refresh_enriched(spark: SparkSession, root: str, dims_root: str) -> list[_dt.date]:
    """Bring the stored rows up to the current dimension versions without waiting for new events."""
    target = TB.read_if_exists(spark, paths(root)["enriched"])
    if target is None:
        return []
    return merge_enriched(spark, target.drop(*SUBSCRIBER_ATTRS, *CONTENT_ATTRS).limit(0), root, dims_root)


def start_enrichment_stream(spark: SparkSession, silver_source: str, root: str, dims_root: str, checkpoint: str,
                            schema: T.StructType, trigger: str | None = None,
                            max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Enriched events from a stream of silver files (``schema``: silver's columns).

    Rows without an event id or date are not silver rows and are refused by
    silver's admission already. An empty micro-batch rewrites nothing unless a
    dimension has changed."""
    src = ST.read_events_stream(spark, silver_source, schema, max_files_per_trigger=max_files_per_trigger)

    def write(batch: DataFrame, batch_id: int) -> None:
        merge_enriched(batch.sparkSession, batch, root, dims_root)

    w = src.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return ST._trigger(w, trigger).start()
