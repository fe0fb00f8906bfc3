"""Resharding by minimum-cost flow.

Given the bytes of the old shards and the capacities of the new ones, a
minimum-cost flow says how many bytes go from each old shard to each new one:
staying costs nothing, moving a byte costs its price, so the fewest bytes
move. Documents of an old shard, in hash order, are cut into runs of these
lengths. Documents that lie at a cut are then dealt, largest first, to the
shard with most room left, which makes the sizes meet their capacities to
about a small document.

The flow works on shard sizes alone (tens of numbers). Places of documents
and slots in the new shards come from bucketed running totals, so a shard or
source that holds a third of all rows makes no large task.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

SHARDS = 40
OVERHEAD = 16
NEAR = 4           # mean sizes around a cut within which documents are dealt anew


def min_cost_flow(supply: list[int], room: list[int], cost) -> dict[tuple[int, int], int]:
    """Flow (i, j) -> units that sends all supply within the rooms at least cost.

    Successive cheapest paths with potentials on the bipartite network; each
    path uses up a supply, a room or a reverse edge, so a few hundred paths do.
    """
    n, m = len(supply), len(room)
    if sum(supply) > sum(room):
        raise ValueError("the new shards can't hold all bytes")
    flow: dict[tuple[int, int], int] = {}
    left, free = list(supply), list(room)
    pot = [0.0] * (n + m)
    while any(left):
        dist = [0.0 if i < n and left[i] else float("inf") for i in range(n + m)]
        came: list[int | None] = [None] * (n + m)
        heap = [(0.0, i) for i in range(n) if left[i]]
        done = [False] * (n + m)
        while heap:
            d, u = heapq.heappop(heap)
            if done[u]:
                continue
            done[u] = True
            if u < n:
                steps = [(n + j, cost(u, j)) for j in range(m)]
            else:
                steps = [(i, -cost(i, u - n)) for i in range(n) if flow.get((i, u - n))]
            for v, c in steps:
                w = d + c + pot[u] - pot[v]
                if w < dist[v] - 1e-12:
                    dist[v], came[v] = w, u
                    heapq.heappush(heap, (w, v))
        end = min((n + j for j in range(m) if free[j]), key=lambda v: dist[v] + pot[v])
        far = dist[end]
        pot = [p + min(d, far) for p, d in zip(pot, dist)]
        path, v = [], end
        while came[v] is not None:
            path.append((came[v], v))
            v = came[v]
        units = min(left[v], free[end - n], *(flow[b, a - n] for a, b in path if a >= n))
        left[v] -= units
        free[end - n] -= units
        for a, b in path:
            if a < n:
                flow[a, b - n] = flow.get((a, b - n), 0) + units
            else:
                flow[b, a - n] -= units
    return {k: x for k, x in flow.items() if x}


def plan(old: dict[int, int], capacity: list[int]) -> list[tuple[int, int, int, int]]:
    """Runs (old shard, from byte, to byte, new shard) of each old shard's line; what stays comes first."""
    ids = sorted(old)
    flow = min_cost_flow([old[i] for i in ids], capacity, lambda i, j: 0.0 if ids[i] == j else 1.0)
    out = []
    for k, i in enumerate(ids):
        at = 0
        for j in sorted((j for (a, j) in flow if a == k), key=lambda j: (j != i, j)):
            out.append((i, at, at + flow[k, j], j))
            at += flow[k, j]
    return out


def equal_capacity(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def reshard(docs: DataFrame, old_shard: Column, capacity=None, shards: int = SHARDS, doc_id: str = "doc_id",
            text: str = "text") -> DataFrame:
    """One row a document: doc_id, size, text_crc32, old_shard, shard, slot.

    ``capacity``: bytes of each new shard from the total (default: equal).
    Null text has 16 bytes and the crc of no bytes; a null old shard counts
    as shard 0. Equal rows are interchangeable. Empty tables give no rows.
    """
    return _reshard(docs, old_shard, capacity, shards, doc_id, text, F.monotonically_increasing_id()).drop("uid")


def _reshard(docs: DataFrame, old_shard: Column, capacity, shards: int, doc_id: str, text: str, uid: Column) -> DataFrame:
    """The rows of ``reshard`` with ``uid``, which is different for each row."""
    spark = docs.sparkSession
    t = F.coalesce(F.col(text), F.lit("")).cast("binary")
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(t) + OVERHEAD).cast("long").alias("size"),
                    F.crc32(t).alias("text_crc32"), F.coalesce(old_shard, F.lit(0)).cast("int").alias("old_shard"), uid.alias("uid"))
    d = C.stored(d.withColumn("key", F.xxhash64("doc_id", "size", "text_crc32")))
    per = {r[0]: (int(r[1]), int(r[2])) for r in d.groupBy("old_shard").agg(F.sum("size"), F.count(F.lit(1))).collect()}
    total, rows = sum(x for x, _ in per.values()), sum(n for _, n in per.values())
    cap = (capacity or equal_capacity)(total, shards)
    runs = plan({k: x for k, (x, _) in per.items()}, cap)
    r_df = spark.createDataFrame(runs, "old_shard int, lo long, hi long, to int")
    near = NEAR * (total // max(1, rows))
    end = {i: hi for i, _, hi, _ in sorted(runs)}
    inner = spark.createDataFrame([(i, hi) for i, _, hi, _ in runs if hi != end[i]], "old_shard int, cut long")
    line = C.running_total(d, ["old_shard"], C.hash_buckets("key", rows), ["key", "doc_id", "size", "uid"], F.col("size"), "at")
    middle = 2 * F.col("at") + F.col("size")
    # at most shards^2 runs; a middle lies in exactly one
    placed = C.stored(line.join(F.broadcast(r_df), "old_shard").filter((middle >= 2 * F.col("lo")) & (middle < 2 * F.col("hi")))
                      .drop("lo", "hi"))
    at_cut = (placed.join(F.broadcast(inner), "old_shard")
              .filter((F.col("at") < F.col("cut") + near) & (F.col("at") + F.col("size") > F.col("cut") - near))
              .groupBy("uid").agg(F.first("size").alias("size"), F.first("to").alias("home")))
    loose = sorted(((r["size"], r["uid"], r["home"]) for r in at_cut.collect()), reverse=True)
    moved = _deal(placed, loose, cap)
    m_df = spark.createDataFrame(moved, "uid long, better int")
    out = (placed.join(F.broadcast(m_df), "uid", "left")
           .withColumn("shard", F.coalesce("better", "to")).drop("better", "to", "at"))
    return C.running_total(out, ["shard"], C.hash_buckets("key", max(1, rows // shards)), ["key", "doc_id", "size", "uid"], F.lit(1), "slot").select(
        "doc_id", "size", "text_crc32", "old_shard", "shard", "slot", "uid")


def _deal(placed: DataFrame, loose: list[tuple[int, int, int]], cap: list[int]) -> list[tuple[int, int]]:
    """New shards of the documents at cuts (some dozens a cut), largest first, each where most room is left."""
    used = {r[0]: int(r[1]) for r in placed.groupBy("to").agg(F.sum("size")).collect()}
    room = [c - used.get(j, 0) for j, c in enumerate(cap)]
    for size, _, home in loose:
        room[home] += size
    out = []
    for size, uid, home in loose:
        best = max(range(len(room)), key=lambda j: (room[j], j == home))
        room[best] -= size
        if best != home:
            out.append((uid, best))
    return out


def rewrite(docs: DataFrame, old_shard: Column, out: str, capacity=None, shards: int = SHARDS, doc_id: str = "doc_id",
            text: str = "text", folder: str = "shard") -> DataFrame:
    """Write the affected shards (those that lose or gain a document) below ``out``, one folder a shard; gives the moves.

    All columns of ``docs`` are written, each row of an affected shard once:
    rows are known by an id stored with them, so null and repeated document ids
    lose and add nothing. A shard that ends without documents has no folder.
    """
    if folder in docs.columns:
        raise ValueError(f"docs has a column {folder!r}: name the folders' column otherwise")
    d = C.stored(docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                             old_shard.alias("old_shard"), F.monotonically_increasing_id().alias("uid")))
    moves = C.stored(_reshard(d, F.col("old_shard"), capacity, shards, "doc_id", "text", F.col("uid")))
    hit = moves.filter("shard != old_shard").select(F.explode(F.array("old_shard", "shard")).alias("shard")).distinct()
    rows = moves.join(F.broadcast(hit), "shard", "left_semi").select("uid", "shard", "slot")
    (d.select("doc", "uid").join(rows, "uid")
     .repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot")
     .select(F.col("shard").alias(folder), "doc.*").write.partitionBy(folder).parquet(out))
    return moves.drop("uid")


def op5_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents from shards by source (as crawled) to 40 shards of equal bytes, moving the fewest bytes."""
    docs = C.table(spark, sf_dir, "documents")
    old = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % SHARDS
    return reshard(docs, old).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")
