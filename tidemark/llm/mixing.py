"""Mixing sources to target weights by a low-discrepancy schedule.

Every slot of the schedule takes one block of equally many words from one
source. The source of slot t is where the golden-ratio point of t falls among
the cumulative target shares, so any run of slots holds each source in nearly
its share. Slots are ranked per source; the k-th slot of a source takes the
k-th block of its shuffled documents, laid end to end and repeated as often
as the target asks. Blocks are joined with the documents they cut.

The shuffle is a hash of id and seed, so reruns agree. Running totals (place
of a document in its source, rank of a slot in its source) are made from
bucket sums, so a source with a third of all rows is spread like any other.
Only the list of sources (one row each) comes to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

MOST = 3                      # no source, and no document, is taken more often than this
SLOTS = 2048                  # slots for each source, about
BLOCK = 1 << 16               # largest block in words
GOLDEN = 2654435769           # 2^32 / golden ratio


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(C.WORD)).cast("long")


def targets(size: list[int], weight: list[float], most: float = MOST) -> list[float]:
    """Shares of all words by weight, each at most ``most`` times its source; the excess is shared again."""
    out = [0.0] * len(size)
    open_ = set(range(len(size)))
    left = float(sum(size))
    while open_:
        total = sum(weight[i] for i in open_)
        full = [i for i in open_ if left * weight[i] / total > most * size[i]]
        if not full:
            for i in open_:
                out[i] = left * weight[i] / total
            break
        for i in full:
            out[i] = float(most * size[i])
        left -= sum(out[i] for i in full)
        open_ -= set(full)
    return out


_SLOT = "slot long, src int"


def _slots(cum: list[float]):
    schema = C.arrow(_SLOT)

    def run(batches):
        edge = np.array(cum)
        for b in batches:
            t = b.column(0).to_numpy()
            point = ((t + 1) * GOLDEN % (1 << 32)) / float(1 << 32)
            src = np.minimum(np.searchsorted(edge, point, "right"), len(edge) - 1)
            yield C.out_batch(schema, slot=t, src=src.astype(np.int32))
    return run


def schedule(spark: SparkSession, target: list[float], block: int) -> DataFrame:
    """Rows (slot, src, rank): which source each slot takes, and the how-manieth of it this is."""
    total = sum(target)
    n = int(-(-total // block))
    cum = list(np.cumsum(target) / total) if total else [1.0]
    d = spark.range(n).mapInArrow(_slots(cum), C.struct(_SLOT))
    return C.running_total(d, ["src"], F.floor(F.col("slot") / (1 << 16)), ["slot"], F.lit(1), "rank")


class Mix:
    """docs: uid, doc_id, source, size, src, key columns; sources: list of dicts; pieces: what each slot takes."""

    def __init__(self, docs, sources, pieces, block):
        self.docs, self.sources, self.pieces, self.block = docs, sources, pieces, block


def mix(docs: DataFrame, weights: list[float] = (1, 2, 3), seed: int = 11, doc_id: str = "doc_id",
        text: str = "text", source: str = "source") -> Mix:
    """Mix all documents; weights repeat over the sources in code point order, null last.

    A null text has size 0 and is never taken. Rows with equal ids stay rows.
    Pieces: slot, uid, turn (the how-manieth repeat of the source), words
    taken. Empty tables give an empty schedule.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"),
                    words(F.col(text)).alias("size"),
                    F.xxhash64(F.col(doc_id).cast("long"), F.col(text), F.lit(seed)).alias("key"))
    d = C.stored(d.withColumn("uid", F.monotonically_increasing_id()))
    per = d.groupBy("source").agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    per.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    size = [int(r["s"]) for r in per]
    target = targets(size, [float(weights[i % len(weights)]) for i in range(len(per))])
    src = [{"src": i, "source": r["source"], "source_size": size[i], "target": target[i]} for i, r in enumerate(per)]
    rows = sum(int(r["n"]) for r in per)
    block = int(min(BLOCK, max(1, sum(size) // (SLOTS * max(1, len(per))))))
    slots = schedule(spark, target, block)
    s_df = spark.createDataFrame([(x["src"], x["source"], x["source_size"], x["target"]) for x in src],
                                 "src int, source string, source_size long, target double")
    d = d.join(F.broadcast(s_df), d["source"].eqNullSafe(s_df["source"])).drop(s_df["source"])
    placed = C.running_total(d, ["src"], C.hash_buckets("key", rows), ["key", "doc_id", "size"], F.col("size"), "at")
    # the words of a source, repeated MOST times, end to end; a document meets the blocks that its words lie in
    turns = (placed.filter("size > 0")
             .withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
             .withColumn("lo", F.col("at") + F.col("turn") * F.col("source_size"))
             .withColumn("hi", F.col("lo") + F.col("size"))
             # a slot more than the share is the most that the schedule can go beyond a target
             .filter(F.col("lo") < F.col("target") + F.lit(8 * block))
             .withColumn("rank", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block)))))
    pieces = (turns.join(slots, ["src", "rank"])
              .select("slot", "uid", "turn", "src",
                      (F.least("hi", (F.col("rank") + 1) * block) - F.greatest("lo", F.col("rank") * block)).alias("words")))
    return Mix(d, src, pieces, block)


def taken(m: Mix) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken."""
    t = m.pieces.groupBy("uid").agg(F.sum("words").alias("taken"))
    return (m.docs.join(t, "uid", "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, weights: list[float] = (1, 2, 3), seed: int = 11) -> DataFrame:
    """The documents of the mix, whole: one row for each repeat of which the schedule takes half or more.

    A repeat that the end of a source's share cuts is in if half its words are.
    """
    cols = docs.columns
    d = C.stored(docs.withColumn("_row", F.monotonically_increasing_id()))
    m = mix(d.select(F.col("_row").alias("doc_id"), "text", "source"), weights, seed)
    part = m.pieces.groupBy("uid", "turn").agg(F.sum("words").alias("w"))
    times = (part.join(m.docs.select("uid", F.col("doc_id").alias("_row"), "size"), "uid")
             .filter("2 * w >= size").select("_row", "turn"))
    return d.join(times, "_row").select(*cols)


def op2_golden_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(mix(C.table(spark, sf_dir, "documents")))
