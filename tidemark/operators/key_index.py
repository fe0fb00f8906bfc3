"""Stored-key index for insert-if-absent (S3, J1, T3): Bloom filters per ingest
day, written with the day, which spare the exact anti-join the days that hold
none of a batch's keys.

A day's filter is cut into blocks of 2^15 bits. A key's hash names its block
and its ``PROBES`` bits there, so a look-up joins the batch's keys with the index
on the block and tests the bits inside the join. The number of blocks is a
power of two set by the rows of the write, so that a key takes ``BITS_A_KEY``
bits at least: a key that isn't stored passes a filter with probability below
one in a million, and a batch of that size reads few days for nothing. The
index takes 4 to 8 bytes a key and holds one row a block. Its build sends each
key to its block's task once (bitmaps combined before the shuffle would be one
a block and task, which grows with the square of the keys); blocks are chosen
by a hash, so no key of the events can make it skewed.

Filters only say "maybe": what they let through is looked up exactly, in the
days they name and for the keys they name. They never miss a stored key. Days
of rows that were stored without a filter are always read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .joins import stored_matches

BLOCK_BITS = 1 << 15       # a row of the index: 4 KB
BITS_A_KEY, PROBES = 32, 12

DAY = "ingest_date"


def _block(key: str):
    return F.xxhash64(F.col(key))


def _places(key: str) -> list:
    """Bit positions of a key in its block: four of 15 bits from each of three more hashes."""
    hashes = [F.xxhash64(F.col(key), F.lit(j)) for j in range(1, PROBES // 4 + 1)]
    return [F.shiftright(h, 15 * q).bitwiseAND(F.lit(BLOCK_BITS - 1)) for h in hashes for q in range(4)]


def build(rows: DataFrame, key: str = "event_id", day: str = DAY, run: str = "pipeline_run_id") -> DataFrame:
    """Index rows of ``rows`` (the rows of one write): run, day, n_blocks, block, bits.

    Null keys aren't indexed: they match nothing in an anti-join either."""
    keys = rows.where(F.col(key).isNotNull()).select(F.col(run).alias("run_id"), F.col(day).alias(DAY), F.col(key).alias("_key"))
    need = F.ceil(F.count(F.lit(1)) * BITS_A_KEY / F.lit(float(BLOCK_BITS)))
    # one row a run and day of this write, so small enough to send to every task
    sizes = keys.groupBy("run_id", DAY).agg(
        F.pow(F.lit(2.0), F.ceil(F.log2(need))).cast("long").alias("n_blocks"))
    # one hash for the group, first: rows are dealt and sorted by it, also where run and day are constants
    group = ["_at", "block", "run_id", DAY, "n_blocks"]
    dealt = (keys.join(F.broadcast(sizes), ["run_id", DAY])
             .select(F.pmod(_block("_key"), "n_blocks").alias("block"), "run_id", DAY, "n_blocks", "_key")
             .withColumn("_at", F.xxhash64("block", "run_id", DAY)).repartition("_at"))
    # one bitmap a probe, then all of a block in one: twelve rows a block are sorted, not twelve a key
    maps = dealt.groupBy(*group).agg(F.array(*[F.bitmap_construct_agg(p) for p in _places("_key")]).alias("_maps"))
    return (maps.select(*group, F.explode("_maps").alias("_map"))
            .groupBy(*group).agg(F.bitmap_or_agg("_map").alias("bits"))
            .select("run_id", DAY, "n_blocks", "block", "bits"))


def write(rows: DataFrame, path: str, run_id: str, days: list) -> None:
    """Append the filters of a run's rows. Do this before the rows are stored: a run
    that dies in between leaves filters of nothing, which cost a look-up at most.
    A marker row a day (no bits) says that the run is indexed, also if it is empty."""
    marks = R.literal_table(rows.sparkSession, [(run_id, d, 0) for d in days], f"run_id string, {DAY} date, n_blocks bigint")
    build(rows).unionByName(marks, allowMissingColumns=True).write.mode("append").parquet(path)


def unindexed_days(index: DataFrame | None, runs: DataFrame) -> list | None:
    """Days of ``runs`` (run_id, ingest_date) without filters; None if such a run's day isn't known."""
    if index is not None:
        runs = runs.join(index.select("run_id").distinct(), "run_id", "left_anti")
    days = [r[0] for r in runs.select(DAY).distinct().collect()]
    return None if None in days else days


def _has(bits, place):
    """Whether a bit is set; only the byte that holds it is taken out."""
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte.cast("long"), place.bitwiseAND(F.lit(7)).cast("int")) == 1


def _maybe(index: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """(key, day) for every row of ``keys`` and every filter that holds all bits of its key."""
    index = index.where("n_blocks > 0")
    # powers of two in use: at most a few dozen numbers
    sizes = [r[0] for r in index.select("n_blocks").distinct().collect()]
    probes = (keys.select(key).where(F.col(key).isNotNull())
              .select(key, F.explode(F.array(*[F.lit(n).cast("long") for n in sizes]) if sizes else F.array().cast("array<bigint>"))
                      .alias("n_blocks"))
              .withColumn("block", F.pmod(_block(key), "n_blocks")))
    p, i = probes.alias("p"), index.alias("i")
    on = (F.col("p.block") == F.col("i.block")) & (F.col("p.n_blocks") == F.col("i.n_blocks"))
    for place in _places(f"p.{key}"):      # found again from the key, so only the key is sent
        on = on & _has(F.col("i.bits"), place)
    return p.join(i, on).select(F.col(f"p.{key}").alias(key), F.col(f"i.{DAY}").alias(DAY))


def candidates(index: DataFrame, batch: DataFrame, key: str = "event_id") -> DataFrame:
    """(key, day) pairs whose filters hold all bits of the key."""
    return _maybe(index, batch.select(key).distinct(), key).distinct()


def candidate_days(index: DataFrame, batch: DataFrame, key: str = "event_id") -> set:
    """The days of :func:`candidates`. Each task reduces its pairs to days, so no pair is sent."""
    return {r[0] for r in _maybe(index, batch, key).select(DAY).distinct().collect()}


def absent_by_index(batch: DataFrame, stored: DataFrame, index: DataFrame, unindexed: list | None = (),
                    key: str = "event_id", day: str = DAY) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``stored``: the anti-join of
    ``joins.absent_from``, reading only days that may hold a key.

    ``unindexed``: days that hold rows without a filter, read whatever the
    filters say; ``None`` if they aren't known: all days are read then. Days are
    literals, so others are pruned before they are read."""
    if unindexed is not None:
        days = candidate_days(index, batch, key) | set(unindexed)
        stored = stored.where(F.col(day).isin(sorted(days)) if days else F.lit(False))
    return batch.join(stored_matches(stored, batch, key), key, "left_anti")
