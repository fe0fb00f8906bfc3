"""Helpers shared by the training-data operators.

Every operator first selects the columns it needs, so extra columns of the
input (whatever their names) never meet an operator's own columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(c: Column) -> Column:
    """Lower-case A-Z only, as the word contracts define it."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage: what is built on the result survives lost executors
    without running the steps above again, and sees the same rows each time.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tidemark-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def blocks(batch: pa.RecordBatch, column: str, limit: int = 4 << 20
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts of an Arrow batch in runs of about ``limit`` bytes: (from, to, bytes, offsets).

    Bytes are UTF-8, offsets count from 0 within the run; null is empty. A
    longer text makes a run of its own: no text is cut.
    """
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = pc.fill_null(col, "")
    col = col.cast(pa.large_binary())
    n = len(col)
    if not n:
        return
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset: col.offset + n + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield at, to, data[off[at]: off[to]], off[at: to + 1] - off[at]
        at = to


def out_batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The groups of batches that are sorted by ``key``, one at a time; only one group is held."""
    tail: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy()
        cut = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for lo, hi in zip(cut, cut[1:]):
            if lo == 0 and tail and tail[-1].column(tail[-1].schema.get_field_index(key))[-1].as_py() == k[0]:
                tail.append(batch.slice(lo, hi - lo))
                continue
            if tail:
                yield pa.Table.from_batches(tail).combine_chunks()
            tail = [batch.slice(lo, hi - lo)]
    if tail:
        yield pa.Table.from_batches(tail).combine_chunks()


def mix64(z: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (splitmix64 constants)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def running_total(df: DataFrame, group: list[str], bucket: Column, order: list[str], value: Column, out: str) -> DataFrame:
    """Exclusive running total of ``value`` within ``group``, in the order of ``bucket`` and then ``order``.

    No window spans a whole group: bucket sums (a small table) are summed up
    over the buckets of a group, and rows are summed up within their bucket.
    A group that holds a third of all rows is spread over all its buckets,
    which callers choose by hash or by place. Group columns must not be null.
    """
    d = df.withColumn("_b", bucket).withColumn("_v", value.cast("long"))
    whole = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    base = (d.groupBy(*group, "_b").agg(F.sum("_v").alias("_s"))
            .select(*group, "_b", F.coalesce(F.sum("_s").over(whole), F.lit(0)).alias("_base")))
    return (d.join(base, [*group, "_b"])
            .withColumn(out, F.col("_base") + F.coalesce(F.sum("_v").over(inner), F.lit(0)))
            .drop("_b", "_v", "_base"))


PER_BUCKET = 8192


def hash_buckets(key: str, rows: int) -> Column:
    """Bucket of a hash column such that ``rows`` rows make buckets of about PER_BUCKET."""
    return F.pmod(F.col(key), F.lit(max(1, -(-rows // PER_BUCKET))))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component), component the smallest id reached.

    Alternating star contraction: each round points every vertex's larger
    neighbours, then its smaller ones, at the smallest vertex seen, until
    nothing changes. Only two numbers a round come to the driver. A vertex
    with very many neighbours costs aggregations with map-side combine and a
    join that adaptive execution may split; its neighbours are never collected.
    """
    def both(d: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
        return d.select(F.inline(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs])))

    def star(e: DataFrame, large: bool) -> DataFrame:       # edges run small a -> large b
        if large:   # every neighbour v > u of u gets the smallest of u and its neighbours
            low = both(e, ("a", "b"), ("b", "a")).groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
            return e.join(low, "a").filter("b != m").select(F.col("m").alias("a"), "b").distinct()
        low = e.groupBy("b").agg(F.min("a").alias("m"))
        return both(e.join(low, "b"), ("m", "b"), ("m", "a")).filter("a != b").distinct()

    e = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
               .filter("a != b").distinct())
    sign = None
    for _ in range(max_rounds):
        # one star a plan: the second reads its input twice, and large plans fill the driver
        e = stored(star(stored(star(e, True)), False))
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (r[0], r[1]) == sign:
            break
        sign = (r[0], r[1])
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("b").alias("id"), F.col("a").alias("component")).union(
        e.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct())


_SPARK = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
          "string": T.StringType(), "binary": T.BinaryType(), "longs": T.ArrayType(T.LongType())}
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
          "string": pa.string(), "binary": pa.binary(), "longs": pa.list_(pa.int64())}


def struct(columns: str) -> T.StructType:
    """Spark schema of "name type, ..."."""
    return T.StructType([T.StructField(n, _SPARK[t]) for n, t in (c.split() for c in columns.split(","))])


def arrow(columns: str) -> pa.Schema:
    """The same columns for Arrow batches; needs no session, so tasks can call it."""
    return pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in columns.split(","))])
