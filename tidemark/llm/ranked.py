"""Ranked lexical search over a length-stratified index.

A document with n terms has the normaliser m = 75 + (25 * n * N) div L, so a
score depends on a document only through m and its term counts. The index
groups documents by equal m (a stratum) and, inside a stratum, the postings of
a term by its count tf: one row holds all documents of a block with that
(m, term, tf), and the impact (1e9 * tf) div (1000 * tf + 12 * m) is computed
once for the row. A large stratum is cut into blocks of at most DOCS
documents, TOKENS terms or BYTES bytes of text (one document at least), dealt
by row, so neither a frequent length nor a frequent text makes a large group.

A search reads the rows of the query terms once. The largest tf of a term in a
stratum bounds its impact there, and the sum over an item's terms bounds every
score of the stratum. The strata of an item are visited by falling bound until
they surely hold k matching documents; the k-th score found is a threshold,
and of the other strata those are visited whose bound reaches it (equal
scores go by the smaller id, so an equal bound counts). Blocks give their best
k, and the best k of all are ranked.

Nulls and edge cases: a null or term-less text is no document of the index and
a null or term-less item has no results. Repeated rows count as documents of
their own, as do repeated items, each ranked by itself. A null doc_id comes
after all others of the same score. Empty tables give no rows. Other columns
of the inputs are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import common as C

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS, TOKENS, BYTES = 8192, 1 << 21, 1 << 25
ITEMS = 4096             # items that one block is searched for at a time

# byte -> byte of a term (A-Z lowered), 0 where no term goes on
_FOLD = np.zeros(256, np.uint8)
for _c in (*range(48, 58), *range(97, 123), *range(128, 256)):
    _FOLD[_c] = _c
_FOLD[65:91] = np.arange(97, 123)


def _terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of texts laid end to end: folded bytes, start and end of each, and its text."""
    low = _FOLD[data]
    inside = np.zeros(len(low) + 2, bool)
    inside[1:-1] = low > 0
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    at = off[:-1][off[:-1] < off[1:]]             # no term crosses from one text into the next
    first[at] = inside[1:-1][at]
    last[off[1:][off[:-1] < off[1:]] - 1] = inside[1:-1][off[1:][off[:-1] < off[1:]] - 1]
    start = np.flatnonzero(first)
    return low, start, np.flatnonzero(last) + 1, np.searchsorted(off, start, "right") - 1


_COUNTED = "doc_id long, text string, n long, size long"


def _count(batches):
    schema = C.arrow(_COUNTED)
    for batch in batches:
        for at, to, data, off in C.blocks(batch, "text"):
            doc = _terms(data, off)[3]
            part = batch.slice(at, to - at)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("doc_id")), part.column(part.schema.get_field_index("text")),
                 pa.array(np.bincount(doc, minlength=to - at)), pa.array(np.diff(off))], schema=schema)


_INDEX = T.StructType([T.StructField("key", T.LongType()), T.StructField("m", T.LongType()),
                       T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType()),
                       T.StructField("docs", T.ArrayType(T.IntegerType())),
                       T.StructField("ids", T.ArrayType(T.LongType()))])


def _index_schema() -> pa.Schema:
    return pa.schema([("key", pa.int64()), ("m", pa.int64()), ("term", pa.string()), ("tf", pa.int32()),
                      ("docs", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64()))])


def _postings(terms: pa.Array, doc: np.ndarray, docs: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(term, tf, where its documents begin, documents) of a block, terms by dictionary code."""
    coded = terms.dictionary_encode()
    pair, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * docs + doc, return_counts=True)
    code, doc = pair // docs, pair % docs
    order = np.lexsort((doc, tf, code))
    code, tf, doc = code[order], tf[order], doc[order]
    cut = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])))
    return coded.dictionary.take(pa.array(code[cut])), tf[cut], np.append(cut, len(doc)), doc


def _build(batches):
    """Index rows of each block: first one with its document ids, then one for each (term, tf)."""
    schema = _index_schema()
    for block in C.sorted_groups(batches, "key"):
        batch = block.to_batches()[0]
        key, m, docs = block.column("key")[0].as_py(), block.column("m")[0].as_py(), block.num_rows
        spelled, of = [], []
        for at, _, data, off in C.blocks(batch, "text"):
            low, start, end, doc = _terms(data, off)
            ends = np.append(0, np.cumsum(end - start))
            spelled.append(pa.Array.from_buffers(
                pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[low > 0])]))
            of.append(doc + at)
        term, tf, cut, doc = _postings(pa.concat_arrays(spelled), np.concatenate(of), docs)
        n = len(term)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key]), pa.array([m]), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()),
             pa.nulls(1, pa.list_(pa.int32())),
             pa.ListArray.from_arrays(pa.array([0, docs], pa.int32()), block.column("doc_id").combine_chunks())],
            schema=schema)
        for lo in range(0, n, 1 << 16):
            hi = min(n, lo + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(hi - lo, key)), pa.array(np.full(hi - lo, m)),
                 term[lo:hi].cast(pa.binary()).cast(pa.string()), pa.array(tf[lo:hi].astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array((cut[lo:hi + 1] - cut[lo]).astype(np.int32)),
                                          pa.array(doc[cut[lo]:cut[hi]].astype(np.int32))),
                 pa.nulls(hi - lo, pa.list_(pa.int64()))], schema=schema)


@dataclass
class Index:
    """postings: key (block), m, term, tf, docs (places in the block); a row without a term lists the block's ids."""

    postings: DataFrame
    documents: int
    terms: int


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """The index of all documents that hold a term. Whole texts; every term is indexed."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = d.mapInArrow(_count, C.struct(_COUNTED)).filter("n > 0")
    # one row a length: at most as many as the longest text has terms
    lengths = C.stored(counted.groupBy("n").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("size")))
    r = lengths.agg(F.sum("docs"), F.sum(F.col("n") * F.col("docs"))).first()
    if r[0] is None:
        return Index(docs.sparkSession.createDataFrame([], _INDEX), 0, 0)
    m = F.expr(f"75 + (25 * n * {r[0]}L) div {r[1]}L").alias("m")
    strata = (lengths.select("*", m).groupBy("m")
              .agg(F.ceil(F.greatest(F.sum("docs") / DOCS, F.sum(F.col("n") * F.col("docs")) / TOKENS,
                                     F.sum("size") / BYTES)).alias("blocks")))
    row = F.xxhash64(F.monotonically_increasing_id())
    dealt = (counted.select("*", m, row.alias("_row")).join(F.broadcast(strata), "m")
             .select("doc_id", "text", "m", F.expr("shiftleft(m, 24) + pmod(_row, blocks)").alias("key")))
    index = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(_build, _INDEX)
    return Index(C.stored(index), r[0], r[1])


# -------------------------------------------------------------- search

def _impact(tf: str = "tf", m: str = "m"):
    return F.expr(f"(1000000000L * {tf}) div (1000L * {tf} + 12L * {m})")


_FOUND = "row long, doc_id long, score long"


def _best(score: np.ndarray, ids: np.ndarray, none: np.ndarray, least: int, k: int) -> np.ndarray:
    """Places of the k best scores of at least ``least``; equal scores by id, null ids last."""
    at = np.flatnonzero(score >= least)
    if len(at) > k:
        at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]     # with all ties of the last
    return at[np.lexsort((ids[at], none[at], -score[at]))][:k]


def _scorer(k: int):
    schema = C.arrow(_FOUND)

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        """The best k documents of a block for each item that visits it."""
        if not block.num_rows or not asked.num_rows:
            return schema.empty_table()
        term = block.column("term").to_pylist()
        docs = block.column("docs").combine_chunks()
        off, flat = docs.offsets.to_numpy(), docs.values.to_numpy()
        impact = block.column("impact").to_numpy()
        lists: dict[str, list] = {}
        ids = none = None
        for i, t in enumerate(term):
            if t is None:
                got = block.column("ids")[i].values
                none = got.is_null().to_numpy(zero_copy_only=False)
                ids = got.fill_null(0).to_numpy(zero_copy_only=False)
            else:
                lists.setdefault(t, []).append(i)
        joined = {t: (np.concatenate([flat[off[i]: off[i + 1]] for i in rows]),
                      np.repeat(impact[rows], [off[i + 1] - off[i] for i in rows])) for t, rows in lists.items()}
        out_row, out_id, out_score = [], [], []
        for row, least, terms, weights in zip(*(asked.column(c).to_pylist() for c in ("row", "least", "terms", "weights"))):
            score = np.zeros(len(ids), np.int64)
            for t, w in zip(terms, weights):
                if t in joined:
                    at, gain = joined[t]
                    score[at] += w * gain
            best = _best(score, ids, none, max(1, least), k)
            out_row += [row] * len(best)
            out_id.append(pa.array(ids[best], pa.int64(), mask=none[best]))
            out_score.append(score[best])
        return pa.Table.from_arrays([pa.array(out_row, pa.int64()), pa.chunked_array(out_id, pa.int64()),
                                     pa.array(np.concatenate(out_score))], schema=schema)
    return run


def _visit(hits: DataFrame, blocks: DataFrame, visits: DataFrame, asked: DataFrame, chunks: int, k: int) -> DataFrame:
    """Scores of the blocks of the visited strata: visits (row, m, least), asked (row, terms, weights)."""
    right = (visits.join(blocks, "m").join(asked, "row")
             .select("key", F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk"), "row", "least", "terms", "weights"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))
    left = (hits.join(F.broadcast(visits.select("m").distinct()), "m", "left_semi")     # of the strata, see build
            .select(F.col("key").alias("block"), every.alias("part"), "term",
                    F.coalesce(_impact(), F.lit(0)).alias("impact"), "docs", "ids"))
    return (left.groupBy("block", "part").cogroup(right.groupBy("key", "chunk"))
            .applyInArrow(_scorer(k), C.struct(_FOUND)))


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = 20, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank, doc_id, score (above 0)."""
    spark = items.sparkSession
    # each row of the table is an item of its own; stored, so that its number stays
    q = C.stored(items.select(F.monotonically_increasing_id().alias("row"), F.col(item_id).alias("item_id"),
                              F.col(text).cast("string").alias("text")))
    asked_terms = (q.select("row", F.explode(F.regexp_extract_all(C.lower_az(F.col("text")), F.lit(TERM), F.lit(0)))
                            .alias("term")).groupBy("row", "term").agg(F.count(F.lit(1)).alias("times")))
    asked_terms = C.stored(asked_terms)
    wanted = asked_terms.select("term").distinct()
    post = index.postings
    hits = C.stored(post.join(wanted, "term", "left_semi").select(*post.columns)
                    .unionByName(post.filter("term is null")))
    per_stratum = (hits.filter("term is not null").groupBy("m", "term")
                   .agg(F.max("tf").alias("top_tf"), F.sum(F.size("docs").cast("long")).alias("holds")))
    per_stratum = C.stored(per_stratum)
    n = index.documents
    df = per_stratum.groupBy("term").agg(F.sum("holds").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = asked_terms.join(df.select("term", weight.alias("w")), "term").withColumn("w", F.col("w") * F.col("times"))
    weighed = C.stored(weighed)
    asked = weighed.groupBy("row").agg(F.collect_list(F.struct("term", "w")).alias("t")).select(
        "row", F.col("t.term").alias("terms"), F.col("t.w").alias("weights"))
    chunks = max(1, -(-weighed.select("row").distinct().count() // ITEMS))

    bounds = (weighed.join(per_stratum, "term")
              .groupBy("row", "m").agg(F.sum(F.col("w") * _impact("top_tf")).alias("bound"),
                                       F.max("holds").alias("holds")))
    by_bound = Window.partitionBy("row").orderBy(F.col("bound").desc(), "m").rowsBetween(Window.unboundedPreceding, -1)
    order = C.stored(bounds.withColumn("before", F.coalesce(F.sum("holds").over(by_bound), F.lit(0))))
    blocks = hits.filter("term is null").select("m", "key")

    first = order.filter(F.col("before") < k).select("row", "m", F.lit(1).cast("long").alias("least"))
    seen = C.stored(_top(_visit(hits, blocks, first, asked, chunks, k), k))
    threshold = seen.filter(F.col("rank") == k).select("row", F.col("score").alias("least"))
    rest = (order.filter(F.col("before") >= k).join(threshold, "row", "left")
            .withColumn("least", F.coalesce("least", F.lit(1).cast("long"))).filter("bound >= least")
            .select("row", "m", "least"))
    found = _top(seen.drop("rank").unionByName(_visit(hits, blocks, rest, asked, chunks, k)), k)
    return (found.join(q.select("row", "item_id"), "row")
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def op11_length_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item among all documents."""
    return search(build(C.table(spark, sf_dir, "documents")), C.table(spark, sf_dir, "benchmark"))
