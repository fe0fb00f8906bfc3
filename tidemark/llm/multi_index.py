"""Embedding near-duplicates by an inverted multi-index.

Two codebooks, one for each half of the vectors, are learned on a bounded
sample; a vector's cell is the pair of its nearest codewords. A query visits
cells in the order of the summed half distances (the multi-sequence order)
and compares itself exactly, in double precision, with all vectors listed
there. A link found from one side counts for both. How many cells are visited
is measured: blocks of sampled queries are compared with all rows until
``LINKS`` links (none of a vector with itself) are seen, and the number that
finds ``RECALL`` of them from either side is used. Where all sampled queries
have fewer links and are not all rows, the number must also find ``RECALL`` of
made-up partners at a cosine of just ``COSINE``, the farthest a link can be.

The grid grows with the table: there is about one cell for ``PER_CELL``
different vectors, so a visited cell holds as many at every size. Neighbouring
cells of one grid row that hold few vectors make a group, and a vector is sent
once to each group that it visits, whatever the number of cells visited there;
cells, visits and groups are settled on ids before any vector moves.

Equal vectors are one class with a count, so copies are compared once. Groups
with many classes (one cell can hold them all), or many visitors, are dealt into
blocks; what leaves a block is a number a query and a spanning star, never all
pairs.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import common as C

COSINE = 0.9
WORDS = 32             # codewords a half, at least: 1,024 cells
PER_CELL = 64          # different vectors a cell, about, in tables that need more cells
SAMPLE = 20_000        # vectors that the codebooks are fitted on, at most; 8 a codeword where that is more
QUERIES = 256          # first block of sampled queries that the number of visited cells is measured with; each next one is larger
LINKS = 1000           # links that the measure rests on, unless all sampled queries have fewer
RECALL = 0.999
LEAST, MOST = 8, 256   # visited cells: at least, and at most unless recall asks for more
BLOCK = 2048


def rows_of(col: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision, scaled to length 1; None for those that link with nothing."""
    out = []
    for v in col:
        if not v.is_valid:
            out.append(None)
            continue
        a = v.values
        x = a.to_numpy(zero_copy_only=False).astype(float) if a is not None and a.null_count == 0 else None
        n = np.linalg.norm(x) if x is not None and len(x) and np.isfinite(x).all() else 0.0
        if n > 0 and not np.isfinite(n):
            x = x / np.abs(x).max()
            n = np.linalg.norm(x)
        out.append(x / n if n > 0 else None)
    return out


_VECS = "uid long, vec_id long, dim int, class binary, vec binary"


def _normal(batches):
    schema = C.arrow(_VECS)
    for b in batches:
        v = rows_of(b.column(2))
        raw = [None if x is None else x.tobytes() for x in v]
        yield C.out_batch(schema, uid=b.column(0), vec_id=b.column(1), dim=[None if x is None else len(x) for x in v],
                          **{"class": [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw]}, vec=raw)


def kmeans(x: np.ndarray, k: int, seed: int = 3, steps: int = 12) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        near = np.argmin(((c ** 2).sum(1) - 2 * x @ c.T), 1)
        n = np.bincount(near, minlength=len(c))
        s = np.zeros_like(c)
        np.add.at(s, near, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


class Codebooks:
    """Codewords of both halves for vectors of one length; other lengths share one list a length."""

    def __init__(self, sample: np.ndarray, words: int = WORDS):
        self.dim = sample.shape[1]
        self.h = self.dim // 2
        self.a, self.b = kmeans(sample[:, : self.h], words), kmeans(sample[:, self.h:], words)

    def dist(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = []
        for c, y in ((self.a, x[:, : self.h]), (self.b, x[:, self.h:])):
            d.append((c ** 2).sum(1)[None] - 2 * y @ c.T + (y ** 2).sum(1)[:, None])
        return d[0], d[1]

    def cell(self, x: np.ndarray) -> np.ndarray:
        p, q = self.dist(x)
        return p.argmin(1) * len(self.b) + q.argmin(1)

    def rank(self, x: np.ndarray, row: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How many cells come before each cell[k] in the order of x[row[k]]: counted, the order isn't laid out; ties count."""
        p, q = self.dist(x)
        s = p[row, cell // q.shape[1]] + q[row, cell % q.shape[1]] + 1e-9
        q.sort(1)
        out = np.empty(len(row), np.int64)
        for r in np.unique(row):
            for mine in np.array_split(at := np.flatnonzero(row == r), len(at) // 1024 + 1):
                out[mine] = np.searchsorted(q[r], s[mine, None] - p[r][None], "right").sum(1) - 1
        return out

    def order(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n nearest cells of each row, nearest first: sums of sorted half distances.

        Of cell (i-th, j-th nearest half) there are (i+1)(j+1)-1 nearer or as near
        ones, so only pairs with (i+1)(j+1) <= n can be among the first n.
        """
        p, q = self.dist(x)
        sp, sq = np.argsort(p, 1, kind="stable"), np.argsort(q, 1, kind="stable")
        reach = np.minimum(n // np.arange(1, min(n, p.shape[1]) + 1), q.shape[1])
        i = np.repeat(np.arange(len(reach)), reach)
        j = np.arange(len(i)) - np.repeat(np.cumsum(reach) - reach, reach)
        s = np.take_along_axis(p, sp, 1)[:, i] + np.take_along_axis(q, sq, 1)[:, j]
        o = np.argsort(s, 1, kind="stable")[:, :n]
        return sp[np.arange(len(x))[:, None], i[o]] * q.shape[1] + sq[np.arange(len(x))[:, None], j[o]]


_RANKS = "rank long, n long"


def _count(n: Counter, ranks: np.ndarray) -> None:
    for r, k in zip(*np.unique(ranks, return_counts=True)):
        n[int(r)] += int(k)


def _either(books: Codebooks, x: np.ndarray, y: np.ndarray, i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Rank of the pairs (x[i], y[k]): how late the cell of one comes in the order of the other, from the better side."""
    rank = None
    for one, at, other, of in ((x, i, y, k), (y, k, x, i)):
        rows, row = np.unique(at, return_inverse=True)
        r = books.rank(one[rows], row, books.cell(other)[of])
        rank = r if rank is None else np.minimum(rank, r)
    return rank


def _ranks(books_b, queries_b):
    """The ranks of the links that sampled queries have with other classes."""
    schema = C.arrow(_RANKS)

    def run(batches):
        books, (ids, q) = books_b.value, queries_b.value
        n = Counter()
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                rep, vec, dim = (c.to_pylist() for c in b.slice(at, 2048).columns)
                own = [j for j in range(len(rep)) if dim[j] == books.dim]
                if not own:
                    continue
                x, mine = np.frombuffer(b"".join(vec[j] for j in own)).reshape(-1, books.dim), np.array(rep)[own]
                for lo in range(0, len(q), 512):
                    p = q[lo: lo + 512]
                    i, k = np.nonzero((p @ x.T >= COSINE) & (ids[lo: lo + 512, None] != mine[None]))
                    if len(i):
                        _count(n, _either(books, p, x, i, k))
        yield C.out_batch(schema, rank=list(n), n=list(n.values()))
    return run


def _enough(ranks: Counter) -> int:
    """The least number of visited cells that finds RECALL of the links whose ranks are counted."""
    if not ranks:
        return 0
    r = np.array(sorted(ranks))
    have = np.cumsum([ranks[k] for k in r.tolist()])
    return int(r[np.searchsorted(have, RECALL * have[-1])]) + 1


def _made_up(books: Codebooks, x: np.ndarray, seed: int = 7) -> Counter:
    """Counted ranks of partners at COSINE of sampled vectors, each away from it in the direction of another."""
    rng = np.random.default_rng(seed)
    n = Counter()
    for lo in range(0, min(len(x), 4096), 512):
        q = x[lo: lo + 512]
        u = x[rng.integers(0, len(x), len(q))] + 1e-3 * rng.normal(size=q.shape)
        u -= (u * q).sum(1)[:, None] * q
        u /= np.maximum(np.linalg.norm(u, axis=1), 1e-12)[:, None]
        at = np.arange(len(q))
        _count(n, _either(books, q, COSINE * q + (1 - COSINE ** 2) ** .5 * u, at, at))
    return n


_VISITS = "rep long, home long, seen longs"


def _visits(books_b, n: int):
    """Each class with its own cell and the cells that it visits; vectors of another length share one cell a length."""
    schema = C.arrow(_VISITS)
    step = max(8, min(500, (1 << 21) // (n * max(1, n.bit_length()))))      # rows whose candidate cells are held at once

    def run(batches):
        books = books_b.value
        for b in batches:
            for lo in range(0, b.num_rows, step):
                rep, dim, vec = (c.to_pylist() for c in b.slice(lo, step).columns)
                own = [k for k in range(len(rep)) if dim[k] == books.dim]
                home, seen = [-d for d in dim], [[-d] for d in dim]
                if own:
                    x = np.frombuffer(b"".join(vec[k] for k in own)).reshape(-1, books.dim)
                    for k, c, cells in zip(own, books.cell(x).tolist(), books.order(x, n).tolist()):
                        home[k], seen[k] = c, cells
                yield C.out_batch(schema, rep=rep, home=home, seen=seen)
    return run


def _grouped(visits: DataFrame, row: int) -> DataFrame:
    """Each class with the group of its cell and the groups that it visits: rep, home, seen.

    Cells of one grid row (``row`` cells long), in order, fill groups of about ``BLOCK`` classes; a
    larger cell is a group of its own, and so is the list of each other vector length. The running sum goes over cells, not rows.
    """
    cells = visits.groupBy(F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("nv"))
    line = F.floor(F.col("cell") / F.lit(row))
    before = F.sum(F.when(F.col("nv") > BLOCK, 0).otherwise(F.col("nv"))).over(
        Window.partitionBy("_line").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    alone = (F.col("nv") > BLOCK) | (F.col("cell") < 0)
    part = F.floor(F.coalesce(before, F.lit(0)) / F.lit(BLOCK))
    groups = cells.withColumn("_line", line).select(
        "cell", F.when(alone, F.struct(F.lit(True).alias("alone"), F.col("cell").alias("at"), F.lit(0).cast("long").alias("part")))
        .otherwise(F.struct(F.lit(False).alias("alone"), F.col("_line").cast("long").alias("at"), part.cast("long").alias("part"))).alias("_g"))
    groups = groups.select("cell", F.xxhash64("_g.alone", "_g.at", "_g.part").alias("grp"))
    return (visits.select("rep", "home", F.explode("seen").alias("cell")).join(groups, "cell")     # empty cells go here
            .groupBy("rep").agg(F.max(F.when(F.col("cell") == F.col("home"), F.col("grp"))).alias("home"),
                                F.collect_set("grp").alias("seen")))


_LINKS = "rep long, n long, other long"


def _compare(batches):
    """Queries against the list of a tile: counted links (n), and stars (rep, other) that span them.

    A link counts for the query, and for the listed vector too where that one
    doesn't visit the query's group: there it will not find the link itself.
    """
    schema = C.arrow(_LINKS)
    for t in C.sorted_groups(batches, "tile"):
        is_q = t.column("query").to_numpy(zero_copy_only=False)
        if is_q.all() or not is_q.any():
            continue
        rep, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
        x = np.frombuffer(b"".join(t.column("vec").to_pylist())).reshape(len(rep), -1)
        q, v = np.flatnonzero(is_q), np.flatnonzero(~is_q)
        ids, label = np.unique(rep, return_inverse=True)
        group = np.arange(len(ids))
        n, back = np.zeros(len(q), np.int64), np.zeros(len(v), np.int64)
        homes, home = np.unique(t.column("home").to_numpy()[q], return_inverse=True)
        seen = t.column("seen").filter(pa.array(~is_q)).combine_chunks()
        n_seen, groups = np.diff(seen.offsets.to_numpy()), seen.flatten().to_numpy()
        at = np.minimum(np.searchsorted(homes, groups), len(homes) - 1)
        met = homes[at] == groups
        returns = np.zeros((len(v), len(homes)), bool)      # whether a listed vector visits the group of a query
        returns[np.repeat(np.arange(len(v)), n_seen)[met], at[met]] = True
        for lo in range(0, len(q), 512):
            part = q[lo: lo + 512]
            near = x[part] @ x[v].T >= COSINE
            near &= rep[part][:, None] != rep[v][None]
            n[lo: lo + 512] = near @ copies[v]
            back += copies[part] @ (near & ~returns[:, home[lo: lo + 512]].T)
            for r in np.flatnonzero(near.any(1)):
                both = np.unique(group[np.append(label[v[near[r]]], label[part[r]])])
                if len(both) > 1:
                    group[np.isin(group, both)] = both[0]
        hit = np.flatnonzero(n)
        away = np.flatnonzero(group != np.arange(len(ids)))
        if len(hit):
            yield C.out_batch(schema, rep=rep[q[hit]], n=n[hit], other=pa.nulls(len(hit), pa.int64()))
        hit = np.flatnonzero(back)
        if len(hit):
            yield C.out_batch(schema, rep=rep[v[hit]], n=back[hit], other=pa.nulls(len(hit), pa.int64()))
        if len(away):
            yield C.out_batch(schema, rep=ids[away], n=pa.nulls(len(away), pa.int64()), other=ids[group[away]])


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept.

    Null vectors, zero vectors and those with null or non-finite components
    link with nothing; vectors of different lengths do not link. Repeated
    rows are links of each other. Empty tables give no rows.
    """
    spark = vectors.sparkSession
    sc = spark.sparkContext
    d = vectors.select(F.monotonically_increasing_id().alias("uid"), F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding))
    vecs = C.stored(d.mapInArrow(_normal, C.struct(_VECS)))
    named = vecs.filter("class is not null")
    classes = C.stored(named.groupBy("class").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                  F.first("dim").alias("dim"), F.first("vec").alias("vec")))
    dims = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        links = spark.createDataFrame([], C.struct(_LINKS))
    else:
        dim, total = dims
        words = max(WORDS, int(np.ceil((total / PER_CELL) ** .5)))
        most = max(SAMPLE, 8 * words)
        some = (classes.filter(F.col("dim") == dim).filter(F.pmod(F.xxhash64("class"), F.lit(max(1, total // most))) == 0)
                .orderBy(F.xxhash64("class", F.lit(1))).limit(most).select("vec", "rep").collect())
        sample = np.frombuffer(b"".join(bytes(r[0]) for r in some)).reshape(-1, dim)
        reps = np.array([r[1] for r in some])
        model = Codebooks(sample, words)
        books = sc.broadcast(model)
        ranks = Counter()
        at, block = 0, QUERIES
        while at < len(sample) and ranks.total() < LINKS:
            asked = sc.broadcast((reps[at: at + block], sample[at: at + block]))
            found = classes.select("rep", "vec", "dim").mapInArrow(_ranks(books, asked), C.struct(_RANKS))
            for r in found.groupBy("rank").agg(F.sum("n").alias("n")).collect():   # one row a different rank
                ranks[r["rank"]] += r["n"]
            at, block = at + block, 4 * block
        visit = max(LEAST, _enough(ranks))
        if ranks.total() < LINKS and len(sample) < total:
            visit = max(visit, _enough(_made_up(model, sample)))
        visits = C.stored(classes.select("rep", "dim", "vec").mapInArrow(_visits(books, visit), C.struct(_VISITS)))
        met = C.stored(_grouped(visits, len(model.b)))
        listed = met.select("rep", F.col("home").alias("grp"), F.lit(False).alias("query"), "home", "seen")
        asks = met.select("rep", F.explode("seen").alias("grp"), F.lit(True).alias("query"), "home", F.lit(None).cast("array<long>").alias("seen"))
        size = (listed.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("bv"))
                .join(asks.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / (4 * BLOCK)).cast("int").alias("bq")), "grp"))
        salt = F.xxhash64("rep", F.lit(5))
        # every block of queries meets every block of the list
        tiles = F.when(F.col("query"), F.transform(F.sequence(F.lit(0), F.col("bv") - 1),
                                                   lambda j: F.xxhash64("grp", F.pmod(salt, F.col("bq")), j.cast("long")))
                       ).otherwise(F.transform(F.sequence(F.lit(0), F.col("bq") - 1),
                                               lambda j: F.xxhash64("grp", j.cast("long"), F.pmod(salt, F.col("bv")))))
        placed = listed.unionByName(asks).join(size, "grp").select(F.explode(tiles).alias("tile"), "rep", "query", "home", "seen")
        links = C.stored(placed.join(classes.select("rep", "copies", "vec"), "rep")
                         .repartition("tile").sortWithinPartitions("tile")
                         .select("tile", "rep", "copies", "query", "vec", "home", "seen").mapInArrow(_compare, C.struct(_LINKS)))
    counts = links.filter("n is not null").groupBy("rep").agg(F.sum("n").alias("found"))
    comps = C.components(links.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    by_class = (classes.select("class", "rep", "copies").join(counts, "rep", "left")
                .join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
                .select("class", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                        F.coalesce("component", "rep").alias("k")))
    rows = vecs.select("vec_id", "class").join(by_class, "class", "left")
    first = rows.filter("k is not null").groupBy("k").agg(F.min("vec_id").alias("least"))
    return (rows.join(first, "k", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("least", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


def op9_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "embeddings"))
