"""N-gram Jaccard join: documents whose sets of five-word shingles overlap by 75 % or more.

How the exact join stays small:

1. Texts with the same shingle set form one class (id: a 64-bit hash of the
   set); everything below works on classes.
2. *Heavy* shingles: a shingle in at least one ``HEAVY``-th of all documents
   is at that share in some task's documents, so each task reports only its
   own heavy ones; there are at most HEAVY * (mean set size) of them. They
   come last in the global order of shingles, all others first by hash.
3. Prefix: sets that overlap enough share one of the larger one's first
   n - ceil(0.75 n) + 1 shingles in that order, which is also among the
   smaller one's first n - ceil(6/7 n) + 1 (a partner is no smaller than it,
   so more of it must be shared). Classes are grouped by prefix shingle;
   groups with the same members are one tile.
4. Size-banded tiles: band b holds sizes in [2^b, 2^(b+1)), and its lower
   third also visits the band below, so each pair whose sizes can match meets
   in a tile. Each class brings a hashed bitmap; the bits one set has beyond
   the other bound the overlap from above, which leaves few pairs. A tile
   gives its bitmap clusters as stars, not as pairs.
5. Classes that such stars connect are verified exactly on sorted arrays of
   all their shingles, in tiles of at most ``BLOCK`` classes a side; arrays
   are made only for classes with a candidate. Pairs that are already
   connected are not compared again, so copies never turn into all pairs.
6. Connected components of the verified links.

Null and empty texts have no shingle and link with nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import common as C

WIDTH = 5
NUM, DEN = 75, 100       # intersection >= NUM/DEN of the union
HEAVY = 2048
BLOCK = 1024             # classes a side in an exact tile
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint64(0x5851F42D4C957F2D)
_MEET = np.uint64((1 << 48) - 1)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text (lower-cased A-Z, ASCII white space)."""
    n = len(off) - 1
    a = _LOWER[data]
    sp = _SPACE[a]
    word = ~sp
    edge = np.zeros(len(a), bool)
    if len(a):
        edge[off[:-1][off[:-1] < len(a)]] = True           # a text's first byte starts a word anew
        first = word & (edge | np.concatenate([[True], sp[:-1]]))
        start = np.flatnonzero(first)
        nxt = np.concatenate([sp[1:] | edge[1:], [True]])
        end = np.flatnonzero(word & nxt) + 1
    else:
        start = end = np.zeros(0, np.int64)
    # polynomial hash of each word: four bytes at a time would need padding; words are short, so by position
    h = (end - start).astype(np.uint64) * _K[0]
    longest = int((end - start).max()) if len(start) else 0
    alive = np.arange(len(start))
    at = 0
    while len(alive):
        h[alive] = (h[alive] ^ a[start[alive] + at]) * _P
        h[alive] ^= h[alive] >> np.uint64(29)
        at += 1
        alive = alive[(end - start)[alive] > at] if at < longest else alive[:0]
    h = C.mix64(h)
    cut = np.searchsorted(start, off)
    z = np.zeros(0, np.uint64)
    if len(h) >= WIDTH:
        z = sum(h[i: len(h) - WIDTH + 1 + i] * _K[i] for i in range(WIDTH))
        z = C.mix64(z)
    out = []
    for i in range(n):
        lo, hi = cut[i], cut[i + 1]
        if hi - lo >= WIDTH:
            out.append(np.unique(z[lo: hi - WIDTH + 1]))
        elif hi > lo:
            v = np.array([hi - lo], np.uint64)
            for x in h[lo:hi]:
                v = (v ^ x) * _K[1] + _K[2]
            out.append(C.mix64(v))
        else:
            out.append(z[:0])
    return out


def set_id(s: np.ndarray) -> int:
    """64-bit id of a set (int64); order-free sum of remixed members and the size."""
    v = C.mix64(C.mix64(s ^ _K[3]).sum(dtype=np.uint64)[None] + np.array([len(s)], np.uint64) * _K[4])
    return int(v.astype(np.int64)[0])


def _bits(n: int) -> int:
    """Bitmap length of a set's own band: one to two times its size."""
    return max(64, 1 << max(1, n).bit_length())


def bitmap(s: np.ndarray, bits: int) -> bytes:
    m = np.zeros(bits, bool)
    m[(s & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(m).tobytes()


def need(a, b):
    """Least intersection of sets of sizes a and b whose Jaccard similarity is enough."""
    return -(-NUM * (a + b) // (DEN + NUM))


_SETS = "doc_id long, n long, sid long, bitmap binary, heavy long, here long"


def _describe(batches):
    """A row a document, and rows for the task's heavy shingles (``heavy``, ``here`` documents)."""
    schema = C.arrow(_SETS)
    held, docs, size = [], 0, 0

    def heavies():
        u, c = np.unique(np.concatenate(held), return_counts=True)
        u, c = u[c * HEAVY >= docs], c[c * HEAVY >= docs]
        u, c = u[c >= 4], c[c >= 4]        # in a small chunk one document is no sign; see heavy()
        z = pa.nulls
        m = len(u)
        return C.out_batch(schema, doc_id=z(m, pa.int64()), n=z(m, pa.int64()), sid=z(m, pa.int64()),
                           bitmap=z(m, pa.binary()), heavy=u.astype(np.int64), here=c.astype(np.int64))

    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for at, to, data, off in C.blocks(batch, "text"):
            sets = shingle_sets(data, off)
            m = to - at
            sids = [set_id(s) if len(s) else None for s in sets]
            yield C.out_batch(schema, doc_id=ids.slice(at, m), n=[len(s) for s in sets], sid=sids,
                              bitmap=[bitmap(s, _bits(len(s))) if len(s) else None for s in sets],
                              heavy=pa.nulls(m, pa.int64()), here=pa.nulls(m, pa.int64()))
            held.extend(sets)
            docs += m
            size += sum(map(len, sets))
            if size > 8_000_000:
                yield heavies()
                held, docs, size = [], 0, 0
    if held:
        yield heavies()


_PREFIX = "h long, sid long, n long"      # n below 0: a place beyond the shorter prefix of the pair's smaller set


def prefix(s: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.75 n) + 1 members: light ones by hash, then heavy ones by hash."""
    p = len(s) - (-(-NUM * len(s) // DEN)) + 1
    if not len(heavy):
        return s[:p]
    late = heavy[np.minimum(np.searchsorted(heavy, s), len(heavy) - 1)] == s
    light = s[~late]
    return light[:p] if len(light) >= p else np.concatenate([light, s[late][: p - len(light)]])


def _prefixes(heavy_b):
    schema = C.arrow(_PREFIX)

    def run(batches):
        heavy, seen = heavy_b.value, set()
        for batch in batches:
            for _, _, data, off in C.blocks(batch, "text"):
                hs, ids, ns = [], [], []
                for s in shingle_sets(data, off):
                    sid = set_id(s) if len(s) else None
                    if sid is None or sid in seen:
                        continue
                    if len(seen) < 500_000:      # only spares repeats, which are merged by key later in any case
                        seen.add(sid)
                    hs.append(prefix(s, heavy))
                    ids.append(np.full(len(hs[-1]), sid, np.int64))
                    size = np.full(len(hs[-1]), len(s), np.int64)
                    size[len(s) - need(len(s), len(s)) + 1:] *= -1
                    ns.append(size)
                if hs:
                    # 48 bits decide who meets: a chance collision only adds a candidate
                    yield C.out_batch(schema, h=(np.concatenate(hs) & _MEET).astype(np.int64), sid=np.concatenate(ids),
                                      n=np.concatenate(ns))
    return run


# ---------------------------------------------------------------- tiles

def blocked(df: DataFrame, group: list[str], limit: int) -> DataFrame:
    """Adds ``tile``: groups of more than ``limit`` rows are dealt into blocks, and each pair of blocks is a tile.

    Any two rows of a group still meet in a tile, and no tile holds more
    than about twice ``limit`` rows.
    """
    m = F.count(F.lit(1)).over(Window.partitionBy(*group))
    nb = F.ceil(F.col("_m") / limit).cast("int")
    i = F.pmod(F.xxhash64("sid", F.lit(7)), F.col("_nb")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("_nb") - 1),
                        lambda j: F.xxhash64(*group, F.least(j, F.col("_i")), F.greatest(j, F.col("_i"))))
    return (df.withColumn("_m", m).filter("_m > 1").withColumn("_nb", nb).withColumn("_i", i)
            .withColumn("tile", F.explode(pairs)).drop("_m", "_nb", "_i"))


def _joined(labels: np.ndarray, adjacent: np.ndarray, row: int) -> None:
    """Merge the clusters of ``row`` and of the rows it is adjacent to (labels are least row numbers)."""
    near = np.unique(np.append(labels[adjacent], labels[row]))
    if len(near) > 1:
        labels[np.isin(labels, near)] = near[0]


def bitmap_clusters(n: np.ndarray, own: np.ndarray, maps: np.ndarray) -> np.ndarray:
    """Cluster labels of a tile's rows (sorted by size): rows whose overlap bound is enough are joined.

    ``maps``: rows of 64-bit words. Two visitors are left to their own band.
    """
    m = len(n)
    labels = np.arange(m)
    step = max(1, (1 << 21) // max(1, m * maps.shape[1]))
    for lo in range(0, m, step):
        rows = maps[lo: lo + step, None, :]
        extra = np.bitwise_count(rows & ~maps[None]).sum(2, dtype=np.int64)
        back = np.bitwise_count(~rows & maps[None]).sum(2, dtype=np.int64)
        a, b = n[lo: lo + step, None], n[None]
        bound = np.minimum(a - extra, b - back)
        ok = (bound >= need(a, b)) & (own[lo: lo + step, None] | own[None])
        ok &= np.arange(m)[None] < np.arange(lo, min(m, lo + step))[:, None]
        for r in np.flatnonzero(ok.any(1)):
            _joined(labels, np.flatnonzero(ok[r]), lo + r)
    return labels


_EDGES = "a long, b long"


def _stars(sid: np.ndarray, labels: np.ndarray):
    out = np.flatnonzero(labels != np.arange(len(labels)))
    return sid[labels[out]], sid[out]


def _filter_tiles(batches):
    """Rows (tile, band, n, sid, own, bitmap), sorted by tile and size: stars of the bitmap clusters."""
    schema = C.arrow(_EDGES)
    a, b, held = [], [], 0
    for t in C.sorted_groups(batches, "tile"):
        n, sid = t.column("n").to_numpy(), t.column("sid").to_numpy()
        if len(n) < 2:
            continue
        own = t.column("own").to_numpy(zero_copy_only=False)
        bits = 2 << int(t.column("band")[0].as_py())
        size = max(64, bits) // 8
        rows = []
        for x in t.column("bitmap").to_pylist():
            x = np.frombuffer(x, np.uint8)
            while len(x) > size:                      # a visitor's longer bitmap, folded
                x = x[: len(x) // 2] | x[len(x) // 2:]
            rows.append(x)
        labels = bitmap_clusters(n, own, np.stack(rows).view(np.uint64))
        x, y = _stars(sid, labels)
        if len(x):
            a.append(x)
            b.append(y)
            held += len(x)
        if held > 100_000:
            yield C.out_batch(schema, a=np.concatenate(a), b=np.concatenate(b))
            a, b, held = [], [], 0
    if held:
        yield C.out_batch(schema, a=np.concatenate(a), b=np.concatenate(b))


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    i = np.searchsorted(y, x)
    i[i == len(y)] = len(y) - 1
    return int((y[i] == x).sum())


def exact_clusters(sets: list[np.ndarray]) -> np.ndarray:
    """Cluster labels of sets sorted by size: connected by exact similarity. A cluster is left at its first link."""
    labels = np.arange(len(sets))
    members: dict[int, list[int]] = {}
    size = [len(s) for s in sets]
    for i, s in enumerate(sets):
        linked = []
        for c, rows in members.items():
            for j in rows:
                if NUM * size[i] <= DEN * size[j] and overlap(s, sets[j]) >= need(size[i], size[j]):
                    linked.append(c)
                    break
        home = min([i, *linked])
        rows = members.setdefault(home, [])
        for c in linked:
            if c != home:
                rows.extend(members.pop(c))
        rows.append(i)
        labels[rows] = home
    return labels


def _verify_tiles(batches):
    schema = C.arrow(_EDGES)
    for t in C.sorted_groups(batches, "tile"):
        if t.num_rows < 2:
            continue
        sid = t.column("sid").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in t.column("members").to_pylist()]
        a, b = _stars(sid, exact_clusters(sets))
        if len(a):
            yield C.out_batch(schema, a=a, b=b)


_MEMBERS = "sid long, n long, members binary"
_SIEVE = 24                    # the sieve of wanted classes has 2^24 bits, whatever their number


def _members(sieve_b):
    schema = C.arrow(_MEMBERS)

    def run(batches):
        sieve, seen = sieve_b.value, set()
        for batch in batches:
            for _, _, data, off in C.blocks(batch, "text"):
                rows = []
                for s in shingle_sets(data, off):
                    sid = set_id(s) if len(s) else None
                    if sid is None or sid in seen:
                        continue
                    at = sid & ((1 << _SIEVE) - 1)
                    if sieve[at >> 6] >> (at & 63) & 1:
                        if len(seen) < 500_000:
                            seen.add(sid)
                        rows.append((sid, len(s), s.tobytes()))
                if rows:
                    yield C.out_batch(schema, **dict(zip(("sid", "n", "members"), map(list, zip(*rows)))))
    return run


def _sieve(sids: DataFrame) -> list[int]:
    at = F.col("sid").bitwiseAND(F.lit((1 << _SIEVE) - 1))
    words = [0] * (1 << (_SIEVE - 6))
    rows = (sids.select(F.shiftright(at, 6).alias("w"), at.bitwiseAND(F.lit(63)).alias("k"))
            .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(k as int))")).alias("v")).collect())
    for w, v in rows:
        words[w] = v & ((1 << 64) - 1)
    return words


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, n_shingles, class_id (equal sets share it), component_id.

    Repeated rows and ids stay rows; documents of equal sets (not empty ones)
    are linked. A document that links with nothing is its own component.
    """
    sc = docs.sparkSession.sparkContext
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    told = C.stored(d.mapInArrow(_describe, C.struct(_SETS)))
    rows = told.filter("n is not null").select("doc_id", "n", "sid", "bitmap")
    total = rows.count()
    heavy = (told.filter("heavy is not null").groupBy("heavy").agg(F.sum("here").alias("c"))
             .filter((F.col("c") * HEAVY >= total) & (F.col("c") >= 8)).select("heavy").toArrow()["heavy"])
    heavy_b = sc.broadcast(np.sort(heavy.to_numpy().astype(np.uint64)))

    w = Window.partitionBy("h")
    pre = (d.select("text").mapInArrow(_prefixes(heavy_b), C.struct(_PREFIX)).repartition("h").dropDuplicates(["h", "sid"])
           # a pair meets where its smaller set has the shingle in its shorter prefix
           .withColumn("least", F.min(F.when(F.col("n") > 0, F.col("n"))).over(w)).filter("abs(n) >= least")
           .withColumn("n", F.abs("n"))
           .withColumn("c", F.count(F.lit(1)).over(w))
           .withColumn("x", F.expr("bit_xor(xxhash64(sid)) over (partition by h)"))
           # only rows with a partner of fitting size; the next size up or down is the best one there is
           .withColumn("below", F.lag("n").over(w.orderBy("n"))).withColumn("above", F.lead("n").over(w.orderBy("n")))
           .filter(f"{DEN} * below >= {NUM} * n or {DEN} * n >= {NUM} * above"))
    tiles = pre.groupBy("c", "x", "sid").agg(F.max("n").alias("n"))     # groups of the same members are one
    band = F.floor(F.log2("n")).cast("int")
    low = F.expr("3 * n < shiftleft(4L, b) and b > 0")
    banded = (tiles.withColumn("b", band)
              .select("c", "x", "sid", "n", F.explode(F.when(low, F.array(
                  F.struct(F.col("b").alias("band"), F.lit(True).alias("own")),
                  F.struct((F.col("b") - 1).alias("band"), F.lit(False).alias("own"))))
                  .otherwise(F.array(F.struct(F.col("b").alias("band"), F.lit(True).alias("own"))))).alias("o"))
              .select("c", "x", "o.band", "o.own", "sid", "n"))
    maps = rows.filter("sid is not null").groupBy("sid").agg(F.min("bitmap").alias("bitmap"))
    met = blocked(banded, ["c", "x", "band"], 4 * BLOCK).join(maps, "sid")
    stars = (met.repartition("tile").sortWithinPartitions("tile", "n", "sid")
             .select("tile", "band", "n", "sid", "own", "bitmap").mapInArrow(_filter_tiles, C.struct(_EDGES)))
    groups = C.components(stars).select(F.col("id").alias("sid"), F.col("component").alias("g"))

    sieve_b = sc.broadcast(_sieve(groups))
    arrays = d.select("text").mapInArrow(_members(sieve_b), C.struct(_MEMBERS)).dropDuplicates(["sid"])
    near = blocked(groups, ["g"], BLOCK).join(arrays, "sid")
    links = (near.repartition("tile").sortWithinPartitions("tile", "n", "sid")
             .select("tile", "sid", "members").mapInArrow(_verify_tiles, C.struct(_EDGES)))
    comps = C.components(links)

    named = rows.select("doc_id", "n", "sid").join(
        comps.select(F.col("id").alias("sid"), "component"), "sid", "left").withColumn("k", F.coalesce("component", "sid"))
    first = named.filter("k is not null").groupBy("k").agg(F.min("doc_id").alias("component_id"))
    return (named.join(first, "k", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("sid").alias("class_id"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(C.table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
