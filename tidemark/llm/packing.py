"""Best-fit packing by linear grouping.

Documents become token ids (byte-level BPE, one id 0 after each); a document
longer than a sequence is cut from its end into whole sequences, so that the
first piece is the shorter one. Pieces are dealt at random into cells of
about ``CELL`` pieces, and each cell is packed on its own:

1. pieces of more than ``SMALL`` of the capacity are sorted by length and
   grouped into at most ``GROUPS`` groups of equal cardinality, whose lengths
   are rounded up to the group's longest;
2. for these few sizes the configurations (what fits in one sequence) and how
   often each is used are optimised by column generation: a simplex over
   configurations, priced by a knapsack;
3. actual pieces take the places of their group;
4. what is left over and the small pieces are placed by best fit, longest
   first, into the room that the real lengths leave.

A cell is a bounded number of numbers, so no task holds more than that; the
loss against packing everything at once is about one sequence a cell.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

LENGTH = 2048
SMALL = 0.45
GROUPS = 128
CELL = 1 << 17
TOKENIZER = "byte_bpe_50k.tiktoken"      # the vocabulary of byte_bpe_50k.json as ranks
CACHE = 24 << 20         # bytes of remembered words in a worker, with what Python keeps for each


# -------------------------------------------------------------- token ids

class Tokens(dict):
    """Token ids of whole texts as bytes of little-endian unsigned 32-bit numbers.

    Byte-level BPE always cuts before a space that a non-space follows, so a
    text is cut there first and the ids of " word" are remembered by word. A
    text where other white space or an end follows a space is encoded as it
    is. Words are encoded from the vocabulary as ranks, which gives the ids
    that the ``tokenizers`` file gives several times faster; that file's one
    special token is an id of its own, as it is there.
    """

    held: dict = {}
    special, special_id = "<|endoftext|>", 50256

    def __init__(self, ranks_file: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_held = 0
        self.encode = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary

    @classmethod
    def of(cls, path: str) -> Tokens:
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(" " + word)).tobytes()
        # two objects of some 50 bytes and a place in the table
        cost = 200 + 4 * len(word) + len(ids)
        if self.bytes_held + cost <= CACHE:
            self.bytes_held += cost
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if self.special in text:
            return array("I", [self.special_id]).tobytes().join(map(self.ids, text.split(self.special)))
        if _ODD(text):
            return array("I", self.encode(text)).tobytes()
        first, *rest = text.split(" ")
        return array("I", self.encode(first)).tobytes() + b"".join(map(self.__getitem__, rest))


_ODD = re.compile(r" (?:\s|\Z)").search


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


_PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(path: str, limit: int):
    schema = C.arrow(_PIECES)

    def run(batches):
        tok = Tokens.of(path)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for at, to, data, off in C.blocks(batch, "text", 1 << 20):
                raw = data.tobytes()
                rows = []
                for i in range(to - at):
                    ids = tok.ids(raw[off[i]: off[i + 1]].decode()) + b"\0\0\0\0"
                    n = len(ids) // 4
                    first = n % limit or limit
                    cuts = [0, *range(first, n + 1, limit)] if n > limit else [0, n]
                    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((uid, doc[at + i], k, lo, hi - lo, zlib.crc32(ids[4 * lo: 4 * hi])))
                        uid += 1
                yield C.out_batch(schema, **dict(zip(schema.names, map(list, zip(*rows)))))
    return run


# ---------------------------------------------------------------- packing

def _knapsack(sizes: np.ndarray, worth: np.ndarray, cap: int) -> tuple[float, np.ndarray]:
    """The best configuration of any numbers of ``sizes`` within ``cap``: its worth and the numbers.

    Large sizes only: at most 1/SMALL of them fit, so layers over the number
    of pieces replace a walk over the capacity.
    """
    best = np.zeros(cap + 1)
    took: list[np.ndarray] = []
    for _ in range(int(cap // sizes.min())):
        nxt = best.copy()
        pick = np.full(cap + 1, -1)
        for g, (s, w) in enumerate(zip(sizes, worth)):
            v = best[:-s] + w if s else best
            better = v > nxt[s:] + 1e-12
            nxt[s:][better] = v[better]
            pick[s:][better] = g
        took.append(pick)
        if np.array_equal(nxt, best):
            break
        best = nxt
    counts, at = np.zeros(len(sizes), int), cap
    for pick in reversed(took):
        if pick[at] >= 0:
            counts[pick[at]] += 1
            at -= sizes[pick[at]]
    return float(best[cap]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, cap: int, rounds: int = 400) -> list[tuple[np.ndarray, int]]:
    """Configurations of the few sizes and how often each is used (whole numbers, rounded down).

    Column generation from one-size configurations: prices of the current
    basis, the configuration that is worth most by them, one pivot.
    """
    k = len(sizes)
    basis = np.diag(cap // sizes).astype(float)
    for _ in range(rounds):
        inv = np.linalg.inv(basis)
        price = np.ones(k) @ inv
        worth, col = _knapsack(sizes, price, cap)
        if worth <= 1 + 1e-7:
            break
        x, d = inv @ demand, inv @ col
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        if not np.isfinite(ratio).any():
            break
        basis[:, int(np.argmin(ratio))] = col
    x = np.linalg.solve(basis, demand.astype(float))
    return [(basis[:, j].astype(int), int(x[j] + 1e-6)) for j in range(k) if x[j] > 1 - 1e-6]


def pack(length: np.ndarray, cap: int = LENGTH) -> np.ndarray:
    """Sequence number of each piece of one cell."""
    n = len(length)
    seq = np.full(n, -1)
    order = np.argsort(-length, kind="stable")
    used: list[int] = []                                   # words in each sequence
    large = order[length[order] > cap * SMALL]
    if len(large):
        per = -(-len(large) // min(GROUPS, len(large)))
        group = np.arange(len(large)) // per
        top = length[large[np.arange(0, len(large), per)]]
        sizes, group_of = np.unique(-top, return_inverse=True)      # equal sizes are one group
        group = group_of[group]
        sizes = -sizes
        queue = [large[group == g].tolist()[::-1] for g in range(len(sizes))]   # longest last
        for config, times in configurations(sizes, np.bincount(group, minlength=len(sizes)), cap):
            for _ in range(times):
                room = 0
                for g in np.flatnonzero(config):
                    for _ in range(config[g]):
                        if queue[g]:
                            p = queue[g].pop()
                            seq[p] = len(used)
                            room += int(length[p])
                if room:
                    used.append(room)
    # best fit of the rest, longest first: sequences by free room, fullest that still takes the piece
    by_room: list[list[int]] = [[] for _ in range(cap + 1)]
    mask = 0
    for s, u in enumerate(used):
        by_room[cap - u].append(s)
        mask |= 1 << (cap - u)
    for p in order[seq[order] < 0].tolist():
        x = int(length[p])
        fit = mask >> x
        if fit:
            room = x + ((fit & -fit).bit_length() - 1)
            s = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            room, s = cap, len(used)
            used.append(0)
        seq[p] = s
        by_room[room - x].append(s)
        mask |= 1 << (room - x)
    return seq


_OUT = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def _packer(limit: int):
    schema = C.arrow(_OUT)

    def run(batches):
        for t in C.sorted_groups(batches, "cell"):
            length = t.column("length").to_numpy()
            seq = pack(length, limit)
            o = np.lexsort((-length, seq))
            s, ln = seq[o], length[o]
            total = np.cumsum(ln) - ln
            first = np.concatenate([[True], s[1:] != s[:-1]])
            offset = total - np.maximum.accumulate(np.where(first, total, 0))
            t = t.take(pa.array(o))
            base = int(t.column("cell")[0].as_py()) << 32
            for lo in range(0, len(o), 50_000):
                hi = lo + 50_000
                part = t.slice(lo, 50_000)
                yield C.out_batch(schema, **{c: part.column(c).combine_chunks() for c in ("doc_id", "piece", "start", "length", "ids_crc32")},
                                  sequence_id=base + s[lo:hi], offset=offset[lo:hi])
    return run


def pieces(docs: DataFrame, path: str | None = None, limit: int = LENGTH, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Token pieces of all documents: doc_id, piece, start, length, ids_crc32 (null text: one id)."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInArrow(_cutter(path or tokenizer_path(), limit), C.struct(_PIECES))


def pack_documents(docs: DataFrame, path: str | None = None, limit: int = LENGTH) -> DataFrame:
    """Pieces of all documents with their sequence_id and offset; empty tables give no rows."""
    cut = C.stored(pieces(docs, path, limit))
    cells = max(1, -(-cut.count() // CELL))
    dealt = cut.withColumn("cell", F.pmod(F.xxhash64("uid"), F.lit(cells)))
    return (dealt.repartition("cell").sortWithinPartitions("cell", "uid")
            .mapInArrow(_packer(limit), C.struct(_OUT)))


def op3_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(C.table(spark, sf_dir, "documents"))
