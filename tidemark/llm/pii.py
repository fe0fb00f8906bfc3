"""Personal data by boosted candidates.

Generators with high recall propose spans, which may overlap: the base
patterns, and wider ones (digit groups of any separator, numbers without a
plus sign, dotted quads of any size, spelled-out addresses). A boosted-tree
classifier scores the wider ones by format and context. What it learns from
has the wide form on both sides, so the base form tells nothing: positive are
base spans rewritten in their place into wide forms (spelled-out addresses,
national phone numbers, cards with other separators); negative are look-alikes
put in such places (ids, prices, dates, hashes, prose with an "(at)") and
proposals that other evidence speaks against (check digits, ranges, letters
around a number, a base span of another kind). Other proposals are not learned
from. Platt scaling on held-out rows and a precision target give each kind its
threshold; a kind whose held-out rows can't show the precision adds nothing.
So does "ip": a proposal that is no base span is out of range. Base spans
always stay.

The classifier is fitted on at most ``SAMPLE`` documents; all texts are then read
once, without a shuffle.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import random
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.boosting import Boosted, sigmoid

KINDS = ["email", "ip", "card", "phone"]
SAMPLE = 4000            # documents that the classifier is fitted on, at most
PER_DOC = 40             # lessons of one sampled document that are learned from, at most
PRECISION = 0.99         # what an added kind must reach on held-out candidates
LEAST = 100              # held-out candidates above a threshold that can show it

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
# a match can only start at the start of a run of digits, so looking back changes nothing and keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WIDE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]{1,63}"
                        r"(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?[A-Za-z0-9-]{1,63})+", re.I),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20.\-/]?[0-9]){9,15}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:00|\()?[0-9][0-9().\x20/-]{6,18}[0-9](?![0-9])"),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: each @ with the run of name characters before it."""
    out, last, at = [], 0, t.find("@")
    while at >= 0:
        i = at
        while i > last and t[i - 1] in _LOCAL:
            i -= 1
        m = _DOMAIN.match(t, at + 1) if i < at else None
        if m:
            out.append((i, m.end()))
            last = m.end()
        at = t.find("@", max(at + 1, last))
    return out


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Base spans by kind, then start."""
    out = [("email", a, b) for a, b in emails(t)] if "@" in t else []
    if _DIGIT.search(t):
        for m in _IP.finditer(t):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(t):
            if m.end() - m.start() <= 64:
                d = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(d) <= 19 and luhn(d):
                    out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(t):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


class Taken:
    """Spans that don't overlap each other, by place: whether another one overlaps any of them is a binary search."""

    def __init__(self, spans=()):
        self.spans = sorted(spans)

    def overlaps(self, a: int, b: int) -> bool:
        i = bisect.bisect_left(self.spans, (b,)) - 1         # the last that starts before b ends last, too
        return i >= 0 and self.spans[i][1] > a

    def add(self, a: int, b: int) -> None:
        bisect.insort(self.spans, (a, b))


def by_kind(spans: list[tuple[str, int, int]]) -> dict[str, Taken]:
    """Base spans of each kind: leftmost matches of one pattern, so they don't overlap within a kind."""
    return {k: Taken((a, b) for kind, a, b in spans if kind == k) for k in KINDS}


def features(t: str, kind: str, a: int, b: int) -> list[float]:
    """Format of the span and its surroundings, and a card's check digits; nothing that only base forms have."""
    s = t[a:b]
    before, after = t[max(0, a - 24): a], t[b: b + 24]
    digits = sum(c.isdigit() for c in s)
    prev, nxt = before[-1:], after[:1]
    word = re.search(r"([^\W\d_]*)\W*$", before)
    runs = [len(x) for x in re.findall(r"[0-9]+", s)] or [0]
    tail = re.search(r"[^\W\d_]*$", s).group()
    return [KINDS.index(kind), len(s), digits, s.count(" "), s.count("-"), s.count("."), s.count("/"),
            s.count("(") + s.count(")"), s.startswith("("), ord(s[0]) - 48 if s[0].isdigit() else -1,
            max(runs), min(runs), len(runs), runs[0], runs[1] if len(runs) > 1 else 0, runs[-1], s.startswith("00"),
            kind == "card" and luhn("".join(c for c in s if "0" <= c <= "9")),
            ". " in s, len(tail), tail[:1].isupper(), "ot)" in s.lower() or "ot]" in s.lower() or "ot}" in s.lower(),
            prev.isalpha(), prev.isdigit(), prev.isspace(), prev in ("\"", "'", "=", ":", "#", "$"),
            nxt.isalpha(), nxt.isdigit(), nxt.isspace() or nxt == "", sum(c.isdigit() for c in before),
            sum(c.isdigit() for c in after), len(word.group(1)) if word else 0, sum(c.isalpha() for c in s)]


def candidates(t: str) -> list[list]:
    """[kind, start, end, base?, features] of every base span and every wider proposal."""
    base = base_spans(t)
    out = [[k, a, b, 1, features(t, k, a, b)] for k, a, b in base]
    taken = by_kind(base)
    if _DIGIT.search(t) or "at" in t:
        for kind, rx in _WIDE.items():
            if kind == "email" and not ("(at" in t or "[at" in t or "{at" in t or "(AT" in t or "[AT" in t or "{AT" in t):
                continue
            for m in rx.finditer(t):
                a, b = m.span()
                if not taken[kind].overlaps(a, b):
                    out.append([kind, a, b, 0, features(t, kind, a, b)])
    return out


_MARKS = [("(at)", "(dot)"), ("[at]", "[dot]"), ("{at}", "{dot}"), ("(AT)", "(DOT)")]
_DATE = re.compile(r"[12][0-9]{3}([-/.])[0-9]{2}\1[0-9]{2}(?![0-9])|[0-9]{2}([./-])[0-9]{2}\2[12][0-9]{3}(?![0-9])")


def wide_form(kind: str, s: str, rng: random.Random) -> str:
    """The base span ``s`` as people write it beside the base form; empty if there is no such form."""
    if kind == "email":
        (at, dot), gap = rng.choice(_MARKS), rng.choice(["", " "])
        name, host = s.split("@", 1)
        # addresses of one corpus may all look the same: with and without digits, points and subdomains
        if rng.random() < .5:
            name = re.sub(r"[^A-Za-z]", "", name) or name
        if rng.random() < .5:
            host = ".".join(x.strip("0123456789") or x for x in host.split(".")[-2:])
        if rng.random() < .5:
            host = host.rsplit(".", 1)[0] + "." + rng.choice(["com", "org", "net", "de", "info", "io"])
        return f"{name}{gap}{at}{gap}" + host.replace(".", rng.choice([f"{gap}{dot}{gap}", f"{gap}{dot}{gap}", "."]))
    d = "".join(c for c in s if "0" <= c <= "9")
    if kind == "card":
        sep = rng.choice("./")
        return sep.join(d[i: i + 4] for i in range(0, len(d), 4))
    if kind == "phone":
        land = re.match(r"\+([0-9]{1,3})", s).group(1)
        r = d[len(land):]
        if len(r) < 7:          # no separator after the country
            land, r = d[:2], d[2:]
        cut = rng.choice([2, 3, 4])
        a, b, c = (r[:3], r[3:6], r[6:]) if cut == 3 or len(r) < 9 else (r[:cut], r[cut: cut + 3], r[cut + 3:])
        sep = rng.choice(" -.")
        return rng.choice([f"({a}) {b}-{c}", f"({a}) {b} {c}", f"{a}{sep}{b}{sep}{c}", f"00 {land} {a} {b}{c}", f"00 {land} {a} {b} {c}",
                           f"00{land} {a} {b}{c}", f"0{a} {b}{c}", f"0{a}/{b}{c}", f"(0{a}) {b}{c}", f"0{a}-{b}-{c}"]) if c else ""
    return ""


def look_alike(kind: str, text: str, rng: random.Random) -> str:
    """Something that a wide generator of ``kind`` may propose and that is no personal data."""
    n = lambda k: "".join(rng.choices("0123456789", k=k))
    if kind == "email":
        w = [x for x in re.findall(r"[A-Za-z]{2,12}", text[:2000])] or ["we"]
        a, b, c, d = (rng.choice(w) for _ in range(4))
        return rng.choice([f"{a} (at) {b}. {c.title()} {d}", f"{a} [at] {b}. {c.title()}", f"{a}(at){b}. {c}", f"{a} (at) {n(2)}.{n(2)} {b}"])
    if kind == "card":
        x = n(16)
        if rng.random() < .3:
            return f"{rng.randint(1950, 2030)}/{n(2)}/{n(2)}.{n(2)}.{n(2)}.{n(4)}"
        return "" if luhn(x) else rng.choice([x, *(sep.join(x[i: i + 4] for i in range(0, 16, 4)) for sep in "./")])
    y, m, d = rng.randint(1900, 2035), rng.randint(1, 12), rng.randint(1, 28)
    return rng.choice([f"#{n(9)}", f"#{n(4)}-{n(6)}", f"id {n(rng.randint(8, 14))}", n(rng.randint(8, 18)), f"${n(5)}.{n(2)} {n(5)}.{n(2)}",
                       f"{n(5)}.{n(2)}-{n(5)}.{n(2)}", f"{y}-{m:02}-{d:02}", f"{d:02}.{m:02}.{y}", f"{d:02}/{m:02}/{y}", f"{y}/{m:02}/{d:02}",
                       f"{y}-{y + 9}", f"{d:02}.{m:02}.{y} - {d:02}.{m:02}.{y + 1}", f"978-{n(1)}-{n(2)}-{n(6)}-{n(1)}", f"10.{n(4)}/{n(6)}",
                       f"{rng.randbytes(6).hex()}a{n(9)}b{rng.randbytes(5).hex()}", f"{n(8)}-{n(4)}-{n(4)}-{n(4)}-{n(12)}",
                       f"{n(1)}.{n(3)}.{n(3)}.{n(3)}", f"{n(2)} {n(2)} {n(2)} {n(2)} {n(2)} {n(2)}", f"{n(6)}.{n(6)}"])


def _against(t: str, kind: str, a: int, b: int, base: dict[str, Taken]) -> bool:
    """Evidence other than the base form that a proposal is not of its kind."""
    s = t[a:b]
    d = "".join(c for c in s if "0" <= c <= "9")
    if any(k != kind and spans.overlaps(a, b) for k, spans in base.items()):
        return True
    if kind == "ip":
        return True
    if kind == "card":
        return not luhn(d)
    if kind == "phone":
        return (len(d) > 15 or t[max(0, a - 1): a].isalpha() or t[b: b + 1].isalpha() or t[max(0, a - 1): a] in tuple("#$€£")
                or bool(_DATE.fullmatch(s)))
    return False


def lessons(t: str) -> list[list]:
    """[kind, start, end, personal data?, features] of wide forms: what the classifier learns from a text."""
    rng = random.Random(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest())
    cands = candidates(t)
    base = [(c[0], c[1], c[2]) for c in cands if c[3]]
    out = []
    for kind, a, b in base:
        for label, form in [(1, wide_form(kind, t[a:b], rng)) for _ in range(4)] + [
                (0, look_alike(kind, t, rng)) for _ in range(4 if kind != "ip" else 0)]:
            if not form:
                continue
            lead = t[max(0, a - 40): a]
            near = lead + form + t[b: b + 40]
            for c in candidates(near):
                x, y = c[1] - len(lead), c[2] - len(lead)
                if c[0] != kind or c[3] or y <= 0 or x >= len(form):
                    continue
                if not label or (x, y) == (0, len(form)):       # a part of a wide form is left out
                    out.append([kind, a, b, label, c[4]])
    # proposals as they are
    taken = by_kind(base)
    out.extend([k, a, b, 0, f] for k, a, b, is_base, f in cands if not is_base and _against(t, k, a, b, taken))
    rng.shuffle(out)                                             # PER_DOC takes of all
    return out


def _sampled(batches):
    schema = C.arrow("key long, cands string")
    for batch in batches:
        for at, to, data, off in C.blocks(batch, "text"):
            raw = data.tobytes()
            found = [(k, lessons(raw[off[i]: off[i + 1]].decode()))
                     for i, k in zip(range(to - at), batch.column(0).slice(at, to - at).to_pylist())]
            found = [(k, json.dumps(c[:PER_DOC])) for k, c in found if c]
            if found:
                yield C.out_batch(schema, key=[k for k, _ in found], cands=[c for _, c in found])


class Selector:
    """The fitted trees, their calibration, and each kind's threshold on the calibrated probability.

    ``docs`` holds the lessons of different texts, in the order of their hashes: every third is held out.
    """

    def __init__(self, docs: list[list]):
        rows = [(d % 3 == 0, c) for d, doc in enumerate(docs) for c in doc]
        x = np.array([c[4] for _, c in rows], float).reshape(len(rows), len(rows[0][1][4]) if rows else 0)
        y = np.array([c[3] for _, c in rows], float)
        held = np.array([h for h, _ in rows], bool)
        kind = np.array([c[0] for _, c in rows])
        self.thresholds = dict.fromkeys(KINDS, 2.0)
        self.a, self.b = 1.0, 0.0
        self.model = None
        if len(rows) < 2 * LEAST or len(set(y[~held])) < 2:
            return
        self.model = Boosted().fit(x[~held], y[~held])
        z = self.model.raw(x[held])
        for _ in range(200):                       # Platt scaling by gradient steps
            p = sigmoid(self.a * z + self.b)
            self.a -= 0.05 * float(((p - y[held]) * z).mean())
            self.b -= 0.05 * float((p - y[held]).mean())
        p = sigmoid(self.a * z + self.b)
        for k in KINDS:
            mine = kind[held] == k
            o = np.argsort(-p[mine], kind="stable")
            q, hit = p[mine][o], y[held][mine][o]
            right = np.cumsum(hit) / np.arange(1, len(q) + 1)
            # whole ties only: a threshold takes all candidates of its probability
            last = np.append(q[1:] != q[:-1], True) if len(q) else np.zeros(0, bool)
            ok = np.flatnonzero((right >= PRECISION) & last & (np.arange(1, len(q) + 1) >= LEAST))
            if len(ok):
                # halfway to the next candidate, which the held-out rows refuse
                low = q[ok[-1] + 1] if ok[-1] + 1 < len(q) else 0.0
                self.thresholds[k] = float(max(0.5, (q[ok[-1]] + low) / 2))

    def spans(self, cands: list[list]) -> list[tuple[str, int, int]]:
        """Base spans and the selected others, best first where they overlap; by kind, then start."""
        keep = [(c[0], c[1], c[2]) for c in cands if c[3]]
        more = [c for c in cands if not c[3]]
        if more and self.model is not None:
            p = sigmoid(self.a * self.model.raw(np.array([c[4] for c in more], float)) + self.b)
            base, added = by_kind(keep).values(), Taken()
            for q, c in sorted(zip(p, more), key=lambda v: (-v[0], v[1][1], v[1][2], v[1][0])):
                if q >= self.thresholds[c[0]] and not any(x.overlaps(c[1], c[2]) for x in (added, *base)):
                    keep.append((c[0], c[1], c[2]))
                    added.add(c[1], c[2])
        return sorted(keep, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def fit(docs: DataFrame, text: str = "text") -> Selector:
    """The selector from a bounded sample: different texts by hash, at most SAMPLE of those with candidates.

    Copies of a text are one: they take one place, and lie on one side of the held-out split.
    """
    d = docs.select(F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    some = max(1, d.agg(F.approx_count_distinct("key")).first()[0] // (8 * SAMPLE))
    rows = (d.filter(F.pmod("key", F.lit(some)) == 0).mapInArrow(_sampled, C.struct("key long, cands string"))
            .groupBy("key").agg(F.min("cands").alias("cands")).orderBy("key").limit(SAMPLE).collect())
    return Selector([json.loads(r["cands"]) for r in rows])


_SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _find(selector_b):
    schema = C.arrow(_SPANS)

    def run(batches):
        sel = selector_b.value
        none = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
            for at, to, data, off in C.blocks(batch, "text"):
                raw = data.tobytes()
                rows = []
                for i in range(to - at):
                    cands = candidates(raw[off[i]: off[i + 1]].decode())
                    if not cands:
                        rows.append((ids[at + i], 0, 0, 0, 0, none, ""))
                        continue
                    base = [(c[0], c[1], c[2]) for c in cands if c[3]]
                    n = [sum(k == b[0] for b in base) for k in KINDS]
                    rows.append((ids[at + i], *n, hashlib.sha256(_joined(base).encode()).hexdigest(),
                                 _joined(sel.spans(cands))))
                yield C.out_batch(schema, **dict(zip(schema.names, map(list, zip(*rows)))))
    return run


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: base counts, digest of the base spans, and all spans (code points, end exclusive).

    Null text is empty; equal rows stay rows; an empty table gives no rows.
    """
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sel = docs.sparkSession.sparkContext.broadcast(fit(d))
    return d.mapInArrow(_find(sel), C.struct(_SPANS))


def replaced(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by the first one's."""
    parts, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if b > at:
            parts.append(text[at:max(a, at)])
            if a >= at:
                parts.append(f"[{k.upper()}]")
            at = b
    return "".join(parts) + text[at:]


_DOC = "doc_id long, text string, lang string, source string, n_chars long"


def _redact(selector_b):
    schema = C.arrow(_DOC)

    def run(batches):
        sel = selector_b.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                doc, text, lang, source, n = batch.slice(lo, 500).columns
                out, chars = text.to_pylist(), n.to_pylist()
                for i, t in enumerate(out):
                    cands = candidates(t) if t else []
                    spans = sel.spans(cands) if cands else []
                    if spans:
                        out[i] = replaced(t, spans)
                        chars[i] = len(out[i])
                yield C.out_batch(schema, doc_id=doc, text=out, lang=lang, source=source, n_chars=chars)
    return run


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (columns of documents) with every span of its texts replaced by [KIND]; n_chars follows.

    A null text stays null. Documents without spans are untouched. No shuffle.
    """
    sel = docs.sparkSession.sparkContext.broadcast(fit(docs))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source",
                    F.col("n_chars").cast("long").alias("n_chars"))
    return d.mapInArrow(_redact(sel), C.struct(_DOC))


def op6_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(C.table(spark, sf_dir, "documents"))
