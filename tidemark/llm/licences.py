"""License scans: Aho-Corasick phrases and evaluated licence expressions.

One automaton walks the words of a whole text (A-Z lowered, one space between
words, so punctuation and line breaks inside a notice don't matter) and finds
the base phrases, notice phrases and identifier tags together. Behind a tag
("SPDX-License-Identifier:") the raw text is read as a licence expression;
notices joined by and, or, with in running text make an expression as well.
A shunting-yard parser (with binds tighter than and, and tighter than or)
evaluates both: or takes the freest side, and the strictest, with an exception
frees one step.

Columns besides the contract's: ``expressions`` (each with its operators in
capitals and all brackets, semicolon-joined) and ``openness`` (0
closed, 1 free; the strictest of the text's expressions; null without one).
``score`` is the evidence that the text carries a licence: 1 minus the product
of (1 - weight) over all places found.

Nulls and edge cases: a null text is empty and gives no labels, 0 words and
score 0; ids pass through as they are, repeated rows stay rows, an empty table
gives none, other columns are never read. Texts are scanned whole in time in
proportion to their length; a malformed expression counts as far as it can be
read, and unknown identifiers are labels of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C

# fixed values: phrases of the base rule and their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# phrases of the method: words, label, openness (1 free, 0 closed), weight as evidence
NOTICES = [
    ("mit license", "mit", 0.9, 0.8), ("apache license", "apache", 0.9, 0.8),
    ("general public license", "gpl", 0.4, 0.8),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 0.9, 0.95),
    ("lesser general public license", "lgpl", 0.5, 0.9), ("library general public license", "lgpl", 0.5, 0.9),
    ("affero general public license", "agpl", 0.3, 0.9), ("free documentation license", "gfdl", 0.4, 0.9),
    ("mozilla public license", "mpl", 0.6, 0.9), ("eclipse public license", "epl", 0.6, 0.9),
    ("common development and distribution license", "cddl", 0.6, 0.9),
    ("redistribution and use in source and binary forms", "bsd", 0.9, 0.9), ("bsd license", "bsd", 0.9, 0.8),
    ("bsd 2 clause", "bsd-2-clause", 0.9, 0.8), ("bsd 3 clause", "bsd-3-clause", 0.9, 0.8),
    ("2 clause bsd", "bsd-2-clause", 0.9, 0.8), ("3 clause bsd", "bsd-3-clause", 0.9, 0.8),
    ("isc license", "isc", 0.9, 0.8), ("zlib license", "zlib", 0.9, 0.8),
    ("boost software license", "bsl", 0.9, 0.9), ("artistic license", "artistic", 0.6, 0.8),
    ("this is free and unencumbered software released into the public domain", "unlicense", 1.0, 0.95),
    ("released into the public domain", "public-domain", 1.0, 0.7),
    ("dedicated to the public domain", "public-domain", 1.0, 0.7),
    ("cc0", "cc0", 1.0, 0.7), ("all rights reserved", "all-rights-reserved", 0.0, 0.5),
    ("creative commons attribution noncommercial noderivatives", "cc-by-nc-nd", 0.1, 0.9),
    ("creative commons attribution noncommercial sharealike", "cc-by-nc-sa", 0.2, 0.9),
    ("creative commons attribution noncommercial", "cc-by-nc", 0.2, 0.9),
    ("creative commons attribution noderivatives", "cc-by-nd", 0.2, 0.9),
    ("creative commons attribution sharealike", "cc-by-sa", 0.5, 0.9),
    ("creative commons attribution", "cc-by", 0.8, 0.8),
    ("cc by nc nd", "cc-by-nc-nd", 0.1, 0.8), ("cc by nc sa", "cc-by-nc-sa", 0.2, 0.8),
    ("cc by nc", "cc-by-nc", 0.2, 0.8), ("cc by nd", "cc-by-nd", 0.2, 0.8),
    ("cc by sa", "cc-by-sa", 0.5, 0.8), ("cc by", "cc-by", 0.8, 0.5),
]
TAG, TAG_WEIGHT = "spdx license identifier", 0.95
# families whose label takes a version that follows, "version 2.0", "v3" or "4.0"
VERSIONED = {"apache", "gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "cddl", "artistic", "bsl",
             "cc-by", "cc-by-sa", "cc-by-nc", "cc-by-nd", "cc-by-nc-sa", "cc-by-nc-nd", "cc0"}
OPENNESS = {label: o for _, label, o, _ in NOTICES}
UNKNOWN = 0.5

# words that may stand between two notices of one expression
_BETWEEN = {"a", "an", "at", "either", "gnu", "license", "licence", "of", "option", "s", "the", "terms", "under",
            "your", "and", "or", "with"}
PRIORITY = {"or": 1, "and": 2, "with": 3}

_SPACED = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def line(raw: bytes) -> bytes:
    """The words of a text, lowered, each between single spaces."""
    a = np.frombuffer(b" " + raw.translate(_SPACED) + b" ", np.uint8)
    gap = a == 32
    return a[np.append(True, ~(gap[1:] & gap[:-1]))].tobytes()


def automaton():
    """Aho-Corasick over the phrases; a value is (words, kind, notice)."""
    import ahocorasick

    found: dict[str, list] = {}
    for phrase, *notice in NOTICES:
        found.setdefault(phrase, []).append(("notice", *notice))
    for phrase, label in BASE.items():
        found.setdefault(phrase, []).append(("base", label))
    found[TAG] = [("tag",)]
    a = ahocorasick.Automaton()
    for phrase, values in found.items():
        a.add_word(f" {phrase} ", (phrase, values))
    a.make_automaton()
    return a


# -------------------------------------------------------------- expressions

class Value:
    """An evaluated expression: a licence, or an operator over two, and how free it leaves the reader."""

    __slots__ = ("name", "left", "right", "open")

    def __init__(self, name: str, free: float, left: Value | None = None, right: Value | None = None):
        self.name, self.open, self.left, self.right = name, free, left, right

    def text(self) -> str:
        """The expression with all its brackets."""
        out, todo = [], [self]
        while todo:
            v = todo.pop()
            if isinstance(v, str):
                out.append(v)
            elif v.left is None:
                out.append(v.name)
            else:
                todo += [")", v.right, f" {v.name.upper()} ", v.left, "("]
        return "".join(out)

    def labels(self) -> set[str]:
        """The licences in it; what stands behind "with" names an exception and is none."""
        out, todo = set(), [self]
        while todo:
            v = todo.pop()
            if v.left is None:
                out.add(v.name)
            else:
                todo += [v.left] if v.name == "with" else [v.left, v.right]
        return out


def openness(label: str) -> float:
    """Of a licence, by the longest family name that its id starts with."""
    while label:
        if label in OPENNESS:
            return OPENNESS[label]
        label = label.rpartition("-")[0]
    return UNKNOWN


def licence(name: str) -> Value:
    return Value(name, openness(name.rstrip("+")))


def _apply(op: str, a: Value, b: Value) -> Value:
    if op == "with":
        return Value(op, min(1.0, a.open + 0.1), a, b)
    return Value(op, max(a.open, b.open) if op == "or" else min(a.open, b.open), a, b)


def evaluate(tokens: Iterable) -> tuple[Value | None, int]:
    """Shunting-yard over "(", ")", "and", "or", "with" and licences (Value): the value, and the tokens taken.

    Takes tokens as far as they go on well-formed: an operator without a right
    side is left out, as is a closing bracket without an opening one; brackets
    still open at the end are closed there.
    """
    values: list[Value] = []
    ops: list[str] = []
    open_ = taken = 0

    def reduce() -> None:
        b = values.pop()
        values.append(_apply(ops.pop(), values.pop(), b))

    expect = True         # a licence or an opening bracket
    for t in tokens:
        if expect:
            if t == "(":
                ops.append(t)
                open_ += 1
            elif isinstance(t, Value):
                values.append(t)
                expect = False
            else:
                break
        elif t == ")":
            if not open_:
                break
            while ops[-1] != "(":
                reduce()
            ops.pop()
            open_ -= 1
        elif isinstance(t, str) and t in PRIORITY:
            while ops and ops[-1] != "(" and PRIORITY[ops[-1]] >= PRIORITY[t]:
                reduce()
            ops.append(t)
            expect = True
        else:
            break
        taken += 1
    if not values:
        return None, taken
    while expect and ops:                          # what waits for a right side
        if ops.pop() != "(":
            break
    while ops:
        if ops[-1] == "(":
            ops.pop()
        else:
            reduce()
    return values[0], taken


_LEX = re.compile(rb"[ \t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.-]*\+?))")
_COLON, _NEXT_LINE = re.compile(rb"[ \t]*:"), re.compile(rb"[ \t]*[\r\n]+[ \t#*/;-]*")


def tag_tokens(raw: bytes, at: int, read: list[int]) -> Iterator:
    """Tokens of the expression behind a tag, to the end of its line (of its brackets, if these go on).

    ``read`` gets the place in the text behind each token.
    """
    open_ = 0
    m = _COLON.match(raw, at)
    while m:
        m = _LEX.match(raw, at := m.end())
        if not m:
            m = _NEXT_LINE.match(raw, at) if open_ > 0 else None
            continue
        read.append(m.end())
        if m[1]:
            open_ += 1 if m[1] == b"(" else -1
            yield m[1].decode()
        else:
            word = m[2].decode().lower().rstrip(".-")
            yield word if word in PRIORITY else licence(word)


def _versioned(label: str, words: list[str]) -> str:
    """The label with the version that the next words name: "version 2 0 or later" -> label-2.0-or-later."""
    if label not in VERSIONED:
        return label
    w = [*words, *[""] * 9]
    k = 1 if w[0] in ("version", "v") else 0
    first = w[k][1:] if w[k][:1] == "v" else w[k]
    if not re.fullmatch(r"[1-9]", first):
        return label
    minor = w[k + 1] if re.fullmatch(r"[0-9]", w[k + 1]) else ""
    k += 2 if minor else 1
    later = " ".join(w[k:k + 9])
    tail = re.match(r"(of the licen[sc]e )?or (at your option )?(any )?later\b", later)
    return f"{label}-{first}.{minor or 0}{'-or-later' if tail else ''}"


# -------------------------------------------------------------- scan

def _word_ends(raw: bytes) -> np.ndarray:
    """Where each word of the raw text ends."""
    inside = np.append(np.frombuffer(raw.translate(_SPACED), np.uint8) != 32, False)
    return np.flatnonzero(inside[:-1] & ~inside[1:]) + 1


def _prose(marks: list[tuple[int, int, Value]], words) -> list[list]:
    """Token lists of notices in running text: neighbours joined where only connecting words stand between."""
    runs: list[list] = []
    end = -1
    for a, b, value in marks:
        op = None
        if runs and 0 <= a - end <= 8:
            gap = words(end, a)
            if all(w in _BETWEEN or re.fullmatch(r"v?[0-9]+|version|later|any", w) for w in gap):
                op = next((w for w in reversed(gap) if w in PRIORITY), None)
        if op:
            runs[-1] += [op, value]
        else:
            runs.append([value])
        end = max(end, b)
    return runs


def scan(raw: bytes, machine) -> dict:
    """Labels, places and evaluated expressions of one text."""
    text = line(raw)
    n_words = text.count(b" ") - 1
    hits = []
    for end, (phrase, values) in machine.iter(text.decode("latin-1")):
        hits += [(end - len(phrase), end, v) for v in values]       # first byte of the phrase, space behind it
    out = {"n_words": n_words, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "",
           "score": 0.0, "expressions": "", "openness": None}
    if not hits:
        return out
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
    start = np.searchsorted(spaces, [h[0] for h in hits]) - 1
    end = np.searchsorted(spaces, [h[1] for h in hits])             # the word behind the phrase

    def words(a: int, b: int) -> list[str]:
        b = min(b, n_words)
        return text[spaces[a]: spaces[b]].decode("latin-1").split() if a < b else []

    base, labels, doubt, ends, inside = [], set(), 1.0, None, []
    notices: list[tuple[int, int, Value, float]] = []
    expressions: list[Value] = []
    for a, b, (_, _, v) in zip(start.tolist(), end.tolist(), hits):
        if v[0] == "base":
            base.append((a, v[1]))
        elif v[0] == "notice":
            label = _versioned(v[1], words(b, b + 14))
            notices.append((a, b, Value(label, v[2]), v[3]))
        else:
            ends = _word_ends(raw) if ends is None else ends
            read: list[int] = []
            value, taken = evaluate(tag_tokens(raw, int(ends[b - 1]), read))
            if value:
                expressions.append(value)
                doubt *= 1 - TAG_WEIGHT
                inside.append((b, int(np.searchsorted(ends, read[taken - 1], "right"))))
    # of notices at one place the longest says it all ("lesser general public license", "cc by nc")
    notices.sort(key=lambda x: (x[0], -x[1]))
    longest, reach, k = [], -1, 0
    for a, b, value, weight in notices:
        while k < len(inside) and inside[k][1] <= a:
            k += 1
        if b > reach and not (k < len(inside) and inside[k][0] <= a):       # within a tag's expression: said there
            longest.append((a, b, value))
            doubt *= 1 - weight
            reach = b
    expressions += [v for v, _ in map(evaluate, _prose(longest, words)) if v]
    for v in expressions:
        labels |= v.labels()
    mine = {label for _, label in base}
    texts = list(dict.fromkeys(v.text() for v in expressions))
    return out | {
        "n_base": len(base), "first_word": min((a for a, _ in base), default=None),
        "last_word": max((a for a, _ in base), default=None), "base_labels": ",".join(sorted(mine)),
        "labels": ",".join(sorted(mine | labels)), "score": 1.0 - doubt, "expressions": "; ".join(texts),
        "openness": min((v.open for v in expressions), default=None)}


_OUT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, expressions string, openness double")


def _scan(batches):
    schema = C.arrow(_OUT)
    machine = automaton()
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for at, to, data, off in C.blocks(batch, "text"):
            raw = data.tobytes()
            rows = [scan(raw[off[i]: off[i + 1]], machine) for i in range(to - at)]
            cols = {k: [r[k] for r in rows] for k in rows[0]}
            yield C.out_batch(schema, doc_id=ids.slice(at, to - at), **cols)


def licences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: base places, labels, evidence and evaluated expressions."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(_scan, C.struct(_OUT))


def op12_licence_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every whole text of documents."""
    return licences(C.table(spark, sf_dir, "documents"))
