"""The training-data operators against brute force, and their edge rows."""

import hashlib
import itertools
import math
import re
import sys
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (boosting, common as C, ctw, jaccard, language, mincut, mixing, multi_index, outliers, packing,
                          pii, queries, resharding)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, n long, shard string, _row long"
EDGE = [(1, "one two three four five six seven", "en", "a"), (2, "one two three four five six seven", "en", "a"),
        (2, "one two three four five six seven", "en", "a"), (3, None, None, None), (4, "", "en", "a"),
        (None, " \t\n", None, "b"), (5, "word", "de", None), (6, "mail a.b@c.org, 4111 1111 1111 1111 +1 (743) 555-3824 é 1.2.3.4", "en", "b"),
        (7, "x y z " * 30000, "en", "a")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(*r, None, 0, 0, "x", 0) for r in EDGE], SCHEMA).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def _words(t):
    return (t or "").encode().lower().split()


# ---------------------------------------------------------------- edge rows and empty tables

RUNS = {
    "score": lambda d: ctw.score(ctw.train(d.filter("doc_id < 3")), d),
    "mix": lambda d: mixing.taken(mixing.mix(d)), "mixed": mixing.mixed_documents,
    "pack": packing.pack_documents, "join": jaccard.join,
    "reshard": lambda d: resharding.reshard(d, F.lit(0), shards=3),
    "pii": pii.find, "judge": lambda d: outliers.judge(d, ["doc_id"]),
    "language": lambda d: language.predict(language.train(d), d, F.lit(True)),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_edge_rows_and_empty_tables(edge, name):
    out = RUNS[name](edge).collect()
    if name not in ("pack", "mixed"):
        assert len(out) == len(EDGE)
    assert RUNS[name](edge.limit(0)).count() == 0


# ---------------------------------------------------------------- 1

def _brute_ctw(train, text, depth):
    """Context trees as plain recursion over dictionaries."""
    count = defaultdict(lambda: [0, 0])
    kids = defaultdict(set)

    def steps(t):
        b = bytes([255] * depth) + t.encode() + b"\xff"
        for i in range(depth, len(b)):
            for k in range(8):
                yield b[i - depth: i], (1 << k) | (b[i] >> (8 - k)), b[i] >> (7 - k) & 1
    for t in train:
        for ctx, q, bit in steps(t):
            for d in range(depth + 1):
                count[ctx[depth - d:], q][bit] += 1
                if d:
                    kids[ctx[depth - d + 1:], q].add(ctx[depth - d:])
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    memo = {}

    def lw(ctx, q):
        if (ctx, q) not in memo:
            le = kt(*count[ctx, q])
            memo[ctx, q] = le if len(ctx) == depth else np.logaddexp(le, sum(lw(c, q) for c in kids[ctx, q])) - math.log(2)
        return memo[ctx, q]
    total = 0.0
    for ctx, q, bit in steps(text):
        p, rest = 0.0, 1.0
        known = [d for d in range(depth + 1) if (ctx[depth - d:], q) in count]
        if not known:
            total += math.log10(.5)
            continue
        for d in known:
            a, b = count[ctx[depth - d:], q]
            own = 1.0 if d == known[-1] else math.exp(kt(a, b) - math.log(2) - lw(ctx[depth - d:], q))
            p += rest * own * (b + .5) / (a + b + 1)
            rest *= 1 - own
        total += math.log10(p if bit else 1 - p)
    return total


def test_ctw_equals_recursion(spark):
    train = ["the cat sat", "the cat ran", "", "a dog sat on the cat"]
    ask = ["the cat", "zebra", "", "the dog sat"]
    t = spark.createDataFrame([(t,) for t in train], "text string")
    a = spark.createDataFrame(list(enumerate(ask)), "doc_id long, text string")
    got = {r.doc_id: r for r in ctw.score(ctw.train(t), a).collect()}
    for i, x in enumerate(ask):
        assert math.isclose(got[i].score, _brute_ctw(train, x, ctw.DEPTH), rel_tol=1e-9)
        assert got[i].n_bytes == len(x.encode()) and math.isclose(got[i].bits_per_byte * (len(x.encode()) + 1), -got[i].score / math.log10(2))
    n, v = sum(len(_words(x)) + 1 for x in train), len({w for x in train for w in _words(x)}) + 1
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens) == (2, 1, n)
    assert math.isclose(got[1].base_score, math.log10(.5 / (n + .5 * (v + 1))) + math.log10(4.5 / (n + .5 * (v + 1))))


# ---------------------------------------------------------------- 2

def test_code_length_counts_utf8_bytes_and_is_shorter_for_known_text(spark, monkeypatch):
    t = spark.createDataFrame([("the cat sat on the mat é",)] * 20, "text string")
    a = spark.createDataFrame([(1, "the cat sat on the mat é"), (2, "zq#x!"), (3, None), (3, None)], "doc_id long, text string")
    whole = {r.doc_id: r for r in ctw.score(ctw.train(t), a).collect()}
    assert whole[1].n_bytes == 25 and whole[3].n_bytes == 0 and whole[1].bits_per_byte < 1 < 6 < whole[2].bits_per_byte
    monkeypatch.setattr(ctw, "LOCAL_GRAMS", 4)                    # grams beyond the broadcast table are asked by a join
    monkeypatch.setattr(ctw, "LOCAL_WORDS", 2)
    asked = {r.doc_id: r for r in ctw.score(ctw.train(t), a).collect()}
    assert all(math.isclose(asked[k].bits_per_byte, r.bits_per_byte) and asked[k].n_bytes == r.n_bytes for k, r in whole.items())


def test_targets_stop_at_three_times():
    t = mixing.targets([10, 100, 1000], [1, 1, 1])
    assert t == [30.0, 300.0, 780.0] and sum(t) == 1110
    assert mixing.targets([0, 0], [1, 2]) == [0.0, 0.0] and mixing.targets([], []) == []


def test_mix_meets_targets_and_repeats(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.expr("if(doc_id % 9 = 0, 'tiny', if(doc_id % 7 = 0, null, 'big'))"))
    a, b = (sorted(map(tuple, mixing.taken(mixing.mix(d)).drop("source").collect())) for _ in range(2))
    assert a == b and all(x[4] <= 3 * x[1] for x in a)
    per = defaultdict(int)
    for x in a:
        per[x[2], x[3]] += x[4]
    assert all(abs(k - t) <= max(20, 0.01 * t) for (_, t), k in per.items())


# ---------------------------------------------------------------- 3

def test_tokens_equal_the_tokenizers_file():
    import random
    import public_tokenizers
    from tokenizers import Tokenizer
    whole, own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.Tokens(packing.tokenizer_path())
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "a", "Bc", "'s", "12", "!", "é", " ", "\x1c", "<|endoftext|>", ".", "日本", "\r\n", "\x85"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(own.ids(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_packing_is_whole_and_tight(spark, docs):
    own = packing.Tokens(packing.tokenizer_path())
    got = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    for i, t in docs:
        ids = own.ids(t or "") + b"\0\0\0\0"
        p = got[got.doc_id == i].sort_values("piece")
        assert p.length.sum() == len(ids) // 4 and (p.length[1:] == packing.LENGTH).all()
        for r in p.itertuples():
            assert r.ids_crc32 == zlib.crc32(ids[4 * r.start: 4 * (r.start + r.length)])
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert s.length.sum() <= packing.LENGTH and (s.offset == s.length.cumsum() - s.length).all()
    assert got.sequence_id.nunique() <= -(-got.length.sum() // packing.LENGTH) + 2


def test_configurations_beat_single_sizes():
    sizes, demand = np.array([1000, 700, 348]), np.array([30, 30, 30])
    used = packing.configurations(sizes, demand, 2048)
    assert all(c @ sizes <= 2048 for c, _ in used) and sum(n for _, n in used) == 30


# ---------------------------------------------------------------- 4

def test_jaccard_equals_all_pairs(spark, docs):
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()
    extra = [(9000 + k, " ".join(base[:20 + k])) for k in range(6)] + [(9100, " ".join(base).upper()), (9101, "p q"), (9102, "P  q\n")]
    rows = docs + extra
    sets = {i: frozenset(tuple(w[k: k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
            for i, w in ((i, _words(t)) for i, t in rows)}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(sets, 2):
        n = len(sets[a] & sets[b])
        if n and 100 * n >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), top(i)) for i, s in sets.items()}


def test_large_groups_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(base + [f"only{k}"])) for k in range(40)]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


# ---------------------------------------------------------------- 5

def test_flow_is_the_cheapest():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = 3
        supply = rng.integers(0, 4, n).tolist()
        room = resharding.equal_capacity(sum(supply) + 2, n)
        cost = rng.integers(0, 5, (n, n))
        flow = resharding.min_cost_flow(supply, room, lambda i, j: float(cost[i, j]))
        got = sum(cost[k] * v for k, v in flow.items())
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        best = min(sum(cost[i, j] for i, j in zip(units, to)) for to in itertools.product(range(n), repeat=len(units))
                   if all(to.count(j) <= room[j] for j in range(n)))
        assert got == best


def test_shards_are_even_and_gapless(spark):
    got = queries.QUERIES["op5_flow_reshard"](spark, SF).toPandas()
    for _, s in got.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
    per = got.groupby("shard")["size"].sum()
    assert len(got) == 200 and per.max() <= got["size"].sum() / 40 + got["size"].max()


def test_rewritten_files_hold_every_row(spark, tmp_dir):
    rows = [(None if k % 5 == 0 else k // 4, None if k == 7 else f"text {k} " * (k % 9), "x" * (k % 3), k) for k in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string, slot string, n long")
    moves = resharding.rewrite(d, F.col("n") % 3, f"{tmp_dir}/out", shards=4)
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted((r.n, r.doc_id, r.text, r.slot) for r in got.collect()) == sorted((r[3], *r[:3]) for r in rows)
    assert ({r[0]: r[1] for r in got.groupBy("shard").count().collect()}
            == {r[0]: r[1] for r in moves.groupBy("shard").count().collect()} and moves.count() == 200)


# ---------------------------------------------------------------- 6

def test_base_spans_equal_plain_patterns(docs):
    e = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for t in [t or "" for _, t in docs] + ["a@b.c@d.e a@@b.c x@y", "1.2.3.4.5.6.7.8 1234.1.1.1 300.1.1.1", "9" * 3000, "@a.b"]:
        s = pii.base_spans(t)
        assert [x[1:] for x in s if x[0] == "email"] == [m.span() for m in e.finditer(t)]
        assert [x[1:] for x in s if x[0] == "ip"] == [m.span() for m in ip.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    assert [x[0] for x in pii.base_spans(EDGE[7][1])] == ["email", "ip", "card", "phone"]


def _plain_base(t):
    """The contract's four kinds by plain patterns: [(kind, start, end)]."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m.group() if c.isdigit()]
        twice = [x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d))]
        if 13 <= len(d) <= 19 and sum(twice) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


def test_counts_digest_and_spans_equal_plain_patterns(spark, docs):
    odd = ["4111 1111 1111 1111 5500-0000-0000-0004x4111111111111112", "+1 (743) 555-3824+49 30 901820 +1 2 3", "+" + "1" * 16 + " +12345678",
           "é 378282246310005, 1.2.3.4 a@b.c +4411 22 33 44", "4111111111111111" * 2, "0000000000000 +0000000000"]
    rows = docs + [(90000 + i, t) for i, t in enumerate(odd)]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        base, r = _plain_base(t or ""), got[i]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        spans = [x for x in r.spans.split(",") if x]
        assert set(text.split(",")) - {""} <= set(spans)
        key = [(pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])) for x in spans]
        assert key == sorted(key) and len(set(spans)) == len(spans)


def test_copies_take_one_place_in_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "Selector", lambda docs: seen.extend(docs))
    rows = [("copy mail a@b.org and 4111 1111 1111 1111",)] * 3000 + [(f"text {k} mail u{k}@host.org",) for k in range(200)]
    pii.fit(spark.createDataFrame(rows, "text string"))
    assert len(seen) == 201


def test_overlaps_equal_all_pairs_and_long_lists_are_quick():
    rng = np.random.default_rng(1)
    at = np.cumsum(rng.integers(1, 6, 400))
    spans = [(int(a), int(b)) for a, b in zip(at[::2], at[1::2])]
    t = pii.Taken(spans)
    for a, b in rng.integers(0, at[-1] + 5, (3000, 2)):
        if a < b:
            assert t.overlaps(int(a), int(b)) == any(a < y and x < b for x, y in spans)
    long = " ".join(f"u{k}@h{k}.org j (at) h{k} (dot) org" for k in range(50_000))
    t0 = time.time()
    assert len(pii.candidates(long)) == 100_000 and time.time() - t0 < 20


def test_selection_adds_only_what_held_out_rows_support():
    good = [["card", 0, 19, 1, pii.features("4111 1111 1111 1111", "card", 0, 19)]]
    bad = [["card", 0, 16, 0, pii.features("x9234567890123456", "card", 1, 17)]]
    sel = pii.Selector([good if k % 2 else bad for k in range(1200)])
    assert sel.spans([good[0][:3] + [0] + good[0][4:]]) == [("card", 0, 19)] and sel.spans(bad) == []
    assert pii.replaced("mail a@b.cd now", [("email", 5, 11)]) == "mail [EMAIL] now"


def test_wide_forms_are_added_and_look_alikes_are_not(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abdeilmnorstu"), rng.integers(2, 9)))
    some = lambda k: " ".join(word() for _ in range(k))
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    rows = [(k, f"{some(9)} {word()}.{num(2)}@{word()}.{word()}.com {some(4)} +{rng.integers(1, 99)} ({num(3)}) {num(3)}-{num(4)} "
                f"{some(5)} {num(16)} {some(3)}", "en", "a") for k in range(1500)]
    ask = ["write to jane (at) host (dot) org today", "or bob.k [at] mail.host [dot] com please", "call (415) 555-2671 now",
           "call 00 49 30 901820 now", "order #20418377 of", "built on 2024-05-17 again", "hash 9f3ab18822347765cd1 is", "paid $12345.99 in",
           "come (at) noon. Then we go", "isbn 978-3-16-148410-0 is", "at 1234567890123456 then"]
    d = spark.createDataFrame(rows + [(5000 + i, f"{some(5)} {t} {some(5)}", "en", "a") for i, t in enumerate(ask)], "doc_id long, text string, lang string, source string")
    text = {r.doc_id: r.text for r in d.filter("doc_id >= 5000").collect()}
    got = {r.doc_id: [(s.split(":")[0], text[r.doc_id][int(s.split(":")[1]): int(s.split(":")[2])]) for s in r.spans.split(",") if s]
           for r in pii.find(d).filter("doc_id >= 5000").collect()}
    assert [got[5000 + i] for i in range(4)] == [[("email", "jane (at) host (dot) org")], [("email", "bob.k [at] mail.host [dot] com")],
                                                 [("phone", "(415) 555-2671")], [("phone", "00 49 30 901820")]]
    assert not any(got[5000 + i] for i in range(4, len(ask)))


def test_boosting_learns_an_interaction():
    x = np.random.default_rng(0).integers(0, 4, (800, 3)).astype(float)
    y = ((x[:, 0] > 1) & (x[:, 1] > 1)).astype(float)
    assert ((boosting.Boosted().fit(x, y).raw(x) > 0) == y).mean() > .98


# ---------------------------------------------------------------- 7

def test_statistics_equal_plain_counts(spark):
    t = ["a b c a b c a b", "x\n\nx\n \nx y", "# $ %", "a a a a", "", None, "q"]
    got = outliers.statistics(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r, s in zip(got, t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", s or "") if x]
        at = defaultdict(list)
        for i in range(len(w) - 2):
            at[tuple(w[i: i + 3])].append(i)
        rep = {j for v in at.values() if len(v) > 1 for i in v for j in (i, i + 1, i + 2)}
        lines = [x for x in (s or "").split("\n") if x.strip(" \t\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", s or "")), len(lines) - len(set(lines)), len(rep))


def test_distance_is_mahalanobis_and_junk_goes(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = outliers.judge(d, ["doc_id"]).toPandas().set_index("doc_id")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id").join(got)
    lab = lab[~lab.base_failed]
    assert (lab[lab.quality == 1].kept).mean() > .99 and (~lab[lab.quality == 0].kept).mean() > .95


def test_long_clean_text_with_a_few_repeated_lines_stays(spark):
    rng = np.random.default_rng(7)
    words = [f"{a}{b}" for a in ("ta", "re", "mi", "so", "lan", "ver") for b in ("n", "do", "st", "ling", "ra", "e", "gu")]
    line = lambda n: " ".join(rng.choice(words, n)) + "."
    rows = [(k, "\n".join(line(12) for _ in range(rng.integers(6, 90))), "en", "web") for k in range(300)]
    rows += [(300 + k, r[1] + "\n" + r[1].split("\n")[0], "en", "web") for k, r in enumerate(rows[:5])]
    long = [f"{line(50)} {k}" for k in range(400)]
    rows += [(900, "\n".join(long + long[:3]), "en", "web")]
    copies = [line(2) for _ in range(8)]
    rows += [(901, "\n".join([*copies * 4, *(line(12) for _ in range(8))]), "en", "web")]
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), ["doc_id"]).collect()}
    assert got[900].n_words > 20_000 and got[900].n_dup_lines == 3 and got[900].kept
    assert all(got[300 + k].kept for k in range(5)) and not got[901].kept


# ---------------------------------------------------------------- 8

def test_cut_equals_all_labellings():
    rng = np.random.default_rng(2)
    for _ in range(60):
        n = 7
        gain = rng.normal(0, 1, n)
        edges = [(a, b, float(rng.random())) for a, b in itertools.combinations(range(n), 2) if rng.random() < .5]
        cost = lambda v: sum(-g * x for g, x in zip(gain, v)) + sum(c for a, b, c in edges if v[a] != v[b])
        assert math.isclose(cost(mincut.min_cut(gain, edges)), min(map(cost, itertools.product((0, 1), repeat=n))), abs_tol=1e-9)


def test_article_is_extracted(spark):
    w = mincut.fit([])
    page = ('<html><head><title>T</title><style>p{}</style></head><body><nav><a href="/">Home</a></nav><div class="ad">Buy</div>'
            '<article><h1>A &amp; B</h1><p>First,\n one long<br>line.<p><b>Second</b> line &lt;x&gt;.</article>'
            '<script>var t="</p>";</script><footer>&copy; me</footer></body></html>')
    assert mincut.extract(page, w) == "A & B\n\nFirst, one long line.\n\nSecond line <x>."
    got = mincut.main_text(spark.createDataFrame([(1, "u", None), (2, "v", ""), (3, "w", page)], "page_id long, url string, html string")).collect()
    assert [(r.text, r.n_chars) for r in sorted(got)][:2] == [("", 0), ("", 0)]


def test_scripts_and_missing_end_tags_do_not_swallow_the_article():
    w = mincut.fit([])
    text = "<article><h1>A</h1><p>First, one long line of it.</p>%s<p>Second line, as long as that.</p></article>"
    whole = "A\n\nFirst, one long line of it.\n\nSecond line, as long as that."
    for s in ("<script>for(var i=0;i<n;i++){f(i)}</script>", "<SCRIPT>if(a<b)x='</p'</Script >", "<style>a<b{}</style>",
              "<noscript><img alt='a<b'></noscript>", "<textarea><i</textarea>", "<iframe><b <</iframe>", "<script>'<!--'</script>",
              "<svg><g><svg></svg></g><title>t<u</title></svg>", "<div><svg><path d='M0'></div>", "<div><object data='x'><param name='y'></div>",
              "<div><select><option>1<option>2</div>", "<ul><li><canvas></li></ul>", "<div><noscript><img></div>", "<span><svg></span>"):
        assert mincut.extract(f"<html><body>{text % s}<script>i<n</script></body></html>", w) == whole, s


# ---------------------------------------------------------------- 9

def test_links_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 16))
    x[50:90] = x[0] + rng.normal(0, .08, (40, 16))
    x[90:110] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, None), (301, [0.0] * 16), (302, [float("nan")] * 16), (303, [1.0, 2.0]), (304, [2.0, 4.0])]
    got = {r.vec_id: r for r in multi_index.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= .9
    assert sum(got[i].n_links for i in range(300)) >= .99 * (near.sum() - 300)
    assert got[60].component_id == 0 and got[100].n_links >= 19 and got[303].n_links == 1 and got[304].component_id == 303
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (300, 301, 302))


def test_rare_links_are_found_and_count_for_both(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    u = rng.normal(size=(300, 64))
    u -= (u * x[:300]).sum(1)[:, None] * x[:300]
    u /= np.linalg.norm(u, axis=1)[:, None]
    c = rng.uniform(.901, .99, (300, 1))
    x[3000:3300] = c * x[:300] + np.sqrt(1 - c ** 2) * u
    got = {r.vec_id: r for r in multi_index.near_duplicates(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    found = [k for k in range(300) if got[3000 + k].component_id == k]
    assert len(found) >= 299 and all(got[k].n_links == got[3000 + k].n_links == 1 for k in found)


def test_rank_counts_the_cells_before():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 10))
    books = multi_index.Codebooks(x, 12)
    order = books.order(x[:20], 144)
    assert all(sorted(o) == list(range(144)) for o in order)
    rows, at = np.repeat(np.arange(20), 144), np.tile(np.arange(144), 20)
    assert (books.rank(x[:20], rows, order.ravel()) == at).all()
    assert (books.order(x[:20], 7) == order[:, :7]).all() and (books.cell(x[:20]) == order[:, 0]).all()


@pytest.mark.parametrize("block, per_cell", [(2048, 1), (40, 1), (40, 64)])
def test_links_of_fine_grids_and_small_blocks(spark, monkeypatch, block, per_cell):
    """More cells than WORDS gives, groups of many cells, and cells dealt into blocks: the same links as of all pairs."""
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "PER_CELL", per_cell)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2500, 24))
    x[500:900] = x[7] + rng.normal(0, .12, (400, 24))           # a hot cell: different vectors close together
    x[900:1500] = x[1500:2100] + rng.normal(0, .2, (600, 24))
    x[2100:2200] = x[3]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= .9
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in multi_index.near_duplicates(
        spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    n = np.array([got[i].n_links for i in range(len(x))])
    assert (n <= near.sum(1)).all() and n.sum() >= .99 * near.sum()
    comp = np.arange(len(x))
    for _ in range(60):
        comp = np.minimum(comp, np.where(near, comp[None], len(x)).min(1))
    assert np.mean([got[i].component_id == comp[i] for i in range(len(x))]) >= .995


# ---------------------------------------------------------------- 10 and the pipeline

def test_held_out_languages(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    p = queries.QUERIES["op10_centroids"](spark, "/root/testdata/sf0.01").join(d, "doc_id").filter("held_out")
    assert p.filter("lang = lang_pred").count() >= .97 * p.count()


def test_every_language_is_learned_and_copies_take_one_place(spark, monkeypatch):
    monkeypatch.setattr(language, "PER_LANG", 6)
    seen = {}
    monkeypatch.setattr(language, "Centroids", lambda idf, texts: seen.update(texts))
    rows = [(f"der text nummer {k}", "de") for k in range(4) for _ in range(100)] + [(f"the text {k}", "en") for k in range(50)]
    rows += [("one text of very many copies", "fr")] * 400 + [(f"un autre {k}", "fr") for k in range(5)] + [(None, "it"), ("x", None)]
    language.train(spark.createDataFrame(rows, "text string, lang string"))
    assert {k: len(v) for k, v in seen.items()} == {"de": 4, "en": 6, "fr": 6} and all(len(set(v)) == len(v) for v in seen.values())


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    d = spark.read.parquet(f"{SF}/documents.parquet")
    first, sizes = d, []
    for k, (_, f) in enumerate(P.STAGES):
        d = C.stored(f(spark, d, SF))
        sizes.append(d.count())
        assert k == len(P.STAGES) - 1 or d.columns == C.DOC_COLS
    assert first.count() >= sizes[0] >= sizes[1] == sizes[2] > 0 and sizes[4] >= sizes[3] > 0
