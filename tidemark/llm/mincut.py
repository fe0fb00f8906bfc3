"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks (the text between block-level tags, markup
removed). A logistic classifier gives each block its cost of being content or
boilerplate; neighbouring blocks, and blocks that are neighbours within the
same DOM parent, pay for getting different labels. The labelling of least
total cost is a minimum cut: terminals carry the classifier's costs, edges
the smoothness, and maximum flow finds it.

The classifier learns from weak labels of at most ``SAMPLE`` pages: blocks
inside an article or main element are content; blocks in navigation, headers,
footers, asides and forms are not. Structural features are hidden at random
while learning, so pages without such elements are judged by class names,
links, length and punctuation.

Pages are independent: one pass, no shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common as C
from tidemark.llm.boosting import sigmoid

SAMPLE = 1500
NEXT, SIBLING = 0.35, 0.35        # smoothness: neighbours in the page; neighbours within a parent

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|</?[A-Za-z][^\s/>]*(?:\"[^\"]*\"|'[^']*'|[^'\">])*>|[^<]+|<", re.S)
# the same without heed of quotes: after a tag whose quote never ends
_LOOSE = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|</?[A-Za-z][^>]*>|[^<]+|<", re.S)
_OPENS = re.compile(r"</?[A-Za-z]")
_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)")
_HINT = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# fixed values: HTML's element kinds
_RAW = {"script", "style", "noscript", "template", "textarea", "svg", "iframe", "select", "title",
        "annotation", "annotation-xml"}
# their bodies hold no markup: only their own end tag ends them
_OPAQUE = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in ("script", "style", "title", "textarea", "noscript", "iframe")}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
_BREAKS = {"hr", "col"}            # void elements that end a block; the others stand in the line
_INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
           "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
           "canvas", "object", "math", "semantics", "mi", "mn", "mo", "ms", "mrow", "mfrac", "msqrt", "mroot", "msub", "msup",
           "msubsup", "munder", "mover", "munderover", "mstyle", "mpadded", "mphantom", "menclose", "mmultiscripts"}
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_GOOD = {"article", "main"}
_BAD = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button"}
_BAD_NAME = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|gdpr|popup|modal|overlay|"
                       r"sidebar|side|menu|nav\w*|breadcrumbs?|footer|foot|header|masthead|comments?|replies|reply|disqus|"
                       r"related|recommend\w*|share|sharing|social|subscribe|newsletter|signup|login|search|widget|toolbar|"
                       r"pagination|pager|tags|legal|copyright)(?:$|[\s_-])", re.I)
_GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|body|text|main)(?:$|[\s_-])", re.I)


class Open:
    """An open element and what it and the elements above it say of their text."""
    __slots__ = ("name", "good", "bad", "bad_name", "good_name", "serial")

    def __init__(self, name, hint, serial, above):
        self.name, self.serial = name, serial
        self.good = name in _GOOD or (above is not None and above.good)
        # a header of the article itself holds its title, not the site's
        self.bad = (name in _BAD and not (name == "header" and self.good)) or (above is not None and above.bad)
        self.bad_name = bool(hint and _BAD_NAME.search(hint)) or (above is not None and above.bad_name)
        self.good_name = bool(hint and _GOOD_NAME.search(hint)) or (above is not None and above.good_name)


class Block:
    __slots__ = ("text", "link", "tag", "good", "bad", "bad_name", "good_name", "parent")

    def __init__(self, text, link, stack):
        top = stack[-1] if stack else None
        self.text, self.link, self.tag = text, link, top.name if top else ""
        self.good, self.bad = bool(top and top.good), bool(top and top.bad)
        self.bad_name, self.good_name = bool(top and top.bad_name), bool(top and top.good_name)
        # a block is in its own element; its siblings share what is above it
        self.parent = stack[-2].serial if len(stack) > 1 else 0


def blocks(page: str) -> list[Block]:
    """Non-empty blocks of a page in order, character references decoded, white space as one space.

    Scripts and their like are skipped up to their own end tag, whatever is
    between; without one, a script or style takes the rest of the page, as in
    browsers. Other skipped elements without an end tag end with their parent.
    Quotes hide a ``>`` in a tag, until a tag's quote never ends: it and all
    later ones end at their next ``>``; after the last ``>`` there is only text.
    Formulas and the content of ``object`` and ``canvas`` are text of their block.
    The time is linear in the page's length, whatever its markup.
    """
    out: list[Block] = []
    stack: list[Open] = []
    n_open: Counter[str] = Counter()     # open elements by name
    text: list[str] = []
    link, in_link, skip, serial = 0, 0, None, 0
    inner: list[str] = []      # open elements within the skipped one
    n_inner: Counter[str] = Counter()
    endless: set[str] = set()  # without an end tag from some place on

    def flush():
        nonlocal link
        if text:
            s = " ".join(html.unescape("".join(text)).split())
            if s:
                out.append(Block(s, link, stack))
            text.clear()
        link = 0

    at, token, last = 0, _TOKEN, page.rfind(">")
    while at < len(page):
        if page[at] == "<" and at > last and not page.startswith("<!--", at):
            # no tag can end here: text up to a comment, if there is one
            end = page.find("<!--", at)
            m, at = at, len(page) if end < 0 else end
            tok = "\0" + page[m:at]
        else:
            m = token.match(page, at)
            if token is _TOKEN and m.group() == "<" and _OPENS.match(page, at):
                token = _LOOSE
                m = token.match(page, at)
            at = m.end()
            tok = m.group()
        if tok[0] != "<" or len(tok) == 1:
            tok = tok.removeprefix("\0")
            if skip is None:
                text.append(tok)
                if in_link:
                    link += len(tok.strip())
            continue
        if tok[1] in "!?":
            continue
        name = _TAG.match(tok).group(1).lower()
        closing = tok[1] == "/"
        if name in _OPAQUE and not closing and not tok.endswith("/>"):
            end = None if name in endless else _OPAQUE[name].search(page, at)
            if end:
                at = end.start()
                continue
            endless.add(name)
            if name in ("script", "style"):
                break
        if skip is not None:
            if not closing:
                if name not in _VOID and not tok.endswith("/>"):
                    inner.append(name)
                    n_inner[name] += 1
                continue
            if n_inner[name]:
                while True:
                    gone = inner.pop()
                    n_inner[gone] -= 1
                    if gone == name:
                        break
                continue
            if name == skip:
                skip = None
                continue
            if name not in _INLINE and not n_open[name]:
                continue
            skip = None        # the parent's end; it is handled as any other
        if name in _RAW:
            if not closing and not tok.endswith("/>"):
                skip = name
                inner.clear()
                n_inner.clear()
            continue
        if name in _INLINE:
            if name == "a":
                in_link = max(0, in_link + (-1 if closing else 1))
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in _VOID and name not in _BREAKS:
            continue
        flush()
        if name in _VOID:
            continue
        if closing:
            if n_open[name]:
                while True:
                    gone = stack.pop().name
                    n_open[gone] -= 1
                    if gone == name:
                        break
                in_link = 0
            continue
        # a new block ends an open paragraph; list items and cells end their like
        ends = _CLOSES.get(name, set()) | {"p"}
        while stack and stack[-1].name in ends:
            n_open[stack.pop().name] -= 1
        if tok.endswith("/>"):
            continue
        serial += 1
        hint = " ".join(a or b or c for a, b, c in _HINT.findall(tok)) if "=" in tok else ""
        stack.append(Open(name, hint, serial, stack[-1] if stack else None))
        n_open[name] += 1
    flush()
    return out


HIDDEN = 4      # the first features are structural and may be hidden while learning


def features(bs: list[Block]) -> np.ndarray:
    n = len(bs)
    rows = []
    for k, b in enumerate(bs):
        s = b.text
        near = [len(bs[j].text) for j in (k - 1, k + 1) if 0 <= j < n]
        rows.append([b.good and not (b.bad or b.bad_name), b.bad, b.bad_name, b.good_name and not b.bad_name,
                     min(1.0, b.link / max(1, len(s))), math.log1p(len(s)) / 5, s[-1] in ".!?\"”»…",
                     b.tag[:1] == "h" and b.tag[1:].isdigit(), b.tag == "li", b.tag == "p",
                     s.startswith(("©", "(c)", "Copyright")), math.log1p(s.count(",") + s.count(".")) / 3,
                     math.log1p(sum(near) / max(1, len(near))) / 5, 1.0])
    return np.array(rows, float).reshape(n, 14)


def weak_labels(bs: list[Block]) -> list[int | None]:
    return [0 if b.bad or b.bad_name else 1 if b.good else None for b in bs]


def fit(pages: list[str], seed: int = 5) -> np.ndarray:
    """Logistic weights from the weak labels; without labels of both kinds, fixed plain weights."""
    xs, ys = [], []
    for p in pages:
        bs = blocks(p)
        if bs:
            x, y = features(bs), weak_labels(bs)
            keep = [i for i, v in enumerate(y) if v is not None]
            xs.append(x[keep])
            ys.extend(y[i] for i in keep)
    # prior beliefs, in the order of features(); learning starts from and is drawn to them
    prior = np.array([3.0, -4.0, -4.0, 1.5, -3.0, 0.8, 0.8, 0.2, -0.5, 0.8, -2.0, 0.4, 0.3, -1.0])
    if len(set(ys)) < 2:
        return prior
    x, y = np.concatenate(xs), np.array(ys, float)
    w = prior.copy()
    weight = np.where(y == 1, .5 / y.mean(), .5 / (1 - y.mean()))
    rng = np.random.default_rng(seed)
    for step in range(300):
        v = x.copy()
        v[rng.random(len(v)) < .5, :HIDDEN] = 0
        g = v.T @ ((y - sigmoid(v @ w)) * weight) / len(y) - 0.01 * (w - prior)
        w += 0.5 * g
    w[0], w[1], w[2] = max(w[0], prior[0]), min(w[1], prior[1]), min(w[2], prior[2])
    return w


def min_cut(gain: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Labels of least cost: ``gain`` is what label 1 saves against label 0, an edge costs where labels differ.

    Blocks whose gain outweighs all their open edges are decided at once (no
    cut can do better) and pass the edge's worth on to their neighbours; what
    is left is a maximum flow from source (label 1) to sink.
    """
    n = len(gain)
    label = np.full(n, -1)
    gain = gain.astype(float).copy()
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        near[a][b] = near[a].get(b, 0) + c
        near[b][a] = near[b].get(a, 0) + c
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] >= 0 or abs(gain[i]) < sum(near[i].values()):
            continue
        label[i] = int(gain[i] > 0)
        for j, c in near[i].items():
            gain[j] += c if label[i] else -c
            del near[j][i]
            todo.append(j)
        near[i] = {}
    rest = np.flatnonzero(label < 0)
    if not len(rest):
        return label
    # Dinic on the undecided blocks
    at = {int(v): k for k, v in enumerate(rest)}
    s, t = len(rest), len(rest) + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(len(rest) + 2)]

    def add(u, v, c, back):
        out[u].append(len(to))
        to.append(v)
        cap.append(c)
        out[v].append(len(to))
        to.append(u)
        cap.append(back)

    for v, k in at.items():
        if gain[v] > 0:
            add(s, k, gain[v], 0.0)
        elif gain[v] < 0:
            add(k, t, -gain[v], 0.0)
        for j, c in near[v].items():
            if j > v:
                add(k, at[j], c, c)
    while True:
        level = [-1] * len(out)
        level[s] = 0
        q = deque([s])
        while q:
            u = q.popleft()
            for e in out[u]:
                if cap[e] > 1e-12 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    q.append(to[e])
        if level[t] < 0:
            break
        it = [0] * len(out)
        while True:                      # one augmenting path at a time, without recursion
            path, u = [], s
            while u != t:
                while it[u] < len(out[u]):
                    e = out[u][it[u]]
                    if cap[e] > 1e-12 and level[to[e]] == level[u] + 1:
                        break
                    it[u] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    u = to[e ^ 1]
                    it[u] += 1
                    continue
                path.append(e)
                u = to[e]
            if u != t:
                break
            f = min(cap[e] for e in path)
            for e in path:
                cap[e] -= f
                cap[e ^ 1] += f
    for v, k in at.items():
        label[v] = int(level[k] >= 0)    # reached from the source: content
    return label


def extract(page: str, w: np.ndarray) -> str:
    bs = blocks(page)
    if not bs:
        return ""
    gain = features(bs) @ w
    edges = [(k, k + 1, NEXT) for k in range(len(bs) - 1)]
    last: dict[int, int] = {}
    for k, b in enumerate(bs):
        if b.parent in last:
            edges.append((last[b.parent], k, SIBLING))
        last[b.parent] = k
    label = min_cut(gain, edges)
    return "\n\n".join(b.text for b, v in zip(bs, label) if v)


_PAGE = "page_id long, url string, text string, n_chars long"


def _extract(w_b):
    schema = C.arrow(_PAGE)

    def run(batches):
        w = w_b.value
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                p = b.slice(lo, 200)
                text = [extract(x, w) if x else "" for x in p.column(2).to_pylist()]
                yield C.out_batch(schema, page_id=p.column(0), url=p.column(1), text=text, n_chars=[len(x) for x in text])
    return run


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row a page: page_id, url, text, n_chars. Null or empty pages have the empty text."""
    d = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    sample = (d.filter("html is not null").select(F.xxhash64("page_id", "url").alias("h"), "page_id", "url")
              .orderBy("h", "page_id", "url").limit(SAMPLE))
    rows = d.join(F.broadcast(sample.select("page_id", "url").distinct()), ["page_id", "url"]).select("html").limit(SAMPLE).collect()
    w = pages.sparkSession.sparkContext.broadcast(fit([r[0] for r in rows if r[0]]))
    return d.mapInArrow(_extract(w), C.struct(_PAGE))


def op8_mincut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(C.table(spark, sf_dir, "pages"))
