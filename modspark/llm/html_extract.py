"""Main text of web pages by a minimum cut.

A page is cut into blocks of text.  A logistic model, fitted on blocks that pages themselves declare to be
article or not, gives each block bounded log odds; these are capacities to the two terminals of a flow
network.  Blocks that are neighbours in the page, or in one container of its tree, are joined by
smoothness edges, stronger the nearer they are.  The minimum cut is the labelling of least total cost.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from math import log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<(script|style|noscript|template|iframe|svg|textarea|select|object|math)\b[^>]*>.*?(?:</\1\s*>|\Z)
    |<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)/?>
    |<[/!?][^>]*(?:>|\Z)
    |<[a-zA-Z][^<>]*(?:>|\Z)""",
    re.S | re.I | re.X,
)
_NAME = re.compile(r"""\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD_PARTS = re.compile(r"[a-z]+")

BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title head tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK_TAGS - {"button", "label"}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PROSE = frozenset(("p", "pre", "blockquote"))
ITEMS = frozenset(("li", "td", "th", "dt", "dd", "option"))
CONTENT_TAGS = frozenset(("article", "main"))
NEVER = frozenset(("head", "title"))
#: Tags that declare what they hold to be no article; a form around the article does not.
BOILER_TAGS = frozenset("nav footer aside menu dialog button option label fieldset legend form head title".split())
CONTENT_NAMES = frozenset("article articlebody content post entry story main maincontent text".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion promoted cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login "
    "signin register nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar aside rail footer foot masthead "
    "topbar toolbar header comment comments commentlist reply replies respond discussion disqus feedback reactions "
    "share sharing social related recommended recommendations trending popular more pagination pager widget widgets "
    "search searchbox form copyright legal disclaimer skip tags taglist byline complementary contentinfo "
    "dialog".split()
)
#: A name with one of these says how its element looks or what the page has, not what the element is.
STATE_WORDS = frozenset("has with without no not is are single layout theme page fixed free sticky enabled disabled".split())

#: Features of a block and the log odds for content that the fit starts from.
WEIGHTS = {
    "bias": -1.5, "words": 4.0, "links": -4.0, "sentence": 0.5, "heading": 1.5, "prose": 1.5, "item": -0.5,
    "content_tag": 4.0, "content_name": 2.5, "boiler_tag": -8.0, "boiler_name": -7.0,
}
FEATURES = tuple(WEIGHTS)
OWN_FEATURES = FEATURES.index("content_tag")  # those before it are of the block itself, the others of containers
MANY_WORDS, RUNNING = 40, 10
BOUND = 4.0
NEAR, SAME_CONTAINER = 1.0, 1.2
#: Bounds of the fit's sample: pages, blocks of a page; and the weight of all of it against the start.
SAMPLE_PAGES, SAMPLE_BLOCKS, SAMPLE_WEIGHT = 2000, 64, 100.0

NONE, CONTENT, CONTENT_NAMED, BOILER_NAMED, BOILER = range(5)


class Block(NamedTuple):
    text: str
    features: tuple[float, ...]
    state: int
    parent: int  # container around the block's own
    depth: int  # containers on the path to the root
    shared: int  # of these, shared with the block before


class _Element:
    __slots__ = ("tag", "parent", "depth", "box", "sign", "declared", "state", "keys", "above", "running")

    def __init__(self, tag: str, parent: int, depth: int, box: int, sign: int):
        self.tag, self.parent, self.depth, self.box, self.sign = tag, parent, depth, box, sign
        self.declared = False  # inside a tag that says so
        self.state = NONE
        self.keys = self.above = self.running = 0


def _name_sign(attributes: str) -> int:
    """-1 if a class, id or role is a name of boilerplate, 1 for one of content, else 0."""
    sign = 0
    for found in _NAME.findall(attributes):
        for name in "".join(found).replace("articleBody", "articlebody").lower().split():
            words = set(_WORD_PARTS.findall(name))
            if words & STATE_WORDS:
                continue
            if words & BOILER_NAMES and not ("content" in words and "more" in words):
                return -1
            if words & CONTENT_NAMES:
                sign = 1
    return sign


def _resolve(elements: list[_Element], raw: list[tuple]) -> None:
    """The state of every element: what the nearest container that says something says.

    A name of boilerplate does not count for an element that holds all there is to the page: each article,
    first heading, container named for content, and block of running text.
    """
    total = 0
    for e in elements[1:]:  # parents stand before their children
        up = elements[e.parent]
        e.declared = up.declared or (e.tag in BOILER_TAGS and e.tag != "form")
        e.above = up.above
        if not e.declared and (e.tag in CONTENT_TAGS or e.sign > 0):
            e.keys = 1
            total += 1
            e.above += 1
    for _text, at, words, link_share, heading in raw:
        e = elements[at]
        if not e.declared and (heading == "h1" or (words >= RUNNING and link_share < 0.3)):
            e.keys += 1
            e.running += words >= RUNNING
            total += 1
    for e in reversed(elements[1:]):
        elements[e.parent].keys += e.keys
        elements[e.parent].running += e.running
    for e in elements[1:]:
        up = elements[e.parent]
        own = e.keys and (e.tag in CONTENT_TAGS or e.sign > 0)
        whole = total > 0 and e.keys + e.above - bool(own) == total
        wraps = whole and (e.running > 1 or e.keys > e.running)
        if up.state == BOILER or (e.tag in BOILER_TAGS and not (e.tag == "form" and wraps)):
            e.state = BOILER
        elif e.tag == "header" and up.state not in (CONTENT, CONTENT_NAMED):
            e.state = BOILER
        elif up.state == BOILER_NAMED or (e.sign < 0 and e.tag not in ("html", "body", "main") and not wraps):
            e.state = BOILER_NAMED
        elif e.tag in CONTENT_TAGS:
            e.state = CONTENT
        elif e.sign > 0 and up.state == NONE and e.tag not in ("html", "body"):
            e.state = CONTENT_NAMED
        else:
            e.state = up.state


def page_blocks(page: str) -> list[Block]:
    """The blocks of text of a page in order, with their features and places in its tree."""
    elements = [_Element("", 0, 0, 0, 0)]
    raw: list[tuple[str, int, int, float, str]] = []  # text, element, words, share in links, heading
    shares: list[int] = []
    stack = [0]
    still_open: Counter[str] = Counter()
    parts: list[str] = []
    sizes = [0, 0]  # characters of the block, and of those in links
    heading = ""
    lowest = 0  # containers that stayed open since the last block

    def close_block() -> None:
        nonlocal heading, lowest
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text and not (still_open["head"] or still_open["title"]):
                raw.append((text, stack[-1], text.count(" ") + 1, sizes[1] / max(1, sizes[0]), heading))
                shares.append(lowest)
                lowest = elements[stack[-1]].depth
        sizes[0] = sizes[1] = 0
        heading = ""

    def pop_to(depth: int) -> None:
        nonlocal lowest
        for at in stack[depth:]:
            still_open[elements[at].tag] -= 1
        del stack[depth:]
        lowest = min(lowest, elements[stack[-1]].depth)

    def add(text: str) -> None:
        parts.append(text)
        sizes[0] += len(text)
        if still_open["a"]:
            sizes[1] += len(text)

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1]:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag in BLOCK_TAGS:
            close_block()
        if m[2]:
            if still_open[tag]:
                for depth in range(len(stack) - 1, 0, -1):
                    above = elements[stack[depth]].tag
                    if above == tag:
                        pop_to(depth)
                        break
                    if above in ("article", "main", "body", "table") and tag in ("p", "li", "b", "i", "a", "span"):
                        break
            continue
        if tag == "br":
            parts.append(" ")
        if tag in VOID_TAGS:
            continue
        if tag == "body" and still_open["head"]:
            pop_to(next(d for d, e in enumerate(stack) if elements[e].tag == "head"))
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                above = elements[stack[depth]].tag
                if above == "p" or (above == tag and tag in ("li", "dd", "dt", "td", "tr", "th", "option")):
                    pop_to(depth)
                    break
                if above in BLOCK_TAGS:
                    break
        up = elements[stack[-1]]
        attributes = m[4]
        sign = _name_sign(attributes) if attributes and "=" in attributes else 0
        is_block = tag in BLOCK_TAGS
        elements.append(_Element(tag, stack[-1], up.depth + is_block, len(elements) if is_block else up.box, sign))
        stack.append(len(elements) - 1)
        still_open[tag] += 1
        if tag in HEADINGS:
            heading = heading or tag
    if at < len(page):
        add(page[at:])
    close_block()

    _resolve(elements, raw)
    blocks = []
    for (text, own, words, link_share, h), shared in zip(raw, shares, strict=True):
        e = elements[own]
        box = elements[e.box]
        features = (
            1.0, min(1.0, log(1 + words) / log(1 + MANY_WORDS)), link_share, float(text[-1] in ".!?…。！？"),
            float(bool(h)), float(box.tag in PROSE), float(box.tag in ITEMS),
            float(e.state == CONTENT), float(e.state == CONTENT_NAMED), float(e.state == BOILER),
            float(e.state == BOILER_NAMED),
        )
        blocks.append(Block(text, features, e.state, elements[box.parent].box, e.depth, min(shared, e.depth)))
    return blocks


def block_scores(blocks: list[Block], weights: Iterable[float] = tuple(WEIGHTS.values())) -> list[float]:
    """Log odds for content, at most ``BOUND`` either way, so that neighbours can outvote a block."""
    if not blocks:
        return []
    found = np.array([b.features for b in blocks]) @ np.fromiter(weights, float)
    return np.clip(found, -BOUND, BOUND).tolist()


def smoothness_edges(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between neighbours, by how much of their paths they share, and to the last block before
    that has the same container: two for each block at most."""
    edges, last_in = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, NEAR * b.shared / max(1, b.depth, blocks[i - 1].depth)))
        if b.parent in last_in:
            edges.append((last_in[b.parent], i, SAME_CONTAINER))
        last_in[b.parent] = i
    return edges


def content_side(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: a block pays |score| for the label against its sign, an edge its weight if
    its ends differ.  Maximum flow by shortest augmenting levels; the blocks that the source still
    reaches are content."""
    n = len(scores)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def join(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, s in enumerate(scores):
        if s > 0:
            join(source, i, s, 0.0)
        elif s < 0:
            join(i, sink, -s, 0.0)
    for a, b, w in edges:
        if w > 0:
            join(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[a] < len(out[a]):
                e = out[a][following[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            else:
                if not path:
                    break
                e = path.pop()
                a = to[e ^ 1]
                following[a] += 1
                continue
            path.append(e)
            a = to[e]


def main_text(page: str, weights: Iterable[float] = tuple(WEIGHTS.values())) -> str:
    """The content blocks of a page joined by blanks."""
    blocks = page_blocks(page)
    kept = content_side(block_scores(blocks, weights), smoothness_edges(blocks))
    return " ".join(b.text for b, k in zip(blocks, kept, strict=True) if k)


def _labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features and labels of blocks in declared containers, evenly spaced over a page above the bound."""
    for batch in batches:
        for key, page in zip(batch.column("_key").to_pylist(), batch.column("_html").to_pylist(), strict=True):
            found = [b for b in page_blocks(page or "") if b.state in (CONTENT, BOILER)]
            step = -(-len(found) // SAMPLE_BLOCKS) or 1
            chosen = found[::step]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(chosen), pa.int64()), pa.array(range(len(chosen)), pa.int32()),
                 pa.array([list(b.features) for b in chosen], pa.list_(pa.float64())),
                 pa.array([float(b.state == CONTENT) for b in chosen], pa.float64())],
                names=["_key", "_no", "features", "label"],
            )


def fit_weights(pages: DataFrame, id_col: str = "page_id", page: str = "html") -> list[float]:
    """Weights of the block model: maximum a posteriori around ``WEIGHTS``.

    Labels are what pages declare: blocks in an article or main element are content, blocks in a nav,
    footer, aside, form and the like are not.  Each counts twice, as it is and without its containers,
    so that the block's own features learn to do without.  The sample is the ``SAMPLE_PAGES`` pages of
    smallest hash of the id (at most ``SAMPLE_BLOCKS`` blocks of each); all of it weighs like
    ``SAMPLE_WEIGHT`` blocks of each label.  Without labels of both kinds ``WEIGHTS`` are returned.
    """
    key = F.xxhash64(F.col(id_col).cast("long"))
    keys = pages.select(key.alias("_key")).distinct().orderBy("_key").limit(SAMPLE_PAGES)
    rows = pages.select(key.alias("_key"), F.col(page).alias("_html")).join(F.broadcast(keys), "_key", "left_semi")
    # Ids that repeat give one page each: the first text.
    sample = rows.groupBy("_key").agg(F.min("_html").alias("_html"))
    got = sample.mapInArrow(_labelled, "_key long, _no int, features array<double>, label double").orderBy("_key", "_no").collect()
    start = np.array(list(WEIGHTS.values()))
    y = np.array([r.label for r in got])
    if not got or y.min() == y.max():
        return start.tolist()
    x = np.array([r.features for r in got])
    blind = x.copy()
    blind[:, OWN_FEATURES:] = 0.0
    x, y = np.vstack([x, blind]), np.concatenate([y, y])
    each = np.where(y > 0, SAMPLE_WEIGHT / y.sum(), SAMPLE_WEIGHT / (1 - y).sum())
    w = start.copy()
    for _ in range(50):  # Newton steps on a strictly convex loss
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (each * (p - y)) + (w - start)
        hessian = (x * (each * p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return [round(float(v), 4) for v in w]


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html", weights: Iterable[float] | None = None,
) -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` (empty if there is none), ``n_chars`` (code points).

    ``weights`` of the block model are fitted on a bounded sample of the pages if not given.  Scripts,
    styles and comments of the markup never count; character references are decoded; white space inside
    a block becomes one blank.  A missing page is empty; an empty table gives no rows.  Rows are taken
    in place and each on its own, with no shuffle, so repeated rows and ids give one result each; columns
    beyond the three are not read, whatever their names.  A page of any length is held in memory once; the
    time grows with its blocks.  A block of equal costs (a tie of the cut) is boilerplate.
    """
    model = tuple(fit_weights(pages, id_col, page) if weights is None else weights)

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                texts = [main_text(h.as_py() or "", model) for h in part.column("_html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), part.column("_url"), pa.array(texts, type=pa.string()),
                     pa.array([len(t) for t in texts], type=pa.int64())], names=["_id", "_url", "text", "n_chars"],
                )

    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url).alias("_url"), F.col(page).alias("_html"))
    return rows.mapInArrow(extract, "_id long, _url string, text string, n_chars long").withColumnsRenamed(
        {"_id": id_col, "_url": url}
    )
