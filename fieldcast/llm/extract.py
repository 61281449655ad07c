"""Operator 9: main text of web pages by minimum-cut labelling.

A page is cut into text blocks. A logistic classifier gives each block the costs of calling it
boilerplate or content: these are the capacities of its edges to the two terminals. Blocks
that follow each other, and blocks that are close in the element tree, are tied by smoothness
edges. The minimum cut, found by maximum flow, labels all blocks of the page at once.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import deque
from dataclasses import dataclass, field as made

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 400            # pages that the classifier is fitted on, the smallest by a hash of the id
SAMPLE_BLOCKS = 200     # blocks of each of them at most
FOLLOW = 0.6            # capacity between blocks that follow each other
NEAR = 1.2              # capacity between blocks of one parent; less the further apart they are
LEVELS = 3              # ancestors through which blocks are tied

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
# How elements behave in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body canvas center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option"
    " p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "script style textarea title template iframe noembed noframes head select button datalist annotation"
    " annotation-xml".split())
RAW = frozenset("script style textarea title iframe noembed noframes".split())
CLOSES_P = BLOCKS - {"option", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("article aside body div footer form header html main nav section table td ul ol dl".split())

BAD_NAME = re.compile(
    r"(?:^|[-_\s])(?:ad|ads|adv|advert\w*|adsense|banner|promo\w*|sponsor\w*|nav\w*|menu\w*|footer|sidebar\w*"
    r"|comments?\w*|disqus|repl(?:y|ies)|respond|cookies?\w*|consent|gdpr|notification|popup|modal"
    r"|overlay|share|sharing|social|related|recommend\w*|breadcrumbs?|subscribe|newsletter|signup|login"
    r"|toolbar|pagination|pager|skip\w*)(?=$|[-_\s])", re.I)
#: Names that tell of boilerplate around an article, but of its own parts inside one.
VAGUE_NAME = re.compile(
    r"(?:^|[-_\s])(?:header|foot|masthead|side\w*|aside|notices?|alert|search|widget|copyright|legal|form|hidden|tags"
    r"|toc)(?=$|[-_\s])", re.I)
GOOD_NAME = re.compile(
    r"(?:^|[-_\s])(?:article\w*|post|entry|content|main|story|body|text|prose)(?=$|[-_\s])", re.I)
OWNER = re.compile(r"©|\(c\)\s*[12][0-9]{3}|\bcopyright\b|all rights reserved", re.I)
BAR = re.compile(r"\s[|·•»›/]\s")
COMMENT_HEAD = re.compile(
    r"\W*(?:[0-9]+\s+)?(?:(?:reader|user|leave a|add a|post a)\s+)?(?:comments?|responses?|replies|reply|kommentare?"
    r"|commentaires?|comentarios?)\W*(?:\(?[0-9]+\)?)?\W*", re.I)
END_MARK = re.compile(r"[.!?…。]['\"»”)]?\s*$")

LANDMARKS = frozenset(["nav", "footer", "aside", "form", "bad name", "vague name", "header", "hidden", "comments"])
MARKS = ["article", "main", "nav", "footer", "header", "aside", "form", "bad name", "vague name", "good name",
         "comments", "hidden"]
#: What is known of a block: marks of the elements around it, and its own text and place.
FEATURES = ["bias", *MARKS, "links", "long", "short", "sentence", "heading", "paragraph", "item", "owner", "bar", "edge"]
#: The weights before any page is seen; fitting moves them as far as the sample speaks for it.
PRIOR = np.array([-0.5, 4.0, 3.0, -7.0, -7.0, -4.0, -7.0, -6.0, -8.0, -4.0, 1.5, -7.0, -8.0,
                  -3.0, 2.0, -0.6, 1.0, 0.5, 0.5, -0.2, -3.0, -4.0, -0.3])


@dataclass
class Element:
    name: str
    kinds: frozenset
    path: tuple = ()                    # numbers of the block elements around it, the last few
    link: bool = False                  # whether it lies in a link
    block: "Element | None" = None      # the block element that text in it belongs to


@dataclass
class Block:
    text: str
    kinds: frozenset
    tag: str
    links: float
    path: tuple
    pieces: list = made(default_factory=list)


def kinds_of(name: str, attributes: str, above: frozenset) -> frozenset:
    """The marks that an element adds to those of its ancestors."""
    own = set()
    if name in ("article", "main", "nav", "footer", "aside", "form"):
        own.add(name)
    if name == "dialog":
        own.add("aside")
    if name == "header" and not above & {"article", "main"}:
        own.add("header")
    if attributes:
        values = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
        names = f"{values.get('class', '')} {values.get('id', '')}"
        if name not in ("html", "body", "article", "main"):
            if BAD_NAME.search(names):
                own.add("bad name")
            elif not above & {"article", "main"} and VAGUE_NAME.search(names):
                own.add("vague name")
        if GOOD_NAME.search(names):
            own.add("good name")
        role = {"navigation": "nav", "contentinfo": "footer", "banner": "header", "complementary": "aside",
                "search": "form", "form": "form", "dialog": "aside", "main": "main", "article": "article",
                "alert": "aside"}.get(values.get("role", "").lower())
        if role:
            own.add(role)
        style = values.get("style", "").replace(" ", "").lower()
        bare = re.sub(r"""=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", "=", attributes)
        if "display:none" in style or "visibility:hidden" in style or re.search(r"(?:^|\s)hidden(?=$|[\s/])", bare) \
                or values.get("aria-hidden") == "true":
            own.add("hidden")
    return above | own if own else above


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in order. Scripts, styles and controls have none. Elements may be
    nested to any depth: what is asked of the open ones is kept with each of them or by name."""
    out: list[Block] = []
    root = Element("#page", frozenset())
    root.block = root
    stack, places = [root], {}  # places: where elements of a name lie in the stack
    counter, pieces, linked, total, opened = 0, [], 0, 0, root

    def flush():
        nonlocal pieces, linked, total
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, opened.kinds, opened.name, linked / max(total, 1), opened.path))
        pieces, linked, total = [], 0, 0

    def add(text: str):
        nonlocal linked, total, opened
        if not pieces or not total:
            opened = stack[-1].block
        pieces.append(text)
        size = len(text.strip())
        total += size
        if stack[-1].link:
            linked += size

    def close(k: int):
        if any(e.name in BLOCKS for e in stack[k:]):
            flush()
        for e in stack[k:]:
            places[e.name].pop()
        del stack[k:]

    def last(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    at, end = 0, len(page)
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        if page.startswith("<!--", lt):
            stop = page.find("-->", lt + 4)
            at = end if stop < 0 else stop + 3
            continue
        if lt + 1 < end and page[lt + 1] in "!?":
            stop = page.find(">", lt)
            at = end if stop < 0 else stop + 1
            continue
        tag = TAG.match(page, lt) or LOOSE_TAG.match(page, lt)
        if not tag:
            if re.match(r"</?[a-zA-Z]", page[lt:lt + 3]):
                break  # a tag that the page ends in
            add("<")
            at = lt + 1
            continue
        at, name = tag.end(), tag[2].lower()
        if tag[1]:
            if name == "br":
                add(" ")
                continue
            k = last((name,))
            inner = name not in SCOPES and name not in ("p", "html", "table")
            if k and not (inner and last(("table", "article", "body")) > k):
                close(k)
            continue
        if name in SKIPPED and not tag[3].endswith("/"):
            stop = skipped_to(page, at, name)
            if name in BLOCKS:
                flush()
            at = stop
            continue
        if name == "br":
            add(" ")
            continue
        if name in BLOCKS:
            flush()
            closing = ({"p"} if name in CLOSES_P else set()) | SAME.get(name, set())
            k = last(closing)
            if k and last(SCOPES - closing) < k:
                close(k)
        if name not in VOID:
            counter += 1
            above = stack[-1]
            path = (*above.path, counter)[-LEVELS - 1:] if name in BLOCKS else above.path
            element = Element(name, kinds_of(name, tag[3], above.kinds), path, above.link or name == "a", above.block)
            if name in BLOCKS:
                element.block = element
            places.setdefault(name, []).append(len(stack))
            stack.append(element)
        elif name == "img":
            add(" ")
    flush()
    return with_comments(out)


HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


def with_comments(blocks: list[Block]) -> list[Block]:
    """Mark what follows a heading of reader comments, up to the next other heading, as such."""
    inside = False
    for b in blocks:
        if b.tag in HEADINGS or len(b.text) < 40:
            if COMMENT_HEAD.fullmatch(b.text):
                inside = True
            elif b.tag in HEADINGS:
                inside = False
        if inside:
            b.kinds = b.kinds | {"comments"}
    return blocks


def skipped_to(page: str, at: int, name: str) -> int:
    """Where the content of a skipped element ends."""
    close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I)
    if name in RAW:
        found = close.search(page, at)
        return found.end() if found else len(page)
    if name == "head":
        found = re.compile(r"</head\s*>|<body[\s>]", re.I).search(page, at)
        return (found.start() if found[0].lower().startswith("<body") else found.end()) if found else at
    found, depth, both = None, 1, re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.I)
    for found in both.finditer(page, at):
        depth += -1 if found[1] else 1
        if not depth:
            return found.end()
    return at  # never closed: only the tag itself goes


def features(block: Block, place: int = 0, n_blocks: int = 1) -> np.ndarray:
    n, kinds = len(block.text), block.kinds
    short = n < 25
    return np.array([
        1.0, *[float(k in kinds) for k in MARKS], block.links, min(math.log1p(n) / 6, 1.0) if n > 80 else 0.0, float(short),
        float(bool(END_MARK.search(block.text))), float(block.tag in HEADINGS),
        float(block.tag in ("p", "blockquote", "pre", "td")), float(block.tag in ("li", "dt", "dd", "option")),
        float(n < 200 and bool(OWNER.search(block.text))),
        float(n < 200 and len(BAR.findall(block.text)) > 1 and not END_MARK.search(block.text)),
        float(n_blocks > 1 and place in (0, n_blocks - 1))])


def page_features(blocks: list[Block]) -> np.ndarray:
    return np.stack([features(b, i, len(blocks)) for i, b in enumerate(blocks)])


def without_marks(x: np.ndarray) -> np.ndarray:
    """Features of a page that tells nothing by its elements and names."""
    x = x.copy()
    x[..., 1:1 + len(MARKS)] = 0.0
    return x


def weak_label(block: Block) -> int | None:
    """What the landmarks of a page say about a block, for fitting."""
    if block.kinds & LANDMARKS:
        return 0
    return 1 if block.kinds & {"article", "main"} else None


def fit_weights(x: np.ndarray, y: np.ndarray, strength: float = 20.0) -> np.ndarray:
    """Logistic regression with a normal prior around ``PRIOR``, by Newton's method."""
    w = PRIOR.copy()
    if not len(x):
        return w
    pull = strength * np.eye(len(w))
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (p - y) + strength * (w - PRIOR))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """(block, block, capacity): neighbours in the text, more firmly below one parent, and neighbours
    among the blocks below one ancestor, up to three levels up, less with every level that either is
    further down. The latter have the same landmarks, so that an advert between two paragraphs does
    not part them. Edges grow in step with the blocks."""
    out: dict[tuple[int, int], float] = {}
    last: dict[tuple[int, frozenset], tuple[int, int]] = {}
    close: set[tuple[int, int]] = set()
    for i, b in enumerate(blocks):
        marks = b.kinds & LANDMARKS
        if i:
            before = blocks[i - 1]
            firm = marks == before.kinds & LANDMARKS and b.path[-2:-1] == before.path[-2:-1]
            out[i - 1, i] = FOLLOW if firm else FOLLOW / 6
        for up, ancestor in enumerate(reversed(b.path[:-1] if len(b.path) > 1 else b.path)):
            key = ancestor, marks
            if key in last:
                pair = last[key][0], i
                if pair not in close:
                    close.add(pair)
                    out[pair] = out.get(pair, 0.0) + NEAR / 2 ** (up + last[key][1])
            last[key] = i, up
    return [(i, j, c) for (i, j), c in out.items()]


def minimum_cut(lean: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """True for the blocks on the content side. ``lean``: cost of boilerplate minus cost of content.

    A block whose lean outweighs all its open edges is settled at once (no cut could pay for the
    other side) and its edges are added to the leans of its neighbours; what is left is solved by
    maximum flow.
    """
    n, lean = len(lean), lean.astype(float).copy()
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for i, j, c in edges:
        near[i].append((j, c))
        near[j].append((i, c))
    open_ = [sum(c for _, c in x) for x in near]
    side = [0] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] or abs(lean[i]) <= open_[i]:
            continue
        side[i] = 1 if lean[i] > 0 else -1
        for j, c in near[i]:
            if not side[j]:
                lean[j] += side[i] * c
                open_[j] -= c
                todo.append(j)
    free = [i for i in range(n) if not side[i]]
    if free:
        index = {i: k for k, i in enumerate(free)}
        flow = Flow(len(free) + 2)
        source, sink = len(free), len(free) + 1
        for i, k in index.items():
            flow.join(source, k, max(lean[i], 0.0), 0.0) if lean[i] > 0 else flow.join(k, sink, max(-lean[i], 0.0), 0.0)
            for j, c in near[i]:
                if j > i and j in index:
                    flow.join(k, index[j], c, c)
        content = flow.source_side(source, sink)
        for i, k in index.items():
            side[i] = 1 if content[k] else -1
    return np.array([s > 0 for s in side], bool)


class Flow:
    """Maximum flow by shortest augmenting levels."""

    def __init__(self, n: int):
        self.edges: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def join(self, a: int, b: int, there: float, back: float):
        self.edges[a].append(len(self.to))
        self.edges[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def levels(self, source: int) -> list[int]:
        level = [-1] * len(self.edges)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.edges[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def source_side(self, source: int, sink: int) -> list[bool]:
        while (level := self.levels(source))[sink] >= 0:
            nth = [0] * len(self.edges)
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    k = next(k for k, e in enumerate(path) if self.room[e] <= 1e-9)
                    a = self.to[path[k] ^ 1]
                    del path[k:]
                    continue
                while nth[a] < len(self.edges[a]):
                    e = self.edges[a][nth[a]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[a] + 1:
                        break
                    nth[a] += 1
                else:
                    if a == source:
                        break
                    a = self.to[path.pop() ^ 1]
                    nth[a] += 1
                    continue
                path.append(e)
                a = self.to[e]
        return [x >= 0 for x in level]


def main_text(page: str | None, weights: np.ndarray) -> str:
    """The main text: content blocks in page order, one to a line."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    content = minimum_cut(page_features(blocks) @ weights, ties(blocks))
    return "\n".join(b.text for b, c in zip(blocks, content) if c)


def fit(pages: DataFrame, most: int = SAMPLE) -> np.ndarray:
    """Classifier weights from the landmarks of ``most`` pages; the driver gets the features of at
    most ``SAMPLE_BLOCKS`` labelled blocks of each, equal ones once. Every block also counts without
    its landmarks, so that text, links and place are learned for pages that have none."""

    def find(batches):
        for batch in batches:
            rows = set()
            for page in batch.column(0).to_pylist():
                blocks = blocks_of(page or "")
                labelled = [(i, b) for i, b in enumerate(blocks) if weak_label(b) is not None]
                for i, b in labelled[:SAMPLE_BLOCKS]:
                    x = features(b, i, len(blocks))
                    rows |= {(*v.tolist(), float(weak_label(b))) for v in (x, without_marks(x))}
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(r) for r in sorted(rows)], pa.list_(pa.float64()))], names=["row"])

    chosen = pages.select("page_id").where("page_id is not null").distinct().orderBy(
        F.xxhash64("page_id"), "page_id").limit(most)
    some = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id")  # most ids: a proven bound
    found = some.select("html").mapInArrow(find, "row array<double>").distinct()
    rows = np.array([r[0] for r in found.orderBy("row").limit(2 * most * SAMPLE_BLOCKS).collect()])
    return fit_weights(rows[:, :-1], rows[:, -1]) if len(rows) else PRIOR.copy()


def text_column(html: Column, weights: np.ndarray) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, weights) for p in pages], dtype=object)

    return run(html)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``.

    Null or empty html, and pages without content, give an empty text; repeated rows are
    repeated; other columns play no part. One pass without a shuffle, after the fit.
    """
    weights = fit(pages)
    return pages.select("page_id", "url", text_column(F.col("html"), weights).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))
