"""Main text of web pages: a minimum cut between content and boilerplate.

A page is cut into blocks of text at its block-level tags. A logistic classifier
over a block's features gives the cost of calling it content and of calling it boilerplate;
they are the capacities to the two terminals. Neighbouring blocks, and blocks of the same container,
are joined by edges whose capacity falls with their distance in the tree of tags; a list or a table is a part of
the container it stands in. The blocks on the source's side of a minimum cut are the main text. The flow is
found level graph by level graph, so that the many short flows of a long page take few passes over it.

The classifier is fitted on the driver to the blocks of a bounded number of different pages (``SAMPLE_PAGES``, the least
by a hash, each whole) whose place in the markup tells what they are:
inside an article and nothing else, or inside a menu, a footer and so on. Half of them are shown without
what the markup tells, so that pages without such markup can be read too. A
normal prior around ``PRIOR`` holds the weights where the sample says nothing; it is firm for the kind of
a block's own tag, as the sample's articles may hold paragraphs only and others lists, tables and code.

Defined results: a null or empty page, and one without text, has the empty text;
unclosed comments, scripts and styles end with the page, other unclosed tags hide nothing; extra columns play no part;
repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

SAMPLE_PAGES, SEED = 300, 3
#: Capacity of the edge between neighbours at no distance, and between blocks of one parent.
ADJACENT, SIBLINGS, MOST = 0.8, 0.5, 12.0

# What tags of HTML are, and words that name parts of pages.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
RAW_TAGS = frozenset("script style noscript template textarea iframe svg math object head title select button".split())
# Without an end tag these run to the end of the page.
ENDLESS_TAGS = frozenset("script style textarea title".split())
# These end where another part of the page begins.
CONTROL_TAGS = frozenset("button select".split())
# Blocks of these belong to the container around them, as do lists and tables themselves.
LEAF_TAGS = frozenset(
    "p li dt dd td th tr tbody thead tfoot caption h1 h2 h3 h4 h5 h6 pre blockquote figcaption figure option label legend address summary".split()
)
LIST_TAGS = frozenset("ul ol dl table".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A new tag of the key ends an open one of the value.
ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
NOT_CONTENT_TAGS = frozenset("nav footer aside form header menu dialog button select".split())
CONTENT_TAGS = frozenset("article main".split())
NOT_CONTENT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "popup promo promoted promotion recommended related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe toolbar widget alert reader discussion".split()
)
CONTENT_WORDS = frozenset("article content entry main post story text body".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

PART_TAG = re.compile(
    r"<(?:address|article|aside|blockquote|div|dl|figure|footer|form|h[1-6]|header|hr|main|nav|ol|p|pre|section|table|ul)\b", re.I
)

FEATURES = ["bias", "markup against", "markup for", "words", "link share", "full stops", "item", "heading", "paragraph"]
#: Where a block is believed to belong before any page is seen, and how firmly.
PRIOR = np.array([-2.0, -5.0, 4.0, 0.8, -3.0, 1.5, -0.5, 0.5, 0.5])
FIRMNESS = np.array([0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 500.0, 500.0, 500.0])


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    tag: str
    parent: int  # its container
    depth: int  # containers around it
    against: bool
    favour: bool


@dataclass
class _Open:
    tag: str
    against: bool
    favour: bool
    container: int
    depth: int


def blocks_of(page: str) -> list[Block]:
    """The blocks of text of a page, in its order."""
    out: list[Block] = []
    open_tags = [_Open("", False, False, 0, 0)]
    pieces: list[tuple[str, bool]] = []
    links = number = at = 0

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = sum(len(p) for p, in_link in pieces if in_link)
                top = open_tags[-1]
                out.append(Block(text, min(linked, len(text)), top.tag, top.container, top.depth, top.against, top.favour))
            pieces.clear()

    while at < len(page):
        found = TAG.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            pieces.append((page[at:end], links > 0))
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        closing = bool(found["close"] or found["close2"])
        if name == "br":
            pieces.append((" ", links > 0))
        elif name == "a":
            links = 0 if closing else 1
        elif closing:
            if name in BLOCK_TAGS:
                flush()
                if any(o.tag == name for o in open_tags):
                    while open_tags.pop().tag != name:
                        pass
        else:
            attributes = found["attributes"] or found["attributes2"] or ""
            if name in RAW_TAGS and not attributes.endswith("/"):
                # Its content isn't text of the page.
                if name in BLOCK_TAGS:
                    flush()
                at = _end_of(name, page, at)
            elif name in BLOCK_TAGS:
                flush()
                for i in range(len(open_tags) - 1, 0, -1):
                    if open_tags[i].tag in ENDS.get(name, ()):
                        del open_tags[i:]
                        break
                    if open_tags[i].tag not in ("tbody", "thead", "tfoot", "p", "li", "td", "th", "dd", "dt"):
                        break
                if name not in VOID_TAGS:
                    top = open_tags[-1]
                    against, favour = _told(name, attributes)
                    container, depth = top.container, top.depth
                    # What is told for or against content makes a part of its own, whatever its tag.
                    if name not in LEAF_TAGS | LIST_TAGS or against or favour:
                        number += 1
                        container, depth = number, depth + 1
                    open_tags.append(_Open(name, top.against or against, top.favour or favour, container, depth))
    flush()
    return out


_STOPS = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW_TAGS}


def _end_of(name: str, page: str, at: int) -> int:
    """Where the page goes on after a tag whose content isn't text of it."""
    stop = _STOPS[name].search(page, at)
    end = stop.end() if stop else -1
    if name in CONTROL_TAGS:
        # A button holds no parts of a page: where one begins, its end tag is missing.
        part = PART_TAG.search(page, at, stop.start() if stop else len(page))
        return part.start() if part else end if stop else at
    if stop:
        return end
    return len(page) if name in ENDLESS_TAGS else at


def _told(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether a tag's name, class, id or role tells against and for content."""
    against, favour = name in NOT_CONTENT_TAGS, name in CONTENT_TAGS
    if attributes:
        for m in NAMED.finditer(attributes):
            words = {w.lower() for w in WORDS.findall(m[1] or m[2] or m[3] or "")}
            against |= not words.isdisjoint(NOT_CONTENT_WORDS)
            favour |= not words.isdisjoint(CONTENT_WORDS)
    return against, favour


def features(block: Block) -> list[float]:
    text = block.text
    words = text.count(" ") + 1
    return [
        1.0,
        float(block.against),
        float(block.favour and not block.against),
        min(math.log(words), 5.0) - 2.0,
        block.linked / len(text),
        min(1.0, 10 * (text.count(".") + text.count(",")) / words),
        float(block.tag in ("li", "td", "th", "option", "label", "dt", "dd")),
        float(block.tag[:1] == "h" and block.tag[1:].isdigit()),
        float(block.tag in ("p", "blockquote", "pre")),
    ]


def told_blocks(page: str) -> list[list[float]]:
    """The features of the blocks whose place tells what they are, followed by 1 for content and 0 for boilerplate."""
    return [[*features(b), float(not b.against)] for b in blocks_of(page) if b.against or b.favour]


def fit(blocks: list[list[float]]) -> np.ndarray:
    """Weights of the classifier: Newton's steps towards the most likely ones under the prior."""
    w = PRIOR.copy()
    if not blocks:
        return w
    x, y = np.array(blocks)[:, :-1], np.array(blocks)[:, -1]
    hidden = np.random.default_rng(SEED).random(len(x)) < 0.5
    x[hidden, 1:3] = 0
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - FIRMNESS * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(FIRMNESS)
        w = w + np.linalg.solve(curve, slope)
    # The markup never speaks for the other side, nor more weakly than believed, whatever a small sample says.
    w[1], w[2] = min(w[1], PRIOR[1]), max(w[2], PRIOR[2])
    return w


def content_side(excess: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The source's side of a minimum cut.

    ``excess``: a node's capacity from the source less that to the sink, what is left after
    the flow that runs through the node alone. Each round fills all shortest paths, so paths grow from
    round to round.
    """
    n = len(excess)
    flow = list(excess)
    head: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[float] = []
    for a, b, capacity in edges:
        head[a].append(len(to))
        to.append(b)
        room.append(capacity)
        head[b].append(len(to))
        to.append(a)
        room.append(capacity)
    while True:
        sources = [i for i in range(n) if flow[i] > 1e-9]
        level = [-1] * n
        for i in sources:
            level[i] = 0
        front, found = sources, False
        while front and not found:
            further = []
            for i in front:
                for e in head[i]:
                    j = to[e]
                    if level[j] < 0 and room[e] > 1e-9:
                        level[j] = level[i] + 1
                        found = found or flow[j] < -1e-9
                        further.append(j)
            front = further
        if not found:
            return [d >= 0 for d in level]
        tried = [0] * n
        for s in sources:
            path: list[int] = []
            here = s
            while flow[s] > 1e-9:
                if flow[here] < -1e-9:
                    amount = min(flow[s], -flow[here], min(room[e] for e in path))
                    flow[s] -= amount
                    flow[here] += amount
                    for e in path:
                        room[e] -= amount
                        room[e ^ 1] += amount
                    path, here = [], s
                    continue
                while tried[here] < len(head[here]):
                    e = head[here][tried[here]]
                    if room[e] > 1e-9 and level[to[e]] == level[here] + 1:
                        break
                    tried[here] += 1
                if tried[here] < len(head[here]):
                    path.append(e)
                    here = to[e]
                elif path:
                    here = to[path.pop() ^ 1]
                    tried[here] += 1
                else:
                    break


def main_text(page: str, w: np.ndarray) -> str:
    """The blocks on the content side, joined by spaces."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    odds = np.clip(np.array([features(b) for b in blocks]) @ w, -MOST, MOST).tolist()
    edges, latest = [], {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            if a.parent != b.parent:
                # Leaving and entering a part of the page each cost a step.
                steps = 1 + abs(a.depth - b.depth) + (a.against != b.against) * 3
                edges.append((i - 1, i, ADJACENT / (1 + steps)))
            else:
                edges.append((i - 1, i, ADJACENT))
        if b.parent in latest and latest[b.parent] < i - 1:
            edges.append((latest[b.parent], i, SIBLINGS))
        latest[b.parent] = i
    side = content_side(odds, edges)
    return " ".join(b.text for b, content in zip(blocks, side, strict=True) if content)


def train(pages: DataFrame) -> np.ndarray:
    hashed = pages.where("html is not null").select("html", F.xxhash64("html").alias("h"))
    # Hashes alone are put in order; then only the pages of the least ones come, equal pages once.
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).collect()]
    if not least:
        return PRIOR.copy()
    sample = hashed.where(F.col("h") <= least[-1]).groupBy("h").agg(F.any_value("html").alias("html"))

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def told(pages: pa.Array) -> pa.Array:
        return pa.array([told_blocks(p.as_py()) for p in pages], pa.list_(pa.list_(pa.float64())))

    rows = sample.select("h", told("html").alias("blocks")).orderBy("h").collect()
    return fit([list(b) for r in rows for b in r["blocks"]])


def extractor(w: np.ndarray):
    """A column function from pages to their main text."""

    @F.arrow_udf(T.StringType())
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py() or "", w) for p in pages], pa.string())

    return extract


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    done = pages.select("page_id", "url", extractor(train(pages))("html").alias("text"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
