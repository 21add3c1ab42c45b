"""HTML main-text extraction by minimum-cut labelling.

A page is cut into blocks (runs of text between block-level tags). A linear classifier over a block's
tags, class, id and role words, length and link share gives log-odds of content; they become the
capacities of the block's terminal edges (to the source if content is likelier, else to the sink).
Neighbours in page order and blocks under one parent are joined by smoothness edges whose capacity
falls with their distance in the DOM tree. The minimum cut is the labelling with the least total
cost; what stays on the source's side is the main text.

Fallback text of media, drawings and formulas is text of the block they stand in. Work on a page is
linear in its length but for the cut, whose graph has a node and about two edges for each block.

Defined cases: null or empty html gives an empty text of 0 characters; unclosed and stray tags follow
the usual implied-end rules; an unfinished tag at the end of a page is markup; a page without any
block on the source's side gives an empty text.
"""

from __future__ import annotations

import html as entities
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchlake.llm.common import key, tuned, unkey

# Element names of the HTML standard.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template iframe textarea title".split())
#: Elements that drawings and media hold beside text: their text is none of the page's.
INNER_RAW = frozenset("metadata desc".split())
# Words in class, id and role that name page furniture, and those that name content.
FURNITURE = frozenset("ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs byline captcha comment comments consent contentinfo cookie cookies copyright disclaimer disqus donate dropdown feedback flash footer form gdpr header hero login masthead menu menubar message meta modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup privacy promo promoted promotion rail recommended register related replies reply respond search share sharing sidebar sidenav signin signup skip social sponsor sponsored subscribe tags teaser toolbar topbar trending warning widget widgets".split())
HEADING = frozenset("header hero byline".split())
#: Of these, words that name parts of articles as well: inside one they only count a little.
AMBIGUOUS = frozenset("feedback flash message meta rail respond response tags warning widget widgets".split())
#: Words that class names put beside those to name a part of a page. A name with any other word in it ("share-price",
#: "related-work") speaks of a subject: weak evidence, and next to none inside an article.
STRUCTURE = frozenset(
    "a area articles bar block blocks body bottom box button buttons by center column container content count fixed global group header holder icon icons inline inner is item items js label left link links list lists main mobile module nav new outer page panel "
    "post posts primary right row secondary section sections site slot small stories sticky story text title to top unit up us wrap wrapper".split()
)
CONTENT = frozenset("article body content entry main maincontent post prose story text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>?", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_CLOSES = {t: re.compile(rf"</{t}(?![a-z0-9-])[^>]*>?", re.I) for t in (*RAW_TAGS, *INNER_RAW)}
_WORDS = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?;:。！？]")

# Weights of the classifier (log-odds of content).
TAG_WEIGHTS = {"article": 3.0, "main": 3.0, "nav": -9.0, "footer": -9.0, "aside": -9.0, "header": -6.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "search": -9.0, "button": -9.0, "select": -9.0, "label": -6.0, "fieldset": -9.0, "head": -20.0, "table": -0.3, "ul": -0.3, "ol": -0.3}
OWN_WEIGHTS = {"p": 1.0, "h1": 1.5, "h2": 0.8, "h3": 0.6, "h4": 0.4, "h5": 0.3, "h6": 0.3, "blockquote": 0.8, "pre": 0.8, "li": -0.2, "td": 0.1, "div": -0.5, "body": -1.0}
FURNITURE_WEIGHT, AMBIGUOUS_WEIGHT, CONTENT_WEIGHT, HIDDEN_WEIGHT, LINK_WEIGHT = -9.0, -1.5, 1.5, -20.0, -4.0
#: Inside an article links are references, and a name that speaks of a subject says little; outside it says more.
INNER_LINK_WEIGHT, SUBJECT_WEIGHT, OUTER_SUBJECT_WEIGHT = -1.5, -0.5, -3.0
ADJACENT, SIBLINGS = 0.8, 0.4
#: From so many steps in the DOM tree on, the capacity between neighbours falls no further.
FAR = 40
_UNIT = 1000  # capacities are whole thousandths


class Node:
    """An open element: its tag, its depth, and what it and the elements around it say of its text."""

    __slots__ = ("tag", "parent", "depth", "weight", "inside", "home")

    def __init__(self, tag: str, parent: Node | None, attributes: str):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.inside = tag in ("article", "main") or bool(parent and parent.inside)
        own = TAG_WEIGHTS.get(tag, 0.0)
        around = bool(parent and parent.inside)
        if around and tag in ("header", "article", "main"):
            own = 0.0  # the heading of an article; nested articles count once
        good = False
        for name, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id", "role"):
                for words in map(set, map(_WORDS.findall, value.split())):
                    if around or words & CONTENT:
                        words -= HEADING  # of the article, not of the site
                    named = words & FURNITURE
                    if named and tag not in ("html", "body", "article", "main"):
                        if not words <= FURNITURE | STRUCTURE:
                            own = min(own, SUBJECT_WEIGHT if self.inside else OUTER_SUBJECT_WEIGHT)
                        else:
                            own = min(own, AMBIGUOUS_WEIGHT if self.inside and named <= AMBIGUOUS else FURNITURE_WEIGHT)
                    good = good or bool(words & CONTENT)
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                own = HIDDEN_WEIGHT
        if good and own >= 0 and not self.inside:
            own += CONTENT_WEIGHT
        self.weight = own + (parent.weight if parent else 0.0)
        # the element that text in here belongs to: past inline elements that say nothing
        self.home = self if tag in BLOCK_TAGS or not parent or self.weight != parent.weight else parent.home


class Block:
    __slots__ = ("node", "text", "links")

    def __init__(self, node: Node, text: str, links: float):
        self.node, self.text, self.links = node, text, links


def blocks(page: str) -> list[Block]:
    """Blocks in page order, with decoded, single-spaced text; blocks without text are left out."""
    out: list[Block] = []
    stack = [Node("html", None, "")]
    places: dict[str, list[int]] = {}  # tag -> where it stands in the stack, so that no close scans the stack
    parts: list[str] = []
    linked, anchor = 0, False

    def end() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(stack[-1].home, text, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def pop(tag: str, stops: tuple[str, ...] = ()) -> None:
        """Close the last open element of this tag, and what is open inside it, unless a stop is between."""
        own = places.get(tag)
        if own and all(not places.get(t) or places[t][-1] < own[-1] for t in stops):
            k = own[-1]
            for node in stack[k:]:
                places[node.tag].pop()
            del stack[k:]

    def text(s: str) -> None:
        nonlocal linked
        if s:
            parts.append(s)
            if anchor:
                linked += len(s)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                anchor = False
            if tag in BLOCK_TAGS:
                end()
            if tag not in ("html", "body"):
                pop(tag)
            continue
        if tag in RAW_TAGS or tag in INNER_RAW:
            if not m[3].endswith("/") or tag in ("script", "style", "textarea"):
                close = _CLOSES[tag].search(page, at)
                at = close.end() if close else n
            continue
        if tag == "br":
            parts.append("\n")
            continue
        if tag in BLOCK_TAGS:
            end()
            if tag in ("li", "option"):
                pop(tag, ("ul", "ol", "menu", "select"))
            elif tag in ("dt", "dd"):
                pop("dt", ("dl",))
                pop("dd", ("dl",))
            elif tag in ("td", "th", "tr"):
                for t in ("td", "th") + (("tr",) if tag == "tr" else ()):
                    pop(t, ("table",))
            elif tag == "body":
                pop("head")
            if tag != "body":
                pop("p", ("table", "td", "th", "li", "button", "article", "section", "aside", "nav", "div", "form", "blockquote"))
        if tag == "a":
            anchor = True
        if tag not in VOID_TAGS and tag != "html" and not (m[3].endswith("/") and tag not in BLOCK_TAGS):
            places.setdefault(tag, []).append(len(stack))
            stack.append(Node(tag, stack[-1], m[3]))
    end()
    return out


def log_odds(block: Block) -> float:
    """The classifier: positive if content is likelier."""
    n = len(block.text)
    score = block.node.weight + OWN_WEIGHTS.get(block.node.tag, 0.0) + (INNER_LINK_WEIGHT if block.node.inside else LINK_WEIGHT) * block.links
    score += min(2.0, n / 100) - 0.6
    if _SENTENCE.search(block.text[-2:]):
        score += 0.4
    return score


def _distance(a: Node, b: Node) -> int:
    """Steps between two elements in the DOM tree, FAR at most."""
    d = 0
    while a is not b and d < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        d += 1
    return d


def edges(bs: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges (block, block, capacity)."""
    out, last = [], {}
    for k, b in enumerate(bs):
        if k:
            out.append((k - 1, k, ADJACENT / (1 + _distance(bs[k - 1].node, b.node) / 2)))
        parent = id(b.node.parent)
        if parent in last and last[parent] != k - 1:
            out.append((last[parent], k, SIBLINGS))
        last[parent] = k
    return out


def min_cut(terminal: list[float], smooth: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source. terminal: source capacity if positive, else sink capacity.
    Maximum flow by shortest augmenting paths in level graphs."""
    n = len(terminal)
    source, sink = n, n + 1
    to: list[int] = []
    cap: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, c: int, back: int) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        cap.extend((c, back))

    for k, t in enumerate(terminal):
        c = round(abs(t) * _UNIT)
        if t > 0:
            add(source, k, c, 0)
        else:
            add(k, sink, c, 0)
    for a, b, c in smooth:
        add(a, b, round(c * _UNIT), round(c * _UNIT))
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if not cap[e])
                a = to[path[cut] ^ 1]
                del path[cut:]
            while turn[a] < len(out[a]):
                e = out[a][turn[a]]
                if cap[e] and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                turn[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]


def main_text(page: str | None) -> str:
    bs = blocks(page or "")
    if not bs:
        return ""
    keep = min_cut([log_odds(b) for b in bs], edges(bs))
    return "\n\n".join(b.text for b, k in zip(bs, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars. One narrow pass."""
    tuned(pages.sparkSession)

    def run(batches):
        for b in batches:
            out = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    out = pages.select(key("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
    return out.select(unkey("page_id"), "url", "text", "n_chars")
