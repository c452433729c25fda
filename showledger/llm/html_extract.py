"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read once into blocks (the text between block-level tags). Each block gets a cost for either label: the bounded
log odds of a text classifier plus what the nearest telling ancestor says (a tag, role, class or id of content or of
furniture), less the further away that ancestor is, with a weight that is learned from how often the text agrees with
such ancestors. Costs are capacities to the two terminals; neighbouring blocks, and neighbours below the same parent, are
joined by smoothness edges that weaken with their distance in the DOM. The minimum cut separates content from
boilerplate: no cost is beyond the reach of the edges, so a block that its own words or class mislabel is put right by
its surroundings. A block whose terminal capacity is above all its edges is decided at once and passes its edges on as
costs, which is exact; max-flow settles what is left.

The text classifier is a logistic regression trained on the pages themselves: blocks below telling tags are the
examples, at most SAMPLE_BLOCKS blocks of SAMPLE_PAGES pages in the order of a hash. Pages are extracted whole, one row
at a time, without a shuffle; the walk keeps its own stack, so nesting may be of any depth.

Defined results: null and empty html, and pages without content, give the empty string; broken markup is read as far as
it goes (unclosed tags close with their parent; a tag cut off at the end is no text; an unknown declaration is a comment); repeated rows are each extracted;
an empty table gives no rows; extra columns are not read. `br` counts as white space, headings belong to their article.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text
from .toxicity import fit_logistic

SAMPLE_PAGES, SAMPLE_BLOCKS = 1_000, 50
#: Most that a telling ancestor may add, what is left of it for each element between (and at least), and bound of the text's log odds.
HINT, FADE, FADED, BOUND = 2.0, 0.97, 0.85, 1.0
#: Edges of neighbours and of siblings; a block between two others is joined by more than its own cost.
NEXT, SIBLING = 1.5, 0.75

# Tags and words of markup.
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math head title iframe object canvas select option textarea button audio video map".split())
CONTENT_TAGS = frozenset("article main".split())
FURNITURE_TAGS = frozenset("nav aside footer form menu dialog".split())
CONTENT_ROLES = frozenset("main article".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
CONTENT_WORDS = frozenset("article content post entry story main body text prose".split())
FURNITURE_WORDS = frozenset((
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menus breadcrumb breadcrumbs "
    "header masthead footer sidebar aside widget widgets related recommended comment comments respond replies disqus reply cookie cookies consent notice "
    "notices notification popup modal overlay newsletter subscribe signup login search share sharing social pagination pager form toolbar copyright legal "
    "hidden skip").split())

# Words of a class or id that make it say something of the layout only.
LAYOUT_WORDS = frozenset("has no not with without layout open closed enabled disabled".split())
# What the class of a paragraph inside content may be called without being furniture.
PARAGRAPHS = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6 li dd dt td th figcaption".split())
STYLE_WORDS = frozenset("header legal copyright text form search".split())

_WORD = re.compile(r"[a-z]+")
_SPLIT = re.compile(r"(?<=[a-z])(?=[A-Z])")


def hint_of(tag: str, attrs: list[tuple[str, str | None]], inside: int) -> int:
    """1 content, -1 furniture, 0 says nothing. Words of furniture go before all, then roles, then tags."""
    if tag in ("html", "body"):
        return 0
    given = {k: v or "" for k, v in attrs}
    words = set()
    for name in [n for k in ("class", "id") if k in given for n in given[k].split()]:
        found = _WORD.findall(_SPLIT.sub(" ", name).lower())
        if not LAYOUT_WORDS & set(found):  # "has-sidebar", "comments-open": of the page's layout, not of this element
            words.update(found)
    role = given.get("role", "").strip().lower()
    if "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", given.get("style", "")):
        return -1
    telling = words & FURNITURE_WORDS
    if inside > 0:  # the heading of an article, and paragraphs of its text that are only styled
        telling -= {"header"} if tag not in PARAGRAPHS else STYLE_WORDS
    if telling:
        return -1
    if role in FURNITURE_ROLES or tag in FURNITURE_TAGS:
        return -1
    if tag == "header":  # of a page it is furniture, of an article it holds the heading
        return 0 if inside > 0 else -1
    if role in CONTENT_ROLES or tag in CONTENT_TAGS or words & CONTENT_WORDS:
        return 1
    return 0


class Blocks(HTMLParser):
    """Blocks of one page: [text, link characters, tag, hint, parent element, depth, line, elements up to the telling one].

    Inline furniture is a block of its own; the text around it stays one block. Blocks of one element share a line.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[list] = []
        # stack entries: (tag, hint, silent, element number, is a link, elements since the one that told)
        self.stack: list[tuple[str, int, bool, int, bool, int]] = [("", 0, False, 0, False, 0)]
        self.count: dict[str, int] = {}
        self.block: list[tuple[str, int, int]] = [("", 0, 0)]  # open block elements: tag, element, depth of the stack
        self.number, self.links = 0, 0
        # segments of the open block: text, link characters, tag, hint, parent element, depth, distance; the one that is written
        self.parts: list[list] = []
        self.part: list = []
        self.own: list | None = None  # the last segment that is no furniture
        self.line = 0
        self.hints: dict = {}

    def parse_marked_section(self, i, report=1):
        """Declarations such as `<![if` and `<![x]` are comments up to the next `>`, whatever they name."""
        end = self.rawdata.find(">", i)
        return end if end < 0 else end + 1

    def unknown_decl(self, data):
        """Nothing in a declaration is text."""

    def flush(self) -> None:
        if self.parts:
            for texts, *rest in self.parts:
                text = " ".join("".join(texts).split())
                if text:
                    self.out.append([text, *rest[:-1], self.line, rest[-1]])
            self.parts, self.own, self.line = [], None, self.line + 1

    def begin(self, hint: int) -> None:
        """A new segment; inline furniture counts as a child of its block."""
        tag, element, depth = self.block[-1]
        inline = hint < 0 <= self.stack[max(0, depth - 1)][1]
        self.part = [[], 0, tag, hint, element if inline or len(self.block) < 2 else self.block[-2][1], depth, self.stack[-1][5]]
        self.parts.append(self.part)
        if hint >= 0:
            self.own = self.part

    def pop(self) -> None:
        tag, _, _, _, link, _ = self.stack.pop()
        self.count[tag] -= 1
        self.links -= link
        if tag in BLOCK:
            self.flush()
        while self.block[-1][2] > len(self.stack):
            self.block.pop()

    def close_to(self, tag: str) -> None:
        while self.stack[-1][0] != tag:
            self.pop()
        self.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            if self.parts:
                self.part[0].append(" ")
            return
        if tag == "body" and self.count.get("head"):
            self.close_to("head")
        if tag in BLOCK:
            self.flush()
            if self.count.get("p"):  # a paragraph holds no block
                self.close_to("p")
            if tag in ("li", "dd", "dt", "tr", "td", "th", "option") and self.block[-1][0] in ({"dd", "dt"} if tag in ("dd", "dt") else {"td", "th"} if tag in ("td", "th") else {tag}):
                self.close_to(self.block[-1][0])
        if tag in VOID:
            return
        _, hint, silent, _, _, far = self.stack[-1]
        far += 1
        if not silent:
            key = (tag, hint, tuple(x for x in attrs if x[0] in ("class", "id", "role", "hidden", "aria-hidden", "style")))
            own = self.hints.get(key)
            if own is None:
                own = self.hints[key] = hint_of(tag, attrs, hint)
            # content words inside furniture (the body of a notice or of a comment) are furniture still
            if own and not (own == 1 and hint < 0):
                hint, far = own, 0
        self.number += 1
        link = tag == "a"
        self.links += link
        self.stack.append((tag, hint, silent or tag in SILENT, self.number, link, far))
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag in BLOCK:
            self.block.append((tag, self.number, len(self.stack)))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK and self.stack[-1][0] == tag:
            self.pop()

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if self.count.get(tag):
            self.close_to(tag)

    def handle_data(self, data):
        _, hint, silent, _, _, _ = self.stack[-1]
        if silent:
            return
        if not self.parts:
            self.begin(hint)
        elif data.strip() and self.part[3] < 0 <= hint:  # behind inline furniture the text before it goes on
            if self.own is not None and self.own[3] <= hint:
                self.part = self.own
                self.part[0].append(" ")
            else:
                self.begin(hint)
        elif data.strip() and hint < self.part[3]:  # an inline element of furniture stands alone
            self.begin(hint)
        self.part[0].append(data)
        if self.links:
            self.part[1] += len(data.strip())


def blocks_of(html: str) -> list[list]:
    reader = Blocks()
    reader.feed(html)
    if reader.rawdata and reader.rawdata.startswith("<"):  # a tag cut off at the end is no text
        reader.rawdata = ""
    reader.close()
    reader.flush()
    return reader.out


# -- costs ---------------------------------------------------------------------

def features(block: list, place: float) -> list[float]:
    text, linked, tag = block[:3]
    words = text.count(" ") + 1
    return [
        math.log1p(words), min(1.0, linked / max(1, len(text))), float(text[-1] in ".!?…\"”"), sum(text.count(c) for c in ",.;:!?") / words,
        len(text) / words / 10, float(tag == "p"), float(tag == "li"), float(tag in ("h1", "h2", "h3")), 1 - abs(2 * place - 1)]


class Costs(NamedTuple):
    """Coefficients of the text classifier (the last is the intercept), and weights of content and furniture around a block."""

    text: tuple[float, ...]
    content: float
    furniture: float


#: Used where the pages give no examples of both kinds.
DEFAULT = Costs((0.8, -4.0, 1.0, 1.0, 0.0, 0.5, -0.5, 0.3, 0.3, -2.5), HINT, HINT)


def text_odds(block: list, place: float, beta) -> float:
    return beta[-1] + sum(w * x for w, x in zip(beta, features(block, place)))


def trust(agreed: int, of: int) -> float:
    """Weight of a telling ancestor: log odds that the text says the same, at most HINT."""
    return max(0.0, min(HINT, math.log((agreed + 1) / (of - agreed + 1))))


def odds(page: list[list], costs: Costs) -> list[float]:
    """Log odds of content of each block."""
    n, out = len(page), []
    for i, b in enumerate(page):
        told = (costs.content if b[3] > 0 else -costs.furniture) * max(FADED, FADE ** b[7]) if b[3] else 0.0
        out.append(max(-BOUND, min(BOUND, text_odds(b, (i + 0.5) / n, costs.text))) + told)
    return out


def edges(page: list[list]) -> list[tuple[int, int, float]]:
    out, last = [], {}
    for i, b in enumerate(page):
        if i:
            far = abs(b[5] - page[i - 1][5]) + (b[4] != page[i - 1][4])
            out.append((i - 1, i, NEXT / (1 + far)))
        if b[4] in last and last[b[4]] != i - 1:
            out.append((last[b[4]], i, SIBLING))
        last[b[4]] = i
    return out


# -- minimum cut ---------------------------------------------------------------

def min_cut(unary: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) that minimise the cost: |u| for a label against the sign of u, w for each edge that is cut."""
    n = len(unary)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, w in links:
        near[a].append((b, w))
        near[b].append((a, w))
    value, label = list(unary), [None] * n
    free = [sum(w for _, w in x) for x in near]
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(value[i]) >= free[i] and (value[i] or not free[i]):
            label[i] = value[i] > 0
            for j, w in near[i]:
                if label[j] is None:
                    value[j] += w if label[i] else -w
                    free[j] -= w
                    if free[j] < 1e-9:
                        free[j] = 0.0
                    todo.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        number = {x: k for k, x in enumerate(rest)}
        inner = [(number[a], number[b], w) for a, b, w in links if a in number and b in number]
        for i, side in zip(rest, max_flow([value[i] for i in rest], inner)):
            label[i] = side
    return label


def max_flow(value: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Shortest augmenting paths; True for the nodes on the content terminal's side of the cut."""
    scale, n = 1 << 20, len(value)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to, room = [], []

    def arc(a: int, b: int, there: int, back: int) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(there)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, v in enumerate(value):
        c = round(abs(v) * scale)
        if c:
            arc(*((source, i) if v > 0 else (i, sink)), c, 0)
    for a, b, w in links:
        arc(a, b, round(w * scale), round(w * scale))
    while True:
        level = [-1] * (n + 2)
        level[source], todo = 0, deque([source])
        while todo:
            x = todo.popleft()
            for e in head[x]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    todo.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        place = [0] * (n + 2)
        path: list[int] = []
        x = source
        while True:
            if x == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                k = next(i for i, e in enumerate(path) if not room[e])
                x = to[path[k] ^ 1]
                del path[k:]
                continue
            while place[x] < len(head[x]):
                e = head[x][place[x]]
                if room[e] and level[to[e]] == level[x] + 1:
                    break
                place[x] += 1
            if place[x] < len(head[x]):
                path.append(head[x][place[x]])
                x = to[path[-1]]
            elif path:
                level[x] = -1
                x = to[path.pop() ^ 1]
            else:
                break


def settled_by_cut(html: str, costs: Costs = DEFAULT) -> tuple[int, int, int]:
    """(blocks, blocks whose own cost is below their edges, blocks whose label is not the one of their own cost)."""
    page = blocks_of(html)
    own, links = odds(page, costs), edges(page)
    around = [0.0] * len(page)
    for a, b, w in links:
        around[a] += w
        around[b] += w
    kept = min_cut(own, links)
    return len(page), sum(abs(x) < w for x, w in zip(own, around)), sum((x > 0) != k for x, k in zip(own, kept))


def main_text(html: str, costs: Costs = DEFAULT) -> str:
    page = blocks_of(html)
    kept = min_cut(odds(page, costs), edges(page))
    lines: dict[int, list[str]] = {}
    for b, k in zip(page, kept):
        if k:
            lines.setdefault(b[6], []).append(b[0])
    return "\n".join(" ".join(texts) for texts in lines.values())


# -- Spark ---------------------------------------------------------------------

def train(pages: DataFrame, limit: int = SAMPLE_PAGES) -> Costs:
    """Coefficients of the text classifier, from blocks whose markup tells what they are, and how far such markup is to be trusted."""
    keyed = pages.where("html is not null").select(F.xxhash64("html").alias("order"), "html")
    first = keyed.select("order").distinct().orderBy("order").limit(limit)  # numbers only; the pages follow by a join
    chosen = keyed.join(F.broadcast(first), "order").groupBy("order").agg(F.min("html").alias("html"))

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for html in rows["html"]:
                page = blocks_of(html)
                told = [(int(b[3] > 0), features(b, (i + 0.5) / len(page))) for i, b in enumerate(page) if b[3]]
                out += told[:: max(1, -(-len(told) // SAMPLE_BLOCKS))]
            yield pd.DataFrame(out, columns=["label", "x"])

    made = sorted((r[0], tuple(r[1])) for r in chosen.mapInPandas(examples, "label int, x array<double>").collect())
    if len({m[0] for m in made}) < 2:
        return DEFAULT
    x, label = np.array([m[1] for m in made]), np.array([m[0] for m in made], float)
    # each half is judged by what the other half says of its texts
    agreed, half = np.zeros(len(label), bool), np.arange(len(label)) % 2 == 0
    for part in (half, ~half):
        if len(set(label[~part])) < 2:
            return Costs(tuple(fit_logistic(x, label).tolist()), HINT, HINT)
        beta = fit_logistic(x[~part], label[~part])
        agreed[part] = (x[part] @ beta[:-1] + beta[-1] > 0) == (label[part] > 0)
    content = label > 0
    return Costs(tuple(fit_logistic(x, label).tolist()), trust(int(agreed[content].sum()), int(content.sum())), trust(int(agreed[~content].sum()), int((~content).sum())))


def text_column(costs: Costs, html: str = "html") -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield rows.map(lambda h: main_text(h, costs))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")(clean_text(html))


def report(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return pages.select("page_id", "url", text_column(train(pages)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
