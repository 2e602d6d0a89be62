"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A linear classifier over the block's own
text and its ancestors gives each block a cost of being called boilerplate
and a cost of being called content; these are its capacities to the two
terminals. Blocks that follow each other, and blocks that follow each other
under one parent, are tied by smoothness edges. The minimum cut separates
content from boilerplate at the lowest total cost.

Defined cases: a null or empty page, or one without any content block, has
the empty text; markup that is not closed is closed where HTML closes it, an
element without shown text (``RAW``) at its tag unless it is one of
``TO_THE_END``; a
``<`` that opens no tag is text; white space of any kind inside a block,
``<br>`` and table cells are one space; pages that repeat are extracted each
by itself; an empty table gives no rows. Other columns pass through."""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from listenlab.llm.shared import map_arrow

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][-\w:]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Elements whose text is never shown as part of the page.
RAW = frozenset("script style noscript template iframe object svg canvas textarea title audio video select datalist".split())
#: Those that take the rest of the page if they are never closed; of the others only the tag goes.
TO_THE_END = frozenset("script style title textarea".split())
_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot
thead tr ul""".split())
#: What an opening tag closes, if it is the innermost block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tbody": {"tr", "td", "th", "thead"}, "option": {"option"}, "body": {"head"}}

#: Weights of the classifier (log odds of content).
BOILERPLATE_TAGS = {"nav": -9, "footer": -9, "aside": -9, "form": -9, "header": -7, "menu": -9, "head": -30, "button": -9,
                    "dialog": -9, "fieldset": -7, "search": -9}
CONTENT_TAGS = {"article": 4.0, "main": 3.0}
BOILERPLATE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments
consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus feedback foot footer gdpr header hidden
legal login masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination
paywall popup privacy promo promoted promotion recommended related replies reply respond share sharing sidebar signup skip social
sponsor sponsored subscribe subscription tags toolbar topbar widget widgets complementary search""".split())
#: Run together, as names of the comments' list or form.
BOILERPLATE_NAMES |= frozenset("commentlist commentform commentarea commentbox commentsection commentthread".split())
CONTENT_NAMES = frozenset("article body content entry main maincontent post story text".split())
NAME_WEIGHT, CONTENT_NAME_WEIGHT, HIDDEN_WEIGHT = -9.0, 1.5, -30.0
BIAS, LENGTH_WEIGHT, LINK_WEIGHT, SENTENCE_WEIGHT, HEADING_WEIGHT = -2.6, 0.55, -5.0, 1.0, 1.0
#: For all blocks of a page where no element is named as content.
UNNAMED_WEIGHT = 1.5
#: Smoothness: following blocks, and following blocks of one parent.
ADJACENT, SIBLING = 0.5, 0.7


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    context: float
    parent: int


def _context(tag: str, attributes: str) -> float:
    """What an element says about all text below it."""
    weight = BOILERPLATE_TAGS.get(tag, 0.0) + CONTENT_TAGS.get(tag, 0.0)
    if not attributes or attributes.isspace():
        return weight
    names: set[str] = set()
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id", "role"):
            names.update(x.lower() for x in _NAME_PART.findall(value))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            weight += HIDDEN_WEIGHT
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            weight += HIDDEN_WEIGHT
    if tag not in ("html", "body"):
        against = names & BOILERPLATE_NAMES
        # a page's name says nothing of its article, nor does the head of an entry stand outside it
        if tag in CONTENT_TAGS or against == {"header"} and names & CONTENT_NAMES - {"main", "content", "body"}:
            against = set()
        if against:
            weight += NAME_WEIGHT
        elif names & CONTENT_NAMES:
            weight += CONTENT_NAME_WEIGHT
    return weight


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order."""
    out: list[Block] = []
    # open elements: tag, summed context, number; content weights count once
    stack: list[tuple[str, float, float, int]] = [("", 0.0, 0.0, 0)]
    places: dict[str, list[int]] = {}  # in the stack, of each open tag
    open_blocks = [0]
    parts: list[str] = []
    state = {"linked": 0, "links": 0, "number": 0}

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                tag, low, high, _ = stack[-1]
                at = open_blocks[-1]
                holder = stack[at]
                out.append(Block(text, state["linked"], holder[0] in ("h1", "h2", "h3", "h4", "h5", "h6"), low + high,
                                 stack[max(at - 1, 0)][3]))
            parts.clear()
        state["linked"] = 0

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if state["links"]:
                state["linked"] += len(text.strip())

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag = stack.pop()[0]
            places[tag].pop()
            state["links"] -= tag == "a"
            if tag in BLOCK:
                open_blocks.pop()

    at = 0
    unclosed: set[str] = set()
    while at < len(html):
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW:
            if not closing and tag not in unclosed and not (attributes or "").endswith("/"):
                end = _RAW_END[tag].search(html, at)
                if end is None:
                    if tag in TO_THE_END:
                        break
                    unclosed.add(tag)
                    continue
                skip = html.find(">", end.start())
                at = len(html) if skip < 0 else skip + 1
            continue
        if tag in ("br", "td", "th", "wbr"):
            if tag != "wbr":
                add(" ")
            if tag != "td" and tag != "th":
                continue
        if closing:
            if places.get(tag):
                depth = places[tag][-1]
                if open_blocks[-1] >= depth:
                    flush()
                close(depth)
            continue
        if tag in BLOCK:
            flush()
            # nothing is closed beyond the innermost block
            nearest = max((places[t][-1] for t in ("p", *CLOSES.get(tag, ())) if places.get(t)), default=0)
            if nearest and nearest >= open_blocks[-1]:
                close(nearest)
        if tag in VOID or (attributes or "").endswith("/") and tag not in BLOCK:
            continue
        state["number"] += 1
        weight = _context(tag, attributes or "")
        _, low, high, _ = stack[-1]
        stack.append((tag, min(low, weight) if weight < 0 else low, max(high, weight) if weight > 0 else high, state["number"]))
        places.setdefault(tag, []).append(len(stack) - 1)
        if tag in BLOCK:
            open_blocks.append(len(stack) - 1)
        state["links"] += tag == "a"
    flush()
    return out


def log_odds(block: Block, named: bool = True) -> float:
    n = len(block.text)
    z = (BIAS if named else BIAS + UNNAMED_WEIGHT) + LENGTH_WEIGHT * math.log1p(n) + block.context + LINK_WEIGHT * min(1.0, block.linked / n)
    if block.text[-1] in ".!?…\"”»:;)":
        z += SENTENCE_WEIGHT
    return z + HEADING_WEIGHT if block.heading else z


def minimum_cut(odds: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay with the source (content) when the cut is minimal.

    A node whose terminal capacity is at least the sum of its edges goes with
    its terminal in some minimum cut, so it is settled first and its edges
    become terminal capacities of its neighbours; what is left is cut by
    augmenting along shortest paths."""
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), c in edges.items():
        near[a][b] = near[a].get(b, 0.0) + c
        near[b][a] = near[b].get(a, 0.0) + c
    odds, label = list(odds), [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(odds[i]) >= sum(near[i].values()):
            label[i] = odds[i] > 0
            for j, c in near[i].items():
                odds[j] += c if label[i] else -c
                del near[j][i]
                queue.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        s, t = n, n + 1
        flow: dict[int, dict[int, float]] = {i: dict(near[i]) for i in rest}
        flow[s], flow[t] = {}, {}
        for i in rest:
            if odds[i] > 0:
                flow[s][i], flow[i][s] = odds[i], 0.0
            else:
                flow[i][t], flow[t][i] = -odds[i], 0.0
        while True:
            before = {s: s}
            queue = deque([s])
            while queue and t not in before:
                i = queue.popleft()
                for j, c in flow[i].items():
                    if c > 1e-12 and j not in before:
                        before[j] = i
                        queue.append(j)
            if t not in before:
                break
            path, j = [], t
            while j != s:
                path.append((before[j], j))
                j = before[j]
            least = min(flow[a][b] for a, b in path)
            for a, b in path:
                flow[a][b] -= least
                flow[b][a] = flow[b].get(a, 0.0) + least
        for i in rest:
            label[i] = i in before
    return label


def smoothness(found: list[Block]) -> dict[tuple[int, int], float]:
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges[i - 1, i] = ADJACENT
        if b.parent in last:
            pair = (last[b.parent], i)
            edges[pair] = edges.get(pair, 0.0) + SIBLING
        last[b.parent] = i
    return edges


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    named = any(b.context > 0 for b in found)
    labels = minimum_cut([log_odds(b, named) for b in found], smoothness(found))
    return "\n".join(b.text for b, keep in zip(found, labels) if keep)


def extract(pages: DataFrame, html: str = "html", text: str = "text", length: str = "n_chars") -> DataFrame:
    """``pages`` with the html replaced by its main text and the text's code points."""
    others = [c for c in pages.columns if c not in (html, text, length)]
    schema = T.StructType([pages.schema[c] for c in others] + [T.StructField(text, T.StringType()), T.StructField(length, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names)

    return map_arrow(pages.select(*others, html), run, schema)
