"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks, each with the markup around it. A linear
classifier over markup, wording of class and id, link share and length gives every block
the cost of calling it content and of calling it boilerplate: the capacities towards the
two terminals. Neighbouring blocks, and blocks below the same element, are tied by edges
whose capacity is lost where labels differ. The maximum flow leaves the cheapest
labelling; the blocks on the source's side are the main text.

Defined cases: null or empty html and pages without content give an empty text. Unclosed
and stray tags, and a page that breaks off inside a tag, are read as far as they go: a head
ends at the first text or tag that HTML does not allow in it, and any other element that is
not read and has no end tag at the next block; only a script or style runs to the end.
Character references are decoded, broken ones stay as they are. Rows are answered one by
one; a null page_id or url is passed on. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from dataclasses import dataclass, field
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import python_workers, whole

# Elements by their role in a page.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav "
    "ol p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
UNREAD = frozenset(
    "script style template noscript iframe svg math canvas object audio video select textarea "
    "button datalist head title".split()
)
RAW = frozenset("script style textarea title noscript iframe template".split())
HEAD = frozenset(  # all that an open head may hold
    "base basefont bgsound head html link meta noframes noscript script style template title".split()
)
CLOSED_BY = {  # an opening tag ends an open one of the same kind
    "p": BLOCKS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
# The classifier. Positive weights speak for content.
TAG_WEIGHT = {
    "article": 8.0, "main": 4.0, "nav": -12.0, "footer": -12.0, "header": -9.0, "aside": -12.0,
    "form": -9.0, "menu": -12.0, "dialog": -12.0, "fieldset": -6.0, "search": -12.0,
}
ROLE_TAG = {  # landmarks weigh like their elements
    "complementary": "aside", "contentinfo": "footer", "search": "search", "form": "form",
    "banner": "header", "navigation": "nav", "menu": "menu", "menubar": "menu",
    "dialog": "dialog", "alertdialog": "dialog",
}
OWN_WEIGHT = {"p": 1.0, "pre": 1.0, "blockquote": 1.0, "h1": 0.5, "h2": 0.3, "h3": 0.3}
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored "
    "promo promos promotion menu menus nav navbar navigation breadcrumb breadcrumbs sidebar "
    "sidebars side rail footer foot header masthead topbar cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login comment "
    "comments commentlist reply replies respond disqus discussion related recommended more share "
    "sharing social widget widgets toolbar pagination pager copyright legal disclaimer outbrain "
    "taboola skip".split()
)
GOOD_WORDS = frozenset("article content post entry story main body text".split())
#: Words that, as a whole id, class or role, name a part of the page beyond doubt.
PART_WORDS = frozenset(
    "ad ads advert advertisement banner sponsor breadcrumb breadcrumbs sidebar sidebars nav navbar "
    "navigation menu footer header masthead topbar cookie cookies popup modal newsletter comment "
    "comments commentlist disqus respond widget widgets toolbar pagination outbrain taboola".split()
)
STATE_WORDS = frozenset("has with without no category tag".split())  # what follows is no role
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_WEIGHT, GOOD_WEIGHT = -14.0, 2.0
# Shares of a page's text that an element around blocks holds if it is there for all of them.
WIDE, WIDE_WITH_ARTICLE = 0.8, 0.5
NEIGHBOUR, SIBLING = 1.0, 0.8

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![\w:-])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Element:
    tag: str
    parent: int
    weight: float  # of the element; once the page is read, of everything around it too
    link: bool
    article: bool
    loose: bool = False  # not read, and no end tag follows
    wording: float = 0.0
    part: bool = False  # named as a part of the page beyond doubt


@dataclass
class Block:
    element: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def wording(attributes: str, tag: str = "", around: Element | None = None) -> tuple[float, bool]:
    """What class, id and role say, and whether one of them names a part of the page outright.

    A name is bad if one of its words is, otherwise good if one is; words behind "has" and the
    like are states. As many good names as bad ones cancel them, except those that are one
    word, as whole id or role. The id of a heading or link, or of anything in a heading, is an
    address made of its text; so is a section's in an article unless it is a single word.
    """
    bad, good, part, certain = 0, 0, False, False
    values = [(kind.lower(), value.strip("\"'")) for kind, value in _ATTRIBUTE.findall(attributes)]
    in_heading = tag in HEADINGS or (around is not None and around.tag in HEADINGS)
    section = tag == "section" or any(k == "class" and "section" in v.split() for k, v in values)
    for kind, value in values:
        for name in value.split():
            words = _WORDS.findall(_CAMEL.sub("-", name).lower())
            whole_word = len(words) == 1 and words[0] == name.lower() and words[0] in PART_WORDS
            if kind == "id":
                if in_heading or tag == "a":
                    continue
                if section and around is not None and around.article and not whole_word:
                    continue
            state = next((i for i, word in enumerate(words) if word in STATE_WORDS), len(words))
            words = words[:state]
            part = part or whole_word
            certain = certain or (whole_word and kind != "class")
            if not BAD_WORDS.isdisjoint(words):
                bad += 1
            elif not GOOD_WORDS.isdisjoint(words):
                good += 1
    if bad:
        return (BAD_WEIGHT if certain or bad > good else 0.0), part
    return (GOOD_WEIGHT if good else 0.0), part


def landmark(attributes: str) -> str | None:
    """The element that an element's role makes it one of, if it is a part beside the text."""
    for kind, value in _ATTRIBUTE.findall(attributes) if "role" in attributes.lower() else ():
        if kind.lower() == "role":
            names = value.strip("\"'").lower().split()
            return ROLE_TAG.get(names[0]) if names else None
    return None


def weigh(elements: list[Element], found: list[Block]) -> None:
    """Sum the weights from the page inwards.

    What is around all of the page says nothing about its parts: html, body, and elements that
    hold a main element, or blocks with nearly all text, or an article with half of it, have no
    wording; a form around nearly all text has no weight either.
    """
    count = len(elements)
    size, direct = [0] * count, [0] * count
    holds_main, holds_article = [False] * count, [False] * count
    for block in found:
        own = block.element
        while elements[own].parent > 0 and elements[own].tag not in BLOCKS:
            own = elements[own].parent
        direct[own] += len(block.text)
    for i in range(count - 1, 0, -1):
        element, above = elements[i], elements[i].parent
        size[i] += direct[i]
        size[above] += size[i]
        if size[i]:
            main = element.tag == "main"
            clean = element.tag == "article" and element.wording >= 0
            holds_main[above] |= holds_main[i] or main
            holds_article[above] |= holds_article[i] or clean
    total = size[0] + direct[0]
    for i in range(1, count):
        element, inside = elements[i], size[i] - direct[i]
        wide = (
            element.tag in ("html", "body")
            or holds_main[i]
            or (inside >= WIDE * total and not element.part)
            or (holds_article[i] and inside >= WIDE_WITH_ARTICLE * total)
        )
        if not (wide and inside) and element.tag not in ("html", "body"):
            element.weight += element.wording
        if element.tag == "form" and (holds_main[i] or size[i] >= WIDE * total):
            element.weight = max(0.0, element.weight)
        element.weight += elements[element.parent].weight


def left_open(page: str) -> set[int]:
    """Where the unread elements start that no end tag closes, by position in the page."""
    opened: dict[str, list[int]] = {}
    endless: set[str] = set()
    at = 0
    while tag := _TAG.search(page, at):
        at = tag.end()
        name = (tag[2] or "").lower()
        if name not in UNREAD or name == "head":
            continue
        if tag[1]:
            if opened.get(name):
                opened[name].pop()
        elif not tag[3].rstrip().endswith("/") or name in BLOCKS:
            opened.setdefault(name, []).append(tag.start())
            if name in RAW:
                end = raw_end(page, name, at, endless)
                at = at if end is None else end
    return {start for starts in opened.values() for start in starts}


def raw_end(page: str, name: str, at: int, endless: set[str]) -> int | None:
    """Where an element's unparsed text ends; None if it is left open and parsed after all.

    ``endless`` collects the names without an end tag ahead, so that none is sought twice.
    """
    if name not in endless:
        end = re.compile(rf"</{name}[\s>/]", re.I).search(page, at)
        if end:
            return end.start()
        endless.add(name)
    return len(page) if name in ("script", "style") else None


def blocks_of(page: str) -> tuple[list[Element], list[Block]]:
    """The text blocks of a page in order, and the elements around them."""
    elements = [Element("", -1, 0.0, False, False)]
    stack, found = [0], []
    block = Block(0)
    at, unread = 0, 0
    loose, endless = left_open(page), set()
    opened: Counter = Counter()  # elements on the stack, by tag

    def say(text: str) -> None:
        if unread and elements[stack[-1]].tag == "head" and text.strip():
            close(len(stack) - 1)
        if text and not unread:
            text = unescape(text)
            block.parts.append(text)
            if elements[stack[-1]].link:
                block.linked += len(text.strip())

    def finish() -> None:
        nonlocal block
        text = " ".join("".join(block.parts).split())
        if text:
            block.text = text
            found.append(block)
        block = Block(stack[-1])

    def close(depth: int) -> None:
        nonlocal unread
        while len(stack) > depth:
            tag = elements[stack.pop()].tag
            opened[tag] -= 1
            unread -= tag in UNREAD
            if tag in BLOCKS:
                finish()
        block.element = stack[-1]

    while True:
        tag = _TAG.search(page, at)
        if not tag:
            rest = page[at:]
            cut = re.search(r"<[/a-zA-Z!?]", rest)
            say(rest[: cut.start()] if cut else rest)
            break
        say(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if tag[1]:
            if opened[name]:
                depth = len(stack) - 1
                while elements[stack[depth]].tag != name:
                    depth -= 1
                close(depth)
            elif name in BLOCKS:
                finish()
            continue
        if unread and name not in HEAD:
            for depth in range(len(stack) - 1, 0, -1):
                inside = elements[stack[depth]]
                if inside.tag == "head" or (inside.loose and name in BLOCKS):
                    close(depth)
                elif inside.tag in UNREAD:
                    break
        if name in VOID:
            if name == "hr":
                finish()
            elif name == "br":
                say(" ")
            continue
        top = elements[stack[-1]].tag
        if name in CLOSED_BY.get(top, ()):
            close(len(stack) - 1)
        elif name in BLOCKS:  # <p><b>..<p>: inline elements left open end with their block
            for depth in range(len(stack) - 1, 0, -1):
                inside = elements[stack[depth]].tag
                if name in CLOSED_BY.get(inside, ()):
                    close(depth)
                    break
                if inside in BLOCKS:
                    break
            finish()
        if tag[3].rstrip().endswith("/") and name not in BLOCKS:
            continue
        above = elements[stack[-1]]
        says, part = wording(tag[3], name, above) if "=" in tag[3] else (0.0, False)
        weight = 0.0
        if not (name == "header" and above.article):
            weight = TAG_WEIGHT.get(name, 0.0)
        if role := landmark(tag[3]):
            weight = min(weight, TAG_WEIGHT[role])
        article = above.article or name in ("article", "main")
        link = above.link or name == "a"
        left = tag.start() in loose
        elements.append(Element(name, stack[-1], weight, link, article, left, says, part))
        stack.append(len(elements) - 1)
        opened[name] += 1
        unread += name in UNREAD
        block.element = stack[-1] if not block.parts else block.element
        if name in RAW:
            end = raw_end(page, name, at, endless)
            if end is not None:
                say(page[at:end])
                at = end
    close(1)
    finish()
    weigh(elements, found)
    return elements, found


def score(elements: list[Element], block: Block) -> float:
    """Log-odds that a block is content."""
    element = elements[block.element]
    text, own = block.text, element
    while own.parent > 0 and own.tag not in BLOCKS:
        own = elements[own.parent]
    words = text.count(" ") + 1
    share = min(1.0, block.linked / max(1, len(text)))
    value = -0.6 + element.weight + OWN_WEIGHT.get(own.tag, 0.0) - 5.0 * share
    value += min(2.0, words / 15)
    if text[-1] in ".!?…。:;\"'”":
        value += 0.6
    return value


def minimum_cut(gains: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source when flow is at its maximum.

    A node with gain g > 0 is tied to the source with capacity g, one with g < 0 to the
    sink with -g; edges are open both ways. Blocking flows over levels.
    """
    count = len(gains)
    source, sink = count, count + 1
    heads: list[list[int]] = [[] for _ in range(count + 2)]
    to: list[int] = []
    room: list[float] = []

    def tie(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(there)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for node, gain in enumerate(gains):
        if gain > 0:
            tie(source, node, gain, 0.0)
        elif gain < 0:
            tie(node, sink, -gain, 0.0)
    for a, b, capacity in edges:
        tie(a, b, capacity, capacity)

    while True:
        level = [-1] * (count + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for edge in heads[node]:
                if room[edge] > 1e-9 and level[to[edge]] < 0:
                    level[to[edge]] = level[node] + 1
                    queue.append(to[edge])
        if level[sink] < 0:
            return [level[node] >= 0 for node in range(count)]
        tried = [0] * (count + 2)  # edges of a node that lead nowhere on these levels
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(room[edge] for edge in path)
                for edge in path:
                    room[edge] -= flow
                    room[edge ^ 1] += flow
                full = next(i for i, edge in enumerate(path) if room[edge] <= 1e-9)
                node = to[path[full] ^ 1]
                del path[full:]
                continue
            own = heads[node]
            while tried[node] < len(own):
                edge = own[tried[node]]
                if room[edge] > 1e-9 and level[to[edge]] == level[node] + 1:
                    break
                tried[node] += 1
            if tried[node] < len(own):
                path.append(edge)
                node = to[edge]
            elif path:
                edge = path.pop()
                node = to[edge ^ 1]
                tried[node] += 1
            else:
                break


def labels(gains: list[float], parents: list[int]) -> list[bool]:
    """Content or not for blocks in page order, with their elements.

    Neighbours are tied directly, the blocks of one element through a node of its own.
    Runs of blocks that agree in sign and element are one node, with the sum of their gains.
    """
    runs: list[list] = []
    member = []
    for gain, parent in zip(gains, parents, strict=True):
        if runs and runs[-1][1] == parent and (runs[-1][0] > 0) == (gain > 0):
            runs[-1][0] += gain
        else:
            runs.append([gain, parent])
        member.append(len(runs) - 1)
    if len(runs) == 1 or len({run[0] > 0 for run in runs}) == 1:
        return [runs[m][0] > 0 for m in member]
    nodes = [run[0] for run in runs]
    edges = [(i, i + 1, NEIGHBOUR) for i in range(len(runs) - 1)]
    shared: dict[int, int] = {}
    for i, (_, parent) in enumerate(runs):
        if parent not in shared:
            shared[parent] = len(nodes)
            nodes.append(0.0)
        edges.append((i, shared[parent], SIBLING))
    content = minimum_cut(nodes, edges)
    return [content[m] for m in member]


def main_text(page: str) -> str:
    """The content blocks of a page, one to a line."""
    elements, found = blocks_of(page)
    if not found:
        return ""
    parents = []
    for block in found:
        own = elements[block.element]
        while own.parent > 0 and own.tag not in BLOCKS:
            own = elements[own.parent]
        parents.append(own.parent)
    chosen = labels([score(elements, block) for block in found], parents)
    return "\n".join(block.text for block, keep in zip(found, chosen, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text and n_chars, its code points."""
    python_workers(pages.sparkSession)

    def read(batches):
        for batch in batches:
            text = batch["html"].map(main_text)
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "text": text,
                    "n_chars": text.map(len).astype("int64"),
                }
            )

    rows = pages.select(F.col("page_id").cast("long"), "url", whole("html").alias("html"))
    return rows.mapInPandas(read, "page_id long, url string, text string, n_chars long")
