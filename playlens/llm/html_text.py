"""Main text of web pages by the ratios of their tag paths.

A page is read as text nodes, each with the path of its open tags from the root. For every path,
text length and punctuation are summed and divided by its number of nodes; both ratios are smoothed
over the paths in page order with a Gaussian window, standardised by their deviation and multiplied.
Paths whose fused ratio passes a threshold hold content. The smallest element that holds all of the
content, or the article or main element around it, is the article; its text is taken whole, short
paragraphs and headings included. Of several article and main parts with content all are taken.

Furniture takes no part:
* always what tags and roles name (navigation, headers, footers, sidebars, controls, dialogs);
* inside an article or main part beside that only forms and elements with an unmistakable name of an
  advert, sidebar or comment list as a whole class or id;
* elsewhere every whole class or id that names furniture, unless the element is around an article or
  main part (of parts that list other texts, such as comments, this holds only while no article or
  main part stands outside all of these) or nothing would be left;
* forms and names that merely contain such a word (nav-open, top-nav) where no article or main part is
  found, unless a path in them holds content by its ratio. Such an element is a step of its own in a
  path.

Edge cases
    null, empty, tagless html   null and empty give the empty text, plain text is its own block
    unclosed, misnested tags    closed as browsers do for paragraphs, list items and cells
    unclosed markup             a tag without its end is text
    repeated rows               give repeated results
    very long, very deep pages  one pass; time and memory in proportion to the page
    other columns               ignored, whatever their names
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
PLAIN = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no markup and no text of the page.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q "
                   "rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img "
                   "label".split())
SKIPPED = frozenset("nav header footer aside button select option menu dialog svg "
                    "canvas audio video object head".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog "
                          "menu menubar toolbar".split())
FORMS = frozenset(("form", "fieldset"))
CONTENT_TAGS = frozenset(("article", "main"))

# Whole classes and ids that can only name furniture, inside an article, too.
STRICT = frozenset(
    "ad ads advert adverts advertisement advertisements sponsored sidebar side-bar comments "
    "comment-list commentlist comment-section comments-area disqus disqus_thread".split())
# Furniture that may list articles of its own.
LISTS = STRICT | frozenset(
    "adv sponsor promo aside widget widgets related recommend recommended recommendations comment "
    "respond replies reply".split())
NAMES = LISTS | frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer banner share sharing "
    "social subscribe subscription newsletter signup sign-up login cookie cookies consent gdpr "
    "notice notices popup modal overlay toolbar pagination pager skip-link skiplink legal copyright "
    "disclaimer alert".split())
# Beginnings of names that are always notices.
NOTICES = ("cookie-", "cookies-", "gdpr-", "consent-")
# The same words as a part of a name say less.
PART_OF_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adv|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|"
    r"header|masthead|footer|side-?bar\w*|aside|widget\w*|related|recommend\w*|share|sharing|"
    r"social|subscri\w*|newsletter|sign-?up|login|popup|modal|overlay|comment\w*|disqus|respond|"
    r"replies|reply|toolbar|pagination|pager|skip-?link|copyright|disclaimer)(?:$|[\s_-])", re.I)
# How an element is told as furniture.
NONE, LOOSE, NAMED, LISTING, ALWAYS, SURE = range(6)

# Of two tags in a pair, the new one closes the open one unless the boundary comes first.
CLOSES = {"p": (frozenset(("p",)), frozenset("td th button li blockquote".split())),
          "li": (frozenset(("li",)), frozenset("ul ol menu".split())),
          "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
          "tr": (frozenset("tr td th".split()), frozenset(("table",))),
          "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
          "option": (frozenset(("option",)), frozenset(("select",)))}
CLOSES_AS = {"li": "li", "dt": "dt", "dd": "dt", "tr": "tr", "td": "td", "th": "td",
             "option": "option"}
BORDERS = frozenset().union(*(closed | bounds for closed, bounds in CLOSES.values()))
PUNCTUATION = frozenset(".,;:!?…。，、；：！？")

THRESHOLD = 0.5  # of the deviation of the fused ratios


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    parent: Node | None
    furniture: int
    depth: int
    path: int
    # For each pair of CLOSES the outermost open element that a new tag would close.
    open: dict[str, Node]
    skipped: bool = False
    has_text: bool = False
    around: bool = False
    inside: bool = False
    mass: int = 0


@dataclass(slots=True)
class Path:
    length: int = 0
    marks: int = 0
    nodes: int = 0


@dataclass
class Page:
    """Elements, parents first, and text nodes in page order: (block number, element, text)."""

    texts: list = field(default_factory=list)
    elements: list = field(default_factory=list)


def tag_end(html: str, at: int) -> int:
    """Where the tag with its attributes from `at` on ends, behind the `>`; quoted ones are skipped.

    A quote that is never closed is an ordinary character. -1 if there is no end.
    """
    while True:
        at = PLAIN.match(html, at).end()
        if at == len(html):
            return -1
        if html[at] == ">":
            return at + 1
        closed = html.find(html[at], at + 1)
        at = closed + 1 if closed >= 0 else at + 1


def parse(html: str) -> Page:
    page = Page()
    node = Node("", None, NONE, 0, 0, {})
    page.elements.append(node)
    paths: dict[tuple[int, str, bool], int] = {}
    open_tags: Counter[str] = Counter()
    at, block, past = 0, 0, 0
    final = html.rfind(">")

    def text(upto: int) -> None:
        if upto > past and (found := html[past:upto]):
            page.texts.append((block, node, unescape(found)))

    def close(until: Node) -> Node:
        """Closes the open elements up to `until` and it."""
        current = node
        while current is not until.parent:
            open_tags[current.tag] -= 1
            current = current.parent
        return current

    while 0 <= (start := html.find("<", at)) <= final or html.startswith("<!--", start):
        at = start + 1
        if html.startswith("<!--", start):
            ends = html.find("-->", start + 4)
        elif html.startswith("<![CDATA[", start):
            ends = html.find("]]>", start + 9)
        elif html.startswith(("<!", "<?"), start):
            text(start)
            at = past = html.index(">", start) + 1
            continue
        else:
            ends = None
        if ends is not None:
            text(start)
            at = past = ends + 3 if ends >= 0 else len(html)
            continue
        match = OPEN.match(html, at)
        if not match:
            continue
        ends = tag_end(html, match.end())
        if ends < 0:
            continue
        text(start)
        attributes = html[match.end():ends - 1]
        at = past = ends
        tag = match[2].lower()
        if tag == "br":
            page.texts.append((block, node, " "))
        if tag not in INLINE:
            block += 1
        if match[1]:
            if open_tags[tag] > 0:
                until = node
                while until.tag != tag:
                    until = until.parent
                node = close(until)
            continue
        if tag not in INLINE and (outer := node.open.get("p")):
            node = close(outer)
        if tag in CLOSES_AS and (outer := node.open.get(CLOSES_AS[tag])):
            node = close(outer)
        if tag in VOID:
            continue
        told = furniture(tag, attributes)
        path = paths.setdefault((node.path, tag, told == LOOSE), len(paths) + 1)
        child = Node(tag, node, told, node.depth + 1, path, node.open)
        if tag in BORDERS:
            child.open = {pair: outer for pair, outer in node.open.items()
                          if tag not in CLOSES[pair][1]}
            for pair, (closed, bounds) in CLOSES.items():
                if tag in closed and tag not in bounds:
                    child.open.setdefault(pair, child)
        page.elements.append(child)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = past = end.end() if end else len(html)
        elif not attributes.rstrip().endswith("/") or tag not in ("svg", "path"):
            node = child
            open_tags[tag] += 1
    text(len(html))
    return page


def furniture(tag: str, attributes: str) -> int:
    if tag in SKIPPED:
        return SURE
    found = LOOSE if tag in FORMS else NONE
    if tag in ("html", "body", *CONTENT_TAGS) or "=" not in attributes:
        return found
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "role" and value in SKIPPED_ROLES:
            return SURE
        if name in ("class", "id"):
            for word in value.split():
                found = max(found, ALWAYS if word in STRICT else LISTING if word in LISTS
                            else NAMED if word in NAMES or word.startswith(NOTICES)
                            else LOOSE if PART_OF_NAME.search(word) else NONE)
        if (name, value) in (("aria-hidden", "true"), ("role", "form")):
            found = max(found, LOOSE)
    return found


def find_parts(page: Page) -> list[Node]:
    """The article and main parts that count; marks all elements around them."""
    for _, node, text in page.texts:
        if text.strip():
            node.has_text = True
    for node in reversed(page.elements):
        if node.parent and node.has_text:
            node.parent.has_text = True
    # Parts within furniture that tags name count nowhere; within lists only if there is no other.
    sure, listed, free, others = set(), set(), [], []
    for node in page.elements:
        if node.furniture == SURE or node.parent in sure:
            sure.add(node)
        elif node.furniture in (LISTING, ALWAYS) or node.parent in listed:
            listed.add(node)
        if node.tag in CONTENT_TAGS and node.has_text and node not in sure:
            (others if node in listed else free).append(node)
    parts = free or others
    for part in parts:
        part.around = True
    for node in reversed(page.elements):
        if node.around and node.parent:
            node.parent.around = True
    return parts


def skip(page: Page, parts: list[Node]) -> None:
    """Marks what takes no part; parents come before children in `elements`."""
    chosen = set(parts)
    for node in page.elements:
        parent = node.parent
        node.inside = node in chosen or bool(parent and parent.inside)
        if node.furniture == SURE or (parent and parent.skipped):
            node.skipped = True
        elif node.around:
            node.skipped = False
        elif node.inside:
            node.skipped = node.furniture == ALWAYS or node.tag in FORMS
        else:
            node.skipped = bool(parts) or node.furniture >= NAMED
    if not any(text.strip() for _, node, text in page.texts if not node.skipped):
        # Nothing would be left: only tags and roles say what is furniture.
        for node in page.elements:
            node.skipped = node.furniture == SURE or bool(node.parent and node.parent.skipped)


def path_ratios(page: Page) -> dict[int, float]:
    """The fused, smoothed ratio of every path with text, in units of its deviation."""
    paths: dict[int, Path] = {}
    for _, node, text in page.texts:
        if node.skipped or not text.strip():
            continue
        path = paths.setdefault(node.path, Path())
        path.length += len(text) - text.count(" ")
        path.marks += sum(map(text.count, PUNCTUATION))
        path.nodes += 1
    if not paths:
        return {}
    by_length = smoothed([p.length / p.nodes for p in paths.values()])
    by_marks = smoothed([p.marks / p.nodes for p in paths.values()])
    return dict(zip(paths, (a * (1 + b) for a, b in zip(by_length, by_marks, strict=True)),
                    strict=True))


def smoothed(values: list[float]) -> list[float]:
    """A Gaussian window of one neighbour on either side, then division by the deviation."""
    side = math.exp(-2.0)
    out = []
    for i, value in enumerate(values):
        near = [values[j] for j in (i - 1, i + 1) if 0 <= j < len(values)]
        out.append((value + side * sum(near)) / (1 + side * len(near)))
    mean = sum(out) / len(out)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in out) / len(out))
    return [x / deviation if deviation else 1.0 for x in out]


def content_paths(page: Page) -> set[int]:
    ratios = path_ratios(page)
    if not ratios:
        return set()
    mean = sum(ratios.values()) / len(ratios)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratios.values()) / len(ratios))
    return {path for path, r in ratios.items() if r >= THRESHOLD * min(spread, mean)}


def skip_loose(page: Page, content: set[int]) -> None:
    """Forms and loosely named elements without a content path go, unless nothing would be left."""
    holds = set()
    for _, node, text in page.texts:
        if not node.skipped and node.path in content and text.strip():
            while node and node not in holds:
                holds.add(node)
                node = node.parent
    for node in page.elements:
        if (node.parent and node.parent.skipped) or (node.furniture == LOOSE
                                                     and node not in holds):
            node.skipped = True


def main_text(html: str | None) -> str:
    """The blocks of the article, one per line."""
    if not html:
        return ""
    page = parse(html)
    parts = find_parts(page)
    skip(page, parts)
    content = content_paths(page)
    if not parts:
        skip_loose(page, content)
    for _, node, text in page.texts:
        if not node.skipped and node.path in content and (node.inside or not parts):
            node.mass += len(text.strip())
    for node in reversed(page.elements):
        if node.parent:
            node.parent.mass += node.mass
    root = page.elements[0]
    best = root
    for node in page.elements:
        if node.mass == root.mass and node.depth > best.depth:
            best = node
    # Text elements are not containers: a lone paragraph means the element around it.
    while best.parent and (best.tag in INLINE or best.tag in ("p", "li", "td", "tr", "tbody")):
        best = best.parent
    # An article that holds the content is its natural border, headings included.
    border = best
    while border and border.tag not in CONTENT_TAGS:
        border = border.parent
    best = border or best
    inside: set[Node] = set()
    for node in page.elements:
        if node is best or node.parent in inside:
            inside.add(node)
    blocks: dict[int, list[str]] = {}
    for block, node, text in page.texts:
        if not node.skipped and node in inside and (node.inside or not parts):
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(some).split()) for some in blocks.values())
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
            keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """page_id, the kept columns, text and n_chars of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), *keep, F.col(html_col).alias("__html"))
    kinds = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes[:-1])
    names = rows.columns[:-1]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], [*names, "text", "n_chars"])

    return rows.mapInArrow(read, f"{kinds}, text string, n_chars long")
