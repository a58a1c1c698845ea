"""The main text of web pages by scoring their trees.

A page becomes a light tree (unclosed and crossed tags are repaired as browsers do). Subtrees that are
never article text go: menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments. A class or id that names such a part deletes an element only if the article is not in it: where
the only ``article`` or ``main`` or most of the paragraphs lie inside, it stays. Each paragraph then passes points for its length and its commas to its ancestors, the
nearest most; a container's points are discounted by the share of its text that lies in links.
The best container and those siblings that look like parts of the same article are kept, whole; without an
``article`` or ``main`` those are all siblings with prose that is not in links.

Defined results: null and empty pages, and pages without text, give an empty text; repeated rows are
treated row by row; work grows in proportion to a page's length, however deep its elements are
nested and however many are left open. A character reference counts within one piece of text only. Other
columns are not looked at.
"""

from __future__ import annotations

import html as references
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by what they do, and words in class and id that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
FURNITURE = frozenset(
    "nav footer aside form button select option input label menu dialog object embed svg canvas video audio head".split()
)
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address header footer nav aside form fieldset hr center details "
    "summary br menu dialog".split()
)
CONTAINERS = {"div": 5.0, "article": 10.0, "main": 8.0, "section": 4.0, "td": 3.0, "blockquote": 3.0, "pre": 3.0}
PARAGRAPHS = frozenset("p td pre blockquote li dd".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {  # a new element of the left kind closes an open one of the right kinds
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
#: An element closes like ones only up to the nearest of these.
SCOPES = ("ul", "ol", "dl", "table", "select")
UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo related replies reply share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
EXEMPT = frozenset("html body article main".split())
#: The share of a page's paragraph points that keeps an element in spite of its names: one of them is the word, or has it.
NAMED_SHARE, COMPOUND_SHARE = 0.9, 0.5
#: Characters in paragraphs, or else of plain text, from which a sibling without many links counts as prose.
PARAGRAPH_CHARS, PLAIN_CHARS = 25, 80
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
NAMES = re.compile(r"\b(class|id|role|style|aria-hidden|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORDS = re.compile(r"[^a-z0-9]+")


class Node:
    __slots__ = ("tag", "parent", "children", "score", "attributes", "chars", "linked", "commas")

    def __init__(self, tag: str, parent: Node | None, attributes: str = "") -> None:
        self.tag, self.parent, self.attributes = tag, parent, attributes
        self.children: list[Node | str] = []
        self.score: float | None = None
        self.chars = self.linked = self.commas = 0  # set by ``measure``

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def elements(self) -> list[Node]:
        return [c for c in self.children if not isinstance(c, str)]


class OpenElements:
    """The path from the root to where text goes now, with the depths at which each tag is open.

    Every step costs a constant, besides the elements it closes.
    """

    def __init__(self, root: Node) -> None:
        self.path, self.blocks = [root], [0]
        self.depths: dict[str, list[int]] = defaultdict(list)

    def open(self, node: Node) -> None:
        self.depths[node.tag].append(len(self.path))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.path))
        self.path.append(node)

    def close_to(self, depth: int) -> None:
        """Closes the element at ``depth`` and all in it."""
        while len(self.path) > depth:
            node = self.path.pop()
            self.depths[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def deepest(self, tags: Iterator[str] | tuple[str, ...] | frozenset[str]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths[t]), default=0)

    def end(self, tag: str) -> None:
        """An end tag closes the nearest open element of its name; one of an inline element closes no block."""
        depth = self.deepest((tag,))
        if depth and (tag in BLOCKS or depth > self.blocks[-1]):
            self.close_to(depth)

    def end_paragraph(self) -> None:
        if self.path[self.blocks[-1]].tag == "p":
            self.close_to(self.blocks[-1])

    def end_like(self, tags: frozenset[str]) -> None:
        while (depth := self.deepest(tags)) > self.deepest(SCOPES):
            self.close_to(depth)
            if self.path[-1].tag not in tags:
                break


def parse(page: str) -> Node:
    """The tree of a page. Raw elements stay without their content."""
    root = Node("#root", None)
    opened, place = OpenElements(root), 0
    lowered: str | None = None
    while place < len(page):
        found = TOKEN.search(page, place)
        text = page[place : found.start() if found else len(page)]
        if text:
            opened.path[-1].children.append(text)
        if not found:
            break
        place = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            opened.end(tag)
            continue
        if tag in BLOCKS and tag != "br":
            opened.end_paragraph()
        if tag in CLOSES:
            opened.end_like(CLOSES[tag])
        node = Node(tag, opened.path[-1], attributes or "")
        node.parent.children.append(node)
        if tag in RAW:
            lowered = page.lower() if lowered is None else lowered
            end = lowered.find(f"</{tag}", place) if len(lowered) == len(page) else _find_close(page, tag, place)
            place = len(page) if end < 0 else end
        if tag not in VOID and not (attributes or "").endswith("/"):
            opened.open(node)
    return root


def _find_close(page: str, tag: str, place: int) -> int:
    found = re.compile(f"</{re.escape(tag)}", re.I).search(page, place)
    return found.start() if found else -1


def bottom_up(root: Node) -> list[Node]:
    """All elements, each after those inside it."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(node.elements())
    return order[::-1]


def measure(root: Node) -> list[Node]:
    """Sets on every element its characters, those in links, and its commas; returns ``bottom_up``."""
    order = bottom_up(root)
    for node in order:
        node.chars = node.linked = node.commas = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(child.strip())
                node.commas += child.count(",") + child.count("，") + child.count("、")
            else:
                node.chars += child.chars
                node.linked += child.linked
                node.commas += child.commas
        if node.tag == "a":
            node.linked = node.chars
    return order


def is_furniture(node: Node, in_article: bool) -> bool:
    if node.tag in FURNITURE or node.tag in RAW:
        return True
    if node.tag == "header" and not in_article:
        return True
    if not node.attributes or node.tag in EXEMPT:
        return False
    for name, *values in NAMES.findall(node.attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "role" and value in ROLES or name == "hidden" and value != "until-found":
            return True
        if name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def unlikely(node: Node) -> float | None:
    """The share of points that keeps a node whose class or id names page furniture; None for other nodes."""
    if not node.attributes or node.tag in EXEMPT:
        return None
    share = None
    for name, *values in NAMES.findall(node.attributes):
        value = "".join(values).lower()
        if name.lower() not in ("class", "id") or UNLIKELY.isdisjoint(WORDS.split(value)):
            continue
        if not UNLIKELY.isdisjoint(value.split()):
            return NAMED_SHARE
        share = COMPOUND_SHARE
    return share


def prune(root: Node) -> None:
    """Deletes page furniture: by element, role and visibility, then by names.

    Of the elements with such names those go first that lie outside all articles or within one, then plain names, then compound ones.
    """
    waiting, named = [(root, False)], False
    while waiting:
        at, in_article = waiting.pop()
        in_article = in_article or at.tag in ("article", "main")
        at.children = [c for c in at.children if isinstance(c, str) or not is_furniture(c, in_article)]
        inner = at.elements()
        named = named or any(unlikely(c) is not None for c in inner)
        waiting.extend((c, in_article) for c in inner)
    for share in (None, NAMED_SHARE, COMPOUND_SHARE) if named else ():
        held = holdings(root)
        waiting = [root]
        while waiting:
            at = waiting.pop()
            at.children = [
                c for c in at.children if isinstance(c, str) or holds_article(unlikely(c), share, held[id(c)], held[id(root)])
            ]
            waiting.extend(at.elements())


def names_furniture(article: Node) -> bool:
    """Whether the names of an ``article`` begin with such a word, as those of single comments do."""
    values = ["".join(v).lower() for name, *v in NAMES.findall(article.attributes) if name.lower() in ("class", "id")]
    return any(WORDS.split(x)[0] in UNLIKELY for value in values for x in value.split())


def holdings(root: Node) -> dict[int, list[float]]:
    """Per node the paragraph points, the ``article`` and ``main`` elements and the first headings in it."""
    held = {}
    for node in measure(root):
        article = node.tag in ("article", "main") and not names_furniture(node)
        sums = [own_points(node)[0], float(article), float(node.tag == "h1")]
        for child in node.children:
            if not isinstance(child, str):
                sums = [x + y for x, y in zip(sums, held[id(child)], strict=True)]
        held[id(node)] = sums
    return held


def holds_article(needed: float | None, judged: float | None, inside: list[float], page: list[float]) -> bool:
    """False for elements with furniture's names that do not wrap the article, as far as they are judged now."""
    points, articles, titles = inside
    if needed is None or judged not in (None, needed):
        return True
    if judged is None:
        most = needed == COMPOUND_SHARE and points >= needed * page[0]
        return articles > 0 or not page[1] or most  # else the article is elsewhere
    if page[1] > articles and judged == NAMED_SHARE:
        return False
    if articles or titles and titles == page[2]:
        needed = COMPOUND_SHARE
    return points > 0 and points >= needed * page[0]


def texts(node: Node) -> Iterator[tuple[str | None, bool]]:
    """The pieces of text in page order and whether they lie in a link; None at block borders."""
    waiting: list[tuple[Node | str | None, bool]] = [(node, False)]
    while waiting:
        at, linked = waiting.pop()
        if at is None or isinstance(at, str):
            yield at, linked
            continue
        linked = linked or at.tag == "a"
        border = [(None, linked)] if at.tag in BLOCKS else []
        waiting.extend([*border, *[(c, linked) for c in reversed(at.children)], *border])


def score(root: Node) -> list[Node]:
    """Passes the points of all paragraphs upwards; returns the nodes that got some."""
    scored: list[Node] = []
    for node in reversed(measure(root)):
        points, direct = own_points(node)
        if not points:
            continue
        receivers = [*([node] if direct else []), *islice(node.ancestors(), 4)][:4]
        for level, ancestor in enumerate(receivers):
            if ancestor.score is None:
                ancestor.score = CONTAINERS.get(ancestor.tag, 0.0)
                scored.append(ancestor)
            ancestor.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
    return scored


def own_points(node: Node) -> tuple[float, bool]:
    """The points of a paragraph, or of plain text that lies directly in a container; and whether it is the latter."""
    direct = node.tag in ("div", "section", "article", "main", "body", "#root") and any(
        isinstance(c, str) and c.strip() for c in node.children
    )
    if node.tag not in PARAGRAPHS and not direct:
        return 0.0, False
    total, commas = _direct_lengths(node) if direct else (node.chars, node.commas)
    return (min(1.0, total / 25) + commas + min(total / 100, 3.0) if total else 0.0), direct


def _direct_lengths(node: Node) -> tuple[int, int]:
    """Characters and commas of the text that lies directly in an element."""
    own = [c for c in node.children if isinstance(c, str)]
    return sum(len(c.strip()) for c in own), sum(c.count(",") for c in own)


def link_share(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def is_prose(node: Node) -> bool:
    """Whether a part has text in paragraphs, list items or cells, or long plain text, and few links."""
    if link_share(node) >= 0.25:
        return False
    paragraphs = plain = 0
    waiting = [node]
    while waiting:
        at = waiting.pop()
        if at.tag in PARAGRAPHS:
            paragraphs += at.chars
            continue
        plain += _direct_lengths(at)[0]
        waiting.extend(at.elements())
    return paragraphs >= PARAGRAPH_CHARS or plain >= PLAIN_CHARS


def best_parts(root: Node) -> list[Node]:
    """The best container with the siblings that belong to it, in page order."""
    scored = score(root)
    if not scored:
        return [root]
    final = {id(n): n.score * (1 - link_share(n)) for n in scored}
    best = max(scored, key=lambda n: final[id(n)])
    for ancestor in best.ancestors():  # parts of one article stay together
        if ancestor.tag in ("article", "main"):
            best = ancestor
    if best.parent is None:
        return [best]
    limit = max(10.0, 0.2 * final.get(id(best), 0.0))
    kept = []
    for sibling in best.parent.children:
        if isinstance(sibling, str):
            continue
        if sibling is best or final.get(id(sibling), 0.0) >= limit:
            kept.append(sibling)
        elif sibling.tag == "p" or sibling.tag in HEADINGS:
            if sibling.chars and link_share(sibling) < 0.25:
                kept.append(sibling)
        elif best.tag not in ("article", "main") and sibling.tag in BLOCKS and is_prose(sibling):
            kept.append(sibling)
    return kept


def main_text(page: str | None) -> str:
    """The blocks of the main text, one per line."""
    if not page:
        return ""
    root = parse(page)
    prune(root)
    blocks: list[str] = []
    for part in best_parts(root):
        pieces: list[str] = []
        for piece, _ in [*texts(part), (None, False)]:
            if piece is not None:
                pieces.append(piece)
            elif pieces:
                block = " ".join("".join(map(references.unescape, pieces)).split())
                if block:
                    blocks.append(block)
                pieces = []
    return "\n".join(blocks)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per page ``(id, url, text, n_chars)``. No shuffle; a page is read as a whole."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py()) for x in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.string())]
            counts = pa.array([len(x) for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, counts], names=["id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    found = pages.select(id_col, url_col, html_col).mapInArrow(
        extract, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint"
    )
    return found.withColumnsRenamed({"id": id_col, "url": url_col})
