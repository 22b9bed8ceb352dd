"""The main text of web pages, by tree scoring.

A page is cut into tags and text and built into a tree, with the end tags that HTML leaves out
implied.  Parts that are never the article go: scripts, styles, menus, page headers and
footers, sidebars, forms, hidden parts, and what its class, id or role calls an advert, a
notice, a menu or comments.  Each paragraph then passes points for its length and commas to its
ancestors, whole to the first, half to the second, a third to the third and so on, and a
container's points are discounted by the share of its text that is links.  The best container
is kept, an article or main part around it whole, together with siblings that are prose too.

Blocks are what block elements set apart, in page order; character references are decoded;
white space inside a block becomes one space (line breaks and table cells are white space),
blocks are joined by a line feed.  Nothing else is dropped.

Defined results: null, empty and blank html give an empty text, and so does a page without
text; html that breaks off is read to its end; repeated rows give repeated results; null ids
and urls are carried along; an empty table gives no rows.  Only page_id, url and html are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shingles import slices

# Element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""
 address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
 figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
 p pre section summary table tbody tfoot thead tr ul""".split())
CELLS = frozenset(["td", "th"])
SPACE = CELLS | {"br", "option"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("""
 p pre blockquote li dd dt td th figcaption caption summary address""".split()) | HEADINGS
PROSE = PARAGRAPHS | {"ul", "ol", "dl", "table", "figure"}
FIELDS = frozenset("button select input textarea iframe object video".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
NEVER = RAW | frozenset("""
 head noscript template nav footer aside form button select input dialog menu svg
 object canvas audio video applet datalist""".split())
# A start tag that ends an open element, and the elements that this does not reach through.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"})}
# Words in a class, id or role that name what is not the article.
UNLIKELY = frozenset("""
 ad ads adsense adslot advert adverts advertisement advertising banner sponsor sponsored promo
 promos promoted promotion cookie cookies consent gdpr notice notices notification alert popup
 modal overlay newsletter subscribe subscription signup paywall menu menus nav navbar navigation
 navigational breadcrumb breadcrumbs sidebar sidebars rail aside widget widgets footer masthead
 adbox adunit adcontainer comment comments commentlist commentarea disqus reply replies respond
 discussion share sharing social related recommended recommendations login search searchform pagination pager
 toolbar topbar copyright colophon contentinfo complementary dialog alertdialog hidden skip outbrain taboola""".split())
# A word before one of them that says the element only stands next to such a part.
BESIDE = frozenset("has with no without show enable".split())
# Words of a class or id that calls an element the article.
LIKELY = frozenset("article blog body content copy entry hentry main page post story text".split())

WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?>[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|))*+)>""")
COMMENT = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?/][^>]*+>?", re.S)
MARKS = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|style|aria-hidden)"""
                   r"""(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/"']|$)""", re.I)
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


class Node:
    """An element: its place in the page, what is in it, and what that is worth."""

    __slots__ = ("tag", "parent", "parts", "unlikely", "article", "gone", "size", "linked", "own",
                 "commas", "points", "holds")

    def __init__(self, tag: str, parent: Node | None, unlikely: bool = False,
                 article: bool = False, gone: bool = False):
        self.tag, self.parent, self.unlikely, self.gone = tag, parent, unlikely, gone
        self.article = article and not unlikely
        self.parts: list[Node | str] = []
        self.size = self.linked = self.own = self.commas = 0
        self.points = 0.0
        self.holds = False  # the title or a part marked as the article


def names_unlikely(value: str) -> bool:
    """Whether a class, id or role names something that is not the article.

    A name made of nothing else decides; one that has such a word among others does, unless
    another name calls the element the article.
    """
    some = likely = False
    for name in value.split():
        words = [word.lower() for word in WORDS.findall(name)]
        bad = [word in UNLIKELY and (not at or words[at - 1] not in BESIDE)
               for at, word in enumerate(words)]
        if bad and all(bad):
            return True
        some = some or any(bad)
        likely = likely or bool(words) and LIKELY.issuperset(words)
    return some and not likely


def marked(attributes: str) -> tuple[bool, bool, bool]:
    """Whether attributes name an unlikely part, mark the article, or hide the element."""
    unlikely = article = hidden = False
    for name, *values in MARKS.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            unlikely = unlikely or names_unlikely(value)
            article = article or name == "role" and value.lower() in ("main", "article")
        elif name == "itemprop":
            article = article or value.lower() == "articlebody"
        elif name == "style":
            hidden = hidden or HIDDEN_STYLE.search(value) is not None
        elif name == "hidden":
            hidden = hidden or value.lower() != "until-found"
        else:
            hidden = hidden or value.lower() == "true"
    return unlikely, article, hidden


class Tree:
    """The elements of a page in order of their start."""

    def __init__(self, page: str):
        self.root = Node("html", None)
        self.nodes = [self.root]
        self.stack = [self.root]
        self.open: Counter[str] = Counter()
        at, size = 0, len(page)
        while at < size:
            less = page.find("<", at)
            if less < 0:
                less = size
            if less > at:
                self.stack[-1].parts.append(page[at:less])
            if less == size:
                break
            tag = TAG.match(page, less)
            if tag is not None:
                at = tag.end()
                name = tag[2].lower()
                if tag[1]:
                    self.end(name)
                    continue
                self.start(name, tag[3])
                if name in RAW:
                    closing = RAW_ENDS[name].search(page, at)
                    at = closing.start() if closing else size
                continue
            following = page[less + 1:less + 2]
            if following in ("!", "?") or (following == "/" and less + 2 < size):
                at = COMMENT.match(page, less).end()
            elif following.isascii() and following.isalpha():
                break  # a tag that the page breaks off in
            else:
                self.stack[-1].parts.append("<")
                at = less + 1

    def start(self, name: str, attributes: str) -> None:
        if name in IMPLIED_END:
            self._close_open(*IMPLIED_END[name])
        elif name in BLOCK and self.open["p"]:
            self._close_open({"p"}, CELLS | {"table", "button"})
        if name in ("html", "body"):
            return
        unlikely, article, hidden = marked(attributes) if "=" in attributes or (
            "hidden" in attributes.lower()) else (False, False, False)
        node = Node(name, self.stack[-1], unlikely, article or name in ("article", "main"),
                    hidden or name in NEVER)
        self.stack[-1].parts.append(node)
        self.nodes.append(node)
        if name not in VOID:
            self.stack.append(node)
            self.open[name] += 1

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
        if not self.open[name]:
            return
        block = name in BLOCK or name in CELLS or name in NEVER
        for place in range(len(self.stack) - 1, 0, -1):
            found = self.stack[place].tag
            if found == name:
                self._cut(place)
                return
            if (found in CELLS and name not in ("tr", "table", "tbody", "thead", "tfoot")
                    or not block and found in BLOCK):
                return

    def _close_open(self, names: set[str], until: set[str]) -> None:
        if not any(self.open[name] for name in names):
            return
        for place in range(len(self.stack) - 1, 0, -1):
            found = self.stack[place].tag
            if found in names:
                self._cut(place)
                return
            if found in until:
                return

    def _cut(self, place: int) -> None:
        for node in self.stack[place:]:
            self.open[node.tag] -= 1
        del self.stack[place:]


def _mark_gone(nodes: list[Node], by_name: bool = True) -> None:
    """Which parts are not looked at: never the article, hidden, or named so.

    A part named so stays where it holds the page's title or a part marked as the article:
    then it is a wrapper.  A header stays inside an article.
    """
    for node in reversed(nodes):
        if node.parent is not None and not node.gone and (
                node.article or node.holds or node.tag == "h1" and not node.unlikely):
            node.parent.holds = True
    inside = {None: False}
    for node in nodes:
        parent = node.parent
        inside[node] = node.article or inside[parent]
        node.gone = node.gone or parent is not None and (
            parent.gone or by_name and node.unlikely and not node.holds
            or node.tag == "header" and not inside[node])


def _score(nodes: list[Node]) -> None:
    """Lengths, links and points of every element that is looked at."""
    for node in nodes:
        if node.gone:
            continue
        for part in node.parts:
            if isinstance(part, str):
                text = part.strip()
                node.own += len(text)
                node.commas += text.count(",") + text.count("，") + text.count("、")
    for node in reversed(nodes):
        if node.gone:
            continue
        node.size += node.own
        if node.tag == "a":
            node.linked = node.size
        parent = node.parent
        if parent is None:
            continue
        parent.size += node.size
        parent.linked += node.linked
        if node.tag not in BLOCK and node.tag not in CELLS:  # inline: text of its block
            parent.own += node.own
            parent.commas += node.commas
    for node in nodes:
        if node.gone or not node.own or node.tag not in BLOCK and node.tag not in CELLS:
            continue
        prose = 1 - min(node.linked, node.size) / node.size
        worth = (1 + node.commas + min(node.own / 100, 3.0)) * prose
        if node.tag in HEADINGS:
            worth /= 4
        above, share = node.parent if node.tag in PARAGRAPHS else node, 1
        while above is not None and share <= 6:
            above.points += worth / share
            above, share = above.parent, share + 1


def _density(node: Node) -> float:
    return min(node.linked, node.size) / node.size if node.size else 0.0


def _best(nodes: list[Node]) -> Node:
    """The container with most points; parts marked as the article have an advantage."""
    best, most = nodes[0], -1.0
    for node in nodes:
        if node.gone or not node.size:
            continue
        prose = 1 - _density(node)
        worth = prose * (2 * node.points + 10 if node.article else node.points)
        if worth > most:
            best, most = node, worth
    while best.tag in ("tr", "tbody", "thead", "tfoot") and best.parent is not None:
        best = best.parent  # rows of text are a table; a cell of paragraphs stays a container
    around, above = best, best.parent
    while above is not None:
        if above.article:
            around = above
            if above.tag == "article":
                break
        above = above.parent
    return around


def _kept(best: Node) -> list[Node]:
    """The best container and, where no part is marked as the article, what stands beside it
    that is prose too."""
    if best.parent is None or best.article:
        return [best]
    least = 0.0 if best.tag == "section" else max(3.0, best.points / 5)
    return [part for part in best.parent.parts if isinstance(part, Node) and not part.gone
            and part.size and (part is best or _density(part) < 0.3 and (
                part.tag in PROSE
                or part.tag == best.tag and part.points * (1 - _density(part)) >= least))]


def _blocks(kept: list[Node]) -> list[str]:
    """Texts of the blocks below the kept elements, in page order."""
    blocks: list[str] = []
    pieces: list[str] = []

    def close() -> None:
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            blocks.append(text)
        pieces.clear()

    for top in kept:
        walk: list[Node | str | None] = [top]
        ends: list[str] = []
        while walk:
            part = walk.pop()
            if part is None:
                tag = ends.pop()
                if tag in BLOCK:
                    close()
                elif tag in CELLS:
                    pieces.append(" ")
            elif isinstance(part, str):
                pieces.append(part)
            elif part.gone:
                if part.tag in BLOCK:
                    close()
                elif part.tag in FIELDS:
                    pieces.append(" ")
            else:
                if part.tag in BLOCK:
                    close()
                elif part.tag in SPACE:
                    pieces.append(" ")
                walk.append(None)
                ends.append(part.tag)
                walk += reversed(part.parts)
        close()
    return blocks


def main_text(page: str | None) -> str:
    """The blocks of the article of one page, a line each."""
    if not page:
        return ""
    nodes = Tree(page).nodes
    _mark_gone(nodes)
    _score(nodes)
    if not nodes[0].size:  # all of it is called something else: names do not tell here
        nodes = Tree(page).nodes
        _mark_gone(nodes, by_name=False)
        _score(nodes)
    return "\n".join(_blocks(_kept(_best(nodes))))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = [main_text(page.as_py()) for page in batch["text"]]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string())],
            ["page_id", "url", "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its length in code points, of every page."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url"), F.col("html").alias("text"))
    texts = rows.mapInArrow(_extract, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
