"""Main-text extraction by tree scoring.

A page is parsed into a tree in one forward scan. Each block's own text then passes points, for being there, for its
commas and its length, to the elements around it: all of them to its container, half to the next, a third over the
distance to the next three. A container's points are discounted by the share of its text that is inside links. The best
container, widened to the article or main element around it, is kept with those siblings that score well or read like
prose, and its blocks are joined in page order. Names of classes only weigh: points don't leave elements that are named
as comments, adverts and the like, nor count in full there. Inside the container only elements that are surely something
else go (their tag says so, or their class names an advert, a comment list, a menu, a cookie notice ...); words that
articles use, too, such as alert, search or header, don't matter there.

Time is in proportion to the page: an unfinished tag ends it, end tags look up the element that they close, and points
go up five levels.

Defined cases: null html is an empty page; a page without text gives an empty text; markup that is broken is closed as
browsers would, and a tag or comment that is cut off at the end is no text; text outside any element counts as body
text; depth has no limit; repeated rows are extracted each; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The element names of HTML that matter here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select object canvas annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROP = frozenset("nav footer aside button dialog menu fieldset head".split())
#: Elements that a start tag closes, up to the nearest of the fence.
CLOSES = {"li": ("li", "ul ol menu"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tr": ("tr td th", "table"), "option": ("option", "select")}
CLOSES = {k: (a.split(), b.split()) for k, (a, b) in CLOSES.items()}
ENDS_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr".split())
#: Elements that an end tag of something inline or of another table doesn't reach across.
CELLS = ("td", "th", "table")
#: Words of class, id and role that mark other things than the article, wherever they are.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted nav navbar navigation menu breadcrumb breadcrumbs footer sidebar comment comments commentlist disqus respond replies cookie cookies consent gdpr notice notices popup modal share sharing social related recommended recommendations newsletter subscribe subscription signup login masthead topbar pagination pager contentinfo".split()
)
#: Words that mark them around the article, but not in it.
OUTSIDE = frozenset("banner aside reply reader alert overlay header toolbar widget form search skip complementary dialog".split())
GOOD = frozenset("article main content post entry story text body".split())
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>=]|=)*+)>")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_STOP = re.compile(r"[.!?…。][\"'”»)]*\Z")
#: Points go so many levels up; what a marked element's points count.
LEVELS, MARKED = 5, 0.2


class Node:
    __slots__ = ("tag", "parent", "kids", "words", "hidden", "inside", "marked", "points", "chars", "linked", "own", "commas")

    def __init__(self, tag: str, parent: Node | None, words: frozenset = frozenset(), hidden: bool = False):
        self.tag, self.parent, self.words, self.hidden = tag, parent, words, hidden
        self.kids: list[Node | str] = []
        self.inside = parent is not None and (parent.inside or parent.tag in ("article", "main"))
        self.marked = tag not in ("article", "main", "body") and bool(words & MARKS) and not (words & GOOD and not words & {"comment", "comments", "ad", "ads", "sidebar", "advert"})
        self.points = 0.0
        self.chars = self.linked = self.own = self.commas = 0


class Open:
    """The open elements, with the places of each name among them."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks = [0]

    def push(self, n: Node) -> None:
        self.at[n.tag].append(len(self.stack))
        if n.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(n)

    def last(self, names) -> int:
        return max((self.at[x][-1] for x in names if self.at[x]), default=0)

    def close(self, place: int) -> None:
        """Close the element at a place and all in it."""
        while len(self.stack) > place:
            n = self.stack.pop()
            self.at[n.tag].pop()
            if n.tag in BLOCK:
                self.blocks.pop()

    def end(self, tag: str) -> None:
        """An end tag closes the nearest such element, if there is one."""
        place = self.last((tag,))
        if place and place >= (self.last(x for x in CELLS if x != tag) if tag not in BLOCK or tag in CELLS and tag != "table" else 0):
            if tag in BLOCK or self.blocks[-1] <= place:
                self.close(place)

    def start(self, tag: str) -> None:
        """What a start tag closes."""
        if tag in CLOSES:
            shut, fence = CLOSES[tag]
            bar = self.last(fence)
            places = [self.at[x][k] for x in shut if (k := bisect_right(self.at[x], bar)) < len(self.at[x])]
            if places:
                self.close(min(places))
        if tag in ENDS_P and self.stack[self.blocks[-1]].tag == "p":
            self.close(self.blocks[-1])


def attributes(text: str) -> tuple[frozenset, bool]:
    """Words of class, id and role; whether the element is hidden."""
    words, hidden = frozenset(), False
    for name, value in _ATTR.findall(text):
        if name.lower() in ("class", "id", "role"):
            words |= frozenset(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
        else:
            hidden = hidden or name.lower() == "hidden" or "true" in value.lower()
    return words, hidden


def parse(html: str) -> Node:
    """The tree of a page; the root stands for the body."""
    root = Node("body", None)
    open_, unclosed = Open(root), set()
    at = 0
    while at < len(html):
        less = html.find("<", at)
        if less < 0:
            open_.stack[-1].kids.append(html[at:])
            break
        if less > at:
            open_.stack[-1].kids.append(html[at:less])
        mark = html[less + 1 : less + 2]
        after = html[less + 2 : less + 3] if mark == "/" else mark
        if not (after.isascii() and after.isalpha()):
            if mark not in ("!", "?", "/") or not mark:  # a sign, not a tag
                open_.stack[-1].kids.append("<")
                at = less + 1
                continue
            end = html.find("-->", less + 4) if html.startswith("<!--", less) else html.find(">", less)
            if end < 0:
                break
            at = end + (3 if html.startswith("<!--", less) else 1)
            continue
        m = _TAG.match(html, less)
        if not m:  # cut off
            break
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            open_.end(tag)
            continue
        if tag in ("html", "body"):
            continue
        if tag in RAW:
            end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            if end:
                at = end.end()
            elif tag not in ("svg", "object", "select", "noscript"):
                break
            else:
                unclosed.add(tag)
            continue
        open_.start(tag)
        n = Node(tag, open_.stack[-1], *(attributes(m[3]) if m[3] else ()))
        open_.stack[-1].kids.append(n)
        if tag not in VOID and not m[3].endswith("/"):
            open_.push(n)
    return root


def in_order(root: Node) -> list[Node]:
    """The elements that may hold text of the page, parents before children."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        n.kids = [k for k in n.kids if isinstance(k, str) or not (k.hidden or k.tag in DROP or k.tag == "header" and not k.inside)]
        out.append(n)
        stack += [k for k in reversed(n.kids) if not isinstance(k, str)]
    return out


def clean(text: str) -> str:
    return " ".join((unescape(text) if "&" in text else text).split())


def blocks(n: Node, unwanted) -> list[str]:
    """Texts of the blocks below n in page order."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            if text := clean("".join(line)):
                out.append(text)
            line.clear()

    stack: list[Node | str | None] = [n]
    while stack:
        k = stack.pop()
        if k is None:
            flush()
        elif isinstance(k, str):
            line.append(k)
        elif k.tag == "br":
            line.append(" ")
        else:
            if k.tag in BLOCK:
                flush()
                stack.append(None)
            stack += [x for x in reversed(k.kids) if isinstance(x, str) or not unwanted(x)]
    flush()
    return out


def link_menu(n: Node) -> bool:
    """A list that is little but links."""
    return n.tag in ("ul", "ol") and n.chars > 0 and n.linked >= 0.8 * n.chars and sum(not isinstance(k, str) for k in n.kids) > 1


def measured(nodes: list[Node]) -> None:
    """Sums of text and of linked text, passed upwards once; the text of each block that isn't in a block below it."""
    for n in reversed(nodes):
        own = [len(k.strip()) for k in n.kids if isinstance(k, str)]
        n.chars += sum(own)
        n.own += sum(own)
        n.commas += sum(k.count(",") for k in n.kids if isinstance(k, str))
        if n.tag == "a":
            n.linked = n.chars
        if n.parent:
            n.parent.chars += n.chars
            n.parent.linked += n.linked
            if n.tag not in BLOCK:
                n.parent.own += n.own
                n.parent.commas += n.commas


def scored(nodes: list[Node]) -> dict[Node, float]:
    """Points of every element, discounted by link density and for marked ones."""
    for n in nodes:
        if n.own and (n.tag in BLOCK or n.parent is None) and n.tag not in ("h1", "h2", "h3", "h4", "h5", "h6"):
            points = 1 + n.commas + min(n.own / 100, 3)
            up = (n.parent or n) if n.tag in ("p", "pre", "td", "li", "dd", "blockquote") and not n.marked else n
            for level in range(LEVELS):
                up.points += points if level == 0 else points / 2 if level == 1 else points / (3 * level)
                if up.marked or not (up := up.parent):
                    break
    out = {}
    for n in nodes:
        bonus = 25 if n.tag in ("article", "main") or "main" in n.words else 5 if n.words & GOOD else 0
        out[n] = (n.points + (bonus if n.points else 0)) * (1 - n.linked / n.chars if n.chars else 1) * (MARKED if n.marked else 1)
    return out


def main_text(html: str | None) -> str:
    """The article's blocks, joined by line ends."""
    root = parse(html or "")
    nodes = in_order(root)
    measured(nodes)
    forms = {n for n in nodes if n.tag == "form" and n.chars <= 0.5 * root.chars}  # one around the whole page is no form
    menus = {n for n in nodes if link_menu(n)}
    if forms or menus:
        for n in nodes:
            n.kids = [k for k in n.kids if isinstance(k, str) or k not in forms and k not in menus]
            n.chars = n.linked = n.own = n.commas = 0
        nodes = in_order(root)
        measured(nodes)
    score = scored(nodes)
    best = max(nodes, key=lambda n: (score[n], n.chars), default=None)
    if best is None or not best.chars:
        return ""
    up = best
    while up.parent and up.tag not in ("article", "main"):
        up = up.parent
    best = up if up.tag in ("article", "main") else best
    if best.tag in ("tbody", "tr", "td", "p", "ul", "ol", "li") and best.parent:
        best = best.parent

    def sure(n: Node) -> bool:
        return n.marked and n is not best

    def outside(n: Node) -> bool:
        return sure(n) or n.tag not in ("article", "main") and bool(n.words & OUTSIDE) and not n.words & GOOD

    whole = best.parent is None
    picked = [best]
    if best.tag == "article" and best.parent:
        picked = [k for k in best.parent.kids if k is best or not isinstance(k, str) and k.tag == "article" and score[k] >= max(10, 0.2 * score[best])]
    elif not whole and best.tag != "main":
        picked = []
        for k in best.parent.kids:
            if k is best:
                picked.append(k)
            elif not isinstance(k, str) and k.chars and not outside(k):
                density = k.linked / k.chars
                prose = k.tag == "p" and (k.chars > 80 and density < 0.25 or density == 0 and _STOP.search(" ".join(blocks(k, sure))[-40:]))
                if score[k] >= max(10, 0.2 * score[best]) or prose or k.tag in ("h1", "h2") and not density:
                    picked.append(k)
    return "\n".join(b for k in picked for b in blocks(k, outside if whole else sure))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return base.mapInArrow(run, "page_id long, url string, text string, n_chars long")
