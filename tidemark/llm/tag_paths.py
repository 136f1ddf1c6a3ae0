"""Main text of web pages by tag-path ratios.

A page is read into blocks: stretches of text between the starts and ends of
block-level elements, each with its root-to-leaf tag path.  Per path the text length
and the punctuation are summed and divided by the number of blocks (and of
characters inside links); the two ratios are smoothed along the page, fused as their
geometric mean, and a path whose mean fused value is below ``THRESHOLD`` of the
page's best path is not content, unless it is a list, table, code, heading or the like
in a container of content (see ``content``).  This holds on every page.  An ``article`` or
``main`` with most of the page's text weighs in: paths through it need ``INSIDE`` times
less, all others ``OUTSIDE`` times more; of several such elements the one with the text
counts, and where none has it, the ratios stand alone.  Markup settles only what an element
says it is not: one through navigation, a form, an advert, a comment section, ... is no
content unless that element holds most of the page (see ``unmarked``).  Lists of short
links and bars of links are navigation everywhere.

A page is read in one pass.  At most ``DEEPEST`` elements are open at a time, as in browsers;
elements opened beyond that add no level.  A quote opens an attribute's value only after
``=``; elsewhere it is an ordinary character of the tag.

Cases: null and empty html give the empty text; broken markup (unclosed, crossed or
unknown elements, a cut tail) is read as far as it goes; every page is a row of its
own, repeated ids too; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import load

THRESHOLD = 0.12
SIGMA = 1.0
INSIDE, OUTSIDE = 3.0, 4.0
MOST = 0.6  # share of a page's text that makes an article or main element the one
DEEPEST = 256
LEFT = 0.1  # share of the text under soft marks below which the rest of a page is next to nothing
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCT = re.compile(r"[.,;:!?…。，！？、]")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body br-block button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p
 pre search section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - frozenset("button caption dd dt li option tbody td tfoot th thead tr body html head legend summary".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "p": {"p"}}
SCOPE = frozenset("table ul ol dl td th article section div main body html select nav aside form blockquote".split())
GONE = frozenset("head button select option template svg canvas audio video object applet map datalist".split())
NEVER = frozenset(("nav", "footer", "menu"))
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus".split())
NEVER_NAMED = COMMENTS | frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs masthead topbar footer sidebar aside rail
 widget widgets ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr
 notice notices alert disclaimer popup modal overlay newsletter subscribe subscription signup login search social share sharing
 related recommended recommendations form pagination pager toolbar complementary contentinfo copyright""".split())
_PARTS = "area bar banner block box buttons container icons links list notice panel popup section slot widget wrap wrapper".split()
_OF = """ad ads advert breadcrumb breadcrumbs comment comments cookie cookies consent footer gdpr login menu nav navigation newsletter pagination
 popup promo search share sharing sidebar signup social sponsor subscribe""".split()
COMPOUND = frozenset(f"{a}-{b}" for a in _OF for b in _PARTS) | frozenset(
    f"{a}-{b}" for a in "site main page top bottom primary secondary global mobile".split() for b in "nav navbar navigation menu footer search".split()) | frozenset(
    """comment-body comment-form comment-respond comments-title cookie-message login-form menu-item nav-item nav-menu newsletter-form
 newsletter-signup related-articles related-content related-links related-posts related-stories search-form side-bar signup-form
 site-sidebar subscribe-form widget-area""".split())
SLUGGED = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd a span".split())  # their ids are made from their text
FLOW = frozenset("""address blockquote caption center dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup legend li ol option p pre
 summary table tbody td tfoot th thead tr ul""".split())
LISTS = frozenset("ul ol dl menu".split())
SET_OFF = frozenset("pre blockquote figure figcaption details summary".split())
LINK_CHARS = 40  # a list of links whose items are longer in the mean is no menu
_BAR = re.compile(r"[\s|/·•»›>\-–—:]*")
WHOLE = frozenset(("article", "main"))
#: Kinds of marks: never page text; menus and the like; a form or hidden; by a name or the like; comments.
_GONE, _KIND, _WRAP, _NAME, _COMMENT = range(5)


def _names(value: str) -> set[str]:
    return {re.sub(r"[-_\d]+$", "", re.sub(r"[_-]+", "-", _CAMEL.sub("-", w)).lower()) for w in value.split()}


def _mark(tag: str, attrs: str, in_whole: bool, in_pre: bool) -> int | None:
    """Why an element says that it is no content, if it does."""
    if tag in GONE:
        return _GONE
    if tag in ("form", "fieldset"):
        return _WRAP
    if tag in ("aside", "dialog", "search"):
        return _NAME
    if tag in NEVER or tag == "header" and not in_whole:
        return _KIND
    if not attrs.strip() or tag in ("html", "body"):
        return None
    names, hidden = set(), False
    for m in _ATTR.finditer(attrs):
        attr, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if attr in ("class", "role") or attr == "id" and tag not in SLUGGED:
            names |= _names(value)
        hidden |= (attr == "hidden" and value.lower() != "false" or attr == "aria-hidden" and value.lower() == "true"
                   or attr == "style" and bool(_NO_DISPLAY.search(value)))
    if not in_pre:
        if names & COMMENTS or any(n.startswith(("comment-", "comments-")) for n in names & COMPOUND):
            return _COMMENT
        if names & NEVER_NAMED or names & COMPOUND or names & {"header", "site-header", "page-header"} and not in_whole:
            return _NAME
    return _WRAP if hidden else None


class Mark:
    """An element that says it is no content; ``main``: it has an article, main or h1."""

    __slots__ = ("kind", "main", "size")

    def __init__(self, kind):
        self.kind, self.main, self.size = kind, False, 0


class Box:
    """An element that holds paragraphs, or a table's cell, and the one around it;
    ``first`` and ``last``: its first and last block of content."""

    __slots__ = ("parent", "first", "last")

    def __init__(self, parent=None):
        self.parent, self.first, self.last = parent, -1, -1

    def around(self) -> Iterator[Box]:
        box = self
        while box is not None:
            yield box
            box = box.parent


class Place:
    """Where a block stands: the box around it, its outermost list and table by number, and
    its innermost cell, whose chain leads on to the box."""

    __slots__ = ("box", "list", "table", "cell")

    def __init__(self, box, list=0, table=0, cell=None):
        self.box, self.list, self.table, self.cell = box, list, table, cell

    def inside(self, tag: str, number: int) -> Place:
        if tag in LISTS:
            return self if self.list else Place(self.box, number, self.table, self.cell)
        if tag == "table":
            return self if self.table else Place(self.box, self.list, number, self.cell)
        if tag in ("td", "th"):
            return Place(self.box, self.list, self.table, Box(self.cell or self.box))
        if tag in FLOW or self.list or self.table:
            return self
        return Place(Box(self.box))


class Whole:
    """An article or main element, the one around it, and its text outside links."""

    __slots__ = ("parent", "size")

    def __init__(self, parent):
        self.parent, self.size = parent, 0

    def around(self) -> Iterator[Whole]:
        whole = self
        while whole is not None:
            yield whole
            whole = whole.parent


class Path:
    """A root-to-leaf path of block elements, one object per path of a page."""

    __slots__ = ("tag", "below", "pre", "set_off")

    def __init__(self, tag="", parent=None):
        self.tag, self.below = tag, {}
        self.pre = tag == "pre" or parent is not None and parent.pre
        self.set_off = tag in SET_OFF or parent is not None and parent.set_off

    def to(self, tag: str) -> Path:
        if tag not in self.below:
            self.below[tag] = Path(tag, self)
        return self.below[tag]


class Block:
    __slots__ = ("path", "text", "linked", "marks", "whole", "place", "links", "beside")

    def __init__(self, path, text, linked, marks, whole, place, links, beside):
        self.path, self.text, self.linked, self.marks, self.whole = path, text, linked, marks, whole
        self.place, self.links, self.beside = place, links, beside  # beside: the text outside links

    @property
    def plain(self) -> int:
        return len(self.text) - self.linked


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order."""
    out: list[Block] = []
    stack: list[tuple] = []  # tag, path of block elements, marks, innermost article/main, place, link by number
    opened: Counter = Counter()   # of the stack, by tag
    flat: Counter = Counter()     # opened beyond the deepest level, by tag
    root = ("", Path(), (), None, Place(Box()), 0)
    parts: list[str] = []
    beside: list[str] = []
    linked = links = number = last_link = 0
    owner = root[1:5]

    def end_block() -> None:
        nonlocal linked, links
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(owner[0], text, min(linked, len(text)), *owner[1:], links, "".join(beside)))
            parts.clear()
            beside.clear()
        linked = links = 0

    def say(text: str) -> None:
        nonlocal owner, linked, links, last_link
        if not text:
            return
        top = stack[-1] if stack else root
        if not parts:
            owner = top[1:5]
        elif top[2] != owner[1]:  # a hidden or excluded inline element inside a block
            if len(top[2]) > len(owner[1]):
                return
            end_block()
            owner = top[1:5]
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        if top[5]:
            linked += len(text)
            links += top[5] != last_link
            last_link = top[5]
        else:
            beside.append(text)

    def last_open(*tags: str) -> int | None:
        if not any(opened[t] for t in tags):
            return None
        return next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in tags)

    def close(depth: int) -> None:
        for entry in stack[depth:]:
            opened[entry[0]] -= 1
        del stack[depth:]

    at = 0
    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK:
                end_block()
            if flat[tag]:
                flat[tag] -= 1
                continue
            depth = last_open(tag)
            if depth is not None and (tag in BLOCK or not any(s[0] in BLOCK for s in stack[depth + 1:])):
                close(depth)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            if tag == "hr":
                end_block()
            elif tag == "br" and parts:
                parts.append(" ")
            continue
        if tag in BLOCK:
            end_block()
            if tag in CLOSES_P:
                depth = last_open("p")
                if depth is not None and not any(s[0] in SCOPE for s in stack[depth + 1:]):
                    close(depth)
            if tag in SAME:
                depth = last_open(*SAME[tag])
                if depth is not None and not any(s[0] in SCOPE and s[0] not in SAME[tag] for s in stack[depth + 1:]):
                    close(depth)
        if len(stack) >= DEEPEST:
            flat[tag] += 1
            continue
        top = stack[-1] if stack else root
        whole = Whole(top[3]) if tag in WHOLE else top[3]
        marks, why = top[2], _mark(tag, m[3], whole is not None, top[1].pre)
        if why is not None:
            marks = (*marks, Mark(why))
        if tag == "h1" or tag in WHOLE:
            for mark in marks:  # an article among comments is one of them
                mark.main |= mark.kind != _COMMENT or tag != "article"
        if m[3].endswith("/") and tag not in BLOCK:
            continue
        number += 1
        place = top[4].inside(tag, number) if tag in BLOCK else top[4]
        opened[tag] += 1
        stack.append((tag, top[1].to(tag) if tag in BLOCK else top[1], marks, whole, place, number if tag == "a" else top[5]))
    end_block()
    return out


def unmarked(blocks: list[Block]) -> list[Block]:
    """The blocks that no mark settles as no content.

    A mark does not count on an element with most of the page's text outside links, if
    it is a form or hidden or has an ``article``, ``main`` or ``h1``.  Where next to
    nothing is left, names, forms and ``hidden`` do not count; where nothing is left,
    comments are the content."""
    blocks = [b for b in blocks if all(m.kind != _GONE for m in b.marks)]
    for b in blocks:
        for m in b.marks:
            m.size += b.plain
    half = sum(b.plain for b in blocks) / 2

    def without(*kinds: int) -> list[Block]:
        return [b for b in blocks if all(m.kind in kinds or m.size > half and (m.kind == _WRAP or m.main) for m in b.marks)]

    out, soft = without(), without(_WRAP, _NAME)
    if sum(b.plain for b in out) < LEFT * sum(b.plain for b in soft):
        out = soft
    return out or without(_WRAP, _NAME, _COMMENT)


def _smoothed(values: list[float]) -> list[float]:
    kernel = [math.exp(-d * d / (2 * SIGMA * SIGMA)) for d in range(3)]
    out = []
    for i in range(len(values)):
        near = [(kernel[abs(j - i)], values[j]) for j in range(max(0, i - 2), min(len(values), i + 3))]
        out.append(sum(k * v for k, v in near) / sum(k for k, _ in near))
    return out


def content_paths(blocks: list[Block]) -> dict[Path, float]:
    """The fused ratio of each path among blocks that may be content."""
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for b in blocks:
        length[b.path] += len(b.text) - b.linked
        marks[b.path] += len(_PUNCT.findall(b.text)) if b.linked < len(b.text) else 0
        count[b.path] += 1
    text = _smoothed([length[b.path] / count[b.path] for b in blocks])
    signs = _smoothed([marks[b.path] / count[b.path] for b in blocks])
    fused = defaultdict(list)
    for b, t, s in zip(blocks, text, signs):
        fused[b.path].append(math.sqrt(max(t, 0.0) * (s + 0.05)))
    return {p: sum(v) / len(v) for p, v in fused.items()}


def _menus(blocks: list[Block]) -> list[bool]:
    """Whether each block is navigation by its links: an item of a list of short links
    only, or several links with nothing but separators between them."""
    lists: dict[int, list[Block]] = defaultdict(list)
    for b in blocks:
        if b.place.list:
            lists[b.place.list].append(b)
    menus = set()
    for i, items in lists.items():
        links = sum(b.links for b in items)
        if links > 1 and not any(c.isalnum() for b in items for c in b.beside) and sum(b.linked for b in items) <= LINK_CHARS * links:
            menus.add(i)
    return [b.place.list in menus if b.place.list else b.links > 1 and not b.place.table and bool(_BAR.fullmatch(b.beside)) for b in blocks]


def principal(blocks: list[Block]) -> Whole | None:
    """The innermost article or main element with most of the blocks' text."""
    total = sum(b.plain for b in blocks)
    for b in blocks:
        for whole in b.whole.around() if b.whole else ():
            whole.size += b.plain
    most = {w for b in blocks if b.whole for w in b.whole.around() if w.size >= MOST * total}
    return min(most, key=lambda w: w.size, default=None)


def content(blocks: list[Block], threshold: float) -> list[Block]:
    """The blocks of content, by the ratios of their paths and by their containers.

    A block of a path below the threshold is content too if its container holds a
    paragraph of content, or if it is a list, a table, code or a quotation between
    paragraphs of content.  A table with most of the page's text is layout, its cells
    are containers."""
    menu, score, main = _menus(blocks), content_paths(blocks), principal(blocks)
    best = max(score.values(), default=0.0)

    def weight(b: Block) -> float:
        if main is None:
            return 1.0
        return INSIDE if b.whole and any(w is main for w in b.whole.around()) else 1 / OUTSIDE

    good = [score[b.path] * weight(b) >= threshold * best and b.linked < 0.6 * len(b.text) and not m for b, m in zip(blocks, menu)]
    size: dict[int, int] = defaultdict(int)
    for b in blocks:
        size[b.place.table] += b.plain
    half = sum(size.values()) / 2
    boxes = [b.place.cell or b.place.box if b.place.table and size[b.place.table] > half else b.place.box for b in blocks]
    whole = set()
    for i, b in enumerate(blocks):
        if good[i]:
            if b.path.tag in ("p", "pre", "blockquote"):
                whole.add(boxes[i])
            box = boxes[i] if b.path.tag in FLOW else boxes[i].parent or boxes[i]
            box.first, box.last = i if box.first < 0 else box.first, i

    def beside(i: int) -> bool:
        b = blocks[i]
        if boxes[i] in whole:
            return True
        return bool(b.place.list or b.place.table or b.path.set_off) and any(0 <= x.first < i < x.last for x in boxes[i].around())

    return [b for i, b in enumerate(blocks) if good[i] or not menu[i] and beside(i)]


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The content blocks of a page, joined by blank lines."""
    if not page:
        return ""
    return "\n\n".join(b.text for b in content(unmarked(blocks_of(page)), threshold))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            threshold: float = THRESHOLD) -> DataFrame:
    """page_id, url, text, n_chars per page."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                texts = [main_text(x, threshold) for x in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op6_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(load(spark, sf_dir, "pages"))
