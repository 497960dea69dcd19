"""Reading regions out of stored HTML pages.

Real pages are not well-formed, so Spark's ``xpath_*`` cannot read them; this
is the one place that needs Python.  The UDFs are Arrow-batched and return
only what was selected, not every candidate, to keep the transfer small.

Text follows what a browser shows: white space collapses, block elements and
``<br>`` start a new line, scripts and styles are left out.  Whether CSS hides
an element cannot be told from a stored page, and inner HTML is the stored
source, not a re-serialised DOM.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from html import unescape

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from docketframe import rules

# Ship this module inside the UDF, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID = set("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = set("head script style noscript template iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section "
    "summary table tbody tfoot thead tr ul".split()
)
CELL = {"td", "th"}
# Start tag -> (open elements it ends, elements the search stops at).
ENDS = {
    "body": ({"head"}, set()),
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": (CELL, {"tr", "table"}),
    "th": (CELL, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# A block ends an open paragraph of the block it stands in.
P = ({"p"}, BLOCK - {"p"})
PAGE = {"html", "body"}
# Elements whose content holds no tags.
RAW = set("script style title textarea noscript xmp iframe noembed noframes".split())
TEXT, PRE, BREAK, EDGE, GAP = range(5)

# A comment, a declaration, or a tag; quotes may hide a ">" unless unbalanced.
TOKEN = re.compile(
    r"<(?:(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*)>"
    r"|!--.*?(?:-->|\Z)|[!?][^>]*>)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?"
)
SELECTOR = re.compile(
    r"(?P<tag>[a-zA-Z][\w-]*)?(?P<marks>(?:[.#][\w-]+)*)"
    r"(?:\[(?P<attr>[\w-]+)\*=['\"]?(?P<part>[^'\"\]]*)['\"]?\])?"
    r"(?::text\((?P<own>[^)]*)\))?"
)


SPACES = re.compile(r"[ \t\r\n\f]+")

#: Entries of a memo, at most; pages may hold any number of names.
MEMO = 4096


class Kind:
    """What a tag's name says of its elements."""

    __slots__ = ("tag", "itself", "hidden", "block", "pre", "void", "raw", "escaped", "page", "edge", "ends", "stops", "bounds")

    def __init__(self, name: str):
        tag = self.tag = name.lower()
        self.itself = {tag}
        self.hidden, self.block, self.pre, self.void = tag in HIDDEN, tag in BLOCK, tag == "pre", tag in VOID
        self.raw, self.escaped, self.page = tag in RAW, tag in ("title", "textarea"), tag in PAGE
        self.edge = (EDGE, "") if self.block else (BREAK, "") if tag == "br" else (GAP, "") if tag in CELL else None
        self.ends, self.stops = ENDS.get(tag) or (P if self.block else (None, None))
        # An inline end tag does not reach out of the block it stands in.
        self.bounds = PAGE if self.block or tag in CELL or self.hidden else BLOCK


KINDS: dict[str, Kind] = {}


def kind_of(name: str) -> Kind:
    known = KINDS.get(name)
    if known is None:
        if len(KINDS) >= MEMO:
            KINDS.clear()
        known = KINDS[name] = Kind(name)
    return known


#: Attributes as they are written -> read; those of a class name come again on every page.
ATTRIBUTES: dict[str, dict[str, str]] = {}


def attributes(raw: str) -> dict[str, str]:
    """The first of a name counts."""
    known = ATTRIBUTES.get(raw)
    if known is None:
        known = {n.lower(): unescape(x or y or z) for n, x, y, z in reversed(ATTRIBUTE.findall(raw))}
        if len(raw) <= 40:
            if len(ATTRIBUTES) >= MEMO:
                ATTRIBUTES.clear()
            ATTRIBUTES[raw] = known
    return known


PARSED: dict[str, tuple] = {}


def parsed_selector(selector: str) -> tuple:
    if selector not in PARSED:
        m = SELECTOR.fullmatch(selector)
        if not m:
            raise ValueError(f"selector not understood: {selector!r}")
        marks = re.findall(r"[.#][\w-]+", m["marks"])
        classes, ids = ({x[1:] for x in marks if x[0] == sign} for sign in ".#")
        PARSED[selector] = m["tag"], classes, ids, m["attr"], m["part"], m["own"]
    return PARSED[selector]


class Element:
    """A span of the page: positions in the piece list and in the source."""

    __slots__ = ("kind", "tag", "raw", "at", "piece", "piece_end", "source", "source_end", "last", "own", "_attrs")

    def __init__(self, kind: Kind, raw: str, at: int, piece: int, source: int):
        self.kind, self.tag, self.raw, self.at, self.piece, self.source = kind, kind.tag, raw, at, piece, source
        self.own = self._attrs = None

    @property
    def attrs(self) -> dict[str, str]:
        """Attributes, read when first asked for."""
        if self._attrs is None:
            self._attrs = attributes(self.raw)
        return self._attrs


class Page:
    """One page as flat lists: text pieces, and elements as spans over them."""

    def __init__(self, html: str):
        self.html = html
        self.pieces: list[tuple[int, str]] = []
        self.elements: list[Element] = []
        self.open: list[Element] = []
        self.hidden = self.pre = 0
        self._read()
        self._end_from(0, len(html))
        if not any(e.tag == "body" for e in self.elements):
            body = Element(kind_of("body"), "", len(self.elements), 0, 0)
            self._finish(body, len(html))
            self.elements.append(body)

    def _read(self) -> None:
        html, at, going = self.html, 0, True
        last = html.rfind(">") + 1  # behind it there is no tag to look for
        while going:
            going = False
            for m in TOKEN.finditer(html, at, last):
                start, after = m.span()
                if start > at:
                    self._text(html[at:start])
                at = after
                end, name, attrs = m.groups()
                if not name:
                    if m[0].startswith("<!--") and not m[0].endswith("-->"):
                        at = len(html)
                    continue
                kind = KINDS.get(name) or kind_of(name)
                if end:
                    self._end(kind, start)
                    continue
                self._start(kind, attrs, start, after)
                if kind.raw:
                    close = re.compile(f"</{kind.tag}(?=[\\s/>])", re.IGNORECASE).search(html, after)
                    at = close.start() if close else len(html)
                    if at > after:
                        self._text(html[after:at], decode=kind.escaped)
                    going = True  # from there on
                    break
        if at < len(html):
            self._text(html[at:])

    def _finish(self, e: Element, source_end: int) -> None:
        e.piece_end, e.source_end, e.last = len(self.pieces), source_end, len(self.elements)

    def _end_from(self, depth: int, source_end: int) -> None:
        """Close all open elements from ``depth`` inwards."""
        while len(self.open) > depth:
            e = self.open.pop()
            kind = e.kind
            if kind.hidden:
                self.hidden -= 1
            elif kind.block:
                self.pre -= kind.pre
                self.pieces.append((EDGE, ""))
            e.piece_end, e.source_end, e.last = len(self.pieces), source_end, len(self.elements)

    def _depth_of(self, tags: set[str], stops: set[str]) -> int | None:
        depth = len(self.open)
        for e in reversed(self.open):
            depth -= 1
            if e.tag in tags:
                return depth
            if e.tag in stops:
                return None
        return None

    def _start(self, kind: Kind, raw: str, start: int, after: int) -> None:
        if kind.ends:
            depth = self._depth_of(kind.ends, kind.stops)
            if depth is not None:
                self._end_from(depth, start)
        if kind.edge:
            self.pieces.append(kind.edge)
        e = Element(kind, raw, len(self.elements), len(self.pieces), after)
        self.elements.append(e)
        if kind.void:
            self._finish(e, after)
            return
        self.open.append(e)
        self.hidden += kind.hidden
        self.pre += kind.pre

    def _end(self, kind: Kind, start: int) -> None:
        if kind.page:
            return
        depth = self._depth_of(kind.itself, kind.bounds)
        if depth is not None:
            self._end_from(depth, start)

    def _text(self, data: str, decode: bool = True) -> None:
        if decode and "&" in data:
            data = unescape(data)
        if self.open and self.open[-1].own is None:
            self.open[-1].own = data
        if not self.hidden:
            self.pieces.append((PRE if self.pre else TEXT, data))

    def text(self, e: Element) -> str:
        pieces = self.pieces[e.piece : e.piece_end]
        if not pieces:
            return ""
        if len(pieces) == 1 and pieces[0][0] == TEXT:
            return SPACES.sub(" ", pieces[0][1]).strip(" ").replace("\xa0", " ").strip()
        lines = [""]
        for kind, piece in pieces:
            if kind == TEXT:
                piece = SPACES.sub(" ", piece)
                if lines[-1] == "" or lines[-1].endswith(" "):
                    piece = piece.lstrip(" ")
                lines[-1] += piece
            elif kind == PRE:
                first, *others = piece.split("\n")
                lines[-1] += first
                lines.extend(others)
            elif kind == GAP:
                lines[-1] += " " if lines[-1].strip(" ") else ""
            elif kind == BREAK or lines[-1].strip(" "):
                lines.append("")
        shown = "\n".join(line.strip(" ") for line in lines)
        return shown.replace("\xa0", " ").strip()

    def inner_html(self, e: Element) -> str:
        return self.html[e.source : e.source_end]

    def select(self, selector: str, within: Element | None = None) -> Iterator[Element]:
        """Elements matching ``tag``, ``.class``, ``#id``, ``[attr*=part]`` or
        ``:text(part)`` (first own text node), or a combination, in page order."""
        tag, classes, ids, attr, part, own = parsed_selector(selector)
        first, last = 0, len(self.elements)
        if within is not None:
            first, last = within.at + 1, within.last
        for e in self.elements[first:last]:
            if tag and e.tag != tag:
                continue
            if (
                (not classes or classes <= set(e.attrs.get("class", "").split()))
                and (not ids or ids == {e.attrs.get("id")})
                and (not attr or (attr in e.attrs and part in e.attrs[attr]))
                and (own is None or (e.own is not None and own in e.own))
            ):
                yield e

    def first(self, selector: str, within: Element | None = None) -> Element | None:
        return next(self.select(selector, within), None)


REGION = pa.struct([("text", pa.string()), ("html", pa.string())])
LISTING = pa.struct(
    [
        (
            "items",
            pa.list_(
                pa.struct(
                    [("list_index", pa.int32())]
                    + [(n, pa.string()) for n in ("title", "link", "open_link", "case_no", "court", "date")]
                )
            ),
        ),
    ]
)
DETAIL = pa.struct([(n, pa.string()) for n in ("full_text", "html_content", "heading")])


def html_select(html: Column, selectors: Sequence[str]) -> Column:
    """First match of every selector: array of (text, html), NULL where none."""
    selectors = list(selectors)

    def regions(source: str):
        page = Page(source)
        hits = [page.first(s) for s in selectors]
        return [h and {"text": page.text(h), "html": page.inner_html(h)} for h in hits]

    @F.arrow_udf("array<struct<text:string,html:string>>")
    def run(batch: pa.Array) -> pa.Array:
        rows = [None if h is None else regions(h) for h in batch.to_pylist()]
        return pa.array(rows, pa.list_(REGION))

    return run(html)


def listing(
    html: Column,
    item: str = rules.LIST_ITEM,
    fields: dict[str, str] | None = None,
) -> Column:
    """A result-list page: its items in order.

    An item's ``title`` and ``link`` are NULL when it has no title link; other
    missing fields are '', and so are those that ``fields`` has no selector for.  ``open_link`` is the page's
    first title link with the item's title, from one map of the page's titles.
    """
    fields = dict(fields or rules.LIST_FIELDS)

    def anchor(page: Page, e: Element | None) -> dict:
        return {
            "title": e and page.text(e).strip(),
            "link": e and e.attrs.get("href", ""),
        }

    def read(source: str) -> dict:
        page = Page(source)
        items, first = [], {}
        titles = {e.at: anchor(page, e) for e in page.select(fields["title"])}
        places = list(titles)
        for link in titles.values():
            first.setdefault(link["title"], link["link"])
        for at, e in enumerate(page.select(item)):
            i = bisect_right(places, e.at)
            inside = i < len(places) and places[i] < e.last
            row = {"list_index": at, **(titles[places[i]] if inside else anchor(page, None))}
            row["open_link"] = first.get(row["title"])
            for name in ("case_no", "court", "date"):
                hit = page.first(fields[name], e) if name in fields else None
                row[name] = page.text(hit).strip() if hit else ""
            items.append(row)
        return {"items": items}

    @F.arrow_udf(
        "struct<items:array<struct<list_index:int,title:string,link:string,open_link:string,case_no:string,"
        "court:string,date:string>>>"
    )
    def run(batch: pa.Array) -> pa.Array:
        rows = [None if h is None else read(h) for h in batch.to_pylist()]
        return pa.array(rows, LISTING)

    return run(html)


def detail_region(
    html: Column,
    chain: Sequence[str] = rules.BODY_CHAIN,
    longer_than: int | None = rules.SHORT_BODY,
    with_html: bool = False,
) -> Column:
    """Body text of a detail page by an ordered selector chain, and its ``h1``.

    With ``longer_than`` the first region with more characters than that wins,
    else the last one that exists; with ``None`` the first that exists wins.
    If no region matches (or the text so found is empty, in the first mode),
    the whole body is used.
    """
    chain = list(chain)

    def read(source: str) -> dict:
        page = Page(source)
        chosen, text = None, ""
        for selector in chain:
            hit = page.first(selector)
            if hit is None:
                continue
            chosen, text = hit, page.text(hit)
            if longer_than is None or len(text) > longer_than:
                break
        if chosen is None or (longer_than is not None and not text):
            text = page.text(page.first("body"))
        heading = page.first("h1")
        inner = source if chosen is None else page.inner_html(chosen)
        return {
            "full_text": text,
            "html_content": inner if with_html else None,
            "heading": heading and page.text(heading),
        }

    @F.arrow_udf("struct<full_text:string,html_content:string,heading:string>")
    def run(batch: pa.Array) -> pa.Array:
        rows = [None if h is None else read(h) for h in batch.to_pylist()]
        return pa.array(rows, DETAIL)

    return run(html)
