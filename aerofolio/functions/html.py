"""HTML as a flat array of open / text / close events, one array per page.

The Arrow UDF only tokenises; it knows no content rule. Everything the portal's
exporter decides (containers, embeds, widgets, images, Markdown) is a column
expression over the events, so a page is parsed once and never shuffled for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import arrow_udf

# a comment or declaration, or a tag with quoted attribute values, or a tag with a broken quote
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([A-Za-z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style")}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# The innermost open elements that a start tag ends, one after another, as the exporter's parser builds its tree. Nothing
# else is ended, and nothing is opened again: an emphasis that is ended by a block stays ended.
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_CELL = ("a", "b", "font", "p", "span", "td", "th", "u")
_ROWS = ("caption", "col", "colgroup", "p", "td", "th", "tr")
_DEFINITION = ("address", "dir", "menu", "p", "pre", "listing", "xmp")
STARTS_END = {
    "a": ("a",),
    "address": ("p", "ul"),
    "blockquote": ("p",),
    "caption": ("p",),
    "center": ("b", "font", "i", "p"),
    "col": ("caption", "col", "p"),
    "colgroup": ("caption", "col", "colgroup", "p"),
    "dd": (*_DEFINITION, "dt"),
    "dir": ("p",),
    "div": ("p",),
    "dl": ("address", "dir", "dt", "listing", "menu", "p", "pre", "xmp"),
    "dt": (*_DEFINITION, "dd"),
    "fieldset": ("a", *_HEADINGS, "legend", "listing", "p", "pre", "xmp"),
    "form": ("address", "dir", "dl", "form", *_HEADINGS, "hr", "listing", "menu", "ol", "p", "pre", "ul", "xmp"),
    **dict.fromkeys(_HEADINGS, ("p",)),
    "hr": ("p",),
    "li": ("address", "dl", *_HEADINGS, "li", "listing", "p", "pre", "xmp"),
    "listing": ("p",),
    "menu": ("p", "ul"),
    "noscript": ("script",),
    "ol": ("p", "ul"),
    "optgroup": ("option",),
    "option": ("option",),
    "p": ("b", "big", *_HEADINGS, "i", "p", "s", "small", "strike", "tt", "u"),
    "pre": ("p", "ul"),
    "table": ("a", *_HEADINGS, "listing", "p", "pre", "xmp"),
    "tbody": (*_ROWS, "tbody", "tfoot", "thead"),
    "td": _CELL,
    "tfoot": (*_ROWS, "tbody", "thead"),
    "th": _CELL,
    "thead": ("caption", "col", "colgroup"),
    "tr": _ROWS,
    "ul": ("address", "dir", "listing", "menu", "ol", "p", "pre", "xmp"),
    "xmp": ("p",),
}
# An end tag looks for its element no further than one of a greater weight; others weigh 100.
WEIGHT = {"div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180, "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220}
COUNTED_IN = {"li": {"ul", "ol"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}}
# what shows without text
SHOWING = {"img", "iframe", "tableau-viz", "object"}
# what keeps the elements around it, if only by being there
KEEPING = {"a", "table", "hr", "br"}
ATTRIBUTES = {
    "alt", "colspan", "class", "data-elementor-type", "data-src", "data-widget_type", "href", "id", "name", "src", "start", "title", "value",
}
#: Events that a task holds before it hands them on, and a page's more; length of start tags whose attributes are remembered.
HELD, KNOWN_LENGTH = 1 << 14, 200
#: One column of indent, and one level of quoting, in ``lead``; noncharacters, so no text has them.
INDENT, QUOTE = "\ufdd8", "\ufdd9"

EVENTS = T.ArrayType(
    T.StructType()
    .add("i", T.IntegerType()).add("j", T.IntegerType()).add("k", T.StringType()).add("tag", T.StringType())
    .add("at", T.MapType(T.StringType(), T.StringType())).add("text", T.StringType()).add("scope", T.LongType())
    .add("lead", T.StringType()).add("full", T.BooleanType()).add("bare", T.BooleanType())
)


def _attributes(raw: str, names: frozenset) -> tuple[tuple[str, str], ...]:
    """The attributes of a start tag that are among ``names``; of one given twice, the first."""
    at: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        name = name.lower()
        if name in names and name not in at:
            value = double or single or bare
            at[name] = unescape(value) if "&" in value else value
    return tuple(at.items())


_known = lru_cache(4096)(_attributes)


class _Page:
    """Appends one page's balanced events to the columns of a batch."""

    def __init__(self, out: _Batch, marks: Marks, only: frozenset | None) -> None:
        self.out, self.marks, self.only = out, marks, only
        self.base, self.shown, self.kept = len(out.j), 0, 0
        # tag, event, counted children, scope and lead inside, attributes of the end, what had been shown at the start,
        # whether no list item has come yet, steps of selectors that it met, what had been kept at the start
        self.stack: list[list] = []

    def emit(self, kind: str, tag: str, at: list, text: str | None) -> int:
        if self.only is not None and (tag not in self.only or kind != "o"):
            return -1
        out = self.out
        i = len(out.j) - self.base
        scope, lead = self.stack[-1][3:5] if self.stack else (0, "")
        out.j.append(i)
        out.fixed.append((kind, tag, text, scope, lead))
        out.full.append(text is not None)
        out.bare.append(False)
        # most events have no attributes: no map is read faster than an empty one
        out.at_begins.append(len(out.names) if at else None)
        for name, value in at:
            out.names.append(name)
            out.values.append(value)
        return i

    def show(self) -> None:
        if not (self.stack and self.stack[-1][3] & self.marks.hidden):
            self.shown += 1
            self.kept += 1

    def close_top(self) -> None:
        tag, start, items, _, _, extra, shown, _, _, kept = self.stack.pop()
        at = extra + [("#items", str(items))] if tag == "tr" else extra
        end = self.emit("c", tag, at, None)
        if start >= 0 and end >= 0:
            out, opened, closed = self.out, self.base + start, self.base + end
            out.j[opened], out.j[closed] = end, start
            out.full[opened] = out.full[closed] = self.shown > shown
            out.bare[opened] = out.bare[closed] = self.kept == kept

    def end(self, tag: str) -> None:
        """An end tag ends its element and all within it, or nothing; of a paragraph that isn't open it makes an empty one."""
        weight = WEIGHT.get(tag, 100)
        for depth in range(len(self.stack) - 1, -1, -1):
            other = self.stack[depth][0]
            if other == tag:
                while len(self.stack) > depth:
                    self.close_top()
                return
            if WEIGHT.get(other, 100) > weight:
                break
        if tag == "p" and not any(e[0] == "p" for e in self.stack):
            self.start("p", "")
            self.close_top()

    def start(self, tag: str, raw: str) -> None:
        if tag in STARTS_END:
            ended = STARTS_END[tag]
            while self.stack and self.stack[-1][0] in ended:
                self.close_top()
        at = dict((_known if len(raw) <= KNOWN_LENGTH else _attributes)(raw, self.marks.attributes)) if raw else {}
        kept = [(n, at[n]) for n in ("href", "title") if n in at] if tag == "a" and "href" in at else []
        if tag in COUNTED_IN:
            holder = next((h for h in reversed(self.stack) if h[0] in COUNTED_IN[tag]), None)
            if holder is not None:
                if tag == "li" and holder[7]:
                    holder[7], at["#first"] = False, ""
                holder[2] += _span(at) if tag in ("td", "th") else 1
                at["#n"], at["#in"] = str(holder[2]), holder[0]
                kept = [("#n", at["#n"])] + [("#span", str(_span(at)))] * (tag in ("td", "th"))
        scope, lead = self.stack[-1][3:5] if self.stack else (0, "")
        met = 0
        if self.marks.ways:
            met, selected = self.marks.steps(tag, at, scope, self.stack[-1][8] if self.stack else 0)
            if selected:
                at["#selected"] = "\n".join(dict.fromkeys(selected))
        i, shown, before = self.emit("o", tag, list(at.items()), None), self.shown, self.kept
        if tag in SHOWING:
            self.show()
        elif tag in KEEPING and not scope & self.marks.hidden:
            self.kept += 1
        if tag == "li":
            lead += INDENT * (len(at["#n"]) + 2 if at.get("#in") == "ol" else 2)
        elif tag == "blockquote":
            lead += QUOTE
        begin = at.get("start", "") if tag == "ol" else ""
        count = int(begin) - 1 if begin.isascii() and begin.isdigit() and len(begin) < 10 else 0
        self.stack.append([tag, i, count, scope | met | self.marks.bits(tag, at), lead, kept, shown, True, met, before])
        if tag in VOID:
            self.close_top()

    def read(self, html: str) -> None:
        pos, n = 0, len(html)
        while pos < n:
            hit = _TOKEN.search(html, pos)
            upto = hit.start() if hit else n
            if upto > pos:
                text = html[pos:upto]
                text = unescape(text) if "&" in text else text
                if not text.isspace():
                    self.show()
                self.emit("t", "#text", (), text)
            if hit is None:
                break
            pos = hit.end()
            closes, tag, raw = hit.group(1, 2, 3) if hit.group(2) else hit.group(4, 5, 6)
            if tag is None:
                continue
            tag = tag.lower()
            if closes:
                if tag not in VOID:
                    self.end(tag)
                continue
            self.start(tag, raw)
            if tag in _RAW_END:
                end = _RAW_END[tag].search(html, pos)
                pos = end.start() if end else n
        while self.stack:
            self.close_top()


class _Batch:
    """Flat columns of many pages' events, assembled into one nested Arrow array at the end."""

    def __init__(self) -> None:
        # ``fixed``: kind, tag, text, scope and lead of an event; the others are known when its element ends
        self.fixed, self.j, self.full, self.bare = [], [], [], []
        self.names, self.values, self.at_begins = [], [], []

    def array(self, ends: list) -> pa.Array:
        kind, tag, text, scope, lead = zip(*self.fixed) if self.fixed else ((),) * 5
        begins = [e for e in ends[:-1] if e is not None]
        i = np.arange(len(self.j)) - np.repeat(np.array(begins, np.int64), np.diff([*begins, len(self.j)]))
        at = pa.MapArray.from_arrays(
            pa.array([*self.at_begins, len(self.names)], pa.int32()), pa.array(self.names, pa.string()), pa.array(self.values, pa.string())
        )
        flat = pa.StructArray.from_arrays(
            [
                pa.array(i, pa.int32()), pa.array(self.j, pa.int32()), pa.array(kind, pa.string()),
                pa.array(tag, pa.string()), at, pa.array(text, pa.string()), pa.array(scope, pa.int64()),
                pa.array(lead, pa.string()), pa.array(self.full, pa.bool_()), pa.array(self.bare, pa.bool_()),
            ],
            names=["i", "j", "k", "tag", "at", "text", "scope", "lead", "full", "bare"],
        )
        # a null offset marks a null page
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


_STEP = re.compile(r"\s*([>\s])?\s*((?:[\w-]+|\*)?(?:[#.][\w-]+|\[[^\]]*\])*)")
_PART = re.compile(r"([#.])([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\]\s]+))\s*)?\]")


class Selector:
    """A selector as text: types, ``#id``, ``.class``, ``[name]`` and ``[name="value"]``, descendants and children (``>``), and lists with commas.

    It is read into steps; a step is met by an element of its own kind that stands in one that met the step before.
    """

    def __init__(self, text: str) -> None:
        self.text = text
        self.ways = [self._steps(part) for part in text.split(",")]

    def _steps(self, text: str) -> list[tuple[bool, str, list]]:
        steps, pos, text = [], 0, text.strip()
        while pos < len(text) or not steps:
            hit = _STEP.match(text, pos)
            if not hit or not hit[2] or (hit[1] == ">" and not steps):
                raise ValueError(f"not a selector: {self.text!r}")
            tag = re.match(r"[\w-]*|\*", hit[2])[0]
            parts = [("id" if m[1] == "#" else "class" if m[1] else m[3].lower(), m[2] or next((v for v in m.group(4, 5, 6) if v is not None), None)) for m in _PART.finditer(hit[2])]
            steps.append(("" if hit[2].startswith("*") else tag.lower(), parts, hit[1] == ">"))
            pos = hit.end()
        return [(child, tag, parts) for tag, parts, child in steps]

    @property
    def attributes(self) -> set[str]:
        return {name for way in self.ways for _, _, parts in way for name, _ in parts}


def _meets(tag: str, parts: list, own: str, at: dict) -> bool:
    if tag and tag != own:
        return False
    return all(name in at and (value is None or (value in at[name].split() if name == "class" else at[name] == value)) for name, value in parts)


class Marks:
    """Names that events are marked with while an element of that kind is open around them, as bits of ``scope``.

    A mark is a tag, ``.class``, ``tag#id`` or widget type; a link mark is given to links whose href
    matches its pattern. What stands within one of ``hidden`` doesn't show. Elements that ``selectors`` select are marked as such
    themselves; every step of a selector but its last takes a bit, as its order counts.
    """

    def __init__(self, names: list[str] = (), links: dict[str, str] | None = None, hidden: list[str] = (), selectors: list[str] = ()) -> None:
        self.bit = {n: 1 << i for i, n in enumerate(dict.fromkeys([*names, *(links or {})]))}
        self.attributes, self.ways, steps = set(ATTRIBUTES), [], len(self.bit)
        for selector in map(Selector, selectors):
            self.attributes |= selector.attributes
            for way in selector.ways:
                self.ways.append((selector.text, [(child, tag, parts, 1 << steps + k) for k, (child, tag, parts) in enumerate(way)]))
                steps += len(way) - 1
        self.attributes = frozenset(self.attributes)
        if steps > 63:
            raise ValueError("a scope holds 63 marks")
        self.links = [(self.bit[n], re.compile(p)) for n, p in (links or {}).items()]
        self.hidden = self.mask(*hidden)

    def mask(self, *names: str) -> int:
        return sum({self.bit[n] for n in names})

    def bits(self, tag: str, at: dict) -> int:
        bit = self.bit
        out = bit.get(tag, 0)
        if at:
            if "data-widget_type" in at:
                out |= bit.get(at["data-widget_type"], 0)
            if "id" in at:
                out |= bit.get(f"{tag}#{at['id']}", 0)
            for c in at["class"].split() if "class" in at else ():
                out |= bit.get("." + c, 0)
            if tag == "a" and "href" in at:
                for mark, pattern in self.links:
                    if pattern.search(at["href"]):
                        out |= mark
        return out

    def steps(self, tag: str, at: dict, scope: int, parent: int) -> tuple[int, list[str]]:
        """Bits of the steps that an element meets, and the selectors that select it; ``parent``: bits that its parent met."""
        met, selected = 0, []
        for text, way in self.ways:
            before = None
            for child, own, parts, bit in way:
                there = before is None or (parent if child else scope) & before
                if there and _meets(own, parts, tag, at):
                    if bit == way[-1][3]:
                        selected.append(text)
                    else:
                        met |= bit
                before = bit
        return met, selected

    def within(self, e: Column, *names: str) -> Column:
        """Inside an element with one of the marks."""
        return e["scope"].bitwiseAND(F.lit(self.mask(*names))) != 0


def _span(at: dict) -> int:
    """Columns of a table cell."""
    value = at.get("colspan", "")
    return min(max(int(value), 1), 1000) if value.isascii() and value.isdigit() and len(value) < 10 else 1


def event_parser(marks: Marks | None = None, only: list[str] | None = None):
    """UDF from HTML to events.

    ``scope`` has the bits of the marks that are open around an event; ``lead`` is what its lines are led in with, for the list items and
    quotes around it; ``full`` tells of an element whether anything in it shows, ``bare`` whether there is nothing in it that keeps it. With ``only``, nothing but the start events
    of these tags comes out.
    """
    marks, tags = marks or Marks(), frozenset(only) if only is not None else None

    @arrow_udf(EVENTS)
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for html in batches:
            # a batch of Spark's has pages by number, whatever they hold
            batch, ends = _Batch(), []
            for page in html:
                ends.append(len(batch.j) if page.is_valid else None)
                if page.is_valid:
                    _Page(batch, marks, tags).read(page.as_py())
                if len(batch.j) >= HELD or len(ends) >= HELD:
                    yield batch.array([*ends, len(batch.j)])
                    batch, ends = _Batch(), []
            if ends:
                yield batch.array([*ends, len(batch.j)])

    return parse


html_events = event_parser()


def selected(e: Column, selector: str) -> Column:
    """The start of an element that the selector selects; the parser must have been given the selector."""
    return F.coalesce((e["k"] == "o") & F.array_contains(F.split(e["at"]["#selected"], "\n"), selector), F.lit(False))


def is_open(e: Column, *tags: str) -> Column:
    return (e["k"] == "o") & e["tag"].isin(*tags)


def attr(e: Column, name: str) -> Column:
    """Attribute value, blank when absent."""
    return F.coalesce(e["at"][name], F.lit(""))


def has_class(e: Column, name: str) -> Column:
    return F.array_contains(F.split(attr(e, "class"), r"\s+"), name)


def first(events: Column, test) -> Column:
    return F.get(F.filter(events, test), F.lit(0))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def inside(events: Column, node: Column) -> Column:
    """Events strictly between a node's open and close event; ``events`` is a gapless run of one page."""
    base = F.get(events, F.lit(0))["i"]
    return F.slice(events, node["i"] - base + 2, node["j"] - node["i"] - 1)


def text_of(events: Column) -> Column:
    """Text nodes stripped and joined by one space, blank ones left out."""
    parts = F.transform(
        F.filter(events, lambda e: e["k"] == "t"),
        lambda e: F.regexp_replace(e["text"], r"(?U)^\s+|\s+\z", ""),
    )
    return F.array_join(F.filter(parts, lambda t: t != ""), " ")


def plain_text(html: Column) -> Column:
    return text_of(html_events(html))
