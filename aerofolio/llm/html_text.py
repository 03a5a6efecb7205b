"""Main text of web pages by tag-path ratios.

Every block of text has a path of tags from the root. Text length, punctuation and link text are added up per path, so a
path that carries prose stands out however short one of its blocks is. The ratios are smoothed along the page, fused and
compared with a threshold; the element that holds the selected text is the article, and what stands in it is returned.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# HTML's elements by their kind, and names that sites give to what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg object select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset("nav footer dialog menu button head".split())
ASIDE = frozenset("aside form".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "footer masthead cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended comment comments disqus reply replies pagination pager toolbar search contentinfo complementary".split())
#: Words that may stand beside those names in a class or id; with any other word ("has-sidebar", "related-work") it says something else.
BESIDE = frozenset(
    "area articles bar block bottom box button buttons container form icons inner items links list main outer panel policy post posts section site slot stories top "
    "unit widget wrap wrapper".split())
#: Only elements that hold blocks go by their names, never headings, paragraphs or articles.
CONTAINERS = frozenset("div section ul ol dl table details fieldset center".split())
#: An element with this share of the page's selected text or more is the page, whatever its tag or name.
PAGE_SHARE = 0.75
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table menu".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PUNCTUATION = re.compile("[.,;:!?…¡¿。、，！？；：]")
# a quoted value doesn't go over a "<", so a stray quote ends at the next tag
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
WORD = re.compile(r"[A-Za-z]+")


class Block:
    __slots__ = ("path", "parts", "link", "holders", "main", "heading", "aside", "text")

    def __init__(self, path: int, holders: int, main: bool, heading: bool, aside: int):
        self.path, self.holders, self.main, self.heading, self.aside = path, holders, main, heading, aside
        self.parts: list[str] = []
        self.link, self.text = 0, ""


def _is_aside(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in ASIDE or (tag == "header" and not in_main):
        return True
    if tag not in CONTAINERS or not attributes:
        return False
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() in ("class", "id", "role"):
            for token in m[2].strip("\"'").split():
                words = [w.lower() for w in WORD.findall(token)]
                if any(w in ASIDE_NAMES for w in words) and all(w in ASIDE_NAMES or w in BESIDE for w in words):
                    return True
    return False


def blocks(page: str) -> tuple[list[Block], list[tuple[int, str]], list[int]]:
    """Blocks of text; all elements that hold blocks, as ``(parent, tag)``; and of menus and the like, the next one around each (0: none)."""
    # of an open element: tag, path, number of the nearest block element, number of the nearest one aside (-1: no text), article or main, link
    stack: list[tuple[str, int, int, int, bool, bool]] = [("", 0, 0, 0, False, False)]
    asides: list[int] = [0]
    paths: dict[tuple[int, str], int] = {}
    holders: list[tuple[int, str]] = [(-1, "")]
    found: list[Block] = []
    current: Block | None = None
    open_count: dict[str, int] = {}
    at = 0

    def add(raw: str) -> None:
        nonlocal current
        tag, path, holder, aside, main, link = stack[-1]
        if aside < 0 or not raw:
            return
        if current is None:
            if raw.isspace():
                return
            current = Block(path_of_block(), holder, main, holders[holder][1] in HEADINGS, aside)
            found.append(current)
        current.parts.append(raw)
        if link:
            current.link += len(raw)

    def path_of_block() -> int:
        return stack[-1][1]

    def pop() -> None:
        nonlocal current
        tag = stack.pop()[0]
        open_count[tag] -= 1
        if tag in BLOCK:
            current = None

    while True:
        m = TAG.search(page, at)
        add(page[at : m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if open_count.get(tag):
                while stack[-1][0] != tag:
                    pop()
                pop()
            elif tag == "p":
                current = None
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at) if not attributes.endswith("/") else None
            if end is None and tag in ("script", "style", "textarea", "title") and not attributes.endswith("/"):
                break
            at = end.end() if end else at
            continue
        if tag == "br":
            add(" ")
            continue
        if tag in BLOCK:
            current = None
            if tag in CLOSES:
                # up to the list or table that they stand in
                depth = len(stack) - 1
                while depth and stack[depth][0] not in LISTS and stack[depth][0] not in CLOSES[tag]:
                    depth -= 1
                if stack[depth][0] in CLOSES[tag]:
                    while len(stack) > depth:
                        pop()
                    while stack[-1][0] in CLOSES[tag]:
                        pop()
            elif open_count.get("p") and tag not in ("body", "html"):
                while stack[-1][0] != "p":
                    pop()
                pop()
        if tag in VOID:
            continue
        _, path, holder, aside, main, link = stack[-1]
        path = paths.setdefault((path, tag), len(paths) + 1)
        if tag in NEVER:
            aside = -1
        elif aside >= 0 and (_is_aside(tag, attributes, main) or (tag == "article" and main and _in_article(stack))):
            asides.append(aside)
            aside = len(asides) - 1
        if tag in BLOCK and aside >= 0:
            holders.append((holder, tag))
            holder = len(holders) - 1
        stack.append((tag, path, holder, aside, main or tag in MAIN, link or tag == "a"))
        open_count[tag] = open_count.get(tag, 0) + 1
    for b in found:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    return [b for b in found if b.text], holders, asides


def _in_article(stack: list) -> bool:
    """An article within an article is a comment on it, unless it holds most of the page's selected text."""
    return any(x[0] == "article" for x in stack)


def _smoothed(values: list[float]) -> list[float]:
    """Gaussian weights over two neighbours on either side."""
    weights = [math.exp(-0.5 * k * k) for k in range(3)]
    out = []
    for i in range(len(values)):
        total = norm = 0.0
        for k in range(-2, 3):
            if 0 <= i + k < len(values):
                total += weights[abs(k)] * values[i + k]
                norm += weights[abs(k)]
        out.append(total / norm)
    return out


def selected(found: list[Block], share: float) -> list[bool]:
    """Which blocks are content: the fused ratio of the path is at least ``share`` of the page's mean over all characters."""
    sums: dict[int, list[float]] = {}
    for b in found:
        s = sums.setdefault(b.path, [0.0, 0.0, 0.0, 0.0])
        for i, x in enumerate((1, len(b.text), len(PUNCTUATION.findall(b.text)), min(b.link, len(b.text)))):
            s[i] += x
    length = _smoothed([sums[b.path][1] / sums[b.path][0] for b in found])
    marks = _smoothed([sums[b.path][2] / sums[b.path][0] for b in found])
    fused = [math.sqrt(x * (1 + y)) * (1 - sums[b.path][3] / sums[b.path][1]) for x, y, b in zip(length, marks, found)]
    whole = sum(len(b.text) for b in found)
    mean = sum(f * len(b.text) for f, b in zip(fused, found)) / whole if whole else 0.0
    return [f >= share * mean for f in fused]


def _without_asides(found: list[Block], asides: list[int], share: float) -> list[Block]:
    """Blocks outside of menus and the like, but an element that holds most of the selected text is none."""
    if not any(b.aside for b in found):
        return found
    weight = [0] * len(asides)
    for b, c in zip(found, selected(found, share)):
        weight[b.aside] += len(b.text) * c
    whole = sum(weight)
    for i in range(len(asides) - 1, 0, -1):
        weight[asides[i]] += weight[i] if asides[i] else 0
    gone = [False] * len(asides)
    for i in range(1, len(asides)):
        gone[i] = gone[asides[i]] or weight[i] < PAGE_SHARE * whole
    return [b for b in found if not gone[b.aside]]


def main_text(page: str, share: float = 0.3, most: float = 0.9) -> str:
    """The text of the page's article, blocks joined by two line ends; empty if there is none."""
    found, holders, asides = blocks(page)
    found = _without_asides(found, asides, share)
    if not found:
        return ""
    content = selected(found, share)
    weight = [0.0] * len(holders)
    for b, c in zip(found, content):
        weight[b.holders] += len(b.text) * c
    children: dict[int, list[int]] = {}
    for i in range(len(holders) - 1, 0, -1):
        weight[holders[i][0]] += weight[i]
        children.setdefault(holders[i][0], []).append(i)
    # an article or main element that holds nearly all selected text, else the innermost element that holds all of it
    marked = (i for tag in ("article", "main") for i, h in enumerate(holders) if h[1] == tag and weight[i] > 0 and weight[i] >= most * weight[0])
    here = next(marked, 0)
    while not here or holders[here][1] not in MAIN:
        inner = max(children.get(here, ()), key=lambda i: (weight[i], -i), default=None)
        if inner is None or weight[inner] < weight[here] or weight[inner] == 0 or holders[inner][1] in ("p", "ul", "ol", "dl", "table", "blockquote", "pre", *HEADINGS):
            break
        here = inner
    inside = [False] * len(holders)
    for i in range(len(holders)):
        inside[i] = i == here or (i > 0 and inside[holders[i][0]])
    whole = holders[here][1] in MAIN
    return "\n\n".join(b.text for b, c in zip(found, content) if inside[b.holders] and (whole or c or b.heading))


def _run(share: float, most: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index("html")
            texts = [main_text(x, share, most) if x else "" for x in (v.as_py() for v in b.column(at))]
            yield pa.RecordBatch.from_arrays([*b.columns[:at], pa.array(texts, pa.string())], names=[*b.schema.names[:at], "text"])

    return run


def extract(pages: DataFrame, share: float = 0.3, most: float = 0.9, html_col: str = "html") -> DataFrame:
    """The rows of ``pages`` (but the html) with ``text, n_chars``.

    Null and empty pages give an empty text. White space in a block becomes one space, character references are decoded. Within the
    article, menus, forms, comments and the like go, by tag or by a class, id or role of a container (``NEVER``, ``ASIDE``, ``ASIDE_NAMES``); nothing else is dropped or capped. Rows don't depend on each other; columns named as a result are replaced.
    """
    others = [c for c in pages.columns if c not in ("text", "n_chars", html_col)]
    schema = T.StructType([*(T.StructField(f"c{i}", pages.schema[c].dataType) for i, c in enumerate(others)), T.StructField("text", T.StringType())])
    rows = pages.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(html_col).alias("html")).mapInArrow(_run(share, most), schema)
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "text", F.char_length("text").cast("long").alias("n_chars"))
