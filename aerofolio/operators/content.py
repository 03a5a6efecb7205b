"""Page content: container, embeds, widgets, images, links, and the page as Markdown.

Input is a table of pages with an ``events`` column (see ``functions.html``). Each
function is an expression inside the page's own row; what comes out as rows is exploded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx, urls
from ..functions.html import INDENT, QUOTE, Marks, attr, event_parser, first, has_class, inside, is_open, let, selected, text_of

# Widgets without content, and the widgets and classes that carry some.
NOISE = ["spacer.default", "divider.default", "countdown.default"]
FLIP, BUTTON = "flip-box.default", "button.default"
FLIP_TITLE = "elementor-flip-box__layer__title"
FLIP_TEXT = "elementor-flip-box__layer__description"
FLIP_IMAGE = "elementor-flip-box__image"
FLIP_BACK = "elementor-flip-box__back"
LEGACY_CLASS = "tableauViz"
PDF_VIEWER = "pdfjs-viewer-shortcode"
PDF_CONTROL = "#pdfjs-viewer-skip|pdfjs-viewer-shortcode"

DROPPED = ["script", "style", "noscript", "iframe", "tableau-viz", "." + LEGACY_CLASS, *NOISE, "pdf-control"]
HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
# Content containers in the order they are tried.
SELECTORS = [
    'div[data-elementor-type="wp-page"]',
    'div[data-elementor-type="wp-post"]',
    "main#main .entry-content",
    "article .entry-content",
    ".entry-content",
]


def _marks(selectors: list[str]) -> Marks:
    return Marks(
        [*DROPPED[:-1], FLIP, BUTTON, "." + FLIP_IMAGE, *HEADINGS, "b", "strong", "em", "i", "code", "pre", "li", "td", "th", "s", "del"],
        {"pdf-control": PDF_CONTROL}, hidden=DROPPED, selectors=selectors)


# the bits of names don't depend on the selectors, so expressions hold for pages parsed with any
MARKS = _marks(SELECTORS)
within = MARKS.within
link_events = event_parser(only=["a"])

# Labels and notes of the links that stand for embedded viewers.
PDF_LABEL, PDF_LEAF = "Open the PDF: ", "Open PDF"
FRAME_LABEL = "Open the embedded content"
DASHBOARD_LABEL = "Open the interactive dashboard: "
NO_TITLE = "Untitled"
PDF_NOTE = "This document is embedded in a PDF viewer on the original site."
FRAME_NOTE = "This content is embedded in a frame on the original site."
DASHBOARD_NOTE = "This Tableau dashboard is embedded on the original site."
# What may be pruned when empty, and what keeps it.
PRUNABLE = ["div", "section", "span", "p", "u", "b", "strong", "em"]
KEEPS = ["img", "a", "table", "hr", "br", "iframe"]


def parsed(pages: DataFrame, html: str = "html", carry: list[str] | None = None, only_links: bool = False, selectors: list[str] = SELECTORS) -> DataFrame:
    """One parse per page; only the named columns go with it. With ``only_links`` nothing but the starts of links comes out.

    ``selectors`` are what ``extract`` may look for afterwards.
    """
    parse = link_events if only_links else event_parser(_marks(selectors))
    return pages.select(*(carry or ["page_id", "url"]), parse(F.col(html)).alias("events"))


def container(events: Column, selectors: list[str] = SELECTORS) -> Column:
    """Struct of the first selector that matches and the node's event range; null if none does."""
    def hit(selector: str) -> Column:
        return F.transform(
            F.slice(F.filter(events, lambda e: selected(e, selector)), 1, 1),
            lambda e: F.struct(F.lit(selector).alias("selector"), e["i"].alias("i"), e["j"].alias("j")),
        )

    return F.get(F.concat(*[hit(s) for s in selectors]), F.lit(0))


def extract(pages: DataFrame, selectors: list[str] = SELECTORS) -> DataFrame:
    """``matched_selector`` and the container's inner events; both null when nothing matches. Pages were parsed with these selectors."""
    hit = pages.withColumn("_hit", container(F.col("events"), selectors))
    return (
        hit.withColumn("content", inside(F.col("events"), F.col("_hit")))
        .withColumn("matched_selector", F.col("_hit.selector"))
        .drop("_hit", "events")
    )


def prepared(pages: DataFrame, site: Column | str) -> DataFrame:
    """Adds what the later steps share, each computed once: ``embeds``, ``boxes`` and ``buttons``."""
    content, starts = F.col("content"), F.col("_starts")
    return pages.withColumn("_starts", F.filter(content, _may_start)).withColumns({
        "embeds": embeds(content, site, starts),
        "boxes": F.transform(F.filter(starts, lambda e: _is_widget(e, FLIP)), lambda e: flip_box(content, e)),
        "buttons": F.filter(
            F.transform(F.filter(starts, lambda e: _is_widget(e, BUTTON)), lambda e: button(content, e)),
            lambda b: b["found"],
        ),
    }).drop("_starts")


# ---------------------------------------------------------------- embeds


def _embed(kind: str, label: Column, href: Column, note: str, e: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), label.alias("label"), href.alias("href"), F.lit(note).alias("note"), e["i"].alias("i")
    )


def _may_start(e: Column) -> Column:
    """The few events that an embed or a widget can begin with, so that one pass looks at all the others."""
    return (e["k"] == "o") & (e["tag"].isin("iframe", "tableau-viz", "object") | e["at"]["data-widget_type"].isNotNull())


def _is_frame(e: Column) -> Column:
    return is_open(e, "iframe") & (attr(e, "src") != "")


def _is_legacy(e: Column) -> Column:
    return is_open(e, "object") & has_class(e, LEGACY_CLASS)


def _frame(e: Column, site: Column | str) -> Column:
    src = attr(e, "src")

    def pdf(href: Column) -> Column:
        leaf = F.coalesce(tx.blank_to_null(F.substring_index(href, "/", -1)), F.lit(PDF_LEAF))
        return _embed("pdf", F.concat(F.lit(PDF_LABEL), leaf), href, PDF_NOTE, e)

    title = F.coalesce(tx.blank_to_null(attr(e, "title")), F.lit(FRAME_LABEL))
    return F.when(src.contains(PDF_VIEWER), let(urls.pdf_target(src, site), pdf)).otherwise(
        _embed("frame", title, urls.absolutise(site, src), FRAME_NOTE, e)
    )


def _dashboard(kind: str, href: Column, e: Column) -> Column:
    name = F.when(href == "", F.lit("dashboard")).otherwise(urls.dashboard_label(href))
    return _embed(kind, F.concat(F.lit(DASHBOARD_LABEL), name), href, DASHBOARD_NOTE, e)


def _legacy(e: Column, events: Column) -> Column:
    def of(params: Column) -> Column:
        def value(name: str) -> Column:
            named = F.filter(params, lambda p: is_open(p, "param") & (attr(p, "name") == name))
            return F.coalesce(attr(F.try_element_at(named, F.lit(-1)), "value"), F.lit(""))

        href = urls.legacy_dashboard_url(value("host_url"), value("name"))
        return let(href, lambda h: _dashboard("legacy_dashboard", h, e))

    return let(inside(events, e), of)


def embeds(content: Column, site: Column | str, starts: Column | None = None) -> Column:
    """Array of embeds: frames first, then dashboards, then legacy objects, each in page order. ``starts``: the events among which they begin."""
    starts = content if starts is None else starts
    frames = F.transform(F.filter(starts, _is_frame), lambda e: _frame(e, site))
    views = F.transform(
        F.filter(starts, lambda e: is_open(e, "tableau-viz")), lambda e: _dashboard("dashboard", attr(e, "src"), e)
    )
    legacy = F.filter(
        F.transform(F.filter(starts, _is_legacy), lambda e: _legacy(e, content)), lambda x: x["href"].isNotNull()
    )
    return F.concat(frames, views, legacy)


def _rows(pages: DataFrame, key: str, items: Column, *fields: str) -> DataFrame:
    """One row per array item with its position.

    ``inline`` takes the array as a whole; picking fields after an explode would let the optimizer
    compute it once per field. The outer form keeps it from computing it for a "not empty" filter.
    """
    numbered = F.transform(items, lambda x, i: F.struct(i.alias("pos"), *[x[f].alias(f) for f in fields]))
    return pages.select(key, F.inline_outer(numbered)).where(F.col("pos").isNotNull())


def embed_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return _rows(pages, key, F.col("embeds"), "kind", "label", "href")


# ---------------------------------------------------------------- widgets


def _replaced(e: Column) -> Column:
    """Inside something that is removed, or replaced by a link."""
    return within(e, *DROPPED)


def _is_widget(e: Column, name: str) -> Column:
    return (e["k"] == "o") & (attr(e, "data-widget_type") == name) & ~_replaced(e) & ~within(e, FLIP, BUTTON)


def _usable(src: Column) -> Column:
    return (src != "") & ~src.startswith("data:")


def _src(e: Column) -> Column:
    return F.coalesce(tx.blank_to_null(attr(e, "data-src")), attr(e, "src"))


def flip_box(content: Column, e: Column) -> Column:
    """Struct of what a flip box leaves behind: image, heading, link, text (null where it has none)."""

    def of(inner: Column) -> Column:
        def part(name: str) -> Column:
            node = first(inner, lambda x: (x["k"] == "o") & has_class(x, name))
            return let(node, lambda n: F.when(n.isNotNull(), text_of(inside(inner, n))))

        image = first(inner, lambda x: is_open(x, "img") & within(x, "." + FLIP_IMAGE))
        back = first(inner, lambda x: is_open(x, "a") & has_class(x, FLIP_BACK))
        return let(
            F.struct(image.alias("image"), back.alias("back"), part(FLIP_TITLE).alias("title"), part(FLIP_TEXT).alias("text")),
            lambda p: F.struct(
                F.when(p["image"].isNotNull() & _usable(_src(p["image"])), _src(p["image"])).alias("src"),
                F.coalesce(tx.blank_to_null(attr(p["image"], "alt")), p["title"], F.lit("")).alias("alt"),
                F.coalesce(p["title"], F.lit(NO_TITLE)).alias("title"),
                tx.blank_to_null(attr(p["back"], "href")).alias("href"),
                p["text"].alias("text"),
                e["i"].alias("i"),
            ),
        )

    return let(inside(content, e), of)


def button(content: Column, e: Column) -> Column:
    """Struct of a button's link; ``found`` is false when it has none."""

    def of(inner: Column) -> Column:
        # a link without an href attribute is named "link"; one with a blank href stays blank
        return let(
            first(inner, lambda x: is_open(x, "a")),
            lambda link: F.struct(
                link.isNotNull().alias("found"),
                F.coalesce(tx.blank_to_null(text_of(inside(inner, link))), link["at"]["href"], F.lit("link")).alias("text"),
                attr(link, "href").alias("href"),
                e["i"].alias("i"),
            ),
        )

    return let(inside(content, e), of)


def _block(i: Column, part: int, kind: str, level: int, text: Column, href: Column) -> Column:
    return F.struct(
        i.alias("i"), F.lit(part).alias("part"), F.lit(kind).alias("type"), F.lit(level).alias("level"),
        text.alias("text"), href.alias("href"),
    )


def widget_blocks(boxes: Column, buttons: Column) -> Column:
    """Array of blocks the widgets are flattened to, in page order."""
    none = F.lit(None).cast("string")

    def of_box(b: Column) -> Column:
        return F.array(
            F.when(b["src"].isNotNull(), _block(b["i"], 0, "image", 0, b["alt"], b["src"])),
            _block(b["i"], 1, "heading", 3, b["title"], b["href"]),
            F.when(b["text"].isNotNull(), _block(b["i"], 2, "paragraph", 0, b["text"], none)),
        )

    parts = F.filter(F.flatten(F.transform(boxes, of_box)), lambda p: p.isNotNull())
    links = F.transform(buttons, lambda b: _block(b["i"], 0, "link", 0, b["text"], b["href"]))
    return F.array_sort(F.concat(parts, links))


def widget_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    blocks = widget_blocks(F.col("boxes"), F.col("buttons"))
    return _rows(pages, key, blocks, "type", "level", "text", "href")


# ---------------------------------------------------------------- images, links


def images(content: Column, boxes: Column) -> Column:
    """Array of the images a page keeps: lazy source before source, blanks and data URLs dropped."""

    def keeps(e: Column) -> Column:
        return is_open(e, "img") & _usable(_src(e)) & ~_replaced(e) & ~within(e, FLIP, BUTTON)

    def one(src: Column, alt: Column, i: Column) -> Column:
        return F.struct(i.alias("i"), src.alias("src"), alt.alias("alt"))

    plain = F.transform(F.filter(content, keeps), lambda e: one(_src(e), attr(e, "alt"), e["i"]))
    fronts = F.transform(F.filter(boxes, lambda b: b["src"].isNotNull()), lambda b: one(b["src"], b["alt"], b["i"]))
    return F.array_sort(F.concat(plain, fronts))


def image_rows(pages: DataFrame, site: Column | str, key: str = "page_id") -> DataFrame:
    found = _rows(pages, key, images(F.col("content"), F.col("boxes")), "src", "alt")
    absolute = found.withColumn("url", urls.absolutise(site, F.col("src")))
    return absolute.select(key, "pos", "url", urls.asset_name(F.col("url")).alias("name"), "alt")


def name_collisions(image_table: DataFrame) -> DataFrame:
    """File names that different URLs would overwrite each other under."""
    return image_table.groupBy("name").agg(F.count_distinct("url").alias("n_urls")).where(F.col("n_urls") > 1)


def anchors(content: Column) -> Column:
    """Array of all links with an href, stripped, in page order."""
    tags = F.filter(content, lambda e: is_open(e, "a") & e["at"]["href"].isNotNull())
    return F.transform(
        tags,
        lambda e: F.struct(tx.strip(attr(e, "href")).alias("href"), text_of(inside(content, e)).alias("text")),
    )


def link_rows(pages: DataFrame, column: str = "content", key: str = "page_id", with_text: bool = True) -> DataFrame:
    if with_text:
        found = anchors(F.col(column))
    else:
        found = F.transform(
            F.filter(F.col(column), lambda e: is_open(e, "a") & e["at"]["href"].isNotNull()),
            lambda e: F.struct(tx.strip(attr(e, "href")).alias("href")),
        )
    return _rows(pages, key, found, "href", *(["text"] if with_text else []))


# ---------------------------------------------------------------- pruning


def prunable(content: Column) -> Column:
    """Array of the elements that hold no text and nothing that shows.

    Removing one cannot make another one non-empty, so a single pass is the fixpoint.
    """

    def shows(x: Column) -> Column:
        return is_open(x, *KEEPS) | ((x["k"] == "t") & x["text"].rlike(r"(?U)\S"))

    return F.filter(
        content, lambda e: is_open(e, *PRUNABLE) & ~_replaced(e) & ~F.exists(inside(content, e), shows)
    )


def prune_rows(pages: DataFrame, key: str = "page_id") -> DataFrame:
    gone = F.transform(prunable(F.col("content")), lambda e: e["tag"])
    tags = pages.select(key, F.explode_outer(gone).alias("tag")).where(F.col("tag").isNotNull())
    return tags.groupBy(key, "tag").agg(F.count("*").alias("n_pruned"))


# ---------------------------------------------------------------- Markdown

# Noncharacters stand for markup until whitespace is settled; they cannot occur in page text. Those of one kind follow each other, as a regex
# tests a range much faster than a list; ``INDENT`` and ``QUOTE`` are \ufdd8 and \ufdd9.
BOLD, ITALIC, STRIKE, LINK = "\ufdd0", "\ufdd1", "\ufdd2", "\ufdd3"
BOLD_END, ITALIC_END, STRIKE_END, LINK_URL = "\ufdd4", "\ufdd5", "\ufdd6", "\ufdd7"
# a line that has a blank one above it; a list item ends
APART, ITEM_END = "\ufdda", "\ufddb"
LINK_END, LINK_CLOSE = "\ufddc", "\ufddd"
HEAD, KEPT_LINE, KEPT_BLANK = "\ufdde", "\ufddf", "\ufde0"
# no blank line above this line; a list item's marker ends
CLOSE_UP, ITEM = "\ufde1", "\ufde2"
MARK_CHARS = "[\ufdd0-\ufde2]"
BLOCKS = [
    "address", "article", "aside", "center", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form", "header",
    "main", "nav", "p", "section", "table",
]


def _link(text: Column, href: Column) -> Column:
    return F.concat(F.lit(LINK), text, F.lit(LINK_URL), href, F.lit(LINK_END + LINK_CLOSE))


def _image(src: Column, alt: Column, picture: Callable[[Column], Column]) -> Column:
    return F.concat(F.lit("!["), F.regexp_replace(alt, r"\s+", " "), F.lit("]("), picture(src), F.lit(")"))


def _paragraph(*parts: Column) -> Column:
    """A paragraph of its own; ``_piece`` adds what its lines are led in with."""
    return F.concat(F.lit("\n" + APART), *parts, F.lit("\n" + APART))


def swaps(picture: Callable[[Column], Column]) -> Column:
    """``map<event index, Markdown>`` for the nodes that are replaced as a whole."""
    none = F.lit("")

    def embed(x: Column) -> Column:
        note = F.concat(F.lit(ITALIC), x["note"], F.lit(ITALIC_END))
        return F.struct(x["i"], F.concat(_paragraph(note), _paragraph(_link(x["label"], x["href"]))).alias("md"))

    def box(b: Column) -> Column:
        md = F.concat(
            F.coalesce(_paragraph(_image(b["src"], b["alt"], picture)), none),
            F.lit("\n" + APART + HEAD + "### "),
            F.coalesce(_link(b["title"], b["href"]), b["title"]),
            F.lit("\n" + APART),
            F.coalesce(_paragraph(b["text"]), none),
        )
        return F.struct(b["i"], md.alias("md"))

    def knob(b: Column) -> Column:
        return F.struct(b["i"], _paragraph(_link(b["text"], b["href"])).alias("md"))

    pairs = F.concat(
        F.transform("embeds", embed), F.transform("boxes", box), F.transform("buttons", knob)
    )
    return F.map_from_entries(pairs)


def _piece(e: Column, swap: Column, picture: Callable[[Column], Column]) -> Column:
    """Markdown of one event; blank for what is dropped. Every new line brings the event's ``lead``."""
    none = F.lit("")
    opens = e["k"] == "o"
    tight = within(e, "td", "th", *HEADINGS)
    lead = e["lead"]
    line = F.concat(F.lit("\n"), lead)
    apart = F.concat(F.lit("\n" + APART), lead)
    gap = F.when(tight, F.lit(" ")).otherwise(apart)

    text = F.regexp_replace(e["text"], MARK_CHARS, "\ufffd")
    kept = F.replace(F.translate(text, "\n ", KEPT_LINE + KEPT_BLANK), F.lit(KEPT_LINE), F.concat(F.lit(KEPT_LINE), lead))
    flowing = F.regexp_replace(text, r"[ \t\r\n]+", " ")
    marker = F.when(attr(e, "#in") == "ol", F.concat(attr(e, "#n"), F.lit(". "))).otherwise(F.lit("- "))
    item = F.concat(F.when(e["at"]["#first"].isNull(), F.lit(CLOSE_UP)).otherwise(none), line, marker, F.lit(ITEM))
    rule = F.concat(line, F.lit("|"), F.repeat(F.lit(" --- |"), attr(e, "#items").cast("int")))
    inner_list = within(e, "li")

    def pair(start: str, end: str, *same: str) -> Column:
        shows = e["full"] & ~within(e, *same, "pre", "code")
        return F.when(~shows, none).when(opens, F.lit(start)).otherwise(F.lit(end))

    tag = e["tag"]
    widget = attr(e, "data-widget_type")
    whole = tag.isin("iframe", "tableau-viz") | widget.isin(FLIP, BUTTON) | ((tag == "object") & has_class(e, LEGACY_CLASS))
    no_link = attr(e, "href").rlike(PDF_CONTROL) | (attr(e, "href") == "") | ~e["full"]
    title = F.replace(F.regexp_replace(attr(e, "title"), MARK_CHARS + r"|\s+", " "), F.lit('"'), F.lit('\\"'))
    shown_title = F.when(attr(e, "title") == "", none).otherwise(F.concat(F.lit(' "'), title, F.lit('"')))
    return (
        F.when(within(e, *DROPPED, FLIP, BUTTON), none)
        .when(tag == "#text", F.when(within(e, "pre"), kept).otherwise(flowing))
        .when(widget.isin(*NOISE), none)
        .when(whole, F.when(opens, F.replace(F.coalesce(swap[e["i"]], none), F.lit("\n" + APART), apart)).otherwise(none))
        .when(tag == "a", F.when(no_link, none).when(opens, F.lit(LINK)).otherwise(
            F.concat(F.lit(LINK_URL), F.regexp_replace(attr(e, "href"), MARK_CHARS, ""), F.lit(LINK_END), shown_title, F.lit(LINK_CLOSE))))
        .when(tag == "img", F.when(opens & _usable(_src(e)), _image(_src(e), attr(e, "alt"), picture)).otherwise(none))
        .when(tag.isin("b", "strong"), pair(BOLD, BOLD_END, "b", "strong"))
        .when(tag.isin("em", "i"), pair(ITALIC, ITALIC_END, "em", "i"))
        .when(tag.isin("s", "del"), pair(STRIKE, STRIKE_END, "s", "del"))
        .when(tag == "br", F.when(~opens, none).when(tight, F.lit(" ")).otherwise(line))
        .when(tag == "hr", F.when(opens, F.concat(apart, F.lit("---"), apart)).otherwise(none))
        .when(tag.isin(*HEADINGS), F.when(tight, F.lit(" ")).when(~opens, apart).otherwise(
            F.concat(apart, F.lit(HEAD), F.repeat(F.lit("#"), F.substring(tag, 2, 1).cast("int")), F.lit(" "))))
        .when(tag.isin("ul", "ol"), F.when(tight, F.lit(" ")).when(inner_list, line).otherwise(apart))
        .when(tag == "li", F.when(tight, F.lit(" ")).when(opens, item).otherwise(F.lit(ITEM_END)))
        .when(tag == "pre", F.when(opens, F.concat(apart, F.lit("```" + KEPT_LINE), lead)).otherwise(
            F.concat(F.lit(KEPT_LINE), lead, F.lit("```"), apart)))
        .when(tag == "code", F.when(within(e, "pre") | ~e["full"], none).otherwise(F.lit("`")))
        .when(tag == "tr", F.when(opens, F.concat(line, F.lit("|"))).when(attr(e, "#n") == "1", rule).otherwise(none))
        .when(tag.isin("td", "th"), F.when(opens, F.lit(" ")).otherwise(F.repeat(F.lit(" |"), F.coalesce(attr(e, "#span").try_cast("int"), F.lit(1)))))
        .when(tag == "blockquote", F.when(opens & ~tight, F.concat(apart, F.lit(QUOTE))).otherwise(gap))
        .when(tag.isin("div", "section", "p") & e["bare"], none)
        .when(tag.isin(*BLOCKS), gap)
        .otherwise(none)
    )


def _settled(raw: Column) -> Column:
    """Whitespace moved out of markup, runs of it made one space, one line or one blank line."""
    ws, leads = f"[ \n{INDENT}-{APART}]", f"[{INDENT}-{QUOTE}]"
    begin, end = f"[{BOLD}-{LINK}]", f"(?:[{BOLD_END}-{STRIKE_END}]|{LINK_URL}[^{LINK_CLOSE}]*{LINK_CLOSE})"
    # what stands after any of some starts goes before the first of them, whatever their number; the same for ends
    out = F.regexp_replace(raw, f"(?={begin})((?:{begin}{ws}*)*{begin})({ws}+)", "$2$1$2")
    out = F.regexp_replace(out, f"(?<={begin}){ws}+", "")
    out = F.regexp_replace(out, f"({ws}+)({end}(?:{ws}*{end})*)", "$1$2$1")
    out = F.regexp_replace(out, f"{ws}+(?={end})", "")
    # an item begins beside its marker, and has no blank line between it and the one before
    out = F.regexp_replace(out, f"{ITEM}{ws}+", ITEM)
    out = F.regexp_replace(out, f"[ \n{INDENT}-{ITEM_END}]*{CLOSE_UP}", "")
    out = F.regexp_replace(out, f"[{ITEM}{ITEM_END}]", "")
    # of a run of line ends, the last one's lead stays, and whether there was a blank line
    out = F.regexp_replace(out, f"{ws}*{APART}{ws}*?({leads}*) *(?!{ws})", f"\n{APART}$1")
    out = F.regexp_replace(out, f" *\n(?!{APART})[ \n{INDENT}-{QUOTE}]*?({leads}*) *(?![ \n{INDENT}-{QUOTE}])", "\n$1")
    out = F.regexp_replace(out, " {2,}", " ")
    return F.regexp_replace(out, f"{HEAD}#+ *(?=\n|\\z)", "")


def _spaced(text: Column) -> Column:
    """Blank lines put in, each led in with what the lines above and below have in common."""

    def lead(line: Column) -> Column:
        return F.regexp_extract(line, f"^{APART}?([{INDENT}-{QUOTE}]*)", 1)

    def joined(lines: Column) -> Column:
        def one(line: Column, i: Column, leads: Column) -> Column:
            here, above = F.get(leads, i), F.coalesce(F.get(leads, i - 1), F.lit(""))
            common = F.when(here.startswith(above), above).when(above.startswith(here), here).otherwise(F.lit(""))
            return F.when(line.startswith(APART), F.concat(common, F.lit("\n"), F.substring(line, 2, 1 << 30))).otherwise(line)

        # leads are taken once a line
        return let(F.transform(lines, lead), lambda leads: F.array_join(F.transform(lines, lambda line, i: one(line, i, leads)), "\n"))

    return let(F.split(text, "\n"), joined)


def _plain(draft: Column) -> Column:
    """Marks turned into Markdown; a link that shows its own target becomes ``<target>``."""
    out = F.regexp_replace(_spaced(draft), f"{LINK}([^{LINK_URL}]+){LINK_URL}\\1{LINK_END}{LINK_CLOSE}", "<$1>")
    for mark, plain in (
        (BOLD, "**"), (BOLD_END, "**"), (ITALIC, "*"), (ITALIC_END, "*"), (STRIKE, "~~"), (STRIKE_END, "~~"), (LINK, "["), (LINK_URL, "]("), (LINK_END, ""),
        (LINK_CLOSE, ")"), (HEAD, ""), (INDENT, " "), (QUOTE, "> "), (KEPT_LINE, "\n"), (KEPT_BLANK, " "),
    ):
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return out


def drafted(pages: DataFrame, site: Column | str, picture: Callable[[Column], Column] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A prepared page's content as marked text, in ``draft``, in place of the parsed columns.

    ``picture`` gives the source an image is shown under. Blocks inside table
    cells and headings are joined by a space. A draft still holds the
    page's own hrefs; ``keep`` names parsed columns to stay beside it. It is far smaller than the events, so it is what travels
    to the join with the link map.
    """
    show = picture or (lambda src: urls.absolutise(site, src))

    def joined(swap: Column) -> Column:
        return F.array_join(F.transform("content", lambda e: _piece(e, swap, show)), "")

    # bound by let: as a plain column the optimizer would move it into the loop over events
    return pages.withColumn("draft", _settled(let(swaps(show), joined))).drop(*{"content", "embeds", "boxes", "buttons"} - set(keep))


def hrefs(drafts: DataFrame, *carry: str) -> DataFrame:
    """Every href of a page's draft, once per page, beside the columns named."""
    found = F.regexp_extract_all("draft", F.lit(f"{LINK_URL}([^{LINK_END}]*){LINK_END}"), F.lit(1))
    return drafts.select(*carry, F.explode_outer(F.array_distinct(found)).alias("href")).where(F.col("href").isNotNull())


def finished(drafts: DataFrame, targets: str | None = None, name: str = "body") -> DataFrame:
    """Drafts to Markdown (P34, P35). ``targets`` names a map column from href to its rewritten form."""
    text = F.col("draft")
    if targets is not None:
        # text and href take turns between the two marks
        parts = F.split("draft", f"{LINK_URL}|{LINK_END}")

        def put(part: Column, i: Column) -> Column:
            to = F.coalesce(F.col(targets)[part], part)
            return F.when(i % 2 == 1, F.concat(F.lit(LINK_URL), to, F.lit(LINK_END))).otherwise(part)

        text = F.array_join(F.transform(parts, put), "")
    return drafts.withColumn(name, tx.normalise_headings(tx.clean_markdown(_plain(text)))).drop("draft")


def with_markdown(pages: DataFrame, site: Column | str, picture: Callable[[Column], Column] | None = None) -> DataFrame:
    """Prepared pages to Markdown in ``body``, links left as they are."""
    return finished(drafted(pages, site, picture))


def static_picture(depth_prefix: Column, site: Column | str) -> Callable[[Column], Column]:
    """Image sources as the files they were landed under (P28), relative to the document."""
    return lambda src: F.concat(depth_prefix, F.lit("_static/images/"), urls.asset_name(urls.absolutise(site, src)))


def href_targets(resolved: DataFrame, key: str) -> DataFrame:
    """One ``map<href, resolved>`` per page; it is as long as the page's own list of distinct hrefs.

    A key that stands on several rows gets one map with the hrefs of all.
    """
    pairs = F.collect_list(F.struct("href", "resolved"))
    resolved = resolved.groupBy(key, "href").agg(F.min("resolved").alias("resolved"))
    return resolved.groupBy(key).agg(F.map_from_entries(pairs).alias("targets"))
