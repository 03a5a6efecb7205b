"""Text expressions. The whitespace class is the one the portal's exporter uses (Unicode
whitespace plus the four ASCII separators), which is wider than Java's ``\\s``."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .html import let

# Whitespace characters, as a regex class body.
SPACE = r"\t\n\x0b\f\r\x1c-\x1f \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACES = re.compile(f"[{SPACE}]")
SPACES = "".join(chr(c) for c in range(0x3001) if SPACES.match(chr(c)))
# What ends a line when a text is cut into lines.
LINE_END = r"\r\n|[\n\r\x0b\f\x1c-\x1e\x85\u2028\u2029]"
# Fixed value: a Markdown heading line, up to six levels, followed by text.
HEADING = rf"^(#{{1,6}}) (?=[^{SPACE}])"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(SPACES))


def collapse(text: Column) -> Column:
    """Runs of whitespace become one space."""
    return F.regexp_replace(text, rf"[{SPACE}]+", " ")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def lines(text: Column) -> Column:
    return F.split(text, LINE_END)


def clean_markdown(text: Column) -> Column:
    """P35. The order matters: a line ending in a no-break space keeps a trailing space."""
    text = F.regexp_replace(text, r"[ \t]+\n", "\n")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.replace(text, F.lit("\u00a0"), F.lit(" "))
    return strip(text)


def heading_levels(body: Column) -> Column:
    """Levels of all heading lines of a text, in order."""
    found = F.regexp_extract_all(body, F.lit("(?md)" + HEADING), F.lit(1))
    return F.transform(found, lambda marks: F.length(marks))


def shifted_level(level: Column, lowest: Column) -> Column:
    """The level after the shallowest heading of the document has become level 2."""
    return F.greatest(F.lit(2), F.least(F.lit(6), level + 2 - lowest))


def normalise_headings(body: Column) -> Column:
    """P34, inside one row: no shuffle, one pass over the lines."""

    def moved(lowest: Column) -> Column:
        def one(line: Column) -> Column:
            marks = F.regexp_extract(line, HEADING, 1)
            level = shifted_level(F.length(marks), lowest)
            return F.when(
                line.startswith("#") & (marks != ""),
                F.concat(F.repeat(F.lit("#"), level), F.substring(line, F.length(marks) + 1, F.length(line))),
            ).otherwise(line)

        shifted = F.array_join(F.transform(F.split(body, "\n"), one), "\n")
        return F.when(lowest.isNull() | (lowest == 2), body).otherwise(shifted)

    return let(F.array_min(heading_levels(body)), moved)


# The labels of a page's meta lines.
PUBLISHED, SOURCE = "*Published: ", "*Source: ["


def render_document(title: Column, url: Column, kind: Column, date: Column, body: Column) -> Column:
    """Title, blank line, meta lines, blank line, body, closing newline."""
    source = F.concat(F.lit(SOURCE), url, F.lit("]("), url, F.lit(")*"))
    published = F.concat(F.lit(PUBLISHED), F.substring(date, 1, 10), F.lit("*"))
    meta = F.when(kind == "post", F.concat(published, F.lit("  \n"), source)).otherwise(source)
    return F.concat_ws("\n", F.concat(F.lit("# "), title), F.lit(""), meta, F.lit(""), body, F.lit(""))


def upsert_block(text: Column, block: Column, start: str, end: str) -> Column:
    """Put ``block`` between the markers, or append it where they are not both present.

    If the end marker stands only before the start marker, everything after
    the start marker is replaced, as in the portal's own tool.
    """
    head = F.substring_index(text, start, 1)
    rest = F.substring(text, F.length(head) + len(start) + 1, F.length(text))
    tail = F.when(
        rest.contains(end),
        F.substring(rest, F.instr(rest, end) + len(end), F.length(rest)),
    ).otherwise(F.lit(""))
    both = text.contains(start) & text.contains(end)
    appended = F.concat(rstrip(text), F.lit("\n\n"), block, F.lit("\n"))
    return F.when(both, F.concat(head, block, tail)).otherwise(appended)


def table_cells(line: Column) -> Column:
    """Cells of one Markdown table line: outer pipes go, every cell is stripped."""
    bare = F.btrim(strip(line), F.lit("|"))
    return F.transform(F.split(bare, r"\|"), strip)


def without_bold(text: Column) -> Column:
    return strip(F.replace(text, F.lit("**"), F.lit("")))


def cell_url(cell: Column) -> Column:
    """The first ``](http…)`` or ``<http…>`` of a cell; null if there is none."""
    # Fixed value: the two ways a cell can hold a link.
    pattern = rf"\]\((https?://[^){SPACE}]+)\)|<(https?://[^>{SPACE}]+)>"
    return F.coalesce(
        blank_to_null(F.regexp_extract(cell, pattern, 1)),
        blank_to_null(F.regexp_extract(cell, pattern, 2)),
    )
