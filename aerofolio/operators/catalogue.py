"""The catalogue of viewers: parse, captures, gallery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.html import let
from .ordered import row_numbers

# Heading of the id column, cells a row needs, smallest capture, smallest thumbnail.
HEADER = "Serial number"
CELLS = 5
MIN_CAPTURE = 5000
MIN_THUMBNAIL = 12000
# What a capture's message says.
TIMED_OUT, NO_IMAGE, SIZE_UNIT = "timed out", "no image produced", " KB"


def table_rows(texts: DataFrame) -> DataFrame:
    """The data rows of the Markdown tables in ``(source, value)``, with their cells."""
    first = F.col("cells")[0]
    # cells are cut before the explode, and the explode is an outer one, so that neither the filter
    # below nor an inferred "array is not empty" filter runs the cutting again
    cut = F.transform(tx.lines(F.col("value")), lambda line: F.when(line.startswith("|"), tx.table_cells(line)))
    return texts.select("source", F.posexplode_outer(cut).alias("pos", "cells")).where(
        (F.size("cells") >= CELLS) & (first != HEADER) & ~first.rlike(r"^[- ]*$")
    )


def _grouped(rows: Column) -> Column:
    """Rows of one text, each with the group named last above it; one slice for each group, so an array is cut once."""
    named = F.filter(F.transform(rows, lambda r, i: F.when(r["box"].isNotNull(), i)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.concat(F.array(F.lit(0)), named))

    def of(starts: Column) -> Column:
        def part(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(rows))
            box = F.coalesce(F.get(rows, start)["box"], F.lit(""))
            return F.transform(F.slice(rows, start + 1, end - start), lambda r: r.withField("box", box))

        return F.flatten(F.transform(starts, part))

    return F.when(F.size(rows) > 0, let(starts, of))


def applications(texts: DataFrame) -> DataFrame:
    """The applications of a Markdown catalogue, in table order.

    The group is carried down before rows without a URL are dropped: such a
    row still names the group of the rows under it. All of it happens in the
    text's own row, so nothing is shuffled.
    """

    def row(line: Column, pos: Column) -> Column:
        return let(F.when(line.startswith("|"), tx.table_cells(line)), lambda cells: F.when(
            (F.size(cells) >= CELLS) & (cells[0] != HEADER) & ~cells[0].rlike(r"^[- ]*$"),
            F.struct(
                pos.alias("pos"), cells[0].alias("id"), tx.blank_to_null(tx.without_bold(cells[1])).alias("box"), clean_name(cells[2]).alias("name"),
                is_discontinued(cells[2]).alias("discontinued"), tx.without_bold(cells[3]).alias("previously"), tx.cell_url(cells[4]).alias("url"))))

    rows = F.filter(F.transform(tx.lines(F.col("value")), row), lambda r: r.isNotNull())
    # without a value there are no rows: an empty array would do, but the outer form keeps the work from being repeated in a filter
    kept = let(rows, lambda r: F.filter(_grouped(r), lambda x: x["url"].isNotNull()))
    out = texts.select("source", F.inline_outer(kept)).where(F.col("pos").isNotNull())
    return out.select("source", "pos", "id", "box", "name", "discontinued", "previously", "url")


def clean_name(raw: Column) -> Column:
    """P32."""
    return tx.collapse(tx.without_bold(raw))


def is_discontinued(raw: Column) -> Column:
    return F.lower(raw).contains("discontinued")


def chosen(apps: DataFrame, ids: list[str]) -> DataFrame:
    """All rows when no id is given."""
    return apps.where(F.col("id").isin(ids)) if ids else apps


def too_small(size: Column, least: int, strict: bool = False) -> Column:
    """Below ``least``; with ``strict`` exactly ``least`` is too small as well."""
    return size <= least if strict else size < least


def capture_status(captures: DataFrame, least: int = MIN_CAPTURE, strict: bool = False,
                   least_thumbnail: int = MIN_THUMBNAIL) -> DataFrame:
    """P14 over ``(id, bytes, timed_out, thumbnail_bytes)``: ok, message, blank."""
    late = F.coalesce("timed_out", F.lit(False))
    no_image = F.col("bytes").isNull() | too_small(F.col("bytes"), least, strict)
    message = (
        F.when(late, F.lit(TIMED_OUT))
        .when(no_image, F.lit(NO_IMAGE))
        .otherwise(F.concat(F.floor(F.col("bytes") / 1024).cast("string"), F.lit(SIZE_UNIT)))
    )
    ok = ~late & ~no_image
    blank = ok & F.coalesce(F.col("thumbnail_bytes") < least_thumbnail, F.lit(False))
    return captures.withColumn("ok", ok).withColumn("message", message).withColumn("blank", blank)


def capture_summary(status: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """P52, the counts: one mergeable aggregate."""
    return status.groupBy(*(keys or [])).agg(
        F.count_if("ok").alias("captured"),
        F.count("*").alias("total"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count_if("blank").alias("blank"),
    )


def capture_problems(status: DataFrame) -> DataFrame:
    """P52, the lists: failures and blanks as rows, not as one collected array."""
    kind = F.when(~F.col("ok"), F.lit("failure")).when(F.col("blank"), F.lit("blank"))
    return status.withColumn("problem", kind).where(F.col("problem").isNotNull()).select("problem", "id", "message")


def missing(apps: DataFrame, made: DataFrame, key: str = "id") -> DataFrame:
    """Catalogue rows with nothing in the manifest."""
    return apps.join(made.select(key), key, "left_anti")


def present(apps: DataFrame, made: DataFrame, key: str = "id") -> DataFrame:
    """Catalogue rows with an entry in the manifest; its ``count`` is P42."""
    return apps.join(made.select(key), key, "left_semi")


def with_presence(apps: DataFrame, made: DataFrame, key: str = "id", name: str = "has_thumbnail") -> DataFrame:
    """P08 as a column."""
    mark = made.select(key).distinct().withColumn(name, F.lit(True))
    return apps.join(mark, key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def group_sizes(apps: DataFrame, group: str = "box") -> DataFrame:
    """P50."""
    return apps.groupBy(group).agg(F.count("*").alias("n"))


def catalogue_totals(apps: DataFrame, group: str = "box") -> DataFrame:
    return apps.agg(F.count("*").alias("n"), F.count_distinct(group).alias("n_groups"))


def gallery(apps: DataFrame, groups: DataFrame, pos: str = "pos") -> DataFrame:
    """Members numbered in catalogue order inside groups in their given order.

    ``groups`` is ``(box, slug, group_ord)``. One row per member: a group may
    be any size, so it is not collected into an array.
    """
    sizes = groups.join(group_sizes(apps), "box")
    numbered = row_numbers(apps, ["box"], [pos], "member_ord")
    return numbered.join(sizes, "box")


def page_pairing(groups: DataFrame, apps: DataFrame, pages: DataFrame) -> DataFrame:
    """What each group's page gets, or why it is skipped."""
    have = pages.select("slug").distinct().withColumn("_page", F.lit(True))
    joined = groups.join(group_sizes(apps), "box", "left").join(have, "slug", "left")
    reason = F.when(F.col("n").isNull(), F.lit("no applications")).when(F.col("_page").isNull(), F.lit("no page"))
    return joined.select("box", "slug", F.coalesce("n", F.lit(0)).alias("n"), reason.alias("skip_reason"))


def upsert_blocks(pages: DataFrame, blocks: DataFrame, start: str, end: str) -> DataFrame:
    """P07 over pages ``(slug, text)`` and blocks ``(slug, block)``; pages without a block stay."""
    joined = pages.join(blocks, "slug", "left")
    new = tx.upsert_block(F.col("text"), F.col("block"), start, end)
    return joined.withColumn("text", F.when(F.col("block").isNull(), F.col("text")).otherwise(new)).drop("block")
