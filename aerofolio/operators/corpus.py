"""Pages and posts as one document table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx, urls
from ..functions.html import plain_text
from .ordered import row_numbers

# Scratch pages, and pages replaced by a generated index.
DRAFT_SLUGS = ["test", "testing"]
REPLACED_SLUGS = ["news"]
# Fixed value: items per landed batch; a shorter batch is the last one.
BATCH = 100
# Notes on documents that have no text of their own.
NO_CONTAINER, EMPTY = "no content container found", "empty document"
# Why a page is left out.
SCRATCH, BY_INDEX = "scratch page", "replaced by index"
# Fixed value: how a file-sync client marks a copy ("name 2.md").
COPY = r" \d+(\.[^.]+)$"

ITEMS = (
    "array<struct<id:bigint,slug:string,title:struct<rendered:string>,link:string,"
    "date:string,modified:string,categories:array<bigint>>>"
)


def paged_items(batches: DataFrame, size: int = BATCH, schema: str = ITEMS) -> DataFrame:
    """Items of ``(kind, page_no, body)`` batches up to the first non-list, empty or short one.

    ``pos`` numbers a kind's items; batches longer than ``size`` leave gaps after the shorter ones, never equal numbers.
    """
    # counting needs no parse; null for what is no list
    counted = batches.withColumn("n", F.coalesce(F.json_array_length("body"), F.lit(0)))
    ends = counted.groupBy("kind").agg(
        F.min(F.when(F.col("n") < size, F.col("page_no"))).alias("end"), F.greatest(F.max("n"), F.lit(size)).alias("stride"))
    kept = counted.join(ends, "kind").where(
        (F.col("end").isNull() | (F.col("page_no") <= F.col("end"))) & (F.col("n") > 0)
    )
    items = kept.select("kind", "page_no", "stride", F.posexplode_outer(F.from_json("body", schema)).alias("at", "item"))
    return items.where(F.col("at").isNotNull()).select(
        "kind", ((F.col("page_no") - 1).cast("long") * F.col("stride") + F.col("at")).alias("pos"), "item.*"
    )


def skip_reason(kind: Column, slug: Column, include_drafts: bool = False,
                drafts: list[str] = DRAFT_SLUGS, replaced: list[str] = REPLACED_SLUGS) -> Column:
    """P10: why a page is left out; null when it is kept. Posts are never left out."""
    draft = F.lit(not include_drafts) & slug.isin(drafts)
    return F.when(
        kind == "page",
        F.when(draft, F.lit(SCRATCH)).when(slug.isin(replaced), F.lit(BY_INDEX)),
    )


def documents(pages: DataFrame, posts: DataFrame) -> DataFrame:
    """P75: both collections in one table, kind and docname (P22) added."""
    both = pages.withColumn("kind", F.lit("page")).unionByName(
        posts.withColumn("kind", F.lit("post")), allowMissingColumns=True
    )
    return both.withColumn("docname", urls.docname(F.col("kind"), F.col("slug"), F.col("date")))


def plain_title(raw: Column) -> Column:
    """HTML title to one line of text."""
    return tx.strip(tx.collapse(plain_text(raw)))


def named_ids(df: DataFrame, ids: str, names: DataFrame, out: str) -> DataFrame:
    """Every id of an array to its name, or to the id as text; the order is kept.

    ``names`` is ``(id, name)``, one row per id. Each different array is looked up once, so rows need no key, and each
    regrouped array is as long as the array it came from. A null array gives an empty one.
    """
    lists = df.select(F.col(ids).alias("_ids")).where("_ids is not null").distinct()
    single = lists.select("_ids", F.posexplode("_ids").alias("_at", "_id"))
    looked_up = single.join(names.select(F.col("id").alias("_id"), "name"), "_id", "left")
    item = F.struct("_at", F.coalesce("name", F.col("_id").cast("string")).alias("text"))
    back = looked_up.groupBy("_ids").agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return (
        df.join(back, F.col(ids) == F.col("_ids"), "left").drop("_ids")
        .withColumn(out, F.coalesce(F.transform("_items", lambda i: i["text"]), F.array().cast("array<string>")))
        .drop("_items")
    )


def last_wins(df: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """One ``value`` per key, the one with the highest position."""
    return df.groupBy(key).agg(F.max_by(value, pos).alias(value))


def with_placeholder(df: DataFrame, body: str, notice: Column) -> DataFrame:
    """Blank or missing bodies become the notice; ``note`` says which it was."""
    blank = tx.strip(F.col(body)) == ""
    return df.withColumn(
        "note",
        F.when(F.col(body).isNull(), F.lit(NO_CONTAINER)).when(blank, F.lit(EMPTY)),
    ).withColumn(body, F.when(F.col("note").isNull(), F.col(body)).otherwise(notice))


def notes(pages: DataFrame) -> DataFrame:
    """``(docname, kind, detail)``, a note for each of a page's ``embeds`` and for its ``note`` if it has one.

    All of a page's notes come out of its own row, so the page is parsed once.
    """
    embeds = F.transform(F.coalesce("embeds", F.array().cast(pages.schema["embeds"].dataType)), lambda e: F.struct(e["kind"].alias("kind"), e["href"].alias("detail")))
    own = F.array(F.when(F.col("note").isNotNull(), F.struct(F.lit("empty").alias("kind"), F.col("note").alias("detail"))))
    found = F.filter(F.concat(embeds, own), lambda n: n.isNotNull())
    return pages.select("docname", F.inline_outer(found)).where(F.col("kind").isNotNull())


def skipped(items: DataFrame, reason: Column) -> DataFrame:
    """P10: the pages left out, with why; a list of its own beside the report."""
    return items.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("slug", "reason")


def report(*notes: DataFrame) -> DataFrame:
    """The notes ``(docname, kind, detail)`` of all steps, in one table."""
    out = notes[0]
    for more in notes[1:]:
        out = out.unionByName(more)
    return out


def report_counts(notes: DataFrame) -> DataFrame:
    return notes.groupBy("docname", "kind").agg(F.count("*").alias("n"))


def numbered_copies(files: DataFrame) -> DataFrame:
    """Files of ``(folder, name)`` whose un-numbered original is in the same folder."""
    marked = files.where(F.col("name").rlike(COPY)).withColumn(
        "original", F.regexp_replace("name", COPY, "$1")
    )
    have = files.select(F.col("folder"), F.col("name").alias("original"))
    return marked.join(have, ["folder", "original"], "left_semi").select("folder", "name", "original")


def newest_first(posts: DataFrame, date: str, pos: str, name: str = "ord") -> DataFrame:
    """Posts numbered newest first; equal dates keep their source order."""
    return row_numbers(posts, [], [f"{date} desc", pos], name)


def leftovers(present: DataFrame, placed: DataFrame, slug: str = "slug") -> DataFrame:
    """Distinct slugs present and placed nowhere."""
    return present.select(slug).join(placed.select(slug), slug, "left_anti").distinct()


def alphabetical(slugs: DataFrame, slug: str = "slug", name: str = "ord") -> DataFrame:
    """Distinct slugs numbered in code-point order."""
    return row_numbers(slugs, [], [slug], name)


def place_in_sections(present: DataFrame, sections: list[tuple[str, list[str]]], reference: str,
                      pinned: set[str] = frozenset()) -> DataFrame:
    """Each page in its section, the unplaced ones at the end of ``reference``.

    ``sections`` are captions with their slugs in order; pinned entries stand
    for generated pages and need no document.
    """
    listed = [
        (i, caption, j, slug, slug in pinned)
        for i, (caption, slugs) in enumerate(sections, 1)
        for j, slug in enumerate(slugs, 1)
    ]
    wanted = present.sparkSession.createDataFrame(
        listed, "section_ord int, caption string, ord long, slug string, pinned boolean"
    )
    have = present.select("slug").distinct()
    placed = wanted.where(~F.col("pinned")).join(have, "slug", "left_semi").unionByName(wanted.where("pinned"))
    at = [caption for caption, _ in sections].index(reference)
    moved = alphabetical(leftovers(have, wanted), "slug", "_nth").select(
        F.lit(at + 1).alias("section_ord"),
        F.lit(reference).alias("caption"),
        (F.col("_nth") + len(sections[at][1])).alias("ord"),
        "slug",
    )
    return placed.select("section_ord", "caption", "ord", "slug").unionByName(moved)
