"""Mixing sources to target weights: whole copies, then one hash-seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settle

# Fixed value: words are runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes(source, source_size)``, one row per source.

    Sources in order of their bytes (null last) get the weights in turn and share ``share`` times all sizes by weight. A
    target stops at ``most`` times its source's size; the excess goes to the others by weight until none is above. With
    ``share`` above ``most`` all stop. A source without words gets 0.

    Sources stop in order of size per weight, so it takes one pass over the sources in that order: the rest
    is shared at level (what is left) / (weights left), and a source whose limit is below its level stops.
    There is one row per source here, however many documents it has.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "source", "source_size", "weight", "limit", F.sum("source_size").over(whole).alias("all"),
        F.coalesce(F.sum("limit").over(before), F.lit(0.0)).alias("stopped"), F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("past"), F.sum("weight").over(whole).alias("weights"))
    level = (F.col("all") * F.lit(float(share)) - F.col("stopped")) / (F.col("weights") - F.col("past"))
    rows = rows.withColumn("level", F.when(F.col("limit") > F.col("weight") * level, level))
    # the first source that doesn't stop gives the level of all that don't
    common = F.min(F.struct(F.col("level").isNull(), "past", "level")).over(whole)["level"]
    return rows.select("source", "source_size", F.when(common.isNull(), F.col("limit")).otherwise(F.least("limit", F.col("weight") * common)).alias("target"))


def draw(ident: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed alone; a null id draws as the empty text."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rated(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` with ``size, source_size, target, copies``.

    ``copies`` is the whole part of ``target / source_size`` plus one if the row's draw is below the fraction. Null text: size 0;
    null source: a source of its own. Rows with equal ids draw alike. Columns of ``docs`` named as a result are replaced.
    """
    results = ["size", "source_size", "target", "copies"]
    sized = docs.drop(*results).withColumn("size", n_words(F.col(text_col)))
    sizes = docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size"))
    found = settle(targets(sizes, **options)).select(F.col("source").alias("_mix_source"), "source_size", "target")
    # one row per source; AQE broadcasts it while it is small and splits a hot source beyond
    joined = sized.join(found, F.col(source_col).eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (draw(F.col(id_col), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn("copies", F.floor(rate) + extra)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """Each row of ``docs`` as often as its copies say, with ``copy`` (from 0) beside the columns of ``docs``; only a column ``copy`` is replaced."""
    whole = docs.select(F.struct("*").alias("_doc"))
    out = rated(whole, id_col=f"_doc.`{id_col}`", text_col=f"_doc.`{text_col}`", source_col=f"_doc.`{source_col}`", **options).where("copies > 0")
    return out.select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.drop("copy").columns], F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
