"""Internal links: the map from site paths to documents, and the rewriting of every href."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx, urls

NEWS_KEY = "/news"
NEWS_INDEX = "news/index"
LAST = 2**63 - 1


def link_map(docs: DataFrame, front_slug: str | None = None) -> DataFrame:
    """``(path_key, target)`` of documents ``(url, docname, pos[, slug])``.

    On a duplicate path the last document wins (P61). The document with
    ``front_slug`` also answers for ``/``, whatever else claims it.
    """
    rows = docs.select(urls.path_key(F.col("url")).alias("path_key"), "docname", "pos")
    if front_slug is not None:
        front = (
            docs.where(F.col("slug") == front_slug)
            .agg(F.min_by("docname", "pos").alias("docname"))
            .where(F.col("docname").isNotNull())
            .select(F.lit("/").alias("path_key"), "docname", F.lit(LAST).alias("pos"))
        )
        rows = rows.unionByName(front)
    return rows.groupBy("path_key").agg(F.max_by("docname", "pos").alias("target"))


def resolve(
    links: DataFrame,
    targets: DataFrame,
    site: Column | str,
    internal_hosts: list[str] | Column,
    source: str = "docname",
    news_key: str = NEWS_KEY,
    news_index: str = NEWS_INDEX,
) -> DataFrame:
    """Adds ``resolved`` and ``outcome`` to links ``(href, <source>)``.

    The map has one row per path, so a path that many links share (the front
    page, say) cannot multiply rows; Catalyst and AQE pick broadcast or a
    skew-split sort-merge join by its measured size.
    """
    site = F.lit(site) if isinstance(site, str) else site
    href = F.col("_href")
    rows = links.withColumn("_href", tx.strip(F.col("href")))
    inside = urls.eligible(href) & urls.internal(href, internal_hosts)
    # a link that cannot hit gets a key no path can have, spread by link and page: null keys would all
    # meet in one task
    elsewhere = F.concat(F.lit("#"), F.xxhash64(href, F.col(source)).cast("string"))
    rows = rows.withColumn("_key", F.when(inside, urls.path_key(href)).otherwise(elsewhere))
    hit = rows.join(targets.withColumnRenamed("path_key", "_key"), "_key", "left")
    anchor = urls.fragment(href)
    hash_part = F.when(anchor != "", F.concat(F.lit("#"), anchor)).otherwise(F.lit(""))
    bare = urls.host(href) == ""
    outcome = (
        F.when(~urls.eligible(href), F.lit("not_eligible"))
        .when(F.col("_key").startswith("#"), F.lit("external"))
        .when(F.col("_key") == news_key, F.lit("news_index"))
        .when(F.col("target").isNotNull(), F.lit("document"))
        .when(bare & href.startswith("/"), F.lit("site_absolute"))
        .when(bare, F.lit("joined"))
        .otherwise(F.lit("kept"))
    )
    resolved = (
        F.when(F.col("outcome") == "news_index",
               F.concat(urls.relative(F.col(source), F.lit(news_index)), hash_part))
        .when(F.col("outcome") == "document",
              F.concat(urls.relative(F.col(source), F.col("target")), hash_part))
        .when(F.col("outcome") == "site_absolute", F.concat(site, href))
        .when(F.col("outcome") == "joined", urls.absolutise(site, href))
        .otherwise(F.col("href"))
    )
    return (
        hit.withColumn("outcome", outcome)
        .withColumn("resolved", resolved)
        .drop("_href", "_key", "target")
    )


def outcome_counts(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("outcome").agg(F.count("*").alias("n_links"))
