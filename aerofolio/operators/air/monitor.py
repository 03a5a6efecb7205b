"""Monitoring of submissions, aggregations and continuity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ...functions.numbers import exact, inexact, total
from ..ordered import latest, ranks


def verify(computed: DataFrame, reported: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """Recomputed against reported values, with what is on one side only."""
    both = computed.join(reported, keys, "full_outer")
    gap = F.abs(F.col("computed") - F.col("reported"))
    status = (
        F.when(F.col("computed").isNull(), F.lit("only_reported"))
        .when(F.col("reported").isNull(), F.lit("only_computed"))
        .when(gap <= F.lit(tolerance), F.lit("match"))
        .otherwise(F.lit("differs"))
    )
    return both.withColumn("status", status)


def explorer(rows: DataFrame, dims: list[str], value: str) -> DataFrame:
    """Count and mean over every choice of dimensions.

    Counts and sums are taken at the finest grain first, so the cube expands
    one row per combination instead of every input row.
    """
    fine = rows.groupBy(*dims).agg(
        F.count("*").alias("_rows"), F.count(value).alias("_n"), F.sum(exact(F.col(value))).alias("_sum"), F.sum(inexact(F.col(value))).alias("_rest")
    )
    return fine.cube(*dims).agg(
        F.grouping_id().cast("int").alias("level_id"),
        F.sum("_rows").alias("n"),
        (total(F.sum("_sum"), F.sum("_rest")) / F.sum("_n")).alias("mean"),
    )


def submission_overview(rows: DataFrame, levels: list[str]) -> DataFrame:
    """Submissions overall, by country and by station; counted before the rollup."""
    fine = rows.groupBy(*levels).agg(F.count("*").alias("_n"), F.max("submitted").alias("_last"))
    return fine.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level_id"),
        F.sum("_n").alias("n_submissions"),
        F.max("_last").alias("last_submitted"),
    )


def status_overview(submissions: DataFrame, flows: list[str], tie: str) -> DataFrame:
    """The latest status of each flow, one row per country."""
    last = latest(submissions, ["country", "flow"], ["submitted", tie])
    return last.groupBy("country").pivot("flow", flows).agg(F.max("status"))


def time_lag(rows: DataFrame, keys: list[str], probs: dict[str, float]) -> DataFrame:
    """Days from measurement to availability; negative lags are counted apart.

    Lags are whole days, so a histogram carries the quantiles exactly. A key without a known lag has nulls and ``n`` 0.
    """
    lag = F.datediff("available", "measured")
    histogram = rows.groupBy(*keys, lag.alias("lag")).agg(F.count("*").alias("_n"))
    known = F.when(F.col("lag").isNotNull(), F.col("_n"))
    return histogram.groupBy(*keys).agg(
        F.coalesce(F.sum(known), F.lit(0)).alias("n"),
        F.sum(F.when(F.col("lag") < 0, F.col("_n")).otherwise(F.lit(0))).alias("n_negative"),
        (F.sum(F.col("lag").cast("long") * F.col("_n")).cast("double") / F.sum(known)).alias("mean_lag"),
        *[F.percentile("lag", F.lit(p), F.col("_n")).alias(name) for name, p in probs.items()],
    )


def calendar(rows: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """Deliveries by flow and month, months without one included, with 0.

    The reporting period is given by days in its first and last month; without them it is, for each flow, from its first delivery to its
    last. Deliveries are counted first; a flow's months are then as many as the period has. Rows without a date are in no month.
    """
    month = F.date_trunc("month", "submitted")
    counted = rows.where(F.col("submitted").isNotNull()).groupBy("flow", month.alias("month")).agg(F.count("*").alias("n"))
    flows = counted.groupBy("flow").agg(
        F.map_from_entries(F.collect_list(F.struct("month", "n"))).alias("_n"),
        (F.min("month") if first is None else F.date_trunc("month", first)).alias("_first"),
        (F.max("month") if last is None else F.date_trunc("month", last)).alias("_last"))
    months = flows.where("_first <= _last").select("flow", "_n", F.explode(F.sequence("_first", "_last", F.expr("interval 1 month"))).alias("month"))
    return months.select("flow", "month", F.coalesce(F.col("_n")[F.col("month")], F.lit(0).cast("long")).alias("n"))


def submission_ranks(rows: DataFrame) -> DataFrame:
    """Submissions ranked by date within country and flow; a country may hold most of them."""
    return ranks(rows, ["country", "flow"], "submitted", rank="rank")


def unbroken_runs(years: DataFrame, keys: list[str], year: str = "yr") -> DataFrame:
    """Runs of consecutive years per series, with the years missing before each run.

    After the distinct a series has at most one row per year.
    """
    series = W.partitionBy(*keys).orderBy(year)
    islands = years.select(*keys, year).distinct().withColumn("_island", F.col(year) - F.row_number().over(series))
    runs = islands.groupBy(*keys, "_island").agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.count("*").alias("n_years")
    )
    before = F.lag("last_year").over(W.partitionBy(*keys).orderBy("first_year"))
    return runs.withColumn(
        "missing_before", F.coalesce(F.col("first_year") - before - 1, F.lit(0))
    ).drop("_island")


def missing_years(years: DataFrame, keys: list[str], first: int, last: int, year: str = "yr") -> DataFrame:
    """Reporting years of the period a series has no data for.

    Observations are aggregated to one row per series, with the years it has; these are at most the period's.
    """
    there = F.collect_set(F.when(F.col(year).between(first, last), F.col(year)))
    wanted = F.sequence(F.lit(first), F.lit(last))
    series = years.groupBy(*keys).agg(there.alias("_there"))
    return series.select(*keys, F.explode(F.array_except(wanted, "_there")).alias(year))


def year_on_year(levels: DataFrame, keys: list[str], value: str = "level", year: str = "yr") -> DataFrame:
    """Change against the series' previous reported year; one row per series and year comes in."""
    before = F.lag(value).over(W.partitionBy(*keys).orderBy(year))
    return levels.withColumn("change", F.col(value) - before)
