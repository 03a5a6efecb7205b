"""Statistics by station, city and country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.numbers import exact, exact_mean, inexact, total
from ..ordered import quantiles, ranks

FIVE = {"minimum": 0.0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75, "maximum": 1.0}


def counts(rows: DataFrame, keys: list[str], **distinct: str) -> DataFrame:
    """Distinct values per key, e.g. ``n_stations="sampling_point"``."""
    return rows.groupBy(*keys).agg(*[F.count_distinct(c).alias(n) for n, c in distinct.items()])


def period(ts: Column, unit: str) -> Column:
    """Start of the day, week (Monday), month or year."""
    return F.date_trunc(unit, ts)


def station_means(obs: DataFrame, unit: str, value: str = "conc", name: str = "level") -> DataFrame:
    """Mean per station, pollutant and period."""
    return (
        obs.withColumn("period", period(F.col("ts"), unit))
        .groupBy("sampling_point", "pollutant", "period")
        .agg(exact_mean(F.col(value)).alias(name), F.count(value).alias("n_values"))
    )


def station_means_of(obs: DataFrame, units: list[str], value: str = "conc", name: str = "level") -> DataFrame:
    """A25 for several units at once, with the unit in ``unit``.

    The observations are read and added up by day once; days are what is added up to longer units.
    """
    days = obs.groupBy("sampling_point", "pollutant", period(F.col("ts"), "day").alias("_day")).agg(
        F.sum(exact(F.col(value))).alias("_in"), F.sum(inexact(F.col(value))).alias("_out"), F.count(value).alias("_n"))
    spans = F.array(*[F.struct(F.lit(u).alias("unit"), period(F.col("_day"), u).alias("period")) for u in units])
    return (
        days.select("*", F.explode(spans).alias("_span")).groupBy("sampling_point", "pollutant", F.col("_span.unit").alias("unit"), F.col("_span.period").alias("period"))
        .agg((total(F.sum("_in"), F.sum("_out")) / F.sum("_n")).alias(name), F.sum("_n").alias("n_values"))
    )


def annual_levels(obs: DataFrame, value: str = "conc") -> DataFrame:
    """A22."""
    return (
        obs.groupBy("sampling_point", "pollutant", F.year("ts").alias("yr"))
        .agg(exact_mean(F.col(value)).alias("level"), F.count(value).alias("n_values"))
    )


def area_means(levels: DataFrame, stations: DataFrame, area: list[str], when: str = "yr",
               pollutants: list[str] | None = None, station_types: list[str] | None = None) -> DataFrame:
    """Mean over the stations of an area of each station's own mean.

    Stations join the already aggregated levels, never the observations.
    """
    if pollutants:
        levels = levels.where(F.col("pollutant").isin(pollutants))
    if station_types:
        stations = stations.where(F.col("station_type").isin(station_types))
    placed = levels.join(stations.select("sampling_point", *area), "sampling_point")
    return placed.groupBy(*area, "pollutant", when).agg(
        exact_mean(F.col("level")).alias("level"), F.count("*").alias("n_stations")
    )


def box_plot(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Minimum, quartiles and maximum, exact, by linear interpolation; a key without values has nulls."""
    return quantiles(rows, keys, value, FIVE)


def distribution(rows: DataFrame, keys: list[str], value: str, width: float) -> DataFrame:
    """Counts per bin of the given width."""
    return rows.groupBy(*keys, F.floor(F.col(value) / F.lit(width)).alias("bin")).agg(F.count("*").alias("n"))


def trend(levels: DataFrame, keys: list[str], value: str = "level", when: str = "yr") -> DataFrame:
    """Least-squares slope over the years."""
    return levels.groupBy(*keys).agg(
        F.regr_slope(F.col(value), F.col(when).cast("double")).alias("slope"), F.count("*").alias("n_years")
    )


def correlation(levels: DataFrame, by: str, first, second, point: list[str], keys: list[str],
                value: str = "level") -> DataFrame:
    """Pearson correlation over points of two pollutants (``by="pollutant"``) or two years (``by="yr"``)."""
    sides = (
        levels.where(F.col(by).isin(first, second))
        .groupBy(*point, *keys)
        .agg(
            F.max(F.when(F.col(by) == first, F.col(value))).alias("_x"),
            F.max(F.when(F.col(by) == second, F.col(value))).alias("_y"),
        )
        .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    )
    return sides.groupBy(*keys).agg(F.corr("_x", "_y").alias("correlation"), F.count("*").alias("n_points"))


def distance_to_target(levels: DataFrame, targets: DataFrame, value: str = "level") -> DataFrame:
    """Level minus limit and level over limit, for every standard of the pollutant.

    ``targets`` is ``(pollutant, standard, limit)``: a few rows per pollutant.
    """
    joined = levels.join(targets, "pollutant")
    return joined.withColumn("distance", F.col(value) - F.col("limit")).withColumn(
        "ratio", F.col(value) / F.col("limit")
    )


def ranked(levels: DataFrame, keys: list[str], value: str = "level") -> DataFrame:
    """Stations ranked by level within pollutant and period, ties sharing a place."""
    return ranks(levels, keys, value, descending=True, rank=None, dense="place")


def most_polluted(levels: DataFrame, k: int, value: str = "level", tie: list[str] | None = None) -> DataFrame:
    """The k highest levels; a heap per task, no full sort."""
    return levels.orderBy(F.desc(value), *(tie or ["sampling_point"])).limit(k)
