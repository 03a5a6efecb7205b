"""Population exposure and health burden."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.numbers import exact, exact_sum, inexact, total
from ..ordered import ranks


def exposed_share(cities: DataFrame, targets: DataFrame) -> DataFrame:
    """Share of the population above each standard, per pollutant."""
    over = F.when(F.col("level") > F.col("limit"), F.col("population")).otherwise(F.lit(0.0))
    return (
        cities.join(targets, "pollutant")
        .groupBy("pollutant", "standard")
        .agg((exact_sum(over) / exact_sum(F.col("population"))).alias("exposed_share"))
    )


def weighted_levels(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Population-weighted concentration."""
    return rows.groupBy(*keys).agg(
        (exact_sum(F.col("population") * F.col("level")) / exact_sum(F.col("population"))).alias("weighted_level")
    )


def city_ranking(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """A52 over A37: cities ranked by level within ``keys``, ties sharing a place."""
    return ranks(weighted, keys, "weighted_level", descending=True, rank="place")


def attributable(level: Column, population: Column, beta: Column, threshold: Column) -> Column:
    """Cases by the log-linear form; ``beta`` and ``threshold`` are inputs."""
    return population * (F.lit(1.0) - F.exp(-beta * F.greatest(level - threshold, F.lit(0.0))))


def _cases(rows: DataFrame, scenarios: DataFrame) -> DataFrame:
    joined = rows.join(scenarios, "pollutant")
    return joined.withColumn(
        "cases", attributable(F.col("level"), F.col("population"), F.col("beta"), F.col("threshold"))
    ).withColumn("years_lost", F.col("cases") * F.col("years_per_case"))


def burden(rows: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Cases and years of life lost by scenario, rolled up region to country to all.

    The finest level is summed first; the rollup expands those few rows only.
    """
    fine = _cases(rows, scenarios).groupBy("scenario", "country", "region").agg(
        *[F.sum(part(F.col(c))).alias(f"_{n}_{c}") for c in ("cases", "years_lost") for n, part in (("in", exact), ("out", inexact))],
    )
    return (
        fine.rollup("scenario", "country", "region")
        .agg(
            F.grouping_id().cast("int").alias("level_id"),
            *[total(F.sum(f"_in_{c}"), F.sum(f"_out_{c}")).alias(c) for c in ("cases", "years_lost")],
        )
    )


def city_burden(rows: DataFrame, scenarios: DataFrame) -> DataFrame:
    """A38 by city."""
    return _cases(rows, scenarios).groupBy("scenario", "city").agg(
        exact_sum(F.col("cases")).alias("cases"), exact_sum(F.col("years_lost")).alias("years_lost")
    )
