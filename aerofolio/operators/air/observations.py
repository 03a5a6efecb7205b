"""Selecting, checking and combining observation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...sources import versions
from ..ordered import latest


def lay_out(rows: DataFrame, stations: DataFrame, path: str, files: int = 4) -> None:
    """Observations as a versioned table in folders by country and year, sorted by station, pollutant and time within files.

    A country's year is dealt to at most ``files`` tasks by station, so a large one is no single task's. Rows of unknown
    stations go to the folder of no country, rows without a time to that of no year.
    """
    placed = rows.join(stations.select("sampling_point", "country"), "sampling_point", "left").withColumn("yr", F.year("ts"))
    dealt = placed.repartition("country", "yr", F.pmod(F.xxhash64("sampling_point"), F.lit(files)))
    versions.replace(dealt.sortWithinPartitions("country", "yr", "sampling_point", "pollutant", "ts"), path, ("country", "yr"))


def download(
    flows: dict[str, DataFrame],
    stations: DataFrame | None = None,
    countries: list[str] | None = None,
    points: list[int] | None = None,
    pollutants: list[str] | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """Observations of several flows, filtered by country, station, pollutant and period.

    Filters are written on each flow, so they reach its scan; the country filter, or the choice that ``stations`` are, is a semi join. Of a
    flow that ``lay_out`` has written only the folders of the period's years are read, and of the chosen stations' countries, which Spark
    learns as it runs.
    """
    local = stations.where(F.col("country").isin(countries)) if countries else stations
    out = None
    for flow, rows in flows.items():
        part = rows
        if pollutants:
            part = part.where(F.col("pollutant").isin(pollutants))
        if points:
            part = part.where(F.col("sampling_point").isin(points))
        if start is not None:
            part = part.where(F.col("ts") >= F.lit(start))
        if end is not None:
            part = part.where(F.col("ts") < F.lit(end))
        if {"country", "yr"} <= set(rows.columns):
            part = part.where(F.col("yr") >= F.year(F.lit(start))) if start is not None else part
            part = part.where(F.col("yr") <= F.year(F.lit(end))) if end is not None else part
        if local is not None:
            on = [c for c in ("country", "sampling_point") if c in rows.columns]
            part = part.join(local.select(*on), on, "left_semi")
        part = part.withColumn("flow", F.lit(flow))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def accepted(obs: DataFrame, validity: list, verification: list | None = None) -> DataFrame:
    """Observations whose codes are in the accepted sets."""
    out = obs.where(F.col("validity").isin(validity))
    return out.where(F.col("verification").isin(verification)) if verification else out


def not_in_vocabulary(rows: DataFrame, column: str, vocabulary: DataFrame, list_name: str) -> DataFrame:
    """Values missing from a code list, with how often they occur. Values are counted first."""
    codes = vocabulary.where(F.col("list") == list_name).select(F.col("code").alias(column))
    return rows.groupBy(column).agg(F.count("*").alias("n_rows")).join(codes, column, "left_anti")


def country_code(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """ISO code for the country name; unknown names get null."""
    return rows.join(codes.select("country", "iso"), "country", "left")


def adjustment_source(kind: Column, source: Column, adjustment: str = "adjustment") -> Column:
    """The source of adjustment, only where the type says there is one."""
    return F.when(kind == adjustment, source)


def combined(parts: dict[str, DataFrame], column: str = "source") -> DataFrame:
    """Tables of one shape, e.g. historic and current, with where each row is from."""
    out = None
    for name, rows in parts.items():
        part = rows.withColumn(column, F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def preferred(validated: DataFrame, provisional: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """One row per key; a validated row wins over a provisional one."""
    both = validated.withColumn("flow", F.lit("validated")).unionByName(
        provisional.withColumn("flow", F.lit("provisional"))
    )
    return latest(both, keys, ["flow", tie])
