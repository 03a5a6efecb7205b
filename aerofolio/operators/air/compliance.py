"""Attainment, assessment and follow-up of exceedances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def regimes_with_levels(zones: DataFrame, parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """A10: assessment regimes with the levels of each flow beside them.

    Each part has one row per key and a ``level``; the result is as long as ``zones``.
    """
    return reduce(
        lambda left, part: left.join(part[1].select(*keys, F.col("level").alias(part[0])), keys, "left"),
        parts.items(),
        zones,
    )


def exceedance_zones(attainment: DataFrame, limit: Column, keys: list[str]) -> DataFrame:
    """Zones above the limit, once each, with their highest level."""
    over = attainment.where(F.col("level") > limit)
    return over.groupBy(*keys).agg(F.max("level").alias("level"), F.count("*").alias("n_exceedances"))


def with_follow_up(exceedances: DataFrame, follow_up: DataFrame, keys: list[str]) -> DataFrame:
    """Each exceedance zone with its plans (flow H) or measures (flow K); zones without any stay.

    There is one exceedance row per key, so a zone with many plans adds one
    row per plan and no more. The outer join is written as inner plus anti:
    an inner join may broadcast the exceedances or split a busy zone's plans,
    which an outer join may not.
    """
    found = exceedances.join(follow_up, keys)
    bare = without_follow_up(exceedances, follow_up.select(*keys).distinct(), keys)
    return found.unionByName(bare, allowMissingColumns=True)


def without_follow_up(exceedances: DataFrame, follow_up: DataFrame, keys: list[str]) -> DataFrame:
    """Exceedance zones nothing was reported for."""
    return exceedances.join(follow_up.select(*keys), keys, "left_anti")


def assessment_difference(assessed: DataFrame, reported: DataFrame, keys: list[str]) -> DataFrame:
    """Assessed minus reported value at the same key."""
    return assessed.join(reported, keys).withColumn("difference", F.col("assessed") - F.col("reported"))


def attainment_filter(rows: DataFrame, least_difference: float | None = None, sources: list[str] | None = None,
                      types: list[str] | None = None) -> DataFrame:
    """By difference of assessed and reported value, source of adjustment and type of exceedance."""
    if least_difference is not None:
        rows = rows.where(F.abs("difference") >= least_difference)
    if sources:
        rows = rows.where(F.col("adjustment_source").isin(sources))
    if types:
        rows = rows.where(F.col("exceedance_type").isin(types))
    return rows


def attainment_summary(levels: DataFrame, targets: DataFrame) -> DataFrame:
    """Zones in exceedance and highest concentration by year and pollutant."""
    joined = levels.join(targets, "pollutant")
    return joined.groupBy("pollutant", "yr").agg(
        F.count_distinct(F.when(F.col("level") > F.col("limit"), F.col("zone"))).alias("n_zones_over"),
        F.max("level").alias("max_level"),
    )


def attainment_detail(levels: DataFrame, targets: DataFrame) -> DataFrame:
    """Each zone's concentration and exceedance flag, with the number of zones reported beside it."""
    totals = levels.groupBy("pollutant", "yr").agg(F.count_distinct("zone").alias("n_zones"))
    flagged = levels.join(targets, "pollutant").withColumn("exceeds", F.col("level") > F.col("limit"))
    return flagged.join(totals, ["pollutant", "yr"])


def coverage(obs: DataFrame, keys: list[str], valid: Column, expected: int | Column) -> DataFrame:
    """Valid observations over expected ones."""
    wanted = F.lit(expected) if isinstance(expected, int) else expected
    return obs.groupBy(*keys).agg(F.count_if(valid).alias("n_valid")).withColumn(
        "coverage", F.col("n_valid") / wanted
    )
