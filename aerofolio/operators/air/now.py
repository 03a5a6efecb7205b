"""Near real-time: latest values, index bands, combined index."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..ordered import fill_forward, latest


def latest_values(obs: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """The latest row per key; equal times fall back on ``tie``."""
    return latest(obs, keys, ["ts", tie])


def _checked(bands: DataFrame) -> DataFrame:
    """Bands ``(pollutant, lo, hi, band)``, ``lo`` included and ``hi`` not; a null ``lo`` or ``hi`` leaves that end open.

    A null pollutant matches nothing. Bands of one pollutant must not overlap: the job fails if they do.
    """
    lo = F.coalesce(F.col("lo").cast("double"), F.lit(float("-inf")))
    hi = F.coalesce(F.col("hi").cast("double"), F.lit(float("inf")))
    known = bands.where(F.col("pollutant").isNotNull()).select("pollutant", lo.alias("lo"), hi.alias("hi"), "band").where("lo < hi")
    after = F.lead("lo").over(W.partitionBy("pollutant").orderBy("lo"))
    fault = F.raise_error(F.concat(F.lit("bands overlap: "), F.col("pollutant")))
    return known.withColumn("hi", F.when(after < F.col("hi"), fault.cast("double")).otherwise(F.col("hi")))


def banded(obs: DataFrame, bands: DataFrame, value: str = "conc") -> DataFrame:
    """The band of each value; null outside all bands, and for null and NaN.

    A join on the pollutant with the bounds as a further condition; Catalyst broadcasts the list if its size allows.
    """
    b = _checked(bands).withColumnRenamed("pollutant", "_pollutant")
    at = F.col(value).cast("double")
    inside = (F.col("pollutant") == F.col("_pollutant")) & (at >= F.col("lo")) & ((at < F.col("hi")) | ((at == F.col("hi")) & (F.col("hi") == F.lit(float("inf")))))
    return obs.join(b, inside, "left").drop("_pollutant", "lo", "hi")


def banded_by_order(obs: DataFrame, bands: DataFrame, value: str = "conc") -> DataFrame:
    """A14 for callers with very many bands per pollutant: the same rows as ``banded``, by merging values and bands in order."""
    bands = _checked(bands)
    at = F.col(value).cast("double")
    marks = bands.select(
        "pollutant", F.col("lo").alias("_at"), F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_id"),
        F.struct("band", "hi").alias("_band"), F.lit(None).cast(obs.select(F.struct("*")).schema[0].dataType).alias("_row"),
    )
    rows = obs.select(
        "pollutant", at.alias("_at"), F.lit(1).alias("_side"),
        F.xxhash64(*obs.columns).alias("_id"), F.lit(None).cast(marks.schema["_band"].dataType).alias("_band"),
        F.struct("*").alias("_row"),
    )
    order = ["_at", "_side", "_id"]
    filled = fill_forward(marks.unionByName(rows), ["pollutant"], order, "_band", "_found")
    reached = (F.col("_at") < F.col("_found.hi")) | ((F.col("_at") == F.col("_found.hi")) & (F.col("_at") == F.lit(float("inf"))))
    return filled.where(F.col("_side") == 1).select(
        "_row.*", F.when(F.col("pollutant").isNotNull() & F.col("_at").isNotNull() & ~F.isnan("_at") & reached, F.col("_found.band")).alias("band")
    )


def worst_band(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The combined index is the worst band among the pollutants."""
    return rows.groupBy(*keys).agg(F.max("band").alias("index_band"), F.count("band").alias("n_pollutants"))
