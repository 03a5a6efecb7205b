"""Registry of queries and small helpers for the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.files import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def dsum(x: str) -> str:
    """The library's exact sum. By way of text, as both engines round to a decimal and back correctly from there."""
    return f"CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(28,12))) AS VARCHAR) AS DOUBLE)"


def mean(x: str) -> str:
    return f"{dsum(x)} / COUNT({x})"


def values(spark: SparkSession, columns: str, rows: str) -> DataFrame:
    """A literal parameter table (limits, bands, section lists)."""
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


# ---------------------------------------------------------------- stand-ins for air-quality tables


def observations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("user_id").alias("sampling_point"),
        F.col("event_type").alias("pollutant"),
        "ts",
        F.col("value").alias("conc"),
        F.get_json_object("props", "$.k").cast("int").alias("flag"),
        "event_id",
    )


OBS = """obs AS (SELECT user_id AS sampling_point, event_type AS pollutant, ts, value AS conc,
  CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS flag, event_id FROM events)"""


def long_observations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("sampling_point"),
        F.col("o_orderpriority").alias("pollutant"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("conc"),
    )


LONG = """lng AS (SELECT o_custkey AS sampling_point, o_orderpriority AS pollutant, o_orderdate AS ts,
  o_totalprice AS conc FROM orders)"""


def stations(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").join(
        table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    return (
        table(spark, d, "customer")
        .withColumnRenamed("c_nationkey", "n_nationkey")
        .join(nation, "n_nationkey")
        .select(
            F.col("c_custkey").alias("sampling_point"),
            F.col("c_mktsegment").alias("station_type"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            F.concat("n_name", F.lit("/"), "c_mktsegment").alias("city"),
            (F.abs("c_acctbal") + 1).alias("population"),
        )
    )


STATIONS = """stations AS (SELECT c_custkey AS sampling_point, c_mktsegment AS station_type, n_name AS country,
  r_name AS region, n_name || '/' || c_mktsegment AS city, abs(c_acctbal) + 1 AS population
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

ANNUAL = f"""annual AS (SELECT sampling_point, pollutant, CAST(year(ts) AS INT) AS yr, {mean('conc')} AS level,
  COUNT(conc) AS n_values FROM lng GROUP BY ALL)"""


def submissions(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "orders")
        .withColumnRenamed("o_custkey", "sampling_point")
        .join(stations(spark, d).select("sampling_point", "country"), "sampling_point")
        .select(
            "country",
            "sampling_point",
            F.col("o_orderpriority").alias("flow"),
            F.col("o_orderdate").alias("submitted"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderkey").alias("submission_id"),
        )
    )


SUBMISSIONS = """submissions AS (SELECT n_name AS country, o_custkey AS sampling_point, o_orderpriority AS flow,
  o_orderdate AS submitted, o_orderstatus AS status, o_orderkey AS submission_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

LIMIT_ROWS = """('1-URGENT', 'strict', 200000.0D), ('1-URGENT', 'loose', 260000.0D), ('2-HIGH', 'strict', 180000.0D),
  ('3-MEDIUM', 'strict', 250000.0D), ('4-NOT SPECIFIED', 'loose', 300000.0D), ('5-LOW', 'strict', 220000.0D)"""


def limits(spark: SparkSession, standard: str | None = None) -> DataFrame:
    rows = values(spark, "pollutant, standard, limit", LIMIT_ROWS)
    return rows.where(F.col("standard") == standard) if standard else rows


LIMITS = f"""limits(pollutant, standard, lim) AS (VALUES {LIMIT_ROWS.replace('D)', ')')})"""
