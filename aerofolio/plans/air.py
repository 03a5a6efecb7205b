"""Air-quality queries over stand-in tables. Limits, bands and scenarios here are made-up parameters,
not official values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numbers import exact_mean, exact_sum
from ..operators.air import compliance as cp, exposure as ex, monitor as mo, now as nw, observations as ob, stats as st
from ..session import fresh_path
from ..sources import versions
from ..sources.files import ask, register_flows, table
from .base import (
    ANNUAL, LIMITS, LONG, OBS, STATIONS, SUBMISSIONS, dsum, limits, long_observations, mean, observations, query,
    stations, submissions, values,
)


def annual(spark, d):
    return st.annual_levels(long_observations(spark, d))


# ---------------------------------------------------------------- observations


@query("a01_download_selection", f"""WITH {OBS}, {LONG}, {STATIONS}, both_sets AS (
    SELECT sampling_point, pollutant, ts, conc, 'E2a' AS flow FROM obs UNION ALL SELECT sampling_point, pollutant, ts, conc, 'E1a' FROM lng)
  SELECT b.* FROM both_sets b WHERE pollutant IN ('click', 'view', '2-HIGH') AND ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '2024-01-20'
  AND sampling_point IN (SELECT sampling_point FROM stations WHERE country IN (SELECT n_name FROM nation WHERE n_regionkey IN (1, 3)))""")
def a01(spark, d):
    cols = ["sampling_point", "pollutant", "ts", "conc"]
    places = stations(spark, d)
    wanted = table(spark, d, "nation").where(F.col("n_regionkey").isin(1, 3)).select(F.col("n_name").alias("country"))
    local = places.join(wanted, "country", "left_semi").withColumn("country", F.lit("chosen"))
    return ob.download(
        {"E2a": observations(spark, d).select(*cols), "E1a": long_observations(spark, d)}, local, ["chosen"],
        pollutants=["click", "view", "2-HIGH"], start=F.lit("1996-01-01").cast("timestamp_ntz"),
        end=F.lit("2024-01-20").cast("timestamp_ntz"),
    ).select(*cols, "flow")


@query("a01_download_pruned", f"""WITH {LONG}, {STATIONS} SELECT sampling_point, pollutant, ts, conc, country, CAST(year(ts) AS INT) AS yr FROM lng JOIN stations USING (sampling_point)
  WHERE region = 'ASIA' AND population > 3000 AND pollutant IN ('2-HIGH', '5-LOW') AND ts >= TIMESTAMP '1996-03-01' AND ts < TIMESTAMP '1998-02-01'""")
def a01_pruned(spark, d):
    """The long flow laid out by country and year, then the stations of one region that have people around."""
    path = fresh_path(spark, "laid-out")
    ob.lay_out(long_observations(spark, d), stations(spark, d), path)
    chosen = stations(spark, d).where("region = 'ASIA' and population > 3000")
    found = ob.download({"E1a": versions.read(spark, path)}, chosen, pollutants=["2-HIGH", "5-LOW"],
                        start=F.lit("1996-03-01").cast("timestamp_ntz"), end=F.lit("1998-02-01").cast("timestamp_ntz"))
    return found.select("sampling_point", "pollutant", "ts", "conc", "country", "yr")


def zone_levels(spark, d):
    """Level per zone, pollutant and year; the zone is the station's country."""
    return st.area_means(annual(spark, d), stations(spark, d), ["country"]).select(
        F.col("country").alias("zone"), "pollutant", "yr", "level"
    )


ZONES = f"""zl AS (SELECT country AS zone, pollutant, yr, {mean('level')} AS level FROM annual JOIN stations USING (sampling_point) GROUP BY ALL)"""


@query("a02_flow_views", f"""SELECT 'b' AS flow, false AS is_preliminary, COUNT(*) AS n FROM nation UNION ALL SELECT 'b', true, COUNT(*) FROM region
  UNION ALL SELECT 'd', false, COUNT(*) FROM customer UNION ALL SELECT 'e1a', false, COUNT(*) FROM orders""")
def a02(spark, d):
    zones = table(spark, d, "nation").select(F.col("n_name").alias("zone"))
    register_flows(
        {"B": zones, "D": stations(spark, d), "E1a": long_observations(spark, d)},
        {"B": table(spark, d, "region").select(F.col("r_name").alias("zone"))},
    )
    parts = [
        spark.table(f"flow_{f}").groupBy("is_preliminary").agg(F.count("*").alias("n")).withColumn("flow", F.lit(f))
        for f in ("b", "d", "e1a")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("a03_ad_hoc_sql", f"WITH {LONG}, {STATIONS} SELECT country, pollutant, COUNT(*) AS n, MAX(conc) AS max_conc FROM lng JOIN stations USING (sampling_point) GROUP BY ALL")
def a03(spark, d):
    return ask(
        spark,
        "SELECT country, pollutant, count(*) AS n, max(conc) AS max_conc FROM {e1a} JOIN {d} USING (sampling_point) GROUP BY ALL",
        e1a=long_observations(spark, d), d=stations(spark, d),
    )


@query("a04_accepted_codes", f"WITH {OBS} SELECT event_id, conc FROM obs WHERE flag // 10 IN (1, 2, 5) AND pollutant IN ('view', 'error')")
def a04(spark, d):
    coded = observations(spark, d).withColumn("validity", F.floor(F.col("flag") / 10)).withColumn("verification", F.col("pollutant"))
    return ob.accepted(coded, [1, 2, 5], ["view", "error"]).select("event_id", "conc")


def assessments(spark, d):
    assessed = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("zone")).agg(
        exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("assessed")
    )
    reported = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("zone"), F.col("o_totalprice").alias("reported"),
        F.col("o_orderpriority").alias("adjustment_source"), F.col("o_orderstatus").alias("exceedance_type"),
    )
    return assessed, reported


ASSESSED = f"""assessed AS (SELECT l_orderkey AS zone, {dsum('l_extendedprice * (1 - l_discount) * (1 + l_tax)')} AS assessed FROM lineitem GROUP BY 1),
  diff AS (SELECT zone, assessed, o_totalprice AS reported, o_orderpriority AS adjustment_source, o_orderstatus AS exceedance_type,
    assessed - o_totalprice AS difference FROM assessed JOIN orders ON o_orderkey = zone)"""


@query("a05_attainment_filters", f"WITH {ASSESSED} SELECT zone, difference FROM diff WHERE abs(difference) >= 50000 AND adjustment_source IN ('1-URGENT', '5-LOW') AND exceedance_type = 'F'")
def a05(spark, d):
    rows = cp.assessment_difference(*assessments(spark, d), ["zone"])
    return cp.attainment_filter(rows, 50000.0, ["1-URGENT", "5-LOW"], ["F"]).select("zone", "difference")


@query("a06_country_code", f"WITH {STATIONS} SELECT sampling_point, country, CASE WHEN country NOT LIKE '%A' THEN upper(substr(country, 1, 2)) END AS iso FROM stations")
def a06(spark, d):
    """The code list has every country, some under another name."""
    other = F.when(F.col("n_name").like("%A"), F.concat(F.lit("Republic of "), "n_name")).otherwise(F.col("n_name"))
    codes = table(spark, d, "nation").select(other.alias("country"), F.upper(F.substring("n_name", 1, 2)).alias("iso"))
    return ob.country_code(stations(spark, d).select("sampling_point", "country"), codes)


@query("a07_adjustment_source", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS adjustment_source FROM orders")
def a07(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", ob.adjustment_source(F.col("o_orderstatus"), F.col("o_orderpriority"), "F").alias("adjustment_source")
    )


# ---------------------------------------------------------------- joins

KEYS = ["zone", "pollutant", "yr"]


def by_zone(spark, d, rows, value):
    """Mean per (zone, pollutant, year) of rows with ``sampling_point, pollutant, ts``."""
    per_station = rows.groupBy("sampling_point", "pollutant", F.year("ts").alias("yr")).agg(exact_mean(F.col(value)).alias("level"))
    return st.area_means(per_station, stations(spark, d), ["country"]).select(
        F.col("country").alias("zone"), "pollutant", "yr", "level"
    )


@query("a10_assessment_regimes", f"""WITH {LONG}, {STATIONS}, {ANNUAL}, {ZONES},
  e1b AS (SELECT country AS zone, pollutant, yr, {mean('level')} AS level FROM (SELECT sampling_point, pollutant, CAST(year(ts) AS INT) AS yr, {mean('conc')} AS level
    FROM (SELECT l_suppkey AS sampling_point, o_orderpriority AS pollutant, o_orderdate AS ts, l_extendedprice AS conc FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY ALL)
    JOIN stations USING (sampling_point) GROUP BY ALL),
  c AS (SELECT zone, pollutant, yr, CAST(COUNT(*) AS DOUBLE) AS level FROM (SELECT country AS zone, pollutant, CAST(year(ts) AS INT) AS yr FROM lng JOIN stations USING (sampling_point)) GROUP BY ALL)
  SELECT c.zone, c.pollutant, c.yr, c.level AS regime, zl.level AS e1a, e1b.level AS e1b FROM c LEFT JOIN zl USING (zone, pollutant, yr) LEFT JOIN e1b USING (zone, pollutant, yr)""")
def a10(spark, d):
    obs = long_observations(spark, d)
    regimes = obs.join(stations(spark, d).select("sampling_point", F.col("country").alias("zone")), "sampling_point").groupBy(
        "zone", "pollutant", F.year("ts").alias("yr")).agg(F.count("*").cast("double").alias("regime"))
    modelled = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_suppkey").alias("sampling_point"), F.col("o_orderpriority").alias("pollutant"), F.col("o_orderdate").alias("ts"),
        F.col("l_extendedprice").alias("conc"))
    parts = {"e1a": by_zone(spark, d, obs, "conc"), "e1b": by_zone(spark, d, modelled, "conc")}
    return cp.regimes_with_levels(regimes, parts, KEYS)


def exceedances(spark, d):
    return cp.exceedance_zones(zone_levels(spark, d), F.lit(253000.0), ["zone"])


OVER = "over_limit AS (SELECT zone, MAX(level) AS level, COUNT(*) AS n_exceedances FROM zl WHERE level > 253000 GROUP BY zone)"


@query("a11_exceedance_plans", f"""WITH {LONG}, {STATIONS}, {ANNUAL}, {ZONES}, {OVER} SELECT zone, level, n_exceedances, s_suppkey AS plan_id
  FROM over_limit LEFT JOIN (SELECT n_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey) ON n_name = zone""")
def a11(spark, d):
    plans = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("zone"), F.col("s_suppkey").alias("plan_id"))
    return cp.with_follow_up(exceedances(spark, d), plans, ["zone"])


def _renamed(regions):
    return F.when(F.col("n_regionkey").isin(regions), F.concat(F.lit("former "), "n_name")).otherwise(F.col("n_name"))


@query("a11_exceedances_without_plan", f"""WITH {LONG}, {STATIONS}, {ANNUAL}, {ZONES}, {OVER} SELECT zone, level, n_exceedances FROM over_limit
  WHERE zone NOT IN (SELECT CASE WHEN n_regionkey IN (1, 3) THEN 'former ' || n_name ELSE n_name END FROM supplier JOIN nation ON s_nationkey = n_nationkey)""")
def a11_without(spark, d):
    """Plans of two regions stand under a former name of their zone."""
    plans = table(spark, d, "supplier").join(
        table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(_renamed([1, 3]).alias("zone"))
    return cp.without_follow_up(exceedances(spark, d), plans, ["zone"])


@query("a12_exceedance_measures", f"""WITH {LONG}, {STATIONS}, {ANNUAL}, {ZONES}, {OVER} SELECT zone, level, c_custkey AS measure_id, c_mktsegment AS kind
  FROM over_limit LEFT JOIN (SELECT n_name, c_custkey, c_mktsegment FROM (SELECT * REPLACE (CASE WHEN n_regionkey IN (0, 2) THEN 'former ' || n_name ELSE n_name END AS n_name) FROM nation) JOIN customer ON c_nationkey = n_nationkey) ON n_name = zone""")
def a12(spark, d):
    measures = table(spark, d, "customer").join(
        table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        _renamed([0, 2]).alias("zone"), F.col("c_custkey").alias("measure_id"), F.col("c_mktsegment").alias("kind"))
    return cp.with_follow_up(exceedances(spark, d), measures, ["zone"]).drop("n_exceedances")


@query("a13_verify_aggregations", f"""WITH {ASSESSED} SELECT coalesce(zone, o_orderkey) AS zone, assessed AS computed, o_totalprice AS reported,
  CASE WHEN zone IS NULL THEN 'only_reported' WHEN o_orderkey IS NULL THEN 'only_computed'
   WHEN abs(assessed - o_totalprice) <= 25000 THEN 'match' ELSE 'differs' END AS status
  FROM assessed FULL OUTER JOIN orders ON zone = o_orderkey""")
def a13(spark, d):
    computed, reported = assessments(spark, d)
    return mo.verify(
        computed.withColumnRenamed("assessed", "computed"), reported.select("zone", "reported"), ["zone"], 25000.0
    )


BAND_ROWS = """('view', 0.0D, 10.0D, 1), ('view', 10.0D, 40.0D, 2), ('view', 40.0D, 1000.0D, 3), ('click', 0.0D, 25.0D, 1), ('click', 25.0D, 1000.0D, 4),
  ('error', 5.0D, 20.0D, 2), ('error', 30.0D, 90.0D, 5), ('signup', 0.0D, 50.0D, 1), ('purchase', 0.0D, 1.0D, 1), ('purchase', 1.0D, 1000.0D, 6)"""
BANDS = f"bands(pollutant, lo, hi, band) AS (VALUES {BAND_ROWS.replace('D,', ',')})"
BANDED = f"banded AS (SELECT o.*, band FROM obs o LEFT JOIN bands b ON o.pollutant = b.pollutant AND conc >= lo AND conc < hi)"


def bands(spark):
    return values(spark, "pollutant, lo, hi, band", BAND_ROWS)


@query("a14_index_bands", f"WITH {OBS}, {BANDS}, {BANDED} SELECT event_id, band FROM banded")
def a14(spark, d):
    return nw.banded(observations(spark, d), bands(spark)).select("event_id", "band")


@query("a14_index_bands_long_list", f"WITH {OBS}, {BANDS}, {BANDED} SELECT event_id, band FROM banded")
def a14_long(spark, d):
    """By merging in order, as for very long band lists."""
    return nw.banded_by_order(observations(spark, d), bands(spark)).select("event_id", "band")


@query("a15_vocabulary_check", "SELECT p_type AS code, COUNT(*) AS n_rows FROM part WHERE p_type NOT IN ('ECONOMY', 'SMALL') GROUP BY 1")
def a15(spark, d):
    words = values(spark, "list, code", "('type', 'ECONOMY'), ('type', 'SMALL'), ('other', 'PROMO')")
    return ob.not_in_vocabulary(table(spark, d, "part").select(F.col("p_type").alias("code")), "code", words, "type")


@query("a16_assessment_difference", f"WITH {ASSESSED} SELECT zone, assessed, reported, difference FROM diff")
def a16(spark, d):
    return cp.assessment_difference(*assessments(spark, d), ["zone"]).select("zone", "assessed", "reported", "difference")


# ---------------------------------------------------------------- aggregations


@query("a20_station_counts", f"""WITH {OBS}, {STATIONS} SELECT country, station_type, COUNT(DISTINCT sampling_point) AS n_stations, COUNT(DISTINCT pollutant) AS n_pollutants
  FROM obs JOIN stations USING (sampling_point) GROUP BY ALL""")
def a20(spark, d):
    # one row per station and pollutant is enough for both counts, and it is what joins the stations
    seen = observations(spark, d).select("sampling_point", "pollutant").distinct()
    rows = seen.join(stations(spark, d), "sampling_point")
    return st.counts(rows, ["country", "station_type"], n_stations="sampling_point", n_pollutants="pollutant")


@query("a21_stations_by_year", f"WITH {LONG} SELECT CAST(year(ts) AS INT) AS yr, COUNT(DISTINCT sampling_point) AS n_stations FROM lng GROUP BY 1")
def a21(spark, d):
    rows = long_observations(spark, d).select(F.year("ts").alias("yr"), "sampling_point")
    return st.counts(rows, ["yr"], n_stations="sampling_point")


@query("a22_annual_station_level", f"WITH {LONG}, {ANNUAL} SELECT * FROM annual")
def a22(spark, d):
    return annual(spark, d)


def _area_sql(area, extra=""):
    return f"""WITH {LONG}, {STATIONS}, {ANNUAL} SELECT {area}, pollutant, yr, {mean('level')} AS level, COUNT(*) AS n_stations
  FROM annual JOIN stations USING (sampling_point) {extra} GROUP BY ALL"""


@query("a23_annual_country_level", _area_sql("country", "WHERE pollutant IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"))
def a23(spark, d):
    return st.area_means(annual(spark, d), stations(spark, d), ["country"], pollutants=["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])


@query("a24_annual_city_level", _area_sql("country, city"))
def a24(spark, d):
    return st.area_means(annual(spark, d), stations(spark, d), ["country", "city"])


@query("a25_station_periods", " UNION ALL ".join(
    f"SELECT '{u}' AS unit, user_id AS sampling_point, event_type AS pollutant, CAST(date_trunc('{u}', ts) AS TIMESTAMP) AS period, {mean('value')} AS level, COUNT(*) AS n_values FROM events GROUP BY ALL"
    for u in ("day", "week", "month")))
def a25(spark, d):
    means = st.station_means_of(observations(spark, d), ["day", "week", "month"])
    return means.withColumn("period", F.col("period").cast("timestamp_ntz"))


@query("a26_monthly_city_level", f"""WITH {LONG}, {STATIONS}, m AS (SELECT sampling_point, pollutant, CAST(date_trunc('month', ts) AS TIMESTAMP) AS period, {mean('conc')} AS level FROM lng
    WHERE year(ts) >= 1998 GROUP BY ALL)
  SELECT city, pollutant, period, {mean('level')} AS level, COUNT(*) AS n_stations FROM m JOIN stations USING (sampling_point) GROUP BY ALL""")
def a26(spark, d):
    since = long_observations(spark, d).where(F.col("ts") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    monthly = st.station_means(since, "month").withColumn("period", F.col("period").cast("timestamp_ntz"))
    return st.area_means(monthly, stations(spark, d), ["city"], when="period")


@query("a27_urban_country_level", _area_sql("country", "WHERE station_type = 'BUILDING' AND pollutant IN ('1-URGENT', '2-HIGH')"))
def a27(spark, d):
    return st.area_means(annual(spark, d), stations(spark, d), ["country"], pollutants=["1-URGENT", "2-HIGH"], station_types=["BUILDING"])


@query("a28_box_plot", f"""WITH {OBS} SELECT pollutant, MIN(conc) AS minimum, quantile_cont(conc, 0.25) AS lower_quartile, quantile_cont(conc, 0.5) AS median,
  quantile_cont(conc, 0.75) AS upper_quartile, MAX(conc) AS maximum FROM obs GROUP BY 1""")
def a28(spark, d):
    return st.box_plot(observations(spark, d), ["pollutant"], "conc")


@query("a29_distribution", f"WITH {OBS} SELECT pollutant, CAST(floor(conc / 2.5) AS BIGINT) AS bin, COUNT(*) AS n FROM obs GROUP BY ALL")
def a29(spark, d):
    return st.distribution(observations(spark, d), ["pollutant"], "conc", 2.5)


@query("a30_trend", f"WITH {LONG}, {ANNUAL} SELECT sampling_point, pollutant, CASE WHEN COUNT(*) > 1 THEN round(regr_slope(level, yr), 6) END AS slope, COUNT(*) AS n_years FROM annual GROUP BY ALL")
def a30(spark, d):
    return st.trend(annual(spark, d), ["sampling_point", "pollutant"]).withColumn("slope", F.round("slope", 6))


@query("a31_correlation_pollutants", f"""WITH {LONG}, {ANNUAL} SELECT a.yr, round(corr(a.level, b.level), 6) AS correlation, COUNT(*) AS n_points FROM annual a JOIN annual b
  ON a.sampling_point = b.sampling_point AND a.yr = b.yr AND a.pollutant = '1-URGENT' AND b.pollutant = '5-LOW' GROUP BY 1""")
def a31(spark, d):
    c = st.correlation(annual(spark, d), "pollutant", "1-URGENT", "5-LOW", ["sampling_point"], ["yr"])
    return c.withColumn("correlation", F.round("correlation", 6))


@query("a31_correlation_years", f"""WITH {LONG}, {ANNUAL} SELECT a.pollutant, round(corr(a.level, b.level), 6) AS correlation, COUNT(*) AS n_points FROM annual a JOIN annual b
  ON a.sampling_point = b.sampling_point AND a.pollutant = b.pollutant AND a.yr = 1996 AND b.yr = 1999 GROUP BY 1""")
def a31_years(spark, d):
    c = st.correlation(annual(spark, d), "yr", 1996, 1999, ["sampling_point"], ["pollutant"])
    return c.withColumn("correlation", F.round("correlation", 6))


@query("a32_distance_to_target", f"WITH {LONG}, {ANNUAL}, {LIMITS} SELECT sampling_point, pollutant, yr, standard, level - lim AS distance, level / lim AS ratio FROM annual JOIN limits USING (pollutant)")
def a32(spark, d):
    return st.distance_to_target(annual(spark, d), limits(spark)).select("sampling_point", "pollutant", "yr", "standard", "distance", "ratio")


@query("a33_attainment_summary", f"""WITH {LONG}, {STATIONS}, {ANNUAL}, {ZONES}, {LIMITS} SELECT pollutant, yr, COUNT(DISTINCT CASE WHEN level > lim THEN zone END) AS n_zones_over, MAX(level) AS max_level
  FROM zl JOIN limits USING (pollutant) WHERE standard = 'strict' GROUP BY ALL""")
def a33(spark, d):
    return cp.attainment_summary(zone_levels(spark, d), limits(spark, "strict"))


@query("a34_attainment_detail", f"""WITH {LONG}, {STATIONS}, {ANNUAL}, {ZONES}, {LIMITS} SELECT zone, pollutant, yr, level, level > lim AS exceeds,
  COUNT(*) OVER (PARTITION BY pollutant, yr) AS n_zones FROM zl JOIN limits USING (pollutant) WHERE standard = 'strict'""")
def a34(spark, d):
    return cp.attainment_detail(zone_levels(spark, d), limits(spark, "strict")).select("zone", "pollutant", "yr", "level", "exceeds", "n_zones")


@query("a35_data_coverage", f"WITH {OBS} SELECT sampling_point, pollutant, COUNT(*) FILTER (flag >= 10) AS n_valid, COUNT(*) FILTER (flag >= 10) / 720.0::DOUBLE AS coverage FROM obs GROUP BY ALL")
def a35(spark, d):
    return cp.coverage(observations(spark, d), ["sampling_point", "pollutant"], F.col("flag") >= 10, 720)


def city_levels(spark, d):
    """City level of a pollutant over all years beside the city's population."""
    places = stations(spark, d)
    levels = long_observations(spark, d).groupBy("sampling_point", "pollutant").agg(exact_mean(F.col("conc")).alias("level"))
    people = places.groupBy("city", "country", "region").agg(exact_sum(F.col("population")).alias("population"))
    means = levels.join(places.select("sampling_point", "city"), "sampling_point").groupBy("city", "pollutant").agg(
        exact_mean(F.col("level")).alias("level"))
    return means.join(people, "city")


CITY = f"""st AS (SELECT sampling_point, pollutant, {mean('conc')} AS level FROM lng GROUP BY ALL),
  people AS (SELECT city, country, region, {dsum('population')} AS population FROM stations GROUP BY ALL),
  city_levels AS (SELECT city, country, region, population, pollutant, level FROM (SELECT city, pollutant, {mean('level')} AS level FROM st JOIN stations USING (sampling_point) GROUP BY ALL) JOIN people USING (city))"""


@query("a36_exposed_share", f"""WITH {LONG}, {STATIONS}, {CITY}, {LIMITS} SELECT pollutant, standard, {dsum('CASE WHEN level > lim THEN population ELSE 0 END')} / {dsum('population')} AS exposed_share
  FROM city_levels JOIN limits USING (pollutant) GROUP BY ALL""")
def a36(spark, d):
    return ex.exposed_share(city_levels(spark, d), limits(spark))


def station_levels(spark, d):
    levels = long_observations(spark, d).groupBy("sampling_point", "pollutant").agg(exact_mean(F.col("conc")).alias("level"))
    return levels.join(stations(spark, d), "sampling_point")


WEIGHTED = f"""w AS (SELECT city, pollutant, {dsum('population * level')} / {dsum('population')} AS weighted_level
  FROM (SELECT sampling_point, pollutant, {mean('conc')} AS level FROM lng GROUP BY ALL) JOIN stations USING (sampling_point) GROUP BY ALL)"""


@query("a37_population_weighted", f"WITH {LONG}, {STATIONS}, {WEIGHTED} SELECT city, pollutant, weighted_level FROM w")
def a37(spark, d):
    return ex.weighted_levels(station_levels(spark, d), ["city", "pollutant"])


SCENARIO_ROWS = """('low', '1-URGENT', 0.0000002D, 100000.0D, 12.0D), ('high', '1-URGENT', 0.0000008D, 50000.0D, 12.0D), ('low', '5-LOW', 0.0000001D, 150000.0D, 9.5D)"""
SCENARIOS = f"scenarios(scenario, pollutant, beta, threshold, years_per_case) AS (VALUES {SCENARIO_ROWS.replace('D,', ',').replace('D)', ')')})"
CASES = """cases AS (SELECT *, population * (1.0 - exp(-CAST(beta AS DOUBLE) * greatest(level - threshold, 0.0))) AS cases FROM city_levels JOIN scenarios USING (pollutant))"""


def scenarios(spark):
    return values(spark, "scenario, pollutant, beta, threshold, years_per_case", SCENARIO_ROWS)


@query("a38_health_burden", f"""WITH {LONG}, {STATIONS}, {CITY}, {SCENARIOS}, {CASES} SELECT scenario, country, region, CAST(GROUPING_ID(scenario, country, region) AS INT) AS level_id,
  round({dsum('cases')}, 3) AS cases, round({dsum('cases * years_per_case')}, 3) AS years_lost FROM cases GROUP BY ROLLUP (scenario, country, region)""")
def a38(spark, d):
    out = ex.burden(city_levels(spark, d), scenarios(spark))
    return out.withColumn("cases", F.round("cases", 3)).withColumn("years_lost", F.round("years_lost", 3))


@query("a38_city_burden", f"""WITH {LONG}, {STATIONS}, {CITY}, {SCENARIOS}, {CASES} SELECT scenario, city, round({dsum('cases')}, 3) AS cases, round({dsum('cases * years_per_case')}, 3) AS years_lost FROM cases GROUP BY ALL""")
def a38_city(spark, d):
    out = ex.city_burden(city_levels(spark, d), scenarios(spark))
    return out.withColumn("cases", F.round("cases", 3)).withColumn("years_lost", F.round("years_lost", 3))


@query("a39_aggregations_explorer", f"""SELECT o_orderpriority AS pollutant, o_orderstatus AS status, CAST(year(o_orderdate) AS INT) AS yr,
  CAST(GROUPING_ID(o_orderpriority, o_orderstatus, year(o_orderdate)) AS INT) AS level_id, COUNT(*) AS n, {mean('o_totalprice')} AS mean
  FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus, year(o_orderdate))""")
def a39(spark, d):
    rows = table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("pollutant"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("yr"), "o_totalprice")
    return mo.explorer(rows, ["pollutant", "status", "yr"], "o_totalprice")


@query("a40_submission_overview", f"""WITH {SUBMISSIONS} SELECT country, sampling_point, CAST(GROUPING_ID(country, sampling_point) AS INT) AS level_id, COUNT(*) AS n_submissions,
  MAX(submitted) AS last_submitted FROM submissions GROUP BY ROLLUP (country, sampling_point)""")
def a40(spark, d):
    return mo.submission_overview(submissions(spark, d), ["country", "sampling_point"])


FLOWS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("a41_status_overview", f"""WITH {SUBMISSIONS}, r AS (SELECT *, row_number() OVER (PARTITION BY country, flow ORDER BY submitted DESC, submission_id DESC) AS rn FROM submissions)
  SELECT country, {', '.join(f"MAX(CASE WHEN flow = '{f}' THEN status END) AS flow_{i}" for i, f in enumerate(FLOWS, 1))} FROM r WHERE rn = 1 GROUP BY country""")
def a41(spark, d):
    wide = mo.status_overview(submissions(spark, d), FLOWS, "submission_id")
    return wide.select("country", *[F.col(f"`{f}`").alias(f"flow_{i}") for i, f in enumerate(FLOWS, 1)])


@query("a42_time_lag", """WITH l AS (SELECT o_orderpriority AS flow, date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS lag FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT flow, COUNT(*) AS n, COUNT(*) FILTER (lag < 0) AS n_negative, CAST(SUM(lag) AS DOUBLE) / COUNT(*) AS mean_lag, quantile_cont(CAST(lag AS DOUBLE), 0.5) AS median_lag,
  round(quantile_cont(CAST(lag AS DOUBLE), 0.9), 6) AS p90_lag FROM l GROUP BY flow""")
def a42(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("flow"), F.col("o_orderdate").alias("measured"))
    rows = table(spark, d, "lineitem").select("l_orderkey", F.col("l_shipdate").alias("available")).join(orders, "l_orderkey")
    return mo.time_lag(rows, ["flow"], {"median_lag": 0.5, "p90_lag": 0.9}).withColumn("p90_lag", F.round("p90_lag", 6))


@query("a43_combined_index", f"""WITH {OBS}, {BANDS}, latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sampling_point, pollutant ORDER BY ts DESC, event_id DESC) AS rn FROM obs) WHERE rn = 1)
  SELECT sampling_point, MAX(band) AS index_band, COUNT(band) AS n_pollutants FROM latest o LEFT JOIN bands b ON o.pollutant = b.pollutant AND conc >= lo AND conc < hi GROUP BY 1""")
def a43(spark, d):
    last = nw.latest_values(observations(spark, d), ["sampling_point", "pollutant"], "event_id")
    return nw.worst_band(nw.banded(last, bands(spark)), ["sampling_point"])


@query("a44_reporting_calendar", f"""WITH {SUBMISSIONS}, c AS (SELECT flow, CAST(date_trunc('month', submitted) AS TIMESTAMP) AS month, COUNT(*) AS n FROM submissions GROUP BY ALL),
  m AS (SELECT flow, unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2002-06-01', INTERVAL 1 MONTH)) AS month FROM (SELECT DISTINCT flow FROM submissions))
  SELECT flow, month, coalesce(n, 0) AS n FROM m LEFT JOIN c USING (flow, month)""")
def a44(spark, d):
    period = [F.lit(day).cast("timestamp") for day in ("1994-11-20", "2002-06-03")]
    return mo.calendar(submissions(spark, d), *period).withColumn("month", F.col("month").cast("timestamp_ntz"))


@query("a44_calendar_of_one_kind", f"""WITH {SUBMISSIONS}, s AS (SELECT * FROM submissions WHERE status = 'P' AND flow = '1-URGENT'), c AS (SELECT country AS flow, CAST(date_trunc('month', submitted) AS TIMESTAMP) AS month, COUNT(*) AS n FROM s GROUP BY ALL),
  m AS (SELECT flow, unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS month FROM (SELECT flow, min(month) AS lo, max(month) AS hi FROM c GROUP BY flow))
  SELECT flow, month, coalesce(n, 0) AS n FROM m LEFT JOIN c USING (flow, month)""")
def a44_kind(spark, d):
    """Deliveries of one kind by country, each from its first to its last; most months have none."""
    return mo.calendar(submissions(spark, d).where("status = 'P' and flow = '1-URGENT'").withColumn("flow", F.col("country"))).withColumn("month", F.col("month").cast("timestamp_ntz"))


# ---------------------------------------------------------------- windows, order, sets


@query("a50_submission_ranks", f"WITH {SUBMISSIONS} SELECT submission_id, country, flow, rank() OVER (PARTITION BY country, flow ORDER BY submitted) AS rank FROM submissions")
def a50(spark, d):
    return mo.submission_ranks(submissions(spark, d)).select("submission_id", "country", "flow", "rank")


@query("a51_station_ranks", f"WITH {LONG}, {ANNUAL} SELECT sampling_point, pollutant, yr, dense_rank() OVER (PARTITION BY pollutant, yr ORDER BY level DESC) AS place FROM annual")
def a51(spark, d):
    return st.ranked(annual(spark, d), ["pollutant", "yr"]).select("sampling_point", "pollutant", "yr", "place")


@query("a52_city_ranking", f"WITH {LONG}, {STATIONS}, {WEIGHTED} SELECT city, pollutant, CAST(rank() OVER (PARTITION BY pollutant ORDER BY weighted_level DESC) AS INT) AS place FROM w")
def a52(spark, d):
    return ex.city_ranking(ex.weighted_levels(station_levels(spark, d), ["city", "pollutant"]), ["pollutant"]).select("city", "pollutant", "place")


@query("a53_unbroken_runs", f"""WITH {LONG}, y AS (SELECT DISTINCT sampling_point, pollutant, CAST(year(ts) AS INT) AS yr FROM lng),
  s AS (SELECT *, CASE WHEN yr - lag(yr) OVER (PARTITION BY sampling_point, pollutant ORDER BY yr) = 1 THEN 0 ELSE 1 END AS starts FROM y),
  g AS (SELECT *, SUM(starts) OVER (PARTITION BY sampling_point, pollutant ORDER BY yr) AS island FROM s),
  r AS (SELECT sampling_point, pollutant, MIN(yr) AS first_year, MAX(yr) AS last_year, COUNT(*) AS n_years FROM g GROUP BY sampling_point, pollutant, island)
  SELECT *, coalesce(first_year - lag(last_year) OVER (PARTITION BY sampling_point, pollutant ORDER BY first_year) - 1, 0) AS missing_before FROM r""")
def a53(spark, d):
    years = long_observations(spark, d).select("sampling_point", "pollutant", F.year("ts").alias("yr"))
    return mo.unbroken_runs(years, ["sampling_point", "pollutant"])


@query("a53_missing_years", f"""WITH {LONG}, y AS (SELECT DISTINCT sampling_point, pollutant, CAST(year(ts) AS INT) AS yr FROM lng)
  SELECT sampling_point, pollutant, CAST(n AS INT) AS yr FROM (SELECT DISTINCT sampling_point, pollutant FROM y), (SELECT unnest(range(1995, 2002)) AS n)
  WHERE (sampling_point, pollutant, n) NOT IN (SELECT sampling_point, pollutant, yr FROM y)""")
def a53_missing(spark, d):
    years = long_observations(spark, d).select("sampling_point", "pollutant", F.year("ts").alias("yr"))
    return mo.missing_years(years, ["sampling_point", "pollutant"], 1995, 2001)


@query("a54_year_on_year", f"""WITH {LONG}, {STATIONS}, {ANNUAL}, {ZONES} SELECT zone, pollutant, yr, level,
  level - lag(level) OVER (PARTITION BY zone, pollutant ORDER BY yr) AS change FROM zl""")
def a54(spark, d):
    return mo.year_on_year(zone_levels(spark, d), ["zone", "pollutant"])


@query("a55_latest_observation", f"""WITH {OBS} SELECT sampling_point, pollutant, ts, conc, event_id FROM (SELECT *, row_number() OVER (PARTITION BY sampling_point, pollutant ORDER BY ts DESC, event_id DESC) AS rn FROM obs) WHERE rn = 1""")
def a55(spark, d):
    return nw.latest_values(observations(spark, d).drop("flag"), ["sampling_point", "pollutant"], "event_id")


@query("a60_most_polluted", f"WITH {LONG}, {ANNUAL} SELECT sampling_point, pollutant, yr, level FROM annual ORDER BY level DESC, sampling_point, pollutant, yr LIMIT 25")
def a60(spark, d):
    return st.most_polluted(annual(spark, d), 25, tie=["sampling_point", "pollutant", "yr"]).drop("n_values")


@query("a65_historic_and_current", f"""WITH {LONG}, {ANNUAL} SELECT sampling_point, pollutant, yr, level, CASE WHEN yr < 1998 THEN 'historic' ELSE 'current' END AS source FROM annual""")
def a65(spark, d):
    obs = long_observations(spark, d)
    turn = F.lit("1998-01-01").cast("timestamp_ntz")
    parts = {"historic": st.annual_levels(obs.where(F.col("ts") < turn)), "current": st.annual_levels(obs.where(F.col("ts") >= turn))}
    return ob.combined(parts).drop("n_values")


@query("a66_validated_preferred", f"""WITH {OBS}, u AS (SELECT sampling_point, pollutant, date_trunc('hour', ts) AS ts, conc, CASE WHEN flag >= 50 THEN 'validated' ELSE 'provisional' END AS flow FROM obs)
  SELECT sampling_point, pollutant, ts, conc, flow FROM (SELECT *, row_number() OVER (PARTITION BY sampling_point, pollutant, ts ORDER BY flow DESC, conc DESC) AS rn FROM u) WHERE rn = 1""")
def a66(spark, d):
    hourly = observations(spark, d).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    cols = ["sampling_point", "pollutant", "ts", "conc"]
    return ob.preferred(
        hourly.where("flag >= 50").select(*cols), hourly.where("flag < 50").select(*cols), ["sampling_point", "pollutant", "ts"], "conc")
