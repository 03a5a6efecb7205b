import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerofolio.functions.numbers import exact_mean, exact_sum
from aerofolio.operators.air import compliance as cp, exposure as ex, monitor as mo, now as nw, observations as ob, stats as st
from aerofolio.session import fresh_path
from aerofolio.sources import versions


def ts(day, hour=0, year=2024):
    return dt.datetime(year, 1, day, hour)


OBS = "sampling_point long, pollutant string, ts timestamp_ntz, conc double"


def test_download_filters(spark):
    a = spark.createDataFrame([(1, "x", ts(1), 1.0), (2, "x", ts(2), 2.0), (1, "y", ts(3), 3.0)], OBS)
    b = spark.createDataFrame([(1, "x", ts(5), 4.0)], OBS)
    places = spark.createDataFrame([(1, "A"), (2, "B")], "sampling_point long, country string")
    got = ob.download({"E1a": a, "E2a": b}, places, ["A"], pollutants=["x"], start=ts(1), end=ts(5))
    assert [(r.flow, r.conc) for r in got.collect()] == [("E1a", 1.0)]
    assert ob.download({"E1a": a, "E2a": b}).count() == 4


def test_validated_wins_over_provisional(spark):
    val = spark.createDataFrame([(1, "x", ts(1), 5.0)], OBS)
    pro = spark.createDataFrame([(1, "x", ts(1), 9.0), (1, "x", ts(2), 7.0)], OBS)
    got = ob.preferred(val, pro, ["sampling_point", "pollutant", "ts"], "conc").orderBy("ts").collect()
    assert [(r.flow, r.conc) for r in got] == [("validated", 5.0), ("provisional", 7.0)]


def test_area_mean_is_a_mean_of_station_means(spark):
    obs = spark.createDataFrame([(1, "x", ts(1), 1.0), (1, "x", ts(2), 3.0), (1, "x", ts(3), 5.0), (2, "x", ts(1), 9.0)], OBS)
    places = spark.createDataFrame([(1, "A"), (2, "A")], "sampling_point long, country string")
    assert st.area_means(st.annual_levels(obs), places, ["country"]).first().level == 6.0


def test_box_plot_with_one_busy_group(spark):
    rnd = random.Random(1)
    data = [("hot", rnd.random()) for _ in range(500)] + [("b", 1.0), ("b", 2.0), ("c", 7.0)]
    got = {r.g: r for r in st.box_plot(spark.createDataFrame(data, "g string, v double"), ["g"], "v").collect()}
    hot = sorted(v for g, v in data if g == "hot")
    assert got["hot"].median == pytest.approx((hot[249] + hot[250]) / 2)
    assert tuple(got["b"])[1:] == (1.0, 1.25, 1.5, 1.75, 2.0) and tuple(got["c"])[1:] == (7.0,) * 5


def test_ranks_and_top(spark):
    levels = spark.createDataFrame([("x", 1, 5.0), ("x", 2, 7.0), ("x", 3, 7.0), ("y", 1, 1.0)], "pollutant string, sampling_point long, level double")
    got = {(r.pollutant, r.sampling_point): r.place for r in st.ranked(levels, ["pollutant"]).collect()}
    assert got == {("x", 1): 2, ("x", 2): 1, ("x", 3): 1, ("y", 1): 1}
    assert [r.sampling_point for r in st.most_polluted(levels, 2).collect()] == [2, 3]


@pytest.mark.parametrize("find", [nw.banded, nw.banded_by_order])
def test_bands(spark, find):
    bands = spark.createDataFrame([("x", 0.0, 1.0, 1), ("x", 1.0, 2.0, 2), ("x", 5.0, 6.0, 3), ("y", 0.0, 9.0, 4)], "pollutant string, lo double, hi double, band int")
    values = [("x", -1.0), ("x", 0.0), ("x", 0.999), ("x", 1.0), ("x", 2.0), ("x", 5.5), ("x", None), ("y", 5.0), ("z", 1.0), ("x", 1.0)]
    got = nw.banded(spark.createDataFrame([(p, v, i) for i, (p, v) in enumerate(values)], "pollutant string, conc double, i int"), bands)
    assert {r.i: r.band for r in got.collect()} == dict(enumerate([None, 1, 1, 2, None, 3, None, 4, None, 2]))


@pytest.mark.parametrize("find", [nw.banded, nw.banded_by_order])
def test_open_ended_and_null_bands(spark, find):
    shape = "pollutant string, lo double, hi double, band int"
    bands = spark.createDataFrame([("a", None, 10.0, 1), ("a", 10.0, 20.0, 2), (None, 0.0, 9.0, 7), ("b", 5.0, None, 3), ("c", 4.0, 4.0, 9)], shape)
    inf = float("inf")
    values = [("a", 1.0), ("a", -inf), ("a", 10.0), ("a", 20.0), (None, 3.0), ("b", 4.0), ("b", inf), ("b", float("nan")), ("b", None), ("c", 4.0)]
    df = spark.createDataFrame([(p, v, i) for i, (p, v) in enumerate(values)], "pollutant string, conc double, i int")
    assert {r.i: r.band for r in find(df, bands).collect()} == dict(enumerate([1, 1, 2, None, None, None, 3, None, None, None]))
    overlapping = bands.union(spark.createDataFrame([("a", 15.0, 30.0, 4)], shape))
    with pytest.raises(Exception, match="bands overlap: a"):
        find(df, overlapping).collect()


@pytest.mark.parametrize("values, total, mean", [
    ([1e-7, 2e-7], 3e-7, 1.5e-7), ([2e12], 2e12, 2e12), ([1e300, 1.0], 1e300, 5e299), ([float("nan"), 1.0], None, None), ([float("inf"), 1.0], float("inf"), float("inf")),
    ([None, 4.0], 4.0, 4.0), ([0.1] * 10, 1.0, 0.1), ([0.0, 1e-20], 1e-20, 5e-21)])
def test_sums_of_any_size(spark, values, total, mean):
    r = spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).first()
    if total is None:
        assert r.s != r.s and r.m != r.m
    else:
        assert (r.s, r.m) == pytest.approx((total, mean), rel=1e-15)


def test_sums_over_nothing(spark):
    none = spark.createDataFrame([(None,)], "v double")
    assert tuple(none.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first()) == (None, None)


def test_groups_without_values_stay(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None)], "g string, v double")
    assert {r.g: tuple(r)[1:] for r in st.box_plot(df, ["g"], "v").collect()} == {"a": (None,) * 5, "b": (1.0,) * 5}
    lags = spark.createDataFrame([("f", None, None)], "flow string, measured timestamp_ntz, available timestamp_ntz")
    assert tuple(mo.time_lag(lags, ["flow"], {"median": 0.5}).first()) == ("f", 0, 0, None, None)


def test_several_periods_in_one_scan(spark):
    obs = spark.createDataFrame([(1, "x", ts(1), 1.0), (1, "x", ts(1, 5), 2.0), (1, "x", ts(9), 6.0), (1, "x", ts(9), None)], OBS)
    got = {(r.unit, r.period.day): (r.level, r.n_values) for r in st.station_means_of(obs, ["day", "week", "month"]).collect()}
    assert got == {("day", 1): (1.5, 2), ("day", 9): (6.0, 1), ("week", 1): (1.5, 2), ("week", 8): (6.0, 1), ("month", 1): (3.0, 3)}


def test_verify(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, computed double")
    b = spark.createDataFrame([(2, 2.05), (3, 4.0), (4, 4.0)], "k int, reported double")
    got = {r.k: r.status for r in mo.verify(a, b, ["k"], 0.1).collect()}
    assert got == {1: "only_computed", 2: "match", 3: "differs", 4: "only_reported"}


def test_runs_and_missing_years(spark):
    years = spark.createDataFrame([("s", y) for y in (2001, 2002, 2002, 2005, 2006, 2010)] + [("t", 2003)], "s string, yr int")
    runs = [tuple(r) for r in mo.unbroken_runs(years, ["s"]).orderBy("s", "first_year").collect()]
    assert runs == [("s", 2001, 2002, 2, 0), ("s", 2005, 2006, 2, 2), ("s", 2010, 2010, 1, 3), ("t", 2003, 2003, 1, 0)]
    gone = {(r.s, r.yr) for r in mo.missing_years(years, ["s"], 2001, 2004).collect()}
    assert gone == {("s", 2003), ("s", 2004), ("t", 2001), ("t", 2002), ("t", 2004)}


def test_explorer_equals_a_cube_over_the_rows(spark):
    rnd = random.Random(2)
    df = spark.createDataFrame([(rnd.choice("ab"), rnd.choice([None, "c"]), float(rnd.randrange(9))) for _ in range(90)], "p string, q string, v double")
    got = {(r.p, r.q, r.level_id): (r.n, r["mean"]) for r in mo.explorer(df, ["p", "q"], "v").collect()}
    want = df.cube("p", "q").agg(F.grouping_id().alias("g"), F.count("*").alias("n"), F.avg("v").alias("m")).collect()
    assert got.keys() == {(r.p, r.q, r.g) for r in want}
    for r in want:
        assert got[(r.p, r.q, r.g)] == (r.n, pytest.approx(r.m))


def test_time_lag(spark):
    rows = spark.createDataFrame([("f", ts(1), ts(1 + d)) for d in (0, 1, 1, 4)] + [("f", ts(9), ts(7))], "flow string, measured timestamp_ntz, available timestamp_ntz")
    r = mo.time_lag(rows, ["flow"], {"median": 0.5}).first()
    assert (r.n, r.n_negative, r.mean_lag, r["median"]) == (5, 1, 0.8, 1.0)


def test_attainment(spark):
    levels = spark.createDataFrame([("z1", "x", 2020, 5.0), ("z2", "x", 2020, 3.0), ("z1", "x", 2021, 1.0)], "zone string, pollutant string, yr int, level double")
    targets = spark.createDataFrame([("x", 4.0)], "pollutant string, limit double")
    got = {r.yr: (r.n_zones_over, r.max_level) for r in cp.attainment_summary(levels, targets).collect()}
    assert got == {2020: (1, 5.0), 2021: (0, 1.0)}
    assert {(r.zone, r.yr): (r.exceeds, r.n_zones) for r in cp.attainment_detail(levels, targets).collect()} == {
        ("z1", 2020): (True, 2), ("z2", 2020): (False, 2), ("z1", 2021): (False, 1)}
    over = cp.exceedance_zones(levels, F.lit(2.0), ["zone"])
    plans = spark.createDataFrame([("z1", 7), ("z1", 8)], "zone string, plan int")
    assert {(r.zone, r.plan) for r in cp.with_follow_up(over, plans, ["zone"]).collect()} == {("z1", 7), ("z1", 8), ("z2", None)}
    assert [r.zone for r in cp.without_follow_up(over, plans, ["zone"]).collect()] == ["z2"]


def test_exposure_and_burden(spark):
    cities = spark.createDataFrame([("a", "c1", "r1", "x", 10.0, 100.0), ("b", "c1", "r1", "x", 2.0, 300.0)],
                                   "city string, country string, region string, pollutant string, level double, population double")
    targets = spark.createDataFrame([("x", "s", 5.0)], "pollutant string, standard string, limit double")
    assert ex.exposed_share(cities, targets).first().exposed_share == 0.25
    assert ex.weighted_levels(cities, ["pollutant"]).first().weighted_level == 4.0
    scenario = spark.createDataFrame([("low", "x", 0.1, 5.0, 2.0)], "scenario string, pollutant string, beta double, threshold double, years_per_case double")
    rows = {r.level_id: r for r in ex.burden(cities, scenario).collect()}
    assert set(rows) == {0, 1, 3, 7} and rows[7].cases == pytest.approx(100 * (1 - 2.718281828459045 ** -0.5), abs=1e-5)
    assert rows[0].years_lost == pytest.approx(2 * rows[0].cases, abs=1e-5)


def scans(df):
    """Files that each scan of a frame has read, and its partition filters, with the plan as it was first made."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark._jvm.scala.jdk.javaapi.CollectionConverters
        again = df.select("*")
        n = len(again.collect())
        out = []
        for leaf in rows.asJava(again._jdf.queryExecution().executedPlan().collectLeaves()):
            if "numFiles" in set(rows.asJava(leaf.metrics()).keySet()):
                out.append((leaf.metrics().apply("numFiles").value(), leaf.metadata().get("PartitionFilters").get()))
        return n, out
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_laid_out_table_is_pruned(spark):
    """By the years of the period when planned, by the chosen stations' countries when run."""
    path = fresh_path(spark, "laid-out")
    rows = [(p, "x", dt.datetime(y, 5, 1), float(y)) for p in range(40) for y in range(2010, 2020)] + [(99, "x", dt.datetime(2012, 1, 1), 0.0), (1, "x", None, 1.0)]
    obs = spark.createDataFrame(rows, "sampling_point long, pollutant string, ts timestamp_ntz, conc double")
    places = spark.createDataFrame([(p, f"c{p % 10}", p * 10) for p in range(40)], "sampling_point long, country string, population int")
    for _ in range(2):
        ob.lay_out(obs, places, path, files=2)
    whole = versions.read(spark, path)
    assert sorted(map(str, whole.select(*obs.columns).collect())) == sorted(map(str, obs.collect()))
    settled = fresh_path(spark, "places")
    places.write.parquet(settled)
    chosen = spark.read.parquet(settled).where("population < 20")
    got = ob.download({"E1a": whole}, chosen, start=dt.datetime(2012, 1, 1), end=dt.datetime(2014, 1, 1))
    n, found = scans(got)
    assert n == 4  # two stations, two years
    files, filters = next((f, p) for f, p in found if "yr" in p)
    assert "dynamicpruning" in filters and "yr" in filters and files <= 4 * 2 < len(whole.inputFiles()) // 4
    assert {(r.sampling_point, r.yr) for r in got.collect()} == {(p, y) for p in (0, 1) for y in (2012, 2013)}


def test_calendar_has_months_without_deliveries(spark):
    day = dt.datetime
    rows = spark.createDataFrame([("a", day(2020, 1, 31)), ("a", day(2020, 1, 1)), ("a", day(2020, 4, 30)), ("b", day(2020, 2, 5)), (None, day(2020, 3, 1)), ("c", None)], "flow string, submitted timestamp_ntz")
    got = {(r.flow, r.month.month, r.n) for r in mo.calendar(rows).collect()}
    assert got == {("a", 1, 2), ("a", 2, 0), ("a", 3, 0), ("a", 4, 1), ("b", 2, 1), (None, 3, 1)}
    period = [F.lit(d).cast("timestamp") for d in ("2020-02-10", "2020-03-02")]
    assert {(r.flow, r.month.month, r.n) for r in mo.calendar(rows, *period).collect()} == {("a", 2, 0), ("a", 3, 0), ("b", 2, 1), ("b", 3, 0), (None, 2, 0), (None, 3, 1)}
    assert mo.calendar(rows.limit(0)).count() == 0
