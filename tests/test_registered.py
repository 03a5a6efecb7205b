"""Every registered query against its SQL in DuckDB, and the shape of the plans that matter at scale."""

import os

import pytest

import __spark_entry__ as entry
from aerofolio.plans import catalog
from scripts.check_oracle import check, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    text, _ = check(spark, duck, FOLDER, name)
    assert text.startswith("equal"), text


def test_entry(spark):
    assert entry.entry(spark).columns == ["outcome", "n_links"]


def plan(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_what_they_need(spark):
    text = plan(spark, "a01_download_selection")
    assert "In(event_type, [2-HIGH,click,view])" in text or "In(event_type, [click,view,2-HIGH])" in text
    assert "GreaterThanOrEqual(ts" in text and "props" not in text
    assert "html" not in plan(spark, "p40_link_resolution")


def test_heavy_sides_are_aggregated_before_they_meet(spark):
    """Stations join station means, never observations."""
    text = plan(spark, "a23_annual_country_level")
    assert text.index("Join") < text.rindex("HashAggregate")


def test_groups_are_carried_down_in_the_row(spark):
    assert "Exchange" not in plan(spark, "p33_catalogue_applications")


def test_missing_years_shuffle_series_not_observations(spark):
    text = plan(spark, "a53_missing_years")
    assert text.count("FileScan") == 1 and "partial_collect_set" in text and "Join" not in text


def test_periods_come_from_one_scan(spark):
    assert plan(spark, "a25_station_periods").count("FileScan") == 1


def test_links_ship_links_only(spark):
    assert "html" in plan(spark, "p84_links") and "Exchange" not in plan(spark, "p84_links")


@pytest.mark.parametrize("name", [n for n in sorted(catalog.QUERIES) if not n.startswith("a7")])
def test_no_cartesian_products(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    if "BroadcastNestedLoopJoin" in text:
        pytest.fail("a join without an equality")
