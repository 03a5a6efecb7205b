"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Every query is run to the end through Spark's no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from aerofolio.plans import catalog  # noqa: E402
from aerofolio.session import local_session  # noqa: E402

HEADLINE = [
    "p02_markdown_table", "p07_block_upsert", "p33_catalogue_applications", "p34_heading_levels", "p40_link_resolution",
    "p40_link_outcomes", "p43_category_names", "p46_numbered_copies", "p51_gallery", "p60_fill_forward", "p70_newest_first",
    "p80_content_article", "p81_embeds", "p84_links", "p86_markdown", "p86_export_documents", "a01_download_selection",
    "a10_assessment_regimes", "a13_verify_aggregations", "a14_index_bands", "a22_annual_station_level",
    "a23_annual_country_level", "a25_station_periods", "a28_box_plot", "a31_correlation_years", "a33_attainment_summary",
    "a37_population_weighted", "a38_health_burden", "a39_aggregations_explorer", "a40_submission_overview", "a41_status_overview",
    "a42_time_lag", "a50_submission_ranks", "a51_station_ranks", "a53_unbroken_runs", "a55_latest_observation",
    "a66_validated_preferred", "a71_latest_values", "a72_deduplicated_feed", "a73_daily_means", "a74_silence_sessions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.conf.set("spark.aerofolio.spread", os.environ.get("BENCH_CPUS", "8"))  # the test files have one row group each
    spark.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    spark.range(1000).selectExpr("sum(id)").collect()  # start executors before the clock
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
