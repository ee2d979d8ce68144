"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores. The
first entry builds the shared fact tables from the raw tables; every query is
then run to its last row twice and the faster run counts.
"""

from __future__ import annotations

import json
import os
import time

from areapulse.checks.catalog import QUERIES
from areapulse.session import local_session
from areapulse.sources.staging import gold

HEADLINE = [
    "a1_monthly_trend", "a2_trend_norm", "a4_trend_sig", "a6_year_on_year", "a8_demographic_share",
    "a9_advanced", "a13_geo_totals_sido", "w5_date_ranks", "w6_dominant_group", "w7_candidates_norm",
    "u1_candidates_all", "k1_rankings", "k7_vector_lookup", "j9_points_in_polygons", "m9_insights",
    "n4_sales", "n6_telco_grid_demographics", "n8_sex_age", "a20_grouped_aggregates", "q6_compare_yoy",
    "r1_compare_domains", "r8_region_payload", "r11_request_tags", "d6_add_activity",
    "d3_incremental_ingest", "d3_mixed_layouts", "w7_candidates_wide", "k1_rankings_wide", "a24_leading_groups_crowded", "k7_vector_lookup_split",
    "d6_refreshed_activity", "j9_mixed_sizes", "k7_indexed", "w11_long_durations", "w13_one_place",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")

    def run(name: str) -> float:
        return timed(lambda: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())

    times = {"build_fact_tables": timed(lambda: gold(spark, folder))}
    for name in HEADLINE:
        times[name] = min(run(name), run(name))
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0),
    }))


if __name__ == "__main__":
    main()
