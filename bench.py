"""Time the headline queries: one line of JSON.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the cores. Each query
runs once to warm up, then BENCH_RUNS times; its time is the median. A run
computes every row and column and throws them away. The warm-up of the first
query over all sources cleans and stores their tables; timed runs read these,
after a look at whether the given tables have changed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import QUERIES  # noqa: E402
from tidemerge.session import local_session  # noqa: E402

HEADLINE = (
    "integrate_surveys", "integrate_year_range", "season_counts", "practical_salinity", "keep_first",
    "keep_extreme_ties", "first_tow_two_stage", "split_repair_union", "resolve_replicates", "replicate_dedup",
    "collapse_visits_mode", "group_size", "strict_group_mean", "depth_bin_daily", "pivot_value_sign",
    "unpivot_drop_null", "skewed_fact_join", "left_lookup_null_safe", "field_equivalence", "effort_matrix",
    "conflict_merge", "split_event_nutrient", "natural_full_join", "differing_values",
    "integrate_cleaned_surveys", "published_table", "sources_conserved",
    "null_profile", "survey_fmwt", "survey_usgs_sfbs", "survey_ncro", "survey_ybfmp", "survey_baystudy", "survey_20mm",
)


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, **{"spark.driver.memory": "8g"})
    seconds = {}
    for name in HEADLINE:
        run(spark, folder, name)
        seconds[name] = round(statistics.median(run(spark, folder, name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
