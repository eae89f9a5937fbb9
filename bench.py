"""Time the headline queries and print one JSON line.

Every query is planned and run to its end into a sink that discards the rows,
three times, after a warm-up query that starts the session; the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from gate.queries import QUERIES  # noqa: E402
from wayside.session import get_session  # noqa: E402

HEADLINE = (
    "s1_read_incidents",
    "p1_filter_years",
    "p4_impute_median",
    "p8_duration_minutes",
    "p11_cap_sigma",
    "p13_cap_iqr",
    "p20_repair_datetime",
    "j1_attach_weather_id",
    "j2_star_join",
    "j4_orphan_count",
    "a1_agg_federal",
    "a2_agg_state_anomaly",
    "a3_agg_city_by_state",
    "a4_agg_weather_by_state",
    "a5_agg_time_pattern",
    "a6_build_dim_location",
    "a8_build_dim_weather",
    "a9_build_fact",
    "a15_pareto",
    "w2_running_share",
    "c1a_categorize_aggregate",
    "d1_add_time_features",
    "q1_null_profile",
    "q2_duplicate_rows",
    "q3_distinct_profile",
    "q6_box_summary",
    "q7_check_rules",
    "q13_reconcile_city",
    "q14_reconcile_weather",
    "k1_profile",
    "k2_clean",
    "k4_build_aggregates",
    "k5_validate_outputs",
    "k6_run_etl",
)

REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "wayside-bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "a10_count_by_state", sf_dir)
    times = {name: median(run(spark, name, sf_dir) for _ in range(REPEATS)) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
