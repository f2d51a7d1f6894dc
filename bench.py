"""Time the headline queries and print one JSON line.

Each query runs in full into a sink that drops the rows: once to warm up, then
``BENCH_RUNS`` times (3 unless set), of which the median counts. Putting the given events into
message form is done before and not timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import feed  # noqa: E402
from checks.catalog import QUERIES  # noqa: E402
from checks.context import Context  # noqa: E402
from wardflow import build_session  # noqa: E402

HEADLINE = [
    "M2_messages",
    "M4_parsed_map",
    "M6_M10_segment_rows",
    "G1_hl7_parsed",
    "G4_pv1",
    "G7_obx",
    "Q2_Q9_rule_report",
    "K1_encounter_fact",
    "K2_observation_fact",
    "A1_patient_dim",
    "A2_message_metrics",
    "A4_ed_hourly_census",
    "A6_ed_daily_summary",
    "A8_department_census_current",
    "A18_observation_summary",
    "F2_ed_forecast_features",
    "F3_combined_features",
    "A9_F12_forecast_accuracy",
    "A49_digest",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    feed.feed_messages(spark, sf_dir)
    feed.landed_files(spark, sf_dir)
    times = {}
    for name in only or HEADLINE:
        spent = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name][0](Context(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - start)
        times[name] = round(statistics.median(spent[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
