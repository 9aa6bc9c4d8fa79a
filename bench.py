"""Time the headline queries: one JSON line on standard output.

Each query is planned, run and drained in full (no rows are kept) at $BENCH_SF_DIR on
local[$BENCH_CPUS].
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from floorlens.plans.present import present  # noqa: E402
from floorlens.plans.registry import all_queries  # noqa: E402
from floorlens.session import build_session  # noqa: E402
from floorlens.sources.bind import bind  # noqa: E402

HEADLINE = [
    "v1_machine_daily", "v2_location_performance", "v3_player_summary", "v4_machine_health", "v5_executive_kpis",
    "f1_player_churn", "f2_machine_failure", "f3_daily_forecast", "f4_machine_anomaly", "f5_weekly_forecast",
    "m2_top_machines", "m4_machine_ranking", "m11_seven_day_average", "m15_best_worst_machine",
    "p5_player_ranking", "p7_rfm", "p12_preferred_location", "p17_cohort_retention",
    "l7_daily_trend", "l8_monthly", "l12_player_mobility", "h8_mtbf", "h14_maintenance_priority",
    "h15_replacement", "e1_executive_kpis", "e2_daily_trend", "e12_master_dataset", "q2_orphans",
    "q9_relationship_agreement", "ml14_anomaly_output",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "floorlens-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    names = sys.argv[1:] or HEADLINE
    bind(spark, sf_dir).transaction.limit(1).collect()  # start the JVM's code paths outside the timings
    timings = {}
    for name in names:
        began = time.perf_counter()
        present(registered[name](bind(spark, sf_dir))).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - began, 3)
        print(f"{timings[name]:8.3f}s {name}", file=sys.stderr, flush=True)
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time", "value": total, "unit": "sec",
                "queries": timings, "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
