"""Time the headline queries on the given tables; prints one JSON line.

BENCH_SF_DIR  directory of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from greenledger.registry.catalog import QUERIES  # noqa: E402
from greenledger.session import build_session  # noqa: E402

HEADLINE = (
    "demand_weekly",
    "energy_price_weekly",
    "telemetry_weekly_rows",
    "densify_zero",
    "plan_backschedule",
    "wip_by_age",
    "initial_wip_fifo",
    "utilization_weekly",
    "cost_breakdown",
    "cost_breakdown_by_facility",
    "constraint_audit",
    "issues_all",
    "plan_certificate",
    "scenario_sweep",
    "policy_sweep",
    "report_summary",
    "labor_schedule",
    "cost_cube",
    "asof_price",
    "run_aggregate",
    "run_all",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "greenledger-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("demand_weekly")  # starts the JVM and its compiler
    times = {name: run(name) for name in names}
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
