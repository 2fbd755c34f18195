"""Times the load and the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose input and cores. ``build_gold`` is the
full load, run once and cold. Every other query runs five times to a sink that keeps nothing; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from shelfwise import session
from shelfwise.plans import registry

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 5
HEADLINES = [
    "silver_sales", "gold_dim_item", "sales_wide", "filter_options", "kpi_totals", "yoy_ytd", "gauge_target",
    "kpi_tile_reference", "monthly_revenue", "monthly_revenue_panel", "forecast_features", "insights", "yoy_bridge",
    "yoy_bridge_year", "city_map", "pareto_brand", "price_volume_brand", "price_volume_sku", "dq_fact_grain",
    "dq_orphans", "control_totals", "incremental_rows",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {"build_gold": timed(lambda: registry.star(spark, FOLDER))}
    queries = registry.queries()

    def run(name: str) -> None:
        queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()

    for name in HEADLINES:
        seconds[name] = statistics.median(timed(lambda: run(name)) for _ in range(RUNS))
    seconds["forecast_6m"] = timed(lambda: run("forecast_6m"))
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
