"""Times the headline queries and prints one JSON line.

Every query runs to completion into the no-op sink, so all its columns are computed.
BENCH_QUERIES may list other names, or `all`.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from granary.plans import registry  # noqa: E402
from granary.session import build_session  # noqa: E402

HEADLINE = (
    "bronze_orders", "bronze_order_items", "csv_orders", "layout_month", "layout_bucket",
    "fact_order_items", "gold_orders_daily", "gold_revenue_daily", "star_four_dims",
    "promo_effectiveness", "cohort_revenue", "revenue_by_category", "returns_by_product",
    "shipping_by_status", "cardinality_profile", "fanout_meter", "scd2_customers",
    "scd2_asof_lookup", "promo_bridge_revenue", "quality_suite",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = tuple(registry.QUERIES) if chosen == "all" else tuple(filter(None, chosen.split(","))) or HEADLINE
    spark = build_session("granary-bench", f"local[{cpus}]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    registry.run("orders_by_status", spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry.run(name, spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(folder).name}))
    spark.stop()


if __name__ == "__main__":
    main()
