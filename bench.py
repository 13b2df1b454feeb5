"""Times the headline queries and prints one JSON line.

Every query is timed to the last row of its result (``noop`` sink): once cold, then warm.
The reported time per query is the median of the warm runs; the load of the warehouse is
timed on its own, because queries read the loaded tables.
"""

import json
import os
import platform
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from basketry.plans.mart import open_mart
from basketry.registry import QUERIES

HEADLINE = (
    "top_products", "peak_hours", "day_of_week", "department_performance",
    "customer_segmentation", "aisle_reorder", "basket_size_distribution", "weekend_vs_weekday",
    "product_reorder_patterns", "sunday_orders", "weekend_counts", "all_day_counts",
    "order_range_lines", "summary_statistics", "overview_kpis", "day_trends", "hour_trends",
    "weekend_comparison", "departments", "products", "aisles", "customer_segments",
    "basket_distribution", "warehouse_checks", "sql_quality_checks", "source_violations",
    "reconcile_totals", "baskets", "sampled_baskets", "frequent_itemsets",
    "frequent_itemsets_products", "generate_rules", "user_features", "standardize",
    "silhouette_of_segments", "cluster_popularity", "recommend_by_rules", "hybrid_recommend",
)
WARM_RUNS = 2


def timed(call) -> float:
    started = time.perf_counter()
    call()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm, cold = {}, {}
    warm["warehouse_load"] = cold["warehouse_load"] = timed(lambda: open_mart(spark, folder))
    for name in HEADLINE:
        def run(query=QUERIES[name]):
            query(spark, folder).write.format("noop").mode("overwrite").save()

        cold[name] = timed(run)
        warm[name] = statistics.median(timed(run) for _ in range(WARM_RUNS))
    print(json.dumps({
        "metric": "total warm seconds of the warehouse load and the headline queries",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 3) for name, seconds in warm.items()},
        "cold": {name: round(seconds, 3) for name, seconds in cold.items()},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
        "python": platform.python_version(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
