"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesmart.plans.catalog import all_queries  # noqa: E402
from salesmart.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "silver_enriched",
    "dedup_first",
    "quality_counts",
    "silver_rebuild",
    "mart_sales",
    "upsert_mart_sales",
    "rfm_full",
    "rfm_incremental",
    "mart_inventory",
    "upsert_mart_inventory",
    "inventory_after_sales",
    "inventory_new_alerts",
    "inventory_replay",
    "affinity_pair_support",
    "affinity_rules",
    "user_item_spend",
    "spend_top5_per_customer",
    "cf_recommendations",
    "fast_track_json",
    "card_top10_products_7d",
    "card_segment_summary",
    "panel_hourly_by_store_24h",
    "panel_top20_customers",
)


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark_sql_shuffle_partitions=CPUS,
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
    catalogue = all_queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        catalogue[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run("mart_sales")  # start the JVM's code paths and the page cache
    only = sys.argv[1:] or HEADLINE
    times = {name: round(statistics.median(run(name) for _ in range(3)), 3) for name in only}
    line = {
        "metric": "total seconds, headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
