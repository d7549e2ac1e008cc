"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Every query is
planned and run once, over whole tables, into the noop sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

import pyspark

from shelfmark.plans.queries import REGISTRY
from shelfmark.session import local_session

HEADLINE = (
    "indexable_products", "tombstones", "billable_count", "headline_price", "minor_units", "images", "descriptions",
    "pages_plain_text", "brands", "facets_exploded", "category_names", "stock_legacy", "popularity_scores",
    "variants_exploded", "search_items", "item_batches", "parent_fanout", "coalesced_queue", "queue_state",
    "current_documents", "attributed_order_value", "session_attribution", "order_reports", "delivered_prefix",
    "locale_catalogue",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    spark = local_session(cores, shuffle_partitions=cores, app="shelfmark-bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline queries, total seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cores": cores,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
        "spark": pyspark.__version__,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
