"""Headline queries, timed one by one: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and, for a
selection, BENCH_QUERIES (comma-separated names).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from checks.queries import QUERIES
from footfall.session import local_session

HEADLINE = [
    "parse_actions_general",
    "parse_actions_news",
    "ingest_counts",
    "resolve_identity",
    "action_detail",
    "user_item_weight",
    "item_count",
    "hot_items",
    "hot_by_category",
    "user_pair_weight",
    "pair_count",
    "pair_increment",
    "item_neighbours",
    "item_cf",
    "basket_cf",
    "ctr_daily",
    "ctr_lists",
    "user_recent",
    "user_filter_list",
    "tag_index",
    "profile_top_tags",
    "top_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "bench")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
