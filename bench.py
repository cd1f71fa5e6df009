"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the threads, BENCH_RUNS the timed runs per query
(the median counts, after one warm-up), BENCH_QUERIES a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.plans import QUERIES, Tables
from tidemark.session import build

HEADLINE = [
    "hot_items_top3", "hot_urls_top5", "word_count", "running_sum", "top3_rows", "session_count",
    "tumble_sum", "hop_sum", "hop_panes", "pv_uv_ratio", "count_tumble", "count_slide", "late_windows",
    "join_inner", "join_left3", "join_interval", "join_interval_left", "reconcile_timeout",
    "control_asof", "dim_lookup", "changelog_fold", "changelog_enrich", "not_falling_alert",
    "login_fail_span", "order_timeout", "pattern_followed", "weighted_avg", "lateral_split",
]
# Streams start a query, run its batches and stop; one timed run each.
STREAMS = ["stream_tumble_sum", "stream_hot_items_top3", "stream_join_interval", "stream_pattern_next"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",")
    names = [n for n in names if n] or HEADLINE + STREAMS
    spark = build("bench", f"local[{cpus}]", **{
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, folder)

    def once(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name].run(tables).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        if name.startswith("stream_"):
            seconds[name] = round(once(name), 3)
            continue
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
