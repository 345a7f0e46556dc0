"""Benchmark the headline queries.

Runs each query end to end (a ``noop`` write forces full execution without collecting rows) on
``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` and prints ONE JSON line:
``{"metric": ..., "value": total sec, "unit": "sec", "queries": {name: median sec}, "sf": ...}``.
Per query: one warm-up run, then the median of ``$BENCH_REPEATS`` timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "new_visitor_repair", "unique_visit", "bounce_as_written", "log_split_page", "order_wide", "payment_wide",
    "visitor_stats", "product_stats_enriched", "province_stats", "keyword_search", "keyword_product",
    "keyword_explode", "by_trademark", "keyword_topn", "visitor_transpose", "cdc_route_fact", "dim_upsert_merge",
]

#: Streaming jobs, timed once after the others and kept out of the total.
STREAMS = ["unique_visit_stream", "product_stats_stream"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from marketlake.plans.catalog import QUERIES
    from marketlake.session import build_session

    spark = build_session(f"local[{cpus}]", app="marketlake-bench", shuffle_partitions=int(cpus),
                          extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    out: dict[str, float] = {}
    for n in names:
        def run() -> float:
            t = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        run()
        out[n] = round(statistics.median(run() for _ in range(max(1, repeats))), 3)
    streams: dict[str, float] = {}
    for n in STREAMS if names == HEADLINE else []:
        t = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        streams[n] = round(time.perf_counter() - t, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "streams": streams, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
                      "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
