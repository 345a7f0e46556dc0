"""Batch run of the whole warehouse, one layer at a time.

Each shared layer is written once as a table under the shared root (``spark.checkpoint.dir``) and
read back by its consumers: this cuts lineage (a lost executor re-reads a table instead of
recomputing the DAG above it) and stops several consumers from recomputing the same joins.  The
aggregate tables are partitioned by ``dt`` so a one-day report reads one folder.

    python -m marketlake.plans.build /root/testdata/sf0.1 [yyyyMMdd]
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from ..operators import joins, reports, stats
from ..sources import tables as T
from .warehouse import Warehouse


def build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    w = Warehouse(spark, sf_dir)
    p = w.params
    out: dict[str, DataFrame] = {}
    # detail layer: the repaired page log, written once
    out["page_log"] = page_log = w.materialize(w.page_log, "dwd_page_log", partition_by=None)
    # middle layer
    out["unique_visits"] = uv = w.materialize(stats_free(w, "unique_visits", page_log), "dwm_unique_visit", None)
    out["bounces"] = uj = w.materialize(stats_free(w, "bounces", page_log), "dwm_user_jump_detail", None)
    out["order_lines"] = lines = w.materialize(w.order_lines, "dwm_order_lines", None)
    out["order_wide"] = wide = w.materialize(joins.enrich_order_wide(lines, w.dims, p.as_of_ms), "dwm_order_wide", None)
    paid = joins.payment_wide(T.payment_info(spark, sf_dir), wide, within=p.payment_within)
    out["payment_wide"] = paid = w.materialize(paid, "dwm_payment_wide", None)
    # summary layer (dt-partitioned)
    out["visitor_stats"] = w.materialize(
        stats.visitor_stats(stats.visitor_measures(page_log, uv, uj), p.visitor_window, as_of_ms=p.as_of_ms),
        "visitor_stats")
    measures = stats.product_measures(page_log, T.favor_info(spark, sf_dir), T.cart_info(spark, sf_dir), wide, paid,
                                      T.order_refund_info(spark, sf_dir), T.comment_info(spark, sf_dir))
    out["product_stats"] = ps = w.materialize(stats.product_stats(measures, w.dims, p.window, as_of_ms=p.as_of_ms),
                                              "product_stats")
    out["province_stats"] = w.materialize(stats.province_stats(wide, p.window, as_of_ms=p.as_of_ms), "province_stats")
    ks = stats.keyword_search_stats(page_log, p.window, as_of_ms=p.as_of_ms)
    kp = stats.keyword_product_stats(ps, as_of_ms=p.as_of_ms)
    out["keyword_stats"] = w.materialize(stats.union_all([ks, kp]), "keyword_stats")
    out["_timings"] = w.timings
    return out


def stats_free(w: Warehouse, which: str, page_log: DataFrame) -> DataFrame:
    from ..operators import visitors
    if which == "unique_visits":
        return visitors.unique_visits(page_log)
    return visitors.bounces(page_log, w.params.bounce_within)


def day_reports(t: dict[str, DataFrame], date: str) -> dict[str, DataFrame]:
    """The dashboard for one day over the materialised tables (partition-pruned to ``dt=date``)."""
    ps, vs = t["product_stats"], t["visitor_stats"]
    return {
        "gmv": reports.gmv(ps, date), "trademark": reports.by_trademark(ps, 10, date),
        "category3": reports.by_category3(ps, 10, date), "spu": reports.by_spu(ps, 10, date),
        "province": reports.by_province(t["province_stats"], date),
        "visitor": reports.visitor_transpose(reports.visitor_by_new_flag(vs, date), date),
        "hour": reports.hour_densify(reports.visitor_by_hour(vs, date), date),
        "keyword": reports.keyword_topn(t["keyword_stats"], 20, date),
    }


def main() -> None:
    from ..session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(None if "--cluster" in sys.argv else "local[*]")
    t0 = time.time()
    tables = build(spark, sf)
    timing = {"build_sec": round(time.time() - t0, 2), "layers": tables.pop("_timings")}
    date = next((a for a in sys.argv[2:] if a.isdigit()), None) or \
        tables["product_stats"].agg({"dt": "max"}).first()[0]
    for name, df in day_reports(tables, date).items():
        t1 = time.time()
        rows = df.collect()
        timing[name] = {"sec": round(time.time() - t1, 3), "rows": len(rows)}
    print(json.dumps({"date": date, **timing}))


if __name__ == "__main__":
    main()
