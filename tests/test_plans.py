"""Physical-plan properties the design relies on at scale."""

import re

from pyspark.sql import functions as F

from marketlake.operators import lookup, routing, stats, visitors
from marketlake.plans.warehouse import Warehouse
from marketlake.sources import tables as T

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_product_distinct_counts_without_expand(spark):
    w = Warehouse(spark, SF)
    plan = _plan(stats.product_window_sums(w.product_measures, "1 day"))
    assert "Expand" not in plan


def test_neighbour_window_is_split_by_bucket(spark):
    w = Warehouse(spark, SF)
    plan = _plan(visitors.unique_visits(w.page_log))
    specs = re.findall(r"windowspecdefinition\(([^,]+), ([^,]+),", plan)
    assert any(a.startswith("_mid") and b.startswith("_nb_b") for a, b in specs)
    # no window over the raw rows partitioned by the visitor alone
    assert not any(a.startswith("_mid") and b.startswith("seq") for a, b in specs)


def test_json_parsed_once(spark):
    c = routing.clean_changes(routing.parse_changes(T.cdc_raw(spark, SF)))
    assert _plan(c).count("from_json(") == 1  # one parse, above the union of sources


def test_filters_reach_the_scan(spark):
    plan = _plan(T.favor_info(spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,click\)", plan)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan


def test_lookup_broadcasts_only_below_the_planner_threshold(spark):
    dim = T.dim_user(spark, SF)
    fact = T.order_info(spark, SF)
    assert "BroadcastHashJoin" in _plan(lookup.enrich(fact, dim, "user_id", {"g": "gender"}, unique=True))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(lookup.enrich(fact, dim, "user_id", {"g": "gender"}))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


def test_per_day_top_n_limits_before_the_shuffle(spark):
    from marketlake.operators import reports
    w = Warehouse(spark, SF)
    plan = _plan(reports.by_trademark(w.product_stats, 10))
    assert "WindowGroupLimit" in plan


def test_visitor_measures_repair_once(spark):
    """One scan for the pages, two for each neighbour rule, one for the first days."""
    plan = _plan(Warehouse(spark, SF).visitor_measures)
    assert len(re.findall(r"events\.parquet", plan)) <= 6
