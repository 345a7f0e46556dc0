"""Keyword reports over many order lines: one pass over the lines, clicks without a lambda, words once per product."""

import re

import pytest
from pyspark.sql import functions as F

from marketlake.functions import timefmt
from marketlake.operators import joins, reports, stats
from marketlake.plans.catalog import QUERIES
from marketlake.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark):
    """Lines of a repeated order, of one without a payment, without an id; lines alike; empty amounts and skus."""
    rows = [(1, 10, 2, "1.10", 5000), (1, 10, 2, "1.10", 5000), (1, None, 1, None, 5000), (2, 10, 3, "2.00", 0), (3, 11, None, "0.00", 86_400_000),
            (4, 10, 1, "7.00", 90_000_000), (None, 10, 1, "9.00", 5000), (1, 10, 4, "5.00", 7000), (5, 12, 1, None, 5000)]
    return spark.createDataFrame(rows, "order_id long, sku_id long, sku_num long, amount string, create_ts long").select(
        "order_id", "sku_id", "sku_num", F.col("amount").cast("decimal(18,2)").alias("split_total_amount"), "create_ts",
        F.lit("x").alias("create_time"), F.lit(0).cast("bigint").alias("user_id"), F.lit(None).cast("decimal(18,2)").alias("total_amount"))


def _payments(spark):
    """Two payments in time, two alike, too early, too late, at both ends, without an order, a time or a callback."""
    day = "1970-01-01 00:00:"
    rows = [(1, 1, day + "06", day + "06"), (2, 1, day + "07", day + "08"), (3, 1, day + "07", day + "08"), (4, 1, day + "01", day + "02"),
            (5, 1, day + "06", None), (6, 1, None, day + "05"), (7, 3, "1970-01-02 01:00:00", "1970-01-02 00:30:00"), (8, 4, "1970-01-02 02:00:00", "1970-01-02 02:00:00"),
            (9, None, day + "06", day + "06"), (10, 9, day + "06", day + "06"), (11, 5, "1970-01-03 00:00:00", day + "05")]
    return spark.createDataFrame(rows, "id long, order_id long, create_time string, callback_time string").select(
        "*", F.lit("s").alias("subject"), F.lit("t").alias("payment_type"), F.lit(0).cast("bigint").alias("user_id"),
        F.lit(None).cast("decimal(18,2)").alias("total_amount"))


def _streams(spark, one_pass):
    lines, pay, w = _lines(spark), _payments(spark), Warehouse(spark, SF)
    from marketlake.operators import logs
    from marketlake.sources import tables as T
    rest = T.order_refund_info(spark, SF), T.comment_info(spark, SF)
    seen = logs.split_page(w.plain_log), T.favor_info(spark, SF), T.cart_info(spark, SF)
    if one_pass:
        return stats.product_streams(*seen, joins.lines_with_payments(pay, lines), None, *rest)
    return stats.product_streams(*seen, lines, joins.payment_wide(pay, lines, create_ts=True), *rest)


def test_lines_with_payments_are_the_lines_and_the_payment_rows(spark):
    both = joins.lines_with_payments(_payments(spark), _lines(spark))
    cols = ["order_id", "sku_id", "sku_num", "split_total_amount", "create_ts"]
    assert sorted(map(str, both.where("line_first").select(*cols).collect())) == sorted(map(str, _lines(spark).select(*cols).collect()))
    cols = ["order_id", "sku_id", "split_total_amount", "payment_create_ts"]
    apart = joins.payment_wide(_payments(spark), _lines(spark), create_ts=True).select(*cols).collect()
    assert len(apart) == 16   # three lines x four payments, two for the later line, one at either end of the range
    assert sorted(map(str, both.where("line_paid").select(*cols).collect())) == sorted(map(str, apart))


def test_one_pass_gives_the_rows_and_sums_of_two(spark):
    one, two = _streams(spark, True), _streams(spark, False)
    assert [k for k, _ in one] == [None, None, None, ("order", "paid"), "refund", None]
    rows = [sorted(map(str, stats.product_union(s).collect())) for s in (one, two)]
    assert rows[0] == rows[1]
    for size in ("10 seconds", "1 day"):
        sums = [sorted(map(str, stats.product_window_sums(s, size).collect())) for s in (one, two, stats.product_union(two))]
        assert sums[0] == sums[1] == sums[2]


@pytest.mark.parametrize("name", ["name_value_list", "keyword_topn"])
def test_order_lines_are_joined_once(spark, no_broadcast, name):
    plan = _plan(QUERIES[name](spark, SF)).splitlines()
    # order lines with the time of their order: the time is read by one join of lineitem and orders
    assert len([x for x in plan if re.search(r"SortMergeJoin \[l_orderkey#\d+L\], \[o_orderkey#\d+L\]", x)]) == 1
    assert not [x for x in plan if "lambda" in x]


def test_clicks_and_displays_of_odd_pages(spark):
    shown = "array<struct<item:string,item_type:string,display_type:string,order:bigint,pos_id:string>>"
    d = lambda *xs: [(i, t, "r", 1, "1") for i, t in xs]
    rows = [(1, None, ("good_detail", "7"), d(("8", "sku_id"), ("9", "activity_id"), (None, "sku_id"), ("8", "sku_id"))),
            (2, None, ("good_detail", None), None), (3, None, ("home", "7"), d(("x", "sku_id"))), (4, None, None, []),
            (5, {"entry": "icon"}, ("good_detail", "7"), d(("8", "sku_id"))), (6, {}, (None, "7"), [None] + d((" 8", None)))]
    log = spark.createDataFrame(rows, f"ts long, start map<string,string>, page struct<page_id:string,item:string>, displays {shown}")
    got = [(r.ts, r.sku_id, r.click_ct, r.display_ct) for r in stats._seen_rows(log).collect()]
    assert sorted(got, key=str) == sorted([(1, 7, 1, 0), (1, 8, 0, 1), (1, None, 0, 1), (1, 8, 0, 1), (2, None, 1, 0), (3, None, 0, 1), (5, 7, 1, 0)], key=str)


@pytest.mark.parametrize("name", ["name_value_list", "keyword_topn", "keyword_product"])
def test_words_are_cut_once_per_product(spark, no_broadcast, name):
    """No pattern runs over the products' sums: their words come with the lookup, cut on the rows of part."""
    plan = _plan(QUERIES[name](spark, SF)).splitlines()
    cuts = [x for x in plan if "regexp_extract_all" in x and "_extract_item#" not in x and "FileScan" not in x]
    assert cuts and all("p_name#" in x for x in cuts)


def test_words_of_the_lookup_are_those_of_the_name(spark):
    rows = [("Red ring", 1, 0, 2), ("a-a", 0, 3, None), (None, 1, 1, 1), ("--", 1, 1, 1), ("x", 0, None, 0), ("Été 9", None, None, 5)]
    ps = spark.createDataFrame([(*r, "2024-01-02 00:00:00", "e") for r in rows], "sku_name string, click_ct long, cart_ct long, order_ct long, stt string, edt string")
    of = [stats.keyword_product_stats(d, as_of_ms=0) for d in (ps, ps.withColumn("sku_words", stats.words("sku_name")).withColumn("sku_name", F.lit("no")))]
    assert of[0].columns == of[1].columns == stats.KEYWORD_STATS_COLUMNS
    got = [sorted(map(str, d.collect())) for d in of]
    assert got[0] == got[1] and len(got[0]) == 4 + 2 + 2


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai", "America/New_York"])
def test_day_of_millis_is_that_of_the_window_text(spark, zone):
    millis = [0, -1, 1710037800000, 253402300799999, 253402300800000, -62135596800000, -62135596800001 + 1, 86_399_999, 86_400_000, None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        d = spark.createDataFrame([(m,) for m in millis], "ms long").withColumn("stt", F.date_format(timefmt.millis_to_ntz("ms"), timefmt.DATETIME_FMT))
        got = reports.with_day(d.withColumn("day", timefmt.day_from_millis("ms"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.day for r in got] == [r.dt for r in got] and {r.ms: r.day for r in got}[-1] == "19691231"


def test_day_of_a_keyword_needs_no_window_text(spark):
    plan = _plan(Warehouse(spark, SF).keyword_stats.groupBy("dt").agg(F.sum("ct")))
    assert "date_from_unix_date" in plan and not re.search(r"date_format\([^)]*_start", plan)
