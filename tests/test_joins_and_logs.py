import json

from pyspark.sql import functions as F

from marketlake.operators import joins, logs, routing
from marketlake.schemas import ORDER_DETAIL, ORDER_INFO, PAYMENT_INFO, TABLE_PROCESS
from helpers import log_df, log_row


def _orders(spark, rows):
    # rows: (id, create_ts)
    data = [dict(id=i, province_id=1, order_status="1001", user_id=7, create_time="2024-01-01 00:00:00",
                 create_ts=t) for i, t in rows]
    return spark.createDataFrame([tuple(d.get(f.name) for f in ORDER_INFO.fields) for d in data], ORDER_INFO)


def _details(spark, rows):
    # rows: (order_id, sku_id, create_ts)
    data = [dict(order_id=o, sku_id=s, sku_num=1, create_ts=t) for o, s, t in rows]
    return spark.createDataFrame([tuple(d.get(f.name) for f in ORDER_DETAIL.fields) for d in data], ORDER_DETAIL)


def test_order_interval_join_bounds(spark):
    base = 1_000_000
    o = _orders(spark, [(1, base)])
    d = _details(spark, [(1, 10, base), (1, 11, base + 5), (1, 12, base - 5), (1, 13, base + 6), (1, 14, base - 6),
                         (2, 15, base)])
    got = sorted(r.sku_id for r in joins.order_detail_join(o, d).collect())
    assert got == [10, 11, 12]


def test_payment_interval_join(spark):
    pay_ms = 10_000_000_000
    wide = spark.createDataFrame(
        [(1, 100, 7, "t", pay_ms - 1_800_000), (1, 101, 7, "t", pay_ms), (1, 102, 7, "t", pay_ms),
         (2, 200, 7, "t", pay_ms - 1_801_000), (3, 300, 7, "t", pay_ms + 1_000)],
        "order_id long, sku_id long, user_id long, create_time string, create_ts long")
    wide = wide.withColumn("total_amount", F.lit(1).cast("decimal(18,2)"))
    cb = "1970-04-26 17:46:40"  # = pay_ms
    pay = spark.createDataFrame(
        [tuple(dict(id=o * 10, order_id=o, user_id=99, total_amount=None, subject="s", payment_type="1101",
                    create_time=cb, callback_time=cb).get(f.name) for f in PAYMENT_INFO.fields) for o in (1, 2, 3)],
        PAYMENT_INFO)
    out = joins.payment_wide(pay, wide).collect()
    assert sorted(r.sku_id for r in out) == [100, 101, 102]
    assert {r.user_id for r in out} == {99}  # the payment's value wins on shared names
    assert {r.payment_id for r in out} == {10}


def test_log_split(spark):
    raw = spark.createDataFrame([
        (1, json.dumps({"common": {"mid": "a"}, "start": {}, "page": {"page_id": "home"}, "ts": 1})),
        (2, json.dumps({"common": {"mid": "a"}, "start": {"entry": "icon"}, "ts": 2})),
        (3, json.dumps({"common": {"mid": "a"}, "page": {"page_id": "good_list"},
                        "displays": [{"item": "1", "item_type": "sku_id"}, {"item": "2", "item_type": "activity_id"}],
                        "ts": 3})),
        (4, json.dumps({"common": {"mid": "a"}, "page": {"page_id": "home"}, "displays": [], "ts": 4})),
        (5, "not json {"),
    ], "seq long, value string")
    parsed = logs.parse_log(raw)
    assert sorted(r.seq for r in logs.split_start(parsed).collect()) == [2]
    assert sorted(r.seq for r in logs.split_page(parsed).collect()) == [1, 3, 4]
    disp = logs.explode_displays(parsed).collect()
    assert sorted((r.seq, r.item, r.page_id) for r in disp) == [(3, "1", "good_list"), (3, "2", "good_list")]
    page3 = logs.split_page(parsed).filter("seq = 3").select("displays").first()[0]
    assert "page_id" not in page3[0].asDict()
    assert [r.seq for r in logs.dirty_log(raw).collect()] == [5]


CONFIG = [
    ("base_trademark", "insert", "hbase", "dim_base_trademark", "id,tm_name", "id", None),
    ("spaced", "insert", "hbase", "dim_spaced", "id, tm_name", "id", None),
    ("order_info", "insert", "kafka", "dwd_order_info", "id,total_amount", "id", None),
    ("payment_info", "insert", "clickhouse", "x", "id", "id", None),
]


def _changes(spark, rows):
    return spark.createDataFrame(rows, "seq long, table string, type string, data map<string,string>")


def test_cdc_route(spark):
    ch = _changes(spark, [
        (1, None, "insert", {"id": "1"}), (2, "order_info", "insert", None), (3, "order_info", "insert", {}),
        (4, "unknown", "insert", {"id": "4"}), (5, "base_trademark", "insert", {"id": "5", "tm_name": "x", "logo": "l"}),
        (6, "spaced", "insert", {"id": "6", "tm_name": "y"}), (7, "order_info", "insert", {"id": "7", "total_amount": "1", "z": "2"}),
        (8, "payment_info", "insert", {"id": "8"}), (9, "order_info", "bootstrap-insert", {"id": "9"}),
    ])
    cfg = spark.createDataFrame(CONFIG, TABLE_PROCESS)
    clean = routing.clean_changes(ch)
    assert sorted(r.seq for r in clean.collect()) == [4, 5, 6, 7, 8, 9]
    assert sorted(r.seq for r in routing.unmatched(clean, cfg).collect()) == [4, 9]
    r = routing.route(clean, cfg)
    dims = {row.seq: dict(row.data) for row in routing.dims(r).collect()}
    assert dims == {5: {"id": "5", "tm_name": "x"}, 6: {"id": "6"}}
    facts = {row.seq: dict(row.data) for row in routing.facts(r).collect()}
    assert facts == {7: {"id": "7", "total_amount": "1"}}
    r2 = routing.route(clean, cfg, normalize_bootstrap=True)
    assert sorted(row.seq for row in routing.facts(r2).collect()) == [7, 9]


def test_latest_config(spark):
    feed = spark.createDataFrame([
        (1, "insert", {"source_table": "a", "operate_type": "insert", "sink_type": "hbase", "sink_table": "t1"}),
        (2, "update", {"source_table": "a", "operate_type": "insert", "sink_type": "kafka", "sink_table": "t2"}),
        (3, "insert", {"source_table": "b", "operate_type": "insert", "sink_type": "hbase", "sink_table": "t3"}),
        (4, "delete", {"source_table": "b", "operate_type": "insert"}),
    ], "seq long, type string, data map<string,string>")
    got = {(r.source_table, r.sink_type, r.sink_table) for r in routing.latest_config(feed).collect()}
    assert got == {("a", "kafka", "t2")}


def test_dim_upsert(spark):
    empty = spark.createDataFrame([], "id string, data map<string,string>")
    b1 = _changes(spark, [(1, "t", "insert", {"id": "1", "a": "a1", "b": "b1"})]).drop("table")
    snap = routing.merge_dimension(empty, b1)
    b2 = _changes(spark, [(2, "t", "update", {"id": "1", "a": "a2"}), (3, "t", "update", {"id": "1", "a": "a3"}),
                          (4, "t", "update", {"id": "2", "c": "c2"}), (5, "t", "delete", {"id": "1"})]).drop("table")
    out = {r.id: dict(r.data) for r in routing.merge_dimension(snap, b2).collect()}
    assert out == {"1": {"id": "1", "a": "a3", "b": "b1"}, "2": {"id": "2", "c": "c2"}}


def test_merge_first_non_null(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "p", None)], "order_id long, order_status string, sku_name string")
    b = spark.createDataFrame([(1, "q", "y"), (2, "r", "z")], "order_id long, order_status string, sku_name string")
    got = sorted(tuple(r) for r in joins.merge_first_non_null(a, b, "order_id").collect())
    assert got == [(1, "q", "x"), (2, "p", "z")]


def test_report_date():
    from marketlake.operators.reports import report_date
    assert report_date(0, 1735689600000) == "20250101"
    assert report_date(20240105) == "20240105" and report_date(None) is None
