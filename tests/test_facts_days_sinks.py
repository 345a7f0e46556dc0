"""Typed facts, one-day reports without data, snapshots under replay, NULL keys, repeated keys."""

import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.functions import sql
from marketlake.operators import order
from marketlake.operators import facts, logs, lookup, reports, routing, visitors
from marketlake.operators.joins import merge_first_non_null
from marketlake.session import new_location, shared_root
from marketlake.sinks import writers
from marketlake.sources import readers
from helpers import DAY, log_df, log_row


def test_quoted_numbers_keep_the_row(spark):
    lines = ['{"common":{"mid":"m"},"page":{"page_id":"home","during_time":"1200"},"ts":"1000"}',
             '{"common":{"mid":"m"},"page":{"page_id":"home","during_time":7},"displays":[{"item":"1","order":"3"}],"ts":2000}',
             '{"common":{"mid":"m"},"page":{"page_id":"home","during_time":"soon"},"ts":3000}', 'not json']
    raw = spark.createDataFrame(list(enumerate(lines)), "seq long, value string")
    got = {r.seq: r for r in logs.parse_log(raw).collect()}
    assert sorted(got) == [0, 1, 2]
    assert (got[0].page.during_time, got[0].ts) == (1200, 1000) and got[1].displays[0].order == 3
    assert got[2].page.during_time is None
    assert [r.value for r in logs.dirty_log(raw).collect()] == ["not json"]


def test_typed_facts_and_dead_letters(spark):
    lines = ['{"id":"5","province_id":1,"user_id":"9","total_amount":"12.30","create_time":"2024-01-02 03:04:05"}',
             '{"id":6,"total_amount":7}', '{"total_amount":1}', 'broken']
    raw = spark.createDataFrame(list(enumerate(lines)), "seq long, value string")
    got = {r.id: r for r in facts.typed_facts(raw, "order_info", offset_hours=0).collect()}
    assert set(got) == {5, 6} and got[5].user_id == 9 and got[5].total_amount == Decimal("12.30")
    assert (got[5].create_date, got[5].create_hour, got[5].create_ts) == ("2024-01-02", "03", 1704164645000)
    assert [r.seq for r in facts.dirty_facts(raw, "order_info").collect()] == [2, 3]
    pay = spark.createDataFrame([('{"id":1,"order_id":2,"total_amount":"3.5","callback_time":"2024-01-01 00:00:00"}',)], "value string")
    assert facts.typed_facts(pay, "payment_info").first().total_amount == Decimal("3.50")


def test_a_day_without_data_still_answers(spark):
    vs = spark.createDataFrame([], "stt string, vc string, is_new string, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long")
    hours = reports.hour_densify(reports.visitor_by_hour(vs, "20240101"), "20240101").collect()
    assert len(hours) == 24 and {(r.uv_ct, r.pv_ct, r.new_uv) for r in hours} == {(0, 0, 0)}
    rows = reports.visitor_transpose(reports.visitor_by_new_flag(vs, "20240101"), "20240101")
    assert rows.count() == 5 and {(r.new, r.old) for r in rows.collect()} == {(0.0, 0.0)}
    table = json.loads(reports.visitor_table(rows, "20240101").first().json)
    assert len(table["data"]["columns"]) == 3 and len(table["data"]["rows"]) == 5 and table["data"]["combineNum"] == 1
    ps = spark.createDataFrame([], "stt string, spu_id long, spu_name string, category3_id long, category3_name string, "
                                   "order_amount decimal(38,2), order_ct long")
    spu = json.loads(reports.spu_table(reports.by_spu(ps, 10, "20240101"), "20240101").first().json)
    assert spu["data"]["rows"] == [] and [c["id"] for c in spu["data"]["columns"]] == ["spu_name", "order_amount", "order_ct"]
    c3 = reports.category3_list(reports.by_category3(ps, 10, "20240101"), "20240101").first()
    assert json.loads(c3.json) == {"status": 0, "data": []}
    prov = spark.createDataFrame([("20240101", "b", Decimal(2)), ("20240101", "a", Decimal(1))],
                                 "dt string, province_name string, order_amount decimal(38,2)")
    assert json.loads(reports.province_map(prov).first().json)["data"]["mapData"] == [
        {"name": "a", "value": 1.0}, {"name": "b", "value": 2.0}]


def test_null_visitor_is_a_visitor(spark):
    b = 19675 * DAY
    rows = [log_row(i, mid, b + i * 1000) for i, mid in enumerate([None, None, "m", None, "m"], 1)]
    df = log_df(spark, rows)
    wide = sorted(r.seq for r in visitors.bounces(df, "10 seconds", ts_bucket_ms=1 << 40).collect())
    assert wide == sorted(r.seq for r in visitors.bounces(df, "10 seconds", ts_bucket_ms=1).collect())
    assert [r.seq for r in visitors.unique_visits(df, seq_bucket=1).orderBy("seq").collect()] == [1, 3]


def test_hot_visitor_needs_no_single_task(spark):
    """One visitor with a third of the rows: the result does not depend on how finely it is split."""
    b = 19675 * DAY
    rows = [log_row(i, "bot" if i % 3 == 0 else f"m{i % 50}", b + i * 700, last="home" if i % 5 else None) for i in range(1, 900)]
    df = log_df(spark, rows)
    a = {r.seq for r in visitors.bounces(df, "10 seconds", ts_bucket_ms=1 << 40).collect()}
    assert a == {r.seq for r in visitors.bounces(df, "10 seconds", ts_bucket_ms=5_000).collect()}


def test_repeated_dimension_and_config_keys_do_not_fan_out(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z")], "id long, name string")
    got = sorted((r.k or 0, r.n) for r in lookup.enrich(fact, dim, "k", {"n": "name"}).collect())
    assert got == [(0, None), (1, "b"), (2, None)]
    ch = spark.createDataFrame([("t", "insert", {"id": "1"})], "table string, type string, data map<string,string>")
    cfg = spark.createDataFrame([("t", "insert", "kafka", "old", None, "id", 1), ("t", "insert", "kafka", "new", None, "id", 2)],
                                "source_table string, operate_type string, sink_type string, sink_table string, "
                                "sink_columns string, sink_pk string, seq long")
    assert [r.sink_table for r in routing.route(ch, cfg).collect()] == ["new"]


def test_report_batches_are_rewritten_on_replay(spark):
    path = new_location(spark, "report")
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1)], "stt string, n long")
    for _ in range(2):
        writers.append_report(df, path, ["stt", "n"], batch_id=7)
    assert spark.read.parquet(path).count() == 1


def test_merge_first_non_null_fields(spark):
    left = spark.createDataFrame([(1, None, None, "x")], "sku_id long, create_date string, order_price double, sku_name string")
    right = spark.createDataFrame([(1, "2024-01-01", 2.5, "y")], "sku_id long, create_date string, order_price double, sku_name string")
    r = merge_first_non_null(left, right, "sku_id").first()
    assert (r.create_date, r.order_price, r.sku_name) == ("2024-01-01", 2.5, "x")


def test_text_source_has_an_arrival_order(spark, tmp_path):
    (tmp_path / "a.log").write_text("one\ntwo\n")
    got = readers.source(spark, "text", str(tmp_path)).orderBy("seq").collect()
    assert [r.value for r in got] == ["one", "two"] and got[0].seq < got[1].seq
    df = spark.createDataFrame([(5, 1, 0), (4, 0, 9), (5, 0, 1)], "ms long, p int, o long")
    ordered = df.orderBy(order.key(F.col("ms"), order.partition_text(F.col("p")), F.col("o"))).collect()
    assert [(r.ms, r.p, r.o) for r in ordered] == [(4, 0, 9), (5, 0, 1), (5, 1, 0)]


def test_sql_functions(spark):
    sql.register(spark)
    assert [r.keyword for r in spark.sql("SELECT keyword FROM keyword_words('Red  Ball 7')").collect()] == ["red", "ball", "7"]
    assert [(r.ct, r.source) for r in spark.sql("SELECT * FROM keyword_counts(1, 0, 2)").collect()] == [(1, "CLICK"), (2, "ORDER")]


def test_topic_declared_as_a_table(spark):
    raw = spark.createDataFrame([('{"common":{"mid":"m"},"page":{"page_id":"good_list","item":"red ball"},"ts":"1000"}',), ("x",)], "value string")
    sql.topic_view(raw, "page_topic")
    sql.register(spark)
    got = spark.sql("SELECT common['mid'] AS mid, keyword, ts FROM page_topic, LATERAL keyword_words(page['item'])").collect()
    assert [(r.mid, r.keyword, r.ts) for r in got] == [("m", "red", 1000), ("m", "ball", 1000)]


def test_renames_and_json_values(spark):
    df = readers.camel_columns(spark.createDataFrame([("a", 1)], "source_table string, sink_pk int"))
    assert df.columns == ["sourceTable", "sinkPk"]
    assert writers.as_json_value(df).first().value == '{"sourceTable":"a","sinkPk":1}'


def test_shared_root_must_be_set_off_local_mode():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        shared_root(Session())
