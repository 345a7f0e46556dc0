"""What a larger input costs: bytes that meet in one task, passes over the input, rows that a state holds."""

import os
import random
import re
from decimal import Decimal

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from marketlake.functions import timefmt
from marketlake.operators import reports, routing, stats
from marketlake.operators.neighbors import asof, bucket_of
from marketlake.schemas import TABLE_PROCESS
from marketlake.plans.catalog import QUERIES
from marketlake.plans.warehouse import Warehouse
from marketlake.sources import tables as T
from marketlake.streaming import jobs
from test_streaming import FakeState

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _changes(spark):
    rows = [(i, "order_detail", "insert", {"order_id": str(i)}) for i in range(50)] + [(60, "other", "insert", {"id": "1"})]
    return spark.createDataFrame(rows, "seq long, table string, type string, data map<string,string>")


def test_routing_never_sends_the_records_of_a_table_to_one_task(spark):
    """Only the config is exchanged, for its own aggregate or window; the records meet it where they are."""
    changes, config = _changes(spark), spark.createDataFrame(T.ROUTING_CONFIG, TABLE_PROCESS)
    for df in (routing.route(changes, config), routing.unmatched(changes, config), routing.route_asof(changes, T.config_feed(spark))):
        plan = _plan(df)
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert routing.route(changes, config).count() == 50
    twice = config.unionByName(config)
    assert [r.seq for r in routing.unmatched(changes, twice).collect()] == [60]


def test_asof_by_buckets_and_by_spans_agree(spark):
    rnd = random.Random(5)
    left = spark.createDataFrame([(rnd.choice(["hot", "hot", "a", None]), rnd.choice([None, rnd.randrange(900)]), i) for i in range(2000)],
                                 "k string, o long, id long")
    right = spark.createDataFrame(list({(k, o): (k, o, n) for n, (k, o) in enumerate((rnd.choice(["hot", "b", None]), rnd.randrange(900))
                                                                                    for _ in range(80))}.values()), "k string, o long, v long")
    found = [sorted((r.id, r.f and r.f.v) for r in asof(left, right, ["k"], "o", ["v"], bucket=bucket_of("o", 50), name="f", most=m, few=few).collect())
             for m, few in ((None, 10**5), (None, 0), (300, 0), (None, 10))]
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) == 2000
    assert any(v for _, v in found[0])


def _frame(rows):
    from marketlake.streaming.processors import FLAT_COLUMNS
    return pd.DataFrame([{**{c: None for c in FLAT_COLUMNS}, "seq": s, "mid": m, "ts": t, "last_page_id": p} for s, m, t, p in rows])


def _bounces(rows, within, documented):
    """A plain loop over each visitor's rows."""
    out, by = [], {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for mine in by.values():
        mine.sort(key=lambda r: (r[2], r[0]))
        for a, b in zip(mine, mine[1:] + [None]):
            if not a[3] and (b is None or b[2] - a[2] >= within or (documented and not b[3])):
                out.append(a[0])
    return sorted(out)


@pytest.mark.parametrize("small", [1, 10, 20_000])
def test_bounces_of_a_group_of_visitors_equal_a_loop(monkeypatch, small):
    """Several visitors in one state, in any number of rows at a time, with gaps of many slices."""
    from marketlake.streaming import processors
    monkeypatch.setattr(processors, "SMALL", small)
    for seed in range(40):
        rnd, t, rows = random.Random(seed), 0, []
        within, documented = rnd.choice([1, 7, 50]), seed % 2 == 1
        for k in range(rnd.randrange(1, 100)):
            t += rnd.choice([0, 0, 1, 3, 10, 60, 300])
            rows.append((k, rnd.choice(["a", "b", "c", None]), t, rnd.choice([None, "", "home"])))
        state, job, got, wm = FakeState(), processors.BounceDetector(within, documented), [], 0
        job.init(state)
        at = 0
        while at < len(rows):
            batch, at = rows[at: at + 17], at + 17
            rnd.shuffle(batch)
            got += [s for f in job._run(iter([_frame(batch[:9])] + ([_frame(batch[9:])] if batch[9:] else [])), wm) for s in f.seq]
            wm = max(wm, max(r[2] for r in batch) - 5)
            if any(x <= wm for x in state.timers):
                got += [s for f in job._run(iter(()), wm) for s in f.seq]
        got += [s for f in job._run(iter(()), 10**9) for s in f.seq]
        assert sorted(got) == _bounces(rows, within, documented) and not state.d


def _times(staged):
    """The files of a staged input in the order a stream takes them -> (first, last) time of each."""
    found = sorted(os.listdir(staged.path.replace("file:", "")), key=lambda f: os.path.getmtime(f"{staged.path.replace('file:', '')}/{f}"))
    return [(min(t), max(t)) for f in found if f.endswith(".parquet")
            if (t := pq.read_table(f"{staged.path.replace('file:', '')}/{f}", columns=["at"])["at"].to_pylist())]


def test_inputs_of_a_join_are_staged_by_one_clock(spark, monkeypatch):
    """The short input must not run ahead of the long one: batch i of both lies before batch i + 1 of either."""
    monkeypatch.setattr(jobs, "ROWS_PER_FILE", 500)
    orders = spark.range(2_000).select("id", (F.col("id") * 10).alias("at"))
    details = spark.range(8_000).select("id", (F.col("id") * 5 % 40_000 / 2).cast("long").alias("at"))     # all by half time
    staged = jobs.stage_together([(orders, "o", F.col("at")), (details, "d", F.col("at"))])
    ends = []
    for s, df in zip(staged, (orders, details)):
        t, w = _times(s), s.files_per_batch
        assert len(t) % w == 0
        ends.append([(min(x[0] for x in t[i: i + w]), max(x[1] for x in t[i: i + w])) for i in range(0, len(t), w)])
        back = spark.read.parquet(s.path)
        assert sorted(back.collect()) == sorted(df.collect())
    assert staged[1].files_per_batch > 1 and len(ends[0]) >= len(ends[1]) >= 4
    for i in range(len(ends[1]) - 1):
        assert max(ends[0][i][1], ends[1][i][1]) < min(ends[0][i + 1][0], ends[1][i + 1][0])


def test_a_large_batch_is_a_file_for_every_core(spark, monkeypatch):
    monkeypatch.setattr(jobs, "ROWS_PER_FILE", 100)
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(100 * cores * 6).select("id", (F.col("id") * 7).alias("at"))
    staged = jobs.stage(df, "wide", "at", jobs.sentinel(df, "at", "id", -1))
    t = _times(staged)
    assert staged.files_per_batch == cores and len(t) == 6 * cores + 1
    assert t == sorted(t) and all(a[1] < b[0] for a, b in zip(t, t[1:]))       # the end row is alone in the last
    out = jobs.run_available_now(jobs.read_staged(spark, staged), "wide")
    assert out.count() == 600 * cores + 1
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage") == "true"


def _streams(spark):
    """Order, paid, refund and favor rows: null times, keys, ids and amounts, repeated orders, times before 1970."""
    rnd = random.Random(11)

    def rows(n, *more):
        return [(rnd.choice([1, 2, None]), *[f() for f in more], rnd.choice([None, -1, 0, 999, 10_000, 25_000])) for _ in range(n)]

    oid, amount = lambda: rnd.choice([None, 1, 2, 3]), lambda: rnd.choice([None, Decimal("0.10"), Decimal("-7.25"), Decimal("9999999999999.99")])
    return [(None, spark.createDataFrame(rows(40, lambda: 1), "sku_id long, favor_ct long, ts long")),
            ("order", spark.createDataFrame(rows(200, lambda: rnd.choice([None, 3]), amount, oid), "sku_id long, order_sku_num long, order_amount decimal(18,2), oid long, ts long")),
            ("paid", spark.createDataFrame(rows(200, amount, oid), "sku_id long, payment_amount decimal(18,2), oid long, ts long")),
            ("refund", spark.createDataFrame(rows(3, amount, oid), "sku_id long, refund_amount decimal(18,2), oid long, ts long"))]


def test_product_sums_by_stream_equal_those_of_the_union(spark):
    streams = _streams(spark)
    found = [{str(r) for r in stats.product_window_sums(m, "10 seconds").collect()} for m in (streams, stats.product_union(streams))]
    assert found[0] == found[1] and len(found[0]) > 9


def test_order_lines_are_summed_where_their_join_left_them(spark):
    """Only refunds, which come from no join by order, are dealt by order id; a text time is read once per row."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(Warehouse(spark, SF).product_stats)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*oid#", plan)) == 1
    assert "timestampadd" not in "".join(x for x in plan.splitlines() if "SortMergeJoin" in x)
    assert not [x for x in plan.splitlines() if "Filter" in x and "gettimestamp" in x]


def test_words_are_cut_for_counted_products_only_and_without_a_lambda(spark):
    plan = _plan(Warehouse(spark, SF).keyword_product_stats)
    assert "lambda" not in plan.lower().split("regexp_extract_all")[0]
    assert re.search(r"Filter \(\(\(click_ct#\S+ > 0\) OR \(cart_ct#\S+ > 0\)\) OR \(order_ct#\S+ > 0\)\)", plan)
    ps = spark.createDataFrame([("a b", 0, 0, 0, "x", "y"), ("a b", None, 2, None, "x", "y"), (None, 1, 1, 1, "x", "y"), ("-", 1, 1, 1, "x", "y"),
                                ("C", 1, None, 3, "x", "y")], "sku_name string, click_ct long, cart_ct long, order_ct long, stt string, edt string")
    got = [(r.keyword, r.ct, r.source) for r in stats.keyword_product_stats(ps, as_of_ms=0).collect()]
    assert got == [("a", 2, "CART"), ("b", 2, "CART"), ("c", 1, "CLICK"), ("c", 3, "ORDER")]


def test_report_days_need_no_pattern(spark):
    assert "regexp_replace" not in _plan(reports.by_spu(Warehouse(spark, SF).product_stats))
    df = spark.createDataFrame([("2024-01-02 00:00:00",), ("+10000-01-01 00:00:00",), ("",), (None,)], "stt string")
    assert [r.dt for r in reports.with_day(df).collect()] == ["20240102", "+1000001", "", None]


def test_text_times_are_read_as_by_the_pattern(spark):
    good = ["2024-02-29 23:59:59", "0000-01-01 00:00:00", "9999-12-31 00:00:01", None]
    df = spark.createDataFrame([(x,) for x in good], "s string")
    both = df.select(timefmt.parse_datetime("s").cast("string").alias("a"),
                     F.to_timestamp_ntz("s", F.lit(timefmt.DATETIME_FMT)).cast("string").alias("b")).collect()
    assert all(r.a == r.b for r in both) and sum(r.a is None for r in both) == 1
    assert [r.m for r in timefmt.with_millis(df.where("s like '2024%'"), {"m": "s"}, 8).collect()] == [1709222399000]
    for bad in ("2023-02-29 00:00:00", "2024-01-01", "2024-01-01T00:00:00", "2024-01-01 00:00:00\n", "2024-01-01 00:00:0 ", "2024-01-01 00:00:0Z",
                "2024-01-01 24:00:00"):
        for c in (timefmt.parse_datetime("s"), F.to_timestamp_ntz("s", F.lit(timefmt.DATETIME_FMT))):
            with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
                spark.createDataFrame([(bad,)], "s string").select(c).collect()


@pytest.mark.parametrize("name", ["keyword_topn", "name_value_list", "spu_document"])
def test_reports_share_the_sums_by_stream(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*oid#", plan)) == 1 and "regexp_replace" not in plan
    assert not [x for x in plan.splitlines() if "Filter" in x and "gettimestamp" in x]
