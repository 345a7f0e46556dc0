from decimal import Decimal

from pyspark.sql import functions as F

from marketlake.functions.ratios import bounce_rate, pages_per_session, seconds_per_session
from marketlake.functions.text import keyword_sources, words
from marketlake.operators import reports, stats
from helpers import log_df, log_row


def _measure(spark, rows):
    cols = ["sku_id"] + stats.PRODUCT_COUNTS + stats.PRODUCT_AMOUNTS + ["kind", "oid", "ts"]
    full = []
    for r in rows:
        d = {c: 0 for c in stats.PRODUCT_COUNTS}
        d.update({c: Decimal("0.00") for c in stats.PRODUCT_AMOUNTS})
        d.update(kind=None, oid=None)
        d.update(r)
        full.append(tuple(d[c] for c in cols))
    schema = ("sku_id long, " + ", ".join(f"{c} long" for c in stats.PRODUCT_COUNTS) + ", "
              + ", ".join(f"{c} decimal(18,2)" for c in stats.PRODUCT_AMOUNTS) + ", kind string, oid long, ts long")
    return spark.createDataFrame(full, schema)


def test_product_distinct_orders(spark):
    m = _measure(spark, [
        dict(sku_id=1, order_sku_num=2, order_amount=Decimal("3.00"), kind="order", oid=100, ts=1_000),
        dict(sku_id=1, order_sku_num=5, order_amount=Decimal("4.00"), kind="order", oid=100, ts=2_000),
        dict(sku_id=1, click_ct=1, ts=3_000),
        dict(sku_id=2, order_sku_num=1, order_amount=Decimal("1.00"), kind="order", oid=200, ts=50_000),
    ])
    g = {r.sku_id: r for r in stats.product_window_sums(m, "10 seconds").collect()}
    assert (g[1].order_ct, g[1].order_sku_num, g[1].click_ct, g[1].order_amount) == (1, 7, 1, Decimal("7.00"))
    assert g[2].order_ct == 1  # a one-row window still reports its order


def test_visitor_window_sums_bounces_and_boundary(spark):
    one = F.lit(1).cast("bigint")
    rows = log_df(spark, [log_row(1, "m1", 1_000), log_row(2, "m2", 2_000), log_row(3, "m3", 10_000)])
    meas = stats._visitor_rows(rows, uj=one)
    out = stats.visitor_stats(meas, "10 seconds", as_of_ms=0).collect()
    got = sorted((r.stt, r.uj_ct) for r in out)
    assert got == [("1970-01-01 00:00:00", 2), ("1970-01-01 00:00:10", 1)]


def test_keyword_sources(spark):
    df = spark.createDataFrame([(1, 0, 2), (0, 0, 0)], "c long, k long, o long")
    got = [[(x.ct, x.source) for x in r.s] for r in df.select(keyword_sources("c", "k", "o").alias("s")).collect()]
    assert got == [[(1, "CLICK"), (2, "ORDER")], []]
    ps = spark.createDataFrame([("red big", 1, 2, 0, "2024-01-01 00:00:00", "2024-01-01 00:00:10")],
                               "sku_name string, click_ct long, cart_ct long, order_ct long, stt string, edt string")
    assert stats.keyword_product_stats(ps, as_of_ms=0).count() == 4


def test_words_whole_text(spark):
    text = " ".join(f"w{i}" for i in range(5000)) + " Ünïcode 数据"
    got = spark.createDataFrame([(text,)], "t string").select(words("t").alias("w")).first().w
    assert len(got) == 5002 and got[-2:] == ["ünïcode", "数据"]


def test_keyword_topn_orders_by_raw_count(spark):
    ks = spark.createDataFrame([("A", 1, "SEARCH", "2024-01-01 00:00:00"), ("B", 3, "CLICK", "2024-01-01 00:00:00")],
                               "keyword string, ct long, source string, stt string")
    out = reports.keyword_topn(ks, 20).orderBy("rank").collect()
    assert [(r.keyword, r.ct) for r in out] == [("B", 3), ("A", 10)]
    w = reports.keyword_topn(ks, 20, order_by="weighted").orderBy("rank").collect()
    assert [r.keyword for r in w] == ["A", "B"]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 8, 1, 1450, 8, 1), (0, 0, 0, 0, 0, 0), (1, 0, 1, 5, 3, 1)],
                               "uj long, sv long, uv long, dur long, pv long, uv2 long")
    r = df.select(bounce_rate("uj", "sv", "uv").alias("b"), seconds_per_session("dur", "sv", "uv").alias("d"),
                  pages_per_session("pv", "sv", "uv").alias("p")).collect()
    assert r[0].b == Decimal("12.50") and r[0].p == Decimal("1.00")
    assert r[1].b == 0 and r[1].d == 0 and r[1].p == 0
    assert r[2].b is None and r[2].d is None
    one = spark.createDataFrame([(1450, 1, 1)], "dur long, sv long, uv long")
    assert one.select(seconds_per_session("dur", "sv", "uv")).first()[0] == Decimal("1.5")


def test_hour_densify(spark):
    bh = spark.createDataFrame([("20240101", 5, 1, 2, 3, 0)], "dt string, hr int, new_uv long, uv_ct long, pv_ct long, uj_ct long")
    out = reports.hour_densify(bh).orderBy("hr").collect()
    assert len(out) == 24 and out[5].uv_ct == 2 and out[0].uv_ct == 0
    assert [r.hr_label for r in out][:3] == ["00", "01", "02"] and out[23].hr_label == "23"


def test_gmv_empty_day(spark):
    ps = spark.createDataFrame([("2024-01-01 00:00:00", Decimal("5.00"))], "stt string, order_amount decimal(38,2)")
    assert reports.gmv(ps, "20240102").first().gmv == 0
    assert reports.gmv(ps, "20240101").first().gmv == Decimal("5.00")


def test_top_n_single_day_and_all_days(spark):
    ps = spark.createDataFrame(
        [("2024-01-01 00:00:00", t, f"tm{t}", Decimal(a)) for t, a in [(1, "5"), (2, "9"), (3, "0"), (4, "9")]]
        + [("2024-01-02 00:00:00", 1, "tm1", Decimal("1"))],
        "stt string, tm_id long, tm_name string, order_amount decimal(38,2)")
    day = reports.by_trademark(ps, 2, "20240101").orderBy("rank").collect()
    assert [(r.tm_id, r.rank) for r in day] == [(2, 1), (4, 2)]
    alld = reports.by_trademark(ps, 2).collect()
    assert sorted((r.dt, r.tm_id) for r in alld) == [("20240101", 2), ("20240101", 4), ("20240102", 1)]
