"""Product reports over many products: one lookup of the aggregate, sums and orders without wide decimals."""

import re
from decimal import Decimal

import pytest

from marketlake.operators import reports, stats
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


def _above_sums(plan):
    """The lines of the plan that lie above the union of the measure streams, on the way to it."""
    lines = plan.splitlines()
    at = max(i for i, x in enumerate(lines) if re.search(r"[+:]- Union", x))
    depth, out = len(lines[at]), []
    for x in reversed(lines[:at + 1]):
        d = re.search(r"[A-Z]", x)
        if d and d.start() < depth:
            depth = d.start()
            out.append(x)
    return out


@pytest.mark.parametrize("name, joins", [("spu_document", 1), ("keyword_topn", 1), ("name_value_list", 1), ("product_stats_enriched", 1)])
def test_sums_are_joined_with_one_dimension(spark, no_broadcast, name, joins):
    """Trademark, spu and category3 are looked up once per sku: the sums are never dealt by a few trademarks."""
    way = _above_sums(_plan(QUERIES[name](spark, SF)))
    assert sum("Join" in x for x in way) == joins
    assert not [x for x in way if re.search(r"Exchange hashpartitioning\((tm_id|category3_id|spu_id)#[^,]*, \d", x)]


def test_spu_report_sums_and_orders_cents(spark, no_broadcast):
    way = _above_sums(_plan(QUERIES["by_spu"](spark, SF)))
    order = [x for x in way if "Sort [" in x or "WindowGroupLimit" in x]
    assert any("_cents#" in x for x in order) and not any("order_amount#" in x for x in order)
    # products without an order and an amount are left out before the lookup
    names = [x.strip(" +-:*()0123456789").split(" ")[0] for x in way]
    assert names.index("Filter", names.index("SortMergeJoin")) > names.index("SortMergeJoin")


def test_repeated_and_missing_dimension_rows(spark):
    """A repeated sku gives its greatest row with that row's names; missing keys pass with NULLs."""
    dims = {"sku": spark.createDataFrame([(1, "a", 1.0, 10, 5, 7), (1, "b", 0.5, 11, None, 8), (2, "c", 1.0, None, 6, 9)],
                                         "id long, sku_name string, price double, spu_id long, tm_id long, category3_id long"),
            "spu": spark.createDataFrame([(10, "s10"), (11, "s11"), (11, "s12")], "id long, spu_name string"),
            "trademark": spark.createDataFrame([(5, "t5"), (None, "none")], "id long, tm_name string"),
            "category3": spark.createDataFrame([(7, "k7"), (8, "k8")], "id long, name string")}
    m = [(None, spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0), (None, 1, 0)], "sku_id long, favor_ct long, ts long"))]
    got = {r.sku_id: (r.sku_name, r.spu_id, r.spu_name, r.tm_id, r.tm_name, r.category3_id, r.category3_name, r.favor_ct)
           for r in stats.product_stats(m, dims, as_of_ms=0).collect()}
    assert got == {1: ("b", 11, "s12", None, None, 8, "k8", 1), 2: ("c", None, None, 6, None, 9, None, 1),
                   3: (None,) * 7 + (1,), None: (None,) * 7 + (1,)}


@pytest.mark.parametrize("date", [None, "20240101"])
def test_report_keeps_every_product_that_counts(spark, date):
    """Negative amounts, orders without an amount and ties count; what sums to nothing gives no group."""
    rows = [(1, Decimal("5.10"), 1), (1, Decimal("-0.10"), 0), (1, Decimal("0"), 2), (1, None, 1), (2, Decimal("0"), 3), (3, Decimal("0"), 0),
            (4, Decimal("2"), 1), (4, Decimal("-2"), 1), (5, Decimal("5"), 9), (None, Decimal("90000000000000.01"), 1), (6, None, 1)]
    df = spark.createDataFrame([("2024-01-01 00:00:00", s, f"n{s}", a, c) for s, a, c in rows],
                               "stt string, spu_id long, spu_name string, order_amount decimal(38,2), order_ct long")
    got = reports.by_spu(df, 10, date)
    assert dict(got.dtypes)["order_amount"] == "decimal(38,2)"
    assert got.columns == ["dt", "spu_id", "spu_name", "order_amount", "order_ct", "rank"]
    assert sorted(tuple(r)[1:] for r in got.where("spu_id is not null").collect()) == [
        (1, "n1", Decimal("5.00"), 4, 2), (5, "n5", Decimal("5.00"), 9, 3)]
    assert got.where("spu_id is null").first().order_amount == Decimal("90000000000000.01")
