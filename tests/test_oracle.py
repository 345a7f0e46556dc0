"""Every registered query against its DuckDB twin on the smallest driver scale."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry
from marketlake.plans.catalog import QUERIES
from marketlake.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def _digest(df):
    cols = sorted(df.columns)

    def canon(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, float):
            return f"{v:.9g}"
        return str(v.item() if hasattr(v, "item") else v)
    rows = sorted("|".join(canon(r[c]) for c in cols) for r in df[cols].to_dict("records"))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    s = QUERIES[name](spark, SF).toPandas()
    d = con.execute(ORACLE[name]).df()
    assert _digest(s) == _digest(d)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["dt", "province_name", "order_amount"] and df.count() > 0
