"""Report layer: the dashboard queries over the aggregate tables, and their result shapes.

Every report takes ``date``: a ``yyyyMMdd`` string selects one day (on a ``dt``-partitioned table
the literal filter prunes partitions at the scan; top-N becomes ``TakeOrderedAndProject``), and
``None`` answers the report for every day at once (grouped by ``dt``; per-day top-N as a
``row_number() <= n`` filter, which Spark plans as a map-side group limit before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import keyword_weight
from ..functions.ratios import bounce_rate, pages_per_session, seconds_per_session
from ..functions.timefmt import hour_label
from ..schemas import AMOUNT_SUM
from .stats import cents, from_cents

# ---- fixed values: row labels of the new/old visitor table, in display order -------------------
VISITOR_ROW_LABELS = [
    ("uv_ct", "用户数(人)"),            # visitors
    ("pv_ct", "总访问页面(次)"),        # page views
    ("uj_rate", "跳出率(%)"),           # bounce rate
    ("dur_per_sv", "平均在线时长(秒)"),  # seconds per session
    ("pv_per_sv", "平均访问人数(人次)"),  # pages per session
]
NEW_VISITOR_SERIES = "新用户"            # series name of new visitors in the hour chart
VISITOR_COLUMNS = [("类别", "type"), ("新用户", "new"), ("老用户", "old")]     # table headers: label, id
SPU_COLUMNS = [("商品SPU名称", "spu_name"), ("交易额", "order_amount"), ("订单数", "order_ct")]
# -----------------------------------------------------------------------------------------------


def report_date(date: int | str | None, as_of_ms: int | None = None) -> str | None:
    """Dashboard date parameter: ``0`` (or ``"0"``) means today (UTC day of ``as_of_ms``, default
    now); ``None`` means every day; anything else is a ``yyyyMMdd`` day."""
    if date is None:
        return None
    if str(date) == "0":
        import datetime as _dt
        ms = as_of_ms if as_of_ms is not None else int(_dt.datetime.now(_dt.timezone.utc).timestamp() * 1000)
        return _dt.datetime.fromtimestamp(ms / 1000, _dt.timezone.utc).strftime("%Y%m%d")
    return str(date)


def with_day(stats: DataFrame) -> DataFrame:
    """``dt`` (``yyyyMMdd``) of the window start, unless the table already carries it."""
    if "dt" in stats.columns:
        return stats
    return stats.withColumn("dt", F.replace(F.substring("stt", 1, 10), F.lit("-"), F.lit("")))


def _scope(stats: DataFrame, date: str | None) -> DataFrame:
    d = with_day(stats)
    return d if date is None else d.filter(F.col("dt") == F.lit(date))


def _top(df: DataFrame, n: int, order: list[Column], date: str | None) -> DataFrame:
    """Top ``n`` per day with its 1-based ``rank`` (the display order)."""
    if date is not None:
        top = df.orderBy(*order).limit(n)  # TakeOrderedAndProject; the window below sees <= n rows
        return top.withColumn("rank", F.row_number().over(Window.partitionBy("dt").orderBy(*order)))
    rank = F.row_number().over(Window.partitionBy("dt").orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def gmv(product_stats: DataFrame, date: str | None = None) -> DataFrame:
    """Day total of order amounts; a day without rows reports 0."""
    d = _scope(product_stats, date)
    total = F.coalesce(F.sum("order_amount"), F.lit(0)).cast(AMOUNT_SUM).alias("gmv")
    if date is not None:
        return d.agg(total).select(F.lit(date).alias("dt"), "gmv")
    return d.groupBy("dt").agg(total)


def _by(product_stats: DataFrame, id_col: str, name_col: str, n: int, date: str | None,
        with_orders: bool = False) -> DataFrame:
    """Amounts are summed and ordered as exact cents (see ``stats.cents``).  A product row that adds nothing to a sum cannot
    bring a group over zero: it is left out before the lookups."""
    d = _scope(product_stats, date)
    adds = F.col("order_amount") != 0
    aggs = [F.sum(cents("order_amount")).alias("_cents")]
    if with_orders:
        adds = (F.col("order_ct") != 0) | adds
        aggs.append(F.sum("order_ct").cast("bigint").alias("order_ct"))
    g = d.where(adds).groupBy("dt", id_col, name_col).agg(*aggs).filter(F.col("_cents") > 0)
    top = _top(g, n, [F.desc("_cents"), F.asc(id_col)], date)
    return top.select("dt", id_col, name_col, from_cents("_cents").alias("order_amount"), *top.columns[4:])


def by_trademark(product_stats: DataFrame, n: int = 10, date: str | None = None) -> DataFrame:
    return _by(product_stats, "tm_id", "tm_name", n, date)


def by_category3(product_stats: DataFrame, n: int = 10, date: str | None = None) -> DataFrame:
    return _by(product_stats, "category3_id", "category3_name", n, date)


def by_spu(product_stats: DataFrame, n: int = 10, date: str | None = None) -> DataFrame:
    return _by(product_stats, "spu_id", "spu_name", n, date, with_orders=True)


def by_province(province_stats: DataFrame, date: str | None = None) -> DataFrame:
    d = _scope(province_stats, date)
    g = d.groupBy("dt", "province_id", "province_name").agg(
        F.sum("order_amount").cast(AMOUNT_SUM).alias("order_amount"))
    return g.select("dt", "province_name", "order_amount")


VISITOR_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def visitor_by_new_flag(visitor_stats: DataFrame, date: str | None = None) -> DataFrame:
    d = _scope(visitor_stats, date)
    return d.groupBy("dt", "is_new").agg(*[F.sum(c).cast("bigint").alias(c) for c in VISITOR_SUMS])


def visitor_by_hour(visitor_stats: DataFrame, date: str | None = None) -> DataFrame:
    d = _scope(visitor_stats, date).withColumn("hr", F.hour(F.to_timestamp_ntz("stt")))
    g = d.groupBy("dt", "hr").agg(
        F.sum(F.when(F.col("is_new") == "1", F.col("uv_ct")).otherwise(0)).cast("bigint").alias("new_uv"),
        F.sum("uv_ct").cast("bigint").alias("uv_ct"), F.sum("pv_ct").cast("bigint").alias("pv_ct"),
        F.sum("uj_ct").cast("bigint").alias("uj_ct"))
    return g.orderBy("dt", "hr") if date is not None else g


def _days(df: DataFrame, date: str | None) -> DataFrame:
    """The days that a report answers for: the chosen one, data or not, else those of the data."""
    if date is None:
        return df.select("dt").distinct()
    return df.sparkSession.range(1).select(F.lit(date).alias("dt"))


def hour_densify(by_hour: DataFrame, date: str | None = None) -> DataFrame:
    """24 rows per day: hours without data report zeros; ``hr_label`` is ``00``..``23``."""
    grid = _days(by_hour, date).select("dt", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hr"))
    j = grid.join(by_hour, ["dt", "hr"], "left")
    return j.select("dt", "hr", hour_label(F.col("hr")).alias("hr_label"),
                    *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("uv_ct", "pv_ct", "new_uv")])


def visitor_transpose(by_new_flag: DataFrame, date: str | None = None) -> DataFrame:
    """Per day, five metric rows with a ``new`` and an ``old`` column.  ``is_new='1'`` is new;
    every other flag value is summed into old; an absent side reports zeros."""
    newf = F.col("is_new") == "1"
    side = {}
    for c in VISITOR_SUMS:
        side[f"n_{c}"] = F.sum(F.when(newf, F.col(c)).otherwise(0)).cast("bigint")
        side[f"o_{c}"] = F.sum(F.when(~newf | F.col("is_new").isNull(), F.col(c)).otherwise(0)).cast("bigint")
    g = by_new_flag.groupBy("dt").agg(*[v.alias(k) for k, v in side.items()])
    if date is not None:
        g = _days(g, date).join(g, "dt", "left").na.fill(0)

    def metrics(p: str) -> dict[str, Column]:
        uv, pv, sv, uj, dur = (F.col(f"{p}_{c}") for c in VISITOR_SUMS)
        return {"uv_ct": uv, "pv_ct": pv, "uj_rate": bounce_rate(uj, sv, uv),
                "dur_per_sv": seconds_per_session(dur, sv, uv), "pv_per_sv": pages_per_session(pv, sv, uv)}

    mn, mo = metrics("n"), metrics("o")
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(label).alias("type"),
                              mn[k].cast("double").alias("new"), mo[k].cast("double").alias("old"))
                     for i, (k, label) in enumerate(VISITOR_ROW_LABELS)])
    return g.select("dt", F.inline(rows)).select("dt", "pos", "type", "new", "old")


def keyword_topn(keyword_stats: DataFrame, n: int = 20, date: str | None = None,
                 order_by: str = "raw") -> DataFrame:
    """Weighted keyword score ``sum(ct * weight(source))`` per keyword, top ``n`` ordered by the
    unweighted ``sum(ct)`` (``order_by='weighted'`` orders by the score)."""
    d = _scope(keyword_stats, date)
    g = d.groupBy("dt", "keyword").agg(
        F.sum(F.col("ct") * keyword_weight("source")).cast("bigint").alias("ct"),
        F.sum("ct").cast("bigint").alias("raw_ct"))
    key = "raw_ct" if order_by == "raw" else "ct"
    return _top(g, n, [F.desc(key), F.asc("keyword")], date).select("dt", "rank", "keyword", "ct")


def _listed(df: DataFrame, columns: dict[str, str], order: list[Column], date: str | None) -> DataFrame:
    """Per day the rows as an ordered array ``_l`` of structs (empty for a chosen day without rows)."""
    w = Window.partitionBy("dt").orderBy(*order)
    r = df.withColumn("_pos", F.row_number().over(w))
    item = F.struct("_pos", *[F.col(src).alias(out) for out, src in columns.items()])
    g = r.groupBy("dt").agg(F.sort_array(F.collect_list(item)).alias("_l"))
    if date is not None:
        kind = g.schema["_l"].dataType
        g = _days(g, date).join(g, "dt", "left").withColumn("_l", F.coalesce("_l", F.array().cast(kind)))
    return g.withColumn("_l", F.transform("_l", lambda x: F.struct(*[x[c].alias(c) for c in columns])))


def _envelope(df: DataFrame, data: Column) -> DataFrame:
    return df.select("dt", F.to_json(F.struct(F.lit(0).alias("status"), data.alias("data"))).alias("json"))


def province_map(by_prov: DataFrame, date: str | None = None) -> DataFrame:
    """Per day ``{"status":0,"data":{"mapData":[{"name":..,"value":..}]}}``, provinces by name."""
    g = _listed(by_prov, {"name": "province_name", "value": "order_amount"}, [F.asc("province_name")], date)
    return _envelope(g, F.struct(F.col("_l").alias("mapData")))


def category3_list(by_c3: DataFrame, date: str | None = None) -> DataFrame:
    """Per day ``{"status":0,"data":[{"name":..,"value":..}]}`` in rank order."""
    return _envelope(_listed(by_c3, {"name": "category3_name", "value": "order_amount"}, [F.asc("rank")], date), F.col("_l"))


def _header(columns: list[tuple[str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(label).alias("name"), F.lit(c).alias("id")) for label, c in columns])


def spu_table(by_spu_df: DataFrame, date: str | None = None) -> DataFrame:
    """Per day ``{"status":0,"data":{"columns":[..],"rows":[..]}}`` of the SPU report."""
    g = _listed(by_spu_df, {c: c for _, c in SPU_COLUMNS}, [F.asc("rank")], date)
    return _envelope(g, F.struct(_header(SPU_COLUMNS).alias("columns"), F.col("_l").alias("rows")))


def visitor_table(transposed: DataFrame, date: str | None = None) -> DataFrame:
    """Per day the new/old visitor table with its headers."""
    g = _listed(transposed, {c: c for _, c in VISITOR_COLUMNS}, [F.asc("pos")], date)
    return _envelope(g, F.struct(F.lit(1).alias("combineNum"), _header(VISITOR_COLUMNS).alias("columns"), F.col("_l").alias("rows")))


def name_value_json(df: DataFrame, name: str, value: str, order: list[Column], date: str | None = None) -> DataFrame:
    """Per day one JSON document ``{"status":0,"msg":"","data":[{"name":..,"value":..},...]}``.

    The list holds one report's (already top-N bounded) rows, ordered by ``order``."""
    g = _listed(df, {"name": name, "value": value}, order, date)
    doc = F.struct(F.lit(0).alias("status"), F.lit("").alias("msg"), F.col("_l").alias("data"))
    return g.select("dt", F.to_json(doc).alias("json"))


def columns_rows(by_spu_df: DataFrame) -> DataFrame:
    """The SPU table: (dt, spu_name, order_amount, order_ct)."""
    return by_spu_df.select("dt", "rank", "spu_name", "order_amount", "order_ct")


def categories_series(df: DataFrame, category: str, series: list[tuple[str | None, str]],
                      order: list[Column], date: str | None = None) -> DataFrame:
    """Per day ``{"categories":[...], "series":[{"name":..,"data":[...]}, ...]}`` with every array in
    the same row order (carried explicitly, never left to collection order).  ``series`` is a list
    of ``(name, column)``; a ``None`` name leaves the series without a name field."""
    g = _listed(df, {"c": category, **{f"s{i}": src for i, (_, src) in enumerate(series)}}, order, date)

    def one(i: int, nm: str | None) -> Column:
        data = F.transform("_l", lambda x: x[f"s{i}"]).alias("data")
        return F.struct(data) if nm is None else F.struct(F.lit(nm).alias("name"), data)

    ser = F.array(*[one(i, nm) for i, (nm, _) in enumerate(series)])
    doc = F.struct(F.lit(0).alias("status"),
                   F.struct(F.transform("_l", lambda x: x["c"]).alias("categories"), ser.alias("series")).alias("data"))
    return g.select("dt", F.to_json(doc).alias("json"))


def hour_series(densified: DataFrame, date: str | None = None) -> DataFrame:
    return categories_series(densified, "hr_label", [("uv", "uv_ct"), ("pv", "pv_ct"), (NEW_VISITOR_SERIES, "new_uv")],
                             [F.asc("hr")], date)


def trademark_series(by_tm: DataFrame, date: str | None = None) -> DataFrame:
    return categories_series(by_tm, "tm_name", [(None, "order_amount")], [F.asc("rank")], date)


def scalar_envelope(gmv_df: DataFrame) -> DataFrame:
    """Per day ``{"status":0,"data":<gmv>}``."""
    return gmv_df.select("dt", F.to_json(F.struct(F.lit(0).alias("status"), F.col("gmv").alias("data"))).alias("json"))
