"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Outputs are flat and comparable with the SQL twins in ``oracle``: amounts are summed exactly as
DECIMAL and reported as DOUBLE, times as text, nested values flattened.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import CODE_LISTS, decode
from ..functions.segment import segmented
from ..functions.text import words
from ..functions.timefmt import age_years, text_to_millis, ymd_from_millis
from ..operators import joins, logs, reports, routing, stats
from ..schemas import PRODUCT_TOPIC
from ..session import new_location
from ..sinks.dimensions import Dimension
from ..sources import tables as T
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]


def _amounts(df: DataFrame) -> DataFrame:
    """DECIMAL columns -> DOUBLE (after exact aggregation)."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


def _flat_log(df: DataFrame) -> DataFrame:
    return df.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                     "ts", ymd_from_millis(F.col("ts")).alias("dt"), F.col("page.page_id").alias("page_id"),
                     F.col("page.last_page_id").alias("last_page_id"))


# ---- detail layer -------------------------------------------------------------------------------

def log_split_start(spark, d):
    s = logs.split_start(Warehouse(spark, d).repaired_log)
    return s.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts",
                    F.col("start")["entry"].alias("entry"),
                    F.col("start")["loading_time"].cast("bigint").alias("loading_time"))


def log_split_page(spark, d):
    p = logs.split_page(Warehouse(spark, d).repaired_log)
    return p.select("seq", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
                    F.col("common.ch").alias("ch"), "ts", F.col("page.page_id").alias("page_id"),
                    F.col("page.last_page_id").alias("last_page_id"), F.col("page.item").alias("item"),
                    F.col("page.item_type").alias("item_type"), F.col("page.during_time").alias("during_time"),
                    F.size("displays").cast("bigint").alias("n_displays"))


def display_explode(spark, d):
    x = logs.explode_displays(Warehouse(spark, d).parsed_log)
    return x.select("seq", "page_id", "item", "item_type", F.col("order").alias("display_order"), "pos_id")


def new_visitor_repair(spark, d):
    w = Warehouse(spark, d)
    return w.repaired_log.select("seq", F.col("common.mid").alias("mid"), ymd_from_millis(F.col("ts")).alias("dt"),
                                 F.col("common.is_new").alias("is_new"))


def session_entry(spark, d):
    w = Warehouse(spark, d)
    return _flat_log(w.repaired(logs.session_entries(logs.split_page(w.plain_log))))


def unique_visit(spark, d):
    return _flat_log(Warehouse(spark, d).unique_visits)


def bounce_as_written(spark, d):
    return _flat_log(Warehouse(spark, d).bounces("as_written"))


def bounce_as_documented(spark, d):
    return _flat_log(Warehouse(spark, d).bounces("as_documented"))


# ---- middle layer -------------------------------------------------------------------------------

def _interval(spark, d, within):
    oi = T.order_info(spark, d)
    od = T.order_detail(spark, d, time="ship")
    j = joins.order_detail_join(oi, od, within)
    return _amounts(j.select("order_id", "sku_id", "sku_num", "split_total_amount", "province_id",
                             "order_status", "create_time"))


def order_interval_join(spark, d):
    return _interval(spark, d, "5 milliseconds")


def order_interval_join_30d(spark, d):
    return _interval(spark, d, "30 days")


WIDE_OUT = ["order_id", "sku_id", "sku_name", "sku_num", "order_price", "split_total_amount", "province_id",
            "province_name", "province_area_code", "province_iso_code", "province_3166_2_code", "order_status",
            "user_id", "user_age", "user_gender", "total_amount", "create_time", "create_date", "spu_id", "spu_name",
            "tm_id", "tm_name", "category3_id", "category3_name"]


def order_wide(spark, d):
    return _amounts(Warehouse(spark, d).order_wide.select(*WIDE_OUT))


def user_age(spark, d):
    u = T.dim_user(spark, d)
    return u.select("id", "birthday", "gender", age_years(F.col("birthday"), F.lit(T.AS_OF_MS)).alias("user_age"))


def payment_wide(spark, d):
    p = Warehouse(spark, d).payment_wide
    return _amounts(p.select("payment_id", "order_id", "user_id", "total_amount", "payment_type", "subject",
                             "payment_create_time", "callback_time", "order_create_time", "sku_id", "sku_name",
                             "split_total_amount", "province_name", "tm_name"))


# ---- summary layer ------------------------------------------------------------------------------

def visitor_union(spark, d):
    return Warehouse(spark, d).visitor_measures


def visitor_stats(spark, d):
    return Warehouse(spark, d).visitor_stats


def product_union(spark, d):
    m = Warehouse(spark, d).product_measures
    return _amounts(m.withColumn("oid", F.col("oid").cast("string")))


def product_stats(spark, d):
    w = Warehouse(spark, d)
    g = stats.product_window_sums(w.product_streams, w.params.window)
    g = g.select(*stats.window_bounds(), "sku_id", *[c for c in g.columns if c not in ("_w", "sku_id")])
    return _amounts(g)


def product_stats_enriched(spark, d):
    return _amounts(Warehouse(spark, d).product_stats)


def province_stats(spark, d):
    return _amounts(Warehouse(spark, d).province_stats)


def keyword_search(spark, d):
    return Warehouse(spark, d).keyword_search_stats


def keyword_product(spark, d):
    return Warehouse(spark, d).keyword_product_stats


def keyword_explode(spark, d):
    """The tokenizer as a job: every word of every whole document, counted."""
    docs = T.table(spark, d, "documents").select(F.explode(words(F.col("text"))).alias("keyword"))
    return docs.groupBy("keyword").agg(F.count(F.lit(1)).alias("ct"))


def keyword_segment(spark, d):
    """Part names without separators, cut by a dictionary table: how often each word comes."""
    w = segmented(T.joined_names(spark, d), T.user_dictionary(spark, d))
    return w.groupBy("keyword").agg(F.count(F.lit(1)).alias("ct"))


# ---- report layer -------------------------------------------------------------------------------

def gmv(spark, d):
    return _amounts(reports.gmv(Warehouse(spark, d).product_stats))


def by_trademark(spark, d):
    w = Warehouse(spark, d)
    return _amounts(reports.by_trademark(w.product_stats, w.params.top_n))


def by_category3(spark, d):
    w = Warehouse(spark, d)
    return _amounts(reports.by_category3(w.product_stats, w.params.top_n))


def by_spu(spark, d):
    w = Warehouse(spark, d)
    return _amounts(reports.by_spu(w.product_stats, w.params.top_n))


def by_province(spark, d):
    return _amounts(reports.by_province(Warehouse(spark, d).province_stats))


def visitor_by_new_flag(spark, d):
    return reports.visitor_by_new_flag(Warehouse(spark, d).visitor_stats)


def visitor_by_hour(spark, d):
    return reports.visitor_by_hour(Warehouse(spark, d).visitor_stats)


def hour_densify(spark, d):
    return reports.hour_densify(reports.visitor_by_hour(Warehouse(spark, d).visitor_stats))


def visitor_transpose(spark, d):
    return reports.visitor_transpose(reports.visitor_by_new_flag(Warehouse(spark, d).visitor_stats))


def keyword_topn(spark, d):
    w = Warehouse(spark, d)
    return reports.keyword_topn(w.keyword_stats, w.params.keyword_top_n)


def name_value_list(spark, d):
    w = Warehouse(spark, d)
    top = reports.keyword_topn(w.keyword_stats, w.params.keyword_top_n)
    return reports.name_value_json(top, "keyword", "ct", [F.asc("rank")])


def table_rows(spark, d):
    w = Warehouse(spark, d)
    return _amounts(reports.columns_rows(reports.by_spu(w.product_stats, w.params.top_n)))


def series_arrays(spark, d):
    w = Warehouse(spark, d)
    return reports.trademark_series(reports.by_trademark(w.product_stats, w.params.top_n))


def hour_series(spark, d):
    w = Warehouse(spark, d)
    return reports.hour_series(reports.hour_densify(reports.visitor_by_hour(w.visitor_stats)))


def scalar_envelope(spark, d):
    return reports.scalar_envelope(reports.gmv(Warehouse(spark, d).product_stats))


def spu_document(spark, d):
    w = Warehouse(spark, d)
    return reports.spu_table(reports.by_spu(w.product_stats, w.params.top_n))


def code_decode(spark, d):
    """Every code list that the tables hold a column for, decoded and counted."""
    columns = [("order_status", T.order_info(spark, d), "order_status"), ("payment_type", T.payment_info(spark, d), "payment_type"),
               ("appraise", T.comment_info(spark, d), "appraise")]
    return stats.union_all([df.groupBy(F.col(c).alias("code")).agg(F.count(F.lit(1)).alias("ct")).select(
        F.lit(name).alias("code_list"), "code", decode(F.col("code"), CODE_LISTS[name]).alias("meaning"), "ct") for name, df, c in columns])


# ---- change-record layer -------------------------------------------------------------------------

def _clean(spark, d, source_table: str | None = None):
    return routing.clean_changes(routing.parse_changes(T.cdc_raw(spark, d, source_table)))


def _routed(spark, d, source_table: str | None = None):
    return routing.route(_clean(spark, d, source_table), T.routing_config(spark))


def _record_view(df):
    return df.select("seq", "table", "type", "sink_table", F.size("data").cast("bigint").alias("n_cols"),
                     F.col("data")["id"].alias("id"))


def cdc_clean(spark, d):
    c = _clean(spark, d)
    return c.select("seq", "table", "type", F.size("data").cast("bigint").alias("n_keys"), F.col("data")["id"].alias("id"))


def cdc_route_fact(spark, d):
    return _record_view(routing.facts(_routed(spark, d)))


def cdc_route_dim(spark, d):
    return _record_view(routing.dims(_routed(spark, d)))


def cdc_unmatched(spark, d):
    return routing.unmatched(_clean(spark, d), T.routing_config(spark)).select("seq", "table", "type")


def cdc_column_filter(spark, d):
    return routing.kept(_routed(spark, d)).select("seq", "table", "type", "sink_table", F.explode("data").alias("key", "value"))


def cdc_route_asof(spark, d):
    """Records under the config as it stood when they arrived (updates, deletes and re-inserts of routes)."""
    return _record_view(routing.filter_columns(routing.route_asof(_clean(spark, d), T.config_feed(spark))))


def dim_upsert_merge(spark, d):
    """Routed user-dimension changes applied to an empty snapshot in one merge (every column takes its
    latest value by arrival); the result is flattened."""
    r = routing.dims(_routed(spark, d, "user_info")).filter(F.col("sink_table") == "dim_user_info")
    snap = routing.merge_dimension(spark.createDataFrame([], "id string, data map<string,string>"), r)
    return snap.select("id", *[F.col("data")[c].alias(c) for c in ("name", "birthday", "gender")])


# ---- one-day reports: the dashboard's own form, on fixed days of the driver data -----------------

VISIT_DAY, ORDER_DAY, EMPTY_DAY = "20240115", "19960225", "19000101"


def gmv_day(spark, d):
    return _amounts(reports.gmv(Warehouse(spark, d).product_stats, ORDER_DAY))


def by_trademark_day(spark, d):
    w = Warehouse(spark, d)
    return _amounts(reports.by_trademark(w.product_stats, w.params.top_n, ORDER_DAY))


def by_province_day(spark, d):
    return _amounts(reports.by_province(Warehouse(spark, d).province_stats, ORDER_DAY))


def keyword_topn_day(spark, d):
    w = Warehouse(spark, d)
    return reports.keyword_topn(w.keyword_stats, w.params.keyword_top_n, VISIT_DAY)


def hour_densify_day(spark, d):
    return reports.hour_densify(reports.visitor_by_hour(Warehouse(spark, d).visitor_stats, VISIT_DAY), VISIT_DAY)


def hour_densify_empty_day(spark, d):
    return reports.hour_densify(reports.visitor_by_hour(Warehouse(spark, d).visitor_stats, EMPTY_DAY), EMPTY_DAY)


def visitor_transpose_day(spark, d):
    return reports.visitor_transpose(reports.visitor_by_new_flag(Warehouse(spark, d).visitor_stats, VISIT_DAY), VISIT_DAY)


def province_map(spark, d):
    return reports.province_map(reports.by_province(Warehouse(spark, d).province_stats))


def category3_list(spark, d):
    w = Warehouse(spark, d)
    return reports.category3_list(reports.by_category3(w.product_stats, w.params.top_n))


def config_latest(spark, d):
    """Current routing config from a feed of config changes: one change per table of the change
    records, the later ones replacing the earlier."""
    c = _clean(spark, d)
    feed = c.select("seq", F.lit("insert").alias("type"), F.create_map(
        F.lit("source_table"), F.col("table"), F.lit("operate_type"), F.col("type"), F.lit("sink_type"), F.lit("kafka"),
        F.lit("sink_table"), F.concat(F.lit("dwd_"), F.col("table"), F.lit("_"), F.col("seq").cast("string"))).alias("data"))
    latest = routing.latest_config(feed)
    return latest.select("source_table", "operate_type", "sink_type", "sink_table")


def keyword_search_sql(spark, d):
    """The keyword job as SQL text over a temporary view and a SQL-defined table function."""
    from ..functions import sql
    w = Warehouse(spark, d)
    sql.register(spark)
    sql.page_view(w.page_log).createOrReplaceTempView("page_view")
    return spark.sql(sql.KEYWORD_SEARCH_SQL.format(as_of_ms=w.params.as_of_ms))


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    cdc_clean, cdc_route_fact, cdc_route_dim, cdc_unmatched, cdc_column_filter, cdc_route_asof, dim_upsert_merge,
    log_split_start, log_split_page, display_explode, new_visitor_repair, session_entry, unique_visit,
    bounce_as_written, bounce_as_documented, order_interval_join, order_interval_join_30d, order_wide, user_age,
    payment_wide, visitor_union, visitor_stats, product_union, product_stats, product_stats_enriched,
    province_stats, keyword_search, keyword_product, keyword_explode, keyword_segment, gmv, by_trademark, by_category3, by_spu,
    by_province, visitor_by_new_flag, visitor_by_hour, hour_densify, visitor_transpose, keyword_topn,
    name_value_list, table_rows, series_arrays, hour_series, scalar_envelope, spu_document, code_decode,
    gmv_day, by_trademark_day, by_province_day, keyword_topn_day, hour_densify_day, hour_densify_empty_day,
    visitor_transpose_day, province_map, category3_list, config_latest, keyword_search_sql,
]}


# ---- streaming twins: the same operators under Structured Streaming (availableNow) ------------
# Inputs are derived from the driver tables, staged as files, streamed, and read back; the result
# must equal the batch query (same SQL twin).

def _flat_out(df):
    return df.filter(F.col("mid") != _jobs().SENTINEL).select("seq", "mid", "is_new", "ts", "dt", "page_id",
                                                              "last_page_id")


def _jobs():
    from ..streaming import jobs
    return jobs


def _stream(spark, df, name, order, sentinel=None, shape=None):
    j = _jobs()
    return j.read_staged(spark, j.stage(df, name, order, sentinel, shape))


def _streams(spark, *inputs, shape=None):
    """The inputs (rows, name, event time) of one streaming join, staged by one clock."""
    j = _jobs()
    return tuple(j.read_staged(spark, s) for s in j.stage_together(list(inputs), shape))


def _staged_pages(spark, d):
    from ..streaming.processors import flatten_log
    w = Warehouse(spark, d)
    with _jobs().landed(flatten_log(w.repaired(logs.split_page(w.plain_log))), "pages") as flat:
        return _stream(spark, flat, "pages", "ts", _jobs().sentinel(flat, "ts", "mid"))


def unique_visit_stream(spark, d):
    from ..streaming.processors import unique_visits_stream
    return _flat_out(_jobs().run_available_now(unique_visits_stream(_staged_pages(spark, d)), "unique_visit"))


def bounce_as_written_stream(spark, d):
    from ..streaming.processors import bounces_stream
    w = Warehouse(spark, d)
    s = bounces_stream(_staged_pages(spark, d), w.params.bounce_within, "as_written")
    return _flat_out(_jobs().run_available_now(s, "bounce"))


def bounce_as_documented_stream(spark, d):
    from ..streaming.processors import bounces_stream
    w = Warehouse(spark, d)
    s = bounces_stream(_staged_pages(spark, d), w.params.bounce_within, "as_documented")
    return _flat_out(_jobs().run_available_now(s, "bounce_documented"))


def new_visitor_repair_stream(spark, d):
    j = _jobs()
    with j.landed(T.raw_log(spark, d), "raw_log") as raw:
        lines = _stream(spark, raw, "raw_log", "seq")
    out = j.run_available_now(j.detail_log_stream(lines), "repair")
    return out.select("seq", "mid", "dt", "is_new")


def _order_streams(spark, d, time, shape=None):
    at, j = F.col("create_ts"), _jobs()
    with j.landed(T.order_info(spark, d), "order_info") as orders, j.landed(T.order_detail(spark, d, time=time), "order_detail") as details:
        return _streams(spark, (orders, "order_info", at), (details, "order_detail", at), shape=shape)


def order_interval_join_stream(spark, d):
    j = _jobs()
    lines = j.order_lines_stream(*_order_streams(spark, d, "ship"), "5 milliseconds")
    # selected in the stream: its join keeps no column that is not asked for
    lines = lines.select("order_id", "sku_id", "sku_num", "split_total_amount", "province_id", "order_status", "create_time")
    return _amounts(j.run_available_now(lines, "order_lines"))


def order_wide_stream(spark, d):
    """Interval join of two streams; dimensions are joined as snapshots inside each micro-batch."""
    w = Warehouse(spark, d)
    lines = _jobs().order_lines_stream(*_order_streams(spark, d, "order"), w.params.order_within)

    def write(batch, batch_id, out):
        # every batch reads the dimensions anew; its folder is rewritten when it is replayed
        wide = joins.enrich_order_wide(batch, Warehouse(batch.sparkSession, d).dims, w.params.as_of_ms, unique_dims=True)
        wide.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return _amounts(_jobs().run_available_now(lines, "order_wide", foreach=write).select(*WIDE_OUT))


def order_wide_json_stream(spark, d):
    """The same from JSON topics: facts come as text, are typed in the stream, then joined and enriched."""
    from ..operators.facts import typed_facts
    j, w = _jobs(), Warehouse(spark, d)

    def topic(df):
        return df.select("create_ts", F.to_json(F.struct(*[c for c in df.columns if c != "create_ts"])).alias("value"))

    orders, details = _order_streams(spark, d, "order", topic)
    lines = j.order_lines_stream(typed_facts(orders.select("value"), "order_info", key="id"),
                                 typed_facts(details.select("value"), "order_detail", key="order_id"), w.params.order_within)

    def write(batch, batch_id, out):
        wide = joins.enrich_order_wide(batch, Warehouse(batch.sparkSession, d).dims, w.params.as_of_ms, unique_dims=True)
        wide.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return _amounts(j.run_available_now(lines, "order_wide_json", foreach=write).select(*WIDE_OUT))


def keyword_product_stream(spark, d):
    """The keyword job fed by the re-published product statistics: their JSON topic, read back as a stream."""
    from ..sinks.writers import as_json_value
    w = Warehouse(spark, d)
    with _jobs().landed(w.product_stats, "product_stats") as found:
        topic = _stream(spark, found, "product_stats", "stt", shape=as_json_value)
    rows = logs.parse_once(topic, "value", PRODUCT_TOPIC)
    s = stats.keyword_product_stats(rows.where(F.col(logs.CORRUPT).isNull()), as_of_ms=w.params.as_of_ms)
    return _jobs().run_available_now(s, "keyword_product")


def payment_wide_stream(spark, d):
    """Payments joined to the stream of order-wide rows."""
    w = Warehouse(spark, d)
    with _jobs().landed(w.order_wide, "order_wide") as rows:
        pay, wide = _streams(spark, (T.payment_info(spark, d), "payment_info", text_to_millis(F.col("callback_time"))),
                             (rows, "order_wide", F.col("create_ts")))
    # selected in the stream: its join keeps and writes no column that is not asked for
    p = joins.payment_wide(pay, wide, within=w.params.payment_within).select(
        "payment_id", "order_id", "user_id", "total_amount", "payment_type", "subject", "payment_create_time", "callback_time",
        "order_create_time", "sku_id", "sku_name", "split_total_amount", "province_name", "tm_name")
    return _amounts(_jobs().run_available_now(p, "payment_wide"))


def visitor_stats_stream(spark, d):
    j = _jobs()
    w = Warehouse(spark, d)
    with j.landed(w.visitor_measures, "visitor_measures") as m:
        rows = _stream(spark, m, "visitor_measures", "ts", j.sentinel(m, "ts", "vc"))
    s = j.visitor_stats_stream(rows, w.params.visitor_window, w.params.as_of_ms)
    return j.run_available_now(s, "visitor_stats").filter(F.col("vc") != j.SENTINEL)


def keyword_search_stream(spark, d):
    j = _jobs()
    w = Warehouse(spark, d)
    with j.landed(stats.search_pages(w.page_log).select("page", "ts"), "search_pages") as pages:
        last = pages.orderBy(F.desc("ts")).limit(1)
        end = last.select(F.col("page").withField("item", F.lit("zzendzz")).alias("page"),
                          (F.col("ts") + F.lit(j.SENTINEL_SHIFT_MS)).alias("ts"))
        rows = _stream(spark, pages, "search_pages", "ts", end)
    s = stats.keyword_search_stats(rows, w.params.window, as_of_ms=w.params.as_of_ms)
    return j.run_available_now(s, "keyword_search").filter(F.col("keyword") != "zzendzz")


def product_stats_stream(spark, d):
    """Product window sums under streaming: exact distinct orders by chained aggregates."""
    j = _jobs()
    w = Warehouse(spark, d)
    with j.landed(w.product_measures, "product_measures") as m:
        rows = _stream(spark, m, "product_measures", "ts", j.sentinel(m, "ts", "sku_id", -1))
    g = stats.product_window_sums(rows, w.params.window)
    g = g.select(*stats.window_bounds(instant=True), "sku_id", *[c for c in g.columns if c not in ("_w", "sku_id")])
    return _amounts(j.run_available_now(g, "product_stats").filter(F.col("sku_id") != -1))


def province_stats_stream(spark, d):
    """Province window aggregate over the stream of order-wide rows, exact distinct orders."""
    j = _jobs()
    w = Warehouse(spark, d)
    with j.landed(w.order_wide, "province_orders") as wide:
        rows = _stream(spark, wide, "province_orders", "create_ts", j.sentinel(wide, "create_ts", "province_id", -1))
    g = stats.province_stats(rows, w.params.window, as_of_ms=w.params.as_of_ms)
    return _amounts(j.run_available_now(g, "province_stats").filter(F.col("province_id") != -1))


def visitor_report_stream(spark, d):
    """Visitor statistics through the report job: a table of published batches, merged into day folders after every
    second batch, read by its manifests."""
    from ..sinks import report_tables
    j = _jobs()
    w, root = Warehouse(spark, d), new_location(spark, "visitor-report")
    with j.landed(w.visitor_measures, "visitor_measures") as m:
        rows = _stream(spark, m, "visitor_report", "ts", j.sentinel(m, "ts", "vc"))
    s = j.visitor_stats_stream(rows, w.params.visitor_window, w.params.as_of_ms)
    j.start_report(s, "visitor_stats", s.columns, root, merge_every=2).awaitTermination()
    return report_tables.read(spark, f"{root}/visitor_stats").drop("dt").filter(F.col("vc") != j.SENTINEL)


def cdc_route_fact_stream(spark, d):
    j = _jobs()
    raw = _stream(spark, T.cdc_raw(spark, d), "cdc_raw", "seq")
    facts = j.routed_facts_stream(raw, T.routing_config(spark))

    def write(batch, batch_id, out):
        _record_view(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    out = j.run_available_now(facts, "cdc_facts", foreach=write)
    return out.select("seq", "table", "type", "sink_table", "n_cols", "id")


def dim_upsert_merge_stream(spark, d):
    """The change feed through the change layer, in several micro-batches: all configured dimensions, by their own
    keys (one column, two columns), as (dimension, key, column, value) of their newest published version."""
    j = _jobs()
    root = new_location(spark, "dim-stream")
    raw = _stream(spark, T.cdc_raw(spark, d), "cdc_dims", "seq")
    j.start_change_layer(raw, root, T.dimension_config).awaitTermination()
    out = f"{root}/changes"
    names = sorted({r[3] for r in T.ROUTING_CONFIG if r[2] == "hbase"})
    rows = [Dimension(spark, f"{out}/dims/{n}").read().select(F.lit(n).alias("dimension"), F.col("id").alias("key"),
                                                             F.explode("data").alias("column", "value")) for n in names]
    return stats.union_all(rows)


QUERIES.update({f.__name__: f for f in [
    dim_upsert_merge_stream, unique_visit_stream, bounce_as_written_stream, bounce_as_documented_stream, new_visitor_repair_stream, order_interval_join_stream,
    order_wide_stream, order_wide_json_stream, keyword_product_stream, payment_wide_stream, visitor_stats_stream, keyword_search_stream, product_stats_stream,
    province_stats_stream, visitor_report_stream, cdc_route_fact_stream,
]})
