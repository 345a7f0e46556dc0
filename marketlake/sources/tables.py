"""Inputs of the warehouse derived from the driver's parquet tables.

The rules below are deterministic, so each input has an exact SQL twin (``marketlake.plans.oracle``):

* behaviour log  <- ``events`` (one log line per event; ``signup`` events are app-start logs,
  everything else a page log; ``event_id`` is the arrival order ``seq``)
* order facts    <- ``orders`` + ``customer`` (province = the customer's nation)
* order details  <- ``lineitem`` (time = ship time, or the order's time for the wide table)
* payments       <- paid/finished orders, callback ``(id % 60)`` minutes after the order
* favor / cart   <- click / purchase events; refund / comment <- lineitem return flags
* dimensions     <- ``customer`` (user), ``nation``+``region`` (province), ``part`` (sku, spu,
  trademark = brand, category3 = type)
* change records <- the same rows as ``map`` payloads (``cdc_records``) plus a routing config
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import DATE_FMT, datetime_str, ntz_to_millis
from ..schemas import AMOUNT

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# The report date used by the dashboard queries is derived per row; this fixed instant pins the
# "now" of wall-clock columns (``ts`` of the aggregate tables, the age of a user) in queries.
AS_OF_MS = 1735689600000  # 2025-01-01 00:00:00 UTC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c) -> F.Column:
    return F.col(c).cast(AMOUNT) if isinstance(c, str) else c.cast(AMOUNT)


def _zero() -> F.Column:
    return F.lit(0).cast(AMOUNT)


# ---- behaviour log ----------------------------------------------------------------------------

def part_count(spark: SparkSession, sf_dir: str) -> F.Column:
    """Number of parts, as a scalar subquery: events point at any of them, however many there are."""
    return table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()


def _item_of(event_id, parts) -> F.Column:
    return (event_id * 7) % parts


def log_events(spark: SparkSession, sf_dir: str, names: bool = True) -> DataFrame:
    """Parsed behaviour log: ``seq, common, start, page, displays, ts`` (ts = epoch millis).

    Search pages (``good_list``) carry the searched text in ``page.item``: the name of the part
    the event points at.  ``names=False`` leaves it NULL and spares the join with ``part``: for readers of
    anything else.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").cast("int")
    parts = part_count(spark, sf_dir)
    e = e.withColumn("k", k).withColumn("_n", parts).withColumn("_item", _item_of(F.col("event_id"), F.col("_n")))
    if names:
        part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_pk"), F.col("p_name").alias("_pname"))
        e = e.join(part, (F.col("event_type") == "click") & (F.col("_item") == F.col("_pk")), "left")
    else:
        e = e.withColumn("_pname", F.lit(None).cast("string"))
    mid = F.col("user_id").cast("string")
    is_page = F.col("event_type") != "signup"
    page_id = (F.when(F.col("event_type") == "view", "good_detail")
               .when(F.col("event_type") == "click", "good_list")
               .when(F.col("event_type") == "purchase", "trade").otherwise("home"))
    last_page = F.when(F.col("k") < 50, F.lit(None).cast("string")).when(F.col("k") < 55, "").otherwise("home")
    item = F.when(F.col("event_type") == "click", F.col("_pname")).otherwise(F.col("_item").cast("string"))
    item_type = F.when(F.col("event_type") == "click", "keyword").otherwise("sku_id")
    page = F.struct(page_id.alias("page_id"), last_page.alias("last_page_id"), item.alias("item"),
                    item_type.alias("item_type"),
                    F.round(F.col("value") * 100, 0).cast("bigint").alias("during_time"),
                    F.lit(None).cast("string").alias("source_type"))
    disp = [F.struct(((F.col("event_id") + i) % F.col("_n")).cast("string").alias("item"),
                     F.lit("sku_id" if i % 2 == 0 else "activity_id").alias("item_type"),
                     F.lit("recommend").alias("display_type"), F.lit(i + 1).cast("bigint").alias("order"),
                     F.lit(str(i + 1)).alias("pos_id")) for i in range(3)]
    displays = F.slice(F.array(*disp), 1, F.col("k") % 4)
    common = F.struct(mid.alias("mid"), mid.alias("uid"), F.concat(F.lit("v"), (F.col("k") % 2).cast("string")).alias("vc"),
                      F.concat(F.lit("ch"), (F.col("user_id") % 4).cast("string")).alias("ch"),
                      F.concat(F.lit("ar"), (F.col("user_id") % 5).cast("string")).alias("ar"),
                      F.lit(None).cast("string").alias("md"), F.lit(None).cast("string").alias("os"),
                      F.lit(None).cast("string").alias("ba"),
                      F.when(F.col("k") % 3 == 0, "0").otherwise("1").alias("is_new"))
    start = F.when(~is_page, F.create_map(F.lit("entry"), F.lit("icon"), F.lit("loading_time"),
                                          (F.col("k") * 10).cast("string")))
    return e.select(
        F.col("event_id").alias("seq"),
        common.alias("common"),
        start.alias("start"),
        F.when(is_page, page).alias("page"),
        F.when(is_page, displays).alias("displays"),
        F.lit(None).cast("map<string,string>").alias("err"),
        ntz_to_millis("ts").alias("ts"),
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed log as text: ``seq, value`` with one JSON object per row (nulls omitted)."""
    lg = log_events(spark, sf_dir)
    return lg.select("seq", F.to_json(F.struct("common", "start", "page", "displays", "ts")).alias("value"))


# ---- order facts ------------------------------------------------------------------------------

def _ms_of_text_time(ts: str) -> F.Column:
    """``create_ts``: what parsing the second-resolution text time gives, computed without the
    format/parse round trip."""
    return ntz_to_millis(F.date_trunc("second", F.col(ts))).alias("create_ts")


ORDER_STATUS_OF = {"F": "1004", "P": "1002"}  # anything else is unpaid (1001)


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    status = (F.when(F.col("o_orderstatus") == "F", "1004").when(F.col("o_orderstatus") == "P", "1002")
              .otherwise("1001"))
    ct = datetime_str("o_orderdate")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey"), "inner").select(
        F.col("o_orderkey").alias("id"), F.col("c_nationkey").cast("bigint").alias("province_id"),
        status.alias("order_status"), F.col("o_custkey").alias("user_id"),
        _dec("o_totalprice").alias("total_amount"), _zero().alias("activity_reduce_amount"),
        _zero().alias("coupon_reduce_amount"), _dec("o_totalprice").alias("original_total_amount"),
        _zero().alias("feight_fee"), F.lit(None).cast("string").alias("expire_time"),
        ct.alias("create_time"), F.lit(None).cast("string").alias("operate_time"),
        F.date_format("o_orderdate", DATE_FMT).alias("create_date"),
        F.date_format("o_orderdate", "HH").alias("create_hour"),
        _ms_of_text_time("o_orderdate"))


def order_detail(spark: SparkSession, sf_dir: str, time: str = "ship") -> DataFrame:
    """Order details from lineitem.  ``time='ship'``: a detail's time is its ship date;
    ``time='order'``: its order's time (details are written with their order)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                 "l_extendedprice", "l_shipdate")
    if time == "order":
        o = table(spark, sf_dir, "orders").select(F.col("o_orderkey"), F.col("o_orderdate").alias("_t"), _ms_of_text_time("o_orderdate"))
        li = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    elif time == "ship":
        li = li.withColumn("_t", F.col("l_shipdate")).withColumn("create_ts", _ms_of_text_time("l_shipdate"))
    else:
        raise ValueError(time)
    ct = datetime_str("_t")
    return li.select(
        F.lit(None).cast("bigint").alias("id"),  # lineitem has no row id
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        _dec("l_extendedprice").alias("order_price"), F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"), ct.alias("create_time"),
        _dec("l_extendedprice").alias("split_total_amount"), _zero().alias("split_activity_amount"),
        _zero().alias("split_coupon_amount"), "create_ts")


PAYMENT_TYPES = ["1101", "1102", "1103"]


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("F", "P"))
    cb = F.timestamp_add("MINUTE", F.col("o_orderkey") % 60, F.col("o_orderdate"))
    ptype = F.element_at(F.array(*[F.lit(x) for x in PAYMENT_TYPES]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("out_trade_no"),
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), ptype.alias("payment_type"),
        F.lit(None).cast("string").alias("trade_no"), _dec("o_totalprice").alias("total_amount"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("subject"),
        F.lit("1602").alias("payment_status"), datetime_str("o_orderdate").alias("create_time"),
        datetime_str(cb).alias("callback_time"))


def favor_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    e = e.filter(F.get_json_object("props", "$.k").cast("int") % 10 == 0)
    return e.select(F.col("event_id").alias("id"), F.col("user_id"), _item_of(F.col("event_id"), part_count(spark, sf_dir)).alias("sku_id"),
                    datetime_str("ts").alias("create_time"))


def cart_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(F.col("event_id").alias("id"), F.col("user_id"), _item_of(F.col("event_id"), part_count(spark, sf_dir)).alias("sku_id"),
                    datetime_str("ts").alias("create_time"))


def order_refund_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
                     _dec("l_extendedprice").alias("refund_amount"), datetime_str("l_shipdate").alias("create_time"))


def comment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "A")
    appraise = F.when(F.col("l_linenumber") % 3 == 0, "1201").otherwise("1202")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
                     appraise.alias("appraise"), datetime_str("l_shipdate").alias("create_time"))


# ---- dimensions (one row per id) --------------------------------------------------------------

def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    bday = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.date_format(bday, DATE_FMT).alias("birthday"),
                    F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"))


def dim_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    iso = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return n.join(r, F.col("n_regionkey") == F.col("r_regionkey"), "inner").select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").cast("string").alias("region_id"), F.col("r_name").alias("area_code"),
        iso.alias("iso_code"), F.concat(iso, F.lit("-"), F.substring("r_name", 1, 2)).alias("iso_3166_2"))


def _category3_id(t) -> F.Column:
    return F.length(t) * 100 + F.ascii(t)


def _tm_id(b) -> F.Column:
    return F.substring_index(b, "#", -1).cast("bigint")


def dim_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                    _dec("p_retailprice").alias("price"), (F.col("p_partkey") / 10).cast("bigint").alias("spu_id"),
                    _tm_id(F.col("p_brand")).alias("tm_id"), _category3_id(F.col("p_type")).cast("bigint").alias("category3_id"))


def dim_spu(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select((F.col("p_partkey") / 10).cast("bigint").alias("id")).distinct()
    return p.select("id", F.concat(F.lit("spu-"), F.col("id").cast("string")).alias("spu_name"))


def dim_trademark(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_brand").distinct()
    return p.select(_tm_id(F.col("p_brand")).alias("id"), F.col("p_brand").alias("tm_name"))


def dim_category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_type").distinct()
    return p.select(_category3_id(F.col("p_type")).cast("bigint").alias("id"), F.col("p_type").alias("name"))


def joined_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names written without separators: ``id, text``."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.regexp_replace("p_name", r"[^\p{L}\p{N}]+", "").alias("text"))


def user_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary table: the words of three to seven characters of the part names and types."""
    p = table(spark, sf_dir, "part")
    both = p.select(F.explode(F.split(F.concat_ws(" ", "p_name", "p_type"), r"[^\p{L}\p{N}]+")).alias("word"))
    return both.where(F.char_length("word").between(3, 7)).distinct()


# ---- change records and routing config --------------------------------------------------------

# Fixed routing configuration of the driver profile: (source_table, operate_type, sink_type,
# sink_table, sink_columns, sink_pk, sink_extend).
ROUTING_CONFIG = [
    ("user_info", "insert", "hbase", "dim_user_info", "id,name,birthday,gender", "id", None),
    ("user_info", "update", "hbase", "dim_user_info", "id,name,birthday,gender", "id", None),
    ("sku_info", "insert", "hbase", "dim_sku_info", "id,sku_name,price,spu_id,tm_id,category3_id", "id", None),
    ("base_province", "insert", "hbase", "dim_base_province", "id,name,region_id", "id", None),
    ("order_info", "insert", "kafka", "dwd_order_info", "id,user_id,order_status,total_amount,create_time", "id", None),
    ("order_info", "update", "kafka", "dwd_order_info", "id, order_status", "id", None),
    ("order_detail", "insert", "kafka", "dwd_order_detail", "order_id,sku_id,sku_num,order_price,create_time", "id", None),
    ("payment_info", "insert", "clickhouse", "payment_stats", "id,order_id,total_amount", "id", None),
]


#: Key and extension of the dimension tables that do not go by ``id``: one key column, two key columns.
DIMENSION_KEYS = {"dim_base_province": ("name", "SALT_BUCKETS=4"), "dim_sku_info": ("tm_id,id", "SALT_BUCKETS=32")}


def routing_config(spark: SparkSession) -> DataFrame:
    from ..schemas import TABLE_PROCESS
    return spark.createDataFrame(ROUTING_CONFIG, TABLE_PROCESS)


def dimension_config(spark: SparkSession) -> DataFrame:
    """The dimension rows of the routing config, keyed by ``DIMENSION_KEYS``."""
    from ..schemas import SINK_HBASE, TABLE_PROCESS
    rows = [(*r[:5], *DIMENSION_KEYS.get(r[3], r[5:])) for r in ROUTING_CONFIG if r[2] == SINK_HBASE]
    return spark.createDataFrame(rows, TABLE_PROCESS)


#: Changes of the routing config during the run: (arrival position, change, row of ROUTING_CONFIG, other sink table).
CONFIG_CHANGES = ([(-1, "insert", i, None) for i in range(len(ROUTING_CONFIG))]
                  + [(400, "update", 6, "dwd_order_detail_v2"), (700, "delete", 4, None), (900, "insert", 4, "dwd_order_info_again"),
                     (950, "delete", 6, None), (1200, "insert", 6, "dwd_order_detail_v3"), (100, "delete", 0, None), (250, "insert", 0, None)])


def config_feed(spark: SparkSession) -> DataFrame:
    """The routing config as a change feed ``(seq, type, data)`` with updates, deletes and re-inserts."""
    names = ["source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend"]
    rows = []
    for seq, change, i, sink in CONFIG_CHANGES:
        row = dict(zip(names, ROUTING_CONFIG[i]))
        rows.append((seq, change, row | ({"sink_table": sink} if sink else {})))
    return spark.createDataFrame(rows, "seq long, type string, data map<string,string>")


def _m(*pairs) -> F.Column:
    args = []
    for k, v in pairs:
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)


def cdc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records ``(seq, database, table, type, data MAP<STRING,STRING>, ts)`` derived from
    the driver tables: inserts of customers, parts, nations, orders, lineitems, payments and
    suppliers (unconfigured); updates of customers with a negative balance (name upper-cased) and
    of finished orders (status change); dirty records from regions (no table / empty data)."""
    def rec(df, seq, table_name, type_, data, ts):
        return df.select(seq.cast("bigint").alias("seq"), F.lit("shop").alias("database"),
                         table_name.alias("table"), F.lit(type_).alias("type"), data.alias("data"), ts.cast("bigint").alias("ts"))

    t = lambda n: table(spark, sf_dir, n)
    c, p, n, o, li, s, r = (t(x) for x in ("customer", "part", "nation", "orders", "lineitem", "supplier", "region"))
    odate = ntz_to_millis("o_orderdate")
    ship = ntz_to_millis("l_shipdate")
    out = [
        rec(c, F.col("c_custkey"), F.lit("user_info"), "insert",
            _m(("id", F.col("c_custkey")), ("name", F.col("c_name")),
               ("birthday", F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int")), DATE_FMT)),
               ("gender", F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F")), ("segment", F.col("c_mktsegment"))),
            F.lit(0)),
        rec(c.filter(F.col("c_acctbal") < 0), F.col("c_custkey") + F.lit(1 << 40), F.lit("user_info"), "update",
            _m(("id", F.col("c_custkey")), ("name", F.upper("c_name"))), F.lit(1)),
        rec(p, F.col("p_partkey"), F.lit("sku_info"), "insert",
            _m(("id", F.col("p_partkey")), ("sku_name", F.col("p_name")), ("price", F.col("p_retailprice").cast(AMOUNT)),
               ("spu_id", (F.col("p_partkey") / 10).cast("bigint")), ("tm_id", F.substring_index("p_brand", "#", -1)),
               ("category3_id", F.length("p_type") * 100 + F.ascii("p_type")), ("size", F.col("p_size"))),
            F.lit(0)),
        rec(n, F.col("n_nationkey"), F.lit("base_province"), "insert",
            _m(("id", F.col("n_nationkey")), ("name", F.col("n_name")), ("region_id", F.col("n_regionkey"))), F.lit(0)),
        rec(o, F.col("o_orderkey"), F.lit("order_info"), "insert",
            _m(("id", F.col("o_orderkey")), ("user_id", F.col("o_custkey")), ("order_status", F.lit("1001")),
               ("total_amount", F.col("o_totalprice").cast(AMOUNT)), ("create_time", datetime_str("o_orderdate")),
               ("priority", F.col("o_orderpriority"))), odate),
        rec(o.filter(F.col("o_orderstatus") == "F"), F.col("o_orderkey") + F.lit(1 << 40), F.lit("order_info"), "update",
            _m(("id", F.col("o_orderkey")), ("order_status", F.lit("1004"))), odate),
        rec(li, F.col("l_orderkey"), F.lit("order_detail"), "insert",
            _m(("order_id", F.col("l_orderkey")), ("sku_id", F.col("l_partkey")), ("sku_num", F.col("l_quantity").cast("bigint")),
               ("order_price", F.col("l_extendedprice").cast(AMOUNT)), ("create_time", datetime_str("l_shipdate")),
               ("line", F.col("l_linenumber"))), ship),
        rec(o.filter(F.col("o_orderstatus").isin("F", "P")), F.col("o_orderkey"), F.lit("payment_info"), "insert",
            _m(("id", F.col("o_orderkey")), ("order_id", F.col("o_orderkey")), ("total_amount", F.col("o_totalprice").cast(AMOUNT))),
            odate),
        rec(s, F.col("s_suppkey"), F.lit("supplier_info"), "insert",
            _m(("id", F.col("s_suppkey")), ("name", F.col("s_name"))), F.lit(0)),
        rec(r, F.col("r_regionkey"), F.lit(None).cast("string"), "insert",
            _m(("id", F.col("r_regionkey")), ("name", F.col("r_name"))), F.lit(0)),
        rec(r, F.col("r_regionkey"), F.lit("base_region"), "insert",
            F.create_map().cast("map<string,string>"), F.lit(0)),
    ]
    return reduce(lambda a, b: a.unionByName(b), out)


def cdc_raw(spark: SparkSession, sf_dir: str, source_table: str | None = None) -> DataFrame:
    """The change feed as JSON text: ``seq, value``; with ``source_table`` only that table's feed (the
    other tables are not read: the filter on the literal name prunes their branches)."""
    r = cdc_records(spark, sf_dir)
    if source_table is not None:
        r = r.filter(F.col("table") == F.lit(source_table))
    return r.select("seq", F.to_json(F.struct("database", "table", "type", "data", "ts")).alias("value"))
