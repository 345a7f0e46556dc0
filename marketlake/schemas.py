"""Declared schemas: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DecimalType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType)

S, L = StringType(), LongType()
AMOUNT = DecimalType(18, 2)
AMOUNT_SUM = DecimalType(38, 2)


def _st(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# ---- behaviour log (one JSON object per line) -------------------------------------------------
COMMON = _st(("mid", S), ("uid", S), ("vc", S), ("ch", S), ("ar", S), ("md", S), ("os", S),
             ("ba", S), ("is_new", S))
PAGE = _st(("page_id", S), ("last_page_id", S), ("item", S), ("item_type", S),
           ("during_time", L), ("source_type", S))
DISPLAY = _st(("item", S), ("item_type", S), ("display_type", S), ("order", L), ("pos_id", S))
LOG = _st(("common", COMMON), ("start", MapType(S, S)), ("page", PAGE),
          ("displays", ArrayType(DISPLAY)), ("err", MapType(S, S)), ("ts", L))
# the SQL-facing view of the page log: maps instead of structs
PAGE_VIEW = _st(("common", MapType(S, S)), ("page", MapType(S, S)), ("ts", L))

# ---- change records ---------------------------------------------------------------------------
CHANGE = _st(("database", S), ("table", S), ("type", S), ("data", MapType(S, S)), ("ts", L))
TABLE_PROCESS = _st(("source_table", S), ("operate_type", S), ("sink_type", S), ("sink_table", S),
                    ("sink_columns", S), ("sink_pk", S), ("sink_extend", S))
SINK_KAFKA, SINK_HBASE, SINK_CLICKHOUSE = "kafka", "hbase", "clickhouse"

# ---- facts ------------------------------------------------------------------------------------
ORDER_INFO = _st(("id", L), ("province_id", L), ("order_status", S), ("user_id", L),
                 ("total_amount", AMOUNT), ("activity_reduce_amount", AMOUNT),
                 ("coupon_reduce_amount", AMOUNT), ("original_total_amount", AMOUNT),
                 ("feight_fee", AMOUNT), ("expire_time", S), ("create_time", S),
                 ("operate_time", S), ("create_date", S), ("create_hour", S), ("create_ts", L))
ORDER_DETAIL = _st(("id", L), ("order_id", L), ("sku_id", L), ("order_price", AMOUNT),
                   ("sku_num", L), ("sku_name", S), ("create_time", S),
                   ("split_total_amount", AMOUNT), ("split_activity_amount", AMOUNT),
                   ("split_coupon_amount", AMOUNT), ("create_ts", L))
PAYMENT_INFO = _st(("id", L), ("out_trade_no", S), ("order_id", L), ("user_id", L),
                   ("payment_type", S), ("trade_no", S), ("total_amount", AMOUNT), ("subject", S),
                   ("payment_status", S), ("create_time", S), ("callback_time", S))

# Fixed values from here on: the column names and their order that tables and sinks share.
# ---- wide rows (column order of the wide tables) ----------------------------------------------
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id",
    "order_status", "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "expire_time", "create_time", "operate_time",
    "create_date", "create_hour", "province_name", "province_area_code", "province_iso_code",
    "province_3166_2_code", "user_age", "user_gender", "spu_id", "tm_id", "category3_id",
    "spu_name", "tm_name", "category3_name",
]
PAYMENT_WIDE_COLUMNS = [
    "payment_id", "subject", "payment_type", "payment_create_time", "callback_time", "detail_id",
    "order_id", "sku_id", "order_price", "sku_num", "sku_name", "province_id", "order_status",
    "user_id", "total_amount", "activity_reduce_amount", "coupon_reduce_amount",
    "original_total_amount", "feight_fee", "split_feight_fee", "split_activity_amount",
    "split_coupon_amount", "split_total_amount", "order_create_time", "province_name",
    "province_area_code", "province_iso_code", "province_3166_2_code", "user_age", "user_gender",
    "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name",
]

# ---- aggregate tables, in sink column order ---------------------------------------------------
VISITOR_STATS_COLUMNS = ["stt", "edt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct",
                         "uj_ct", "dur_sum", "ts"]
PRODUCT_STATS_COLUMNS = [
    "stt", "edt", "sku_id", "sku_name", "sku_price", "spu_id", "spu_name", "tm_id", "tm_name",
    "category3_id", "category3_name", "display_ct", "click_ct", "favor_ct", "cart_ct",
    "order_sku_num", "order_amount", "order_ct", "payment_amount", "paid_order_ct",
    "refund_order_ct", "refund_amount", "comment_ct", "good_comment_ct", "ts",
]
PROVINCE_STATS_COLUMNS = ["stt", "edt", "province_id", "province_name", "area_code", "iso_code",
                          "iso_3166_2", "order_amount", "order_count", "ts"]
KEYWORD_STATS_COLUMNS = ["keyword", "ct", "source", "stt", "edt", "ts"]

# what readers of the re-published product statistics take from them
PRODUCT_TOPIC = _st(("stt", S), ("edt", S), ("sku_id", L), ("sku_name", S), ("click_ct", L), ("cart_ct", L), ("order_ct", L))
