"""Event-time interval joins and the two wide tables.

``interval_join`` is an inner equi-join plus a time range; the same expression runs in batch
(sort-merge join on the key, range as a post-condition) and in Structured Streaming (state is
evicted by the watermarks).  A hot join key is split by AQE's skew-join handling in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefmt import TEXT_OFFSET_HOURS, age_years, event_time, with_millis
from ..schemas import ORDER_WIDE_COLUMNS, PAYMENT_WIDE_COLUMNS
from .lookup import enrich


def _ms(v: str) -> int:
    """'5 milliseconds' / '30 minutes' / '4 hours' / '1 day' -> millis."""
    n, unit = v.split()
    n = float(n)
    unit = unit.lower().rstrip("s")
    scale = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit]
    return int(n * scale)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ms: str, right_ms: str, lower: str, upper: str, *,
                  watermark: str | None = "3 seconds") -> DataFrame:
    """Inner join on ``left_key = right_key`` with
    ``right time BETWEEN left time + lower AND left time + upper`` (both ends inclusive).

    ``lower``/``upper`` are signed durations such as ``'-5 milliseconds'``.  Times are epoch-millis
    columns.  Batch compares them as they are; when streaming, event-time columns ``_lt``/``_rt`` are
    derived, watermarked and dropped from the output.
    """
    streaming = left.isStreaming or right.isStreaming
    lo, hi = _ms(lower.lstrip("-")) * (-1 if lower.startswith("-") else 1), _ms(upper.lstrip("-")) * (-1 if upper.startswith("-") else 1)
    if not streaming:
        lt, rt = left.withColumn("_lt", F.col(left_ms)), right.withColumn("_rt", F.col(right_ms))
        cond = (lt[left_key] == rt[right_key]) & rt["_rt"].between(lt["_lt"] + F.lit(lo), lt["_lt"] + F.lit(hi))
        return lt.join(rt, cond, "inner").drop("_lt", "_rt")
    lt = left.withColumn("_lt", event_time(F.col(left_ms), streaming))
    rt = right.withColumn("_rt", event_time(F.col(right_ms), streaming))
    if watermark:
        lt = lt.withWatermark("_lt", watermark)
        rt = rt.withWatermark("_rt", watermark)
    cond = ((lt[left_key] == rt[right_key])
            & (rt["_rt"] >= F.timestamp_add("MILLISECOND", F.lit(lo), lt["_lt"]))
            & (rt["_rt"] <= F.timestamp_add("MILLISECOND", F.lit(hi), lt["_lt"])))
    return lt.join(rt, cond, "inner").drop("_lt", "_rt")


def order_detail_join(order_info: DataFrame, order_detail: DataFrame, within: str = "5 milliseconds",
                      watermark: str | None = "3 seconds") -> DataFrame:
    """Order x detail merged into the un-enriched wide row (dimension columns still NULL)."""
    o = order_info.select(*[F.col(c).alias("o_" + c) for c in order_info.columns])
    d = order_detail.select(*[F.col(c).alias("d_" + c) for c in order_detail.columns])
    j = interval_join(o, d, "o_id", "d_order_id", "o_create_ts", "d_create_ts", "-" + within, within,
                      watermark=watermark)
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("decimal(18,2)")
    return j.select(
        F.col("d_id").alias("detail_id"), F.col("o_id").alias("order_id"), F.col("d_sku_id").alias("sku_id"),
        F.col("d_order_price").alias("order_price"), F.col("d_sku_num").alias("sku_num"),
        F.col("d_sku_name").alias("sku_name"), F.col("o_province_id").alias("province_id"),
        F.col("o_order_status").alias("order_status"), F.col("o_user_id").alias("user_id"),
        F.col("o_total_amount").alias("total_amount"),
        F.col("o_activity_reduce_amount").alias("activity_reduce_amount"),
        F.col("o_coupon_reduce_amount").alias("coupon_reduce_amount"),
        F.col("o_original_total_amount").alias("original_total_amount"),
        F.col("o_feight_fee").alias("feight_fee"), null_d.alias("split_feight_fee"),
        F.col("d_split_activity_amount").alias("split_activity_amount"),
        F.col("d_split_coupon_amount").alias("split_coupon_amount"),
        F.col("d_split_total_amount").alias("split_total_amount"),
        null_s.alias("expire_time"), F.col("o_create_time").alias("create_time"), null_s.alias("operate_time"),
        F.col("o_create_date").alias("create_date"), null_s.alias("create_hour"),
        F.col("o_create_ts").alias("create_ts"))


def enrich_order_wide(wide: DataFrame, dims: dict[str, DataFrame], as_of_ms: int,
                      offset_hours: int = TEXT_OFFSET_HOURS, unique_dims: bool = False) -> DataFrame:
    """Dimension lookups of the order-wide row: user, province, sku (overwrites ``sku_name``),
    then spu / trademark / category3 keyed by the sku's values."""
    # the age is computed once per user on the dimension side, not once per order line
    users = dims["user"].withColumn("_age", age_years(F.col("birthday"), F.lit(as_of_ms), offset_hours))
    w = enrich(wide, users, "user_id", {"user_age": "_age", "user_gender": "gender"}, unique=unique_dims)
    w = enrich(w, dims["province"], "province_id",
               {"province_name": "name", "province_area_code": "area_code", "province_iso_code": "iso_code",
                "province_3166_2_code": "iso_3166_2"}, unique=unique_dims)
    w = enrich(w, dims["sku"], "sku_id", {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "tm_id",
                                           "category3_id": "category3_id"}, overwrite=("sku_name",), unique=unique_dims)
    w = enrich(w, dims["spu"], "spu_id", {"spu_name": "spu_name"}, unique=unique_dims)
    w = enrich(w, dims["trademark"], "tm_id", {"tm_name": "tm_name"}, unique=unique_dims)
    w = enrich(w, dims["category3"], "category3_id", {"category3_name": "name"})
    return w.select(*ORDER_WIDE_COLUMNS, "create_ts")


def order_wide(order_info: DataFrame, order_detail: DataFrame, dims: dict[str, DataFrame], *,
               within: str = "5 milliseconds", as_of_ms: int, watermark: str | None = "3 seconds",
               offset_hours: int = TEXT_OFFSET_HOURS, unique_dims: bool = False) -> DataFrame:
    return enrich_order_wide(order_detail_join(order_info, order_detail, within, watermark), dims, as_of_ms,
                             offset_hours, unique_dims)


def _payments(payment_info: DataFrame, offset_hours: int, also: list[str]) -> DataFrame:
    """The payment side of a join with order lines: its own columns told apart, its text times read once."""
    times = {"p_ts": "callback_time", **{c: "create_time" for c in also}}
    return with_millis(payment_info, times, offset_hours).select(F.col("id").alias("payment_id"), "subject", "payment_type",
                            F.col("create_time").alias("payment_create_time"), "callback_time",
                            F.col("order_id").alias("p_order_id"), F.col("user_id").alias("p_user_id"),
                            F.col("total_amount").alias("p_total_amount"),
                            "p_ts", *also)


def payment_wide(payment_info: DataFrame, wide: DataFrame, *, within: str = "1800 seconds",
                 watermark: str | None = "3 seconds", offset_hours: int = TEXT_OFFSET_HOURS,
                 create_ts: bool = False) -> DataFrame:
    """Payment x order-wide: same order, order time in ``[callback - within, callback]``.

    Every wide column is copied, then the payment's own values win on shared names
    (``order_id``, ``user_id``, ``total_amount``); ``create_time`` is renamed on both sides.
    ``wide`` may also be the un-enriched order lines: absent wide columns are simply not output.
    ``create_ts`` adds ``payment_create_ts`` (epoch millis), read once per payment and not once per line.
    """
    also = ["payment_create_ts"] if create_ts else []
    p = _payments(payment_info, offset_hours, also)
    w = wide.withColumnRenamed("create_time", "order_create_time")
    j = interval_join(p, w, "p_order_id", "order_id", "p_ts", "create_ts", "-" + within, "0 seconds",
                      watermark=watermark)
    j = j.drop("order_id", "user_id", "total_amount").withColumnsRenamed(
        {"p_order_id": "order_id", "p_user_id": "user_id", "p_total_amount": "total_amount"})
    return j.select(*[c for c in PAYMENT_WIDE_COLUMNS if c in j.columns], "p_ts", *also)


def lines_with_payments(payment_info: DataFrame, lines: DataFrame, *, within: str = "1800 seconds",
                        offset_hours: int = TEXT_OFFSET_HOURS) -> DataFrame:
    """Batch ``payment_wide`` and the order lines themselves from one pass over the lines: every line once per payment of
    its order, at least once.

    ``line_first`` marks one row of each line (these rows are the order lines), ``line_paid`` the rows whose order time is
    in ``[callback - within, callback]`` (these are the rows of ``payment_wide``), ``payment_create_ts`` is the payment's.
    The pairs are those that the interval join looks at; a payment is numbered in the partitioning of that join.
    """
    nth = F.row_number().over(Window.partitionBy("p_order_id").orderBy("p_ts"))
    p = _payments(payment_info, offset_hours, ["payment_create_ts"]).where(F.col("p_order_id").isNotNull()).select(
        "p_order_id", "p_ts", "payment_create_ts", nth.alias("_nth"))
    paid = F.col("create_ts").between(F.col("p_ts") - F.lit(_ms(within)), F.col("p_ts"))
    return lines.join(p, F.col("order_id") == F.col("p_order_id"), "left").select(
        *lines.columns, (F.coalesce(F.col("_nth"), F.lit(1)) == 1).alias("line_first"),
        F.coalesce(paid, F.lit(False)).alias("line_paid"), "payment_create_ts")


# The order/detail fields that two partial wide rows can both carry.
MERGEABLE = ["order_status", "create_time", "create_date", "user_id", "total_amount",
             "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount", "feight_fee",
             "order_id", "order_price", "sku_id", "sku_num", "sku_name"]


def merge_first_non_null(left: DataFrame, right: DataFrame, key: str, columns: list[str] = MERGEABLE) -> DataFrame:
    """Merge two partial wide rows per ``key``: each column takes the left value, else the right one.

    The three split amounts are left-only: they are kept from ``left`` and never merged.  Only
    columns present on both sides are merged; ``right`` must hold one row per key."""
    columns = [c for c in columns if c != key and c in left.columns and c in right.columns]
    r = right.select(F.col(key).alias("_r_key"), *[F.col(c).alias("_r_" + c) for c in columns])
    j = left.join(r, F.col(key) == F.col("_r_key"), "left")
    out = {c: F.coalesce(F.col(c), F.col("_r_" + c)) for c in columns}
    return j.withColumns(out).drop(*[c for c in j.columns if c.startswith("_r_")])
