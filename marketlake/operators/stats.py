"""Summary layer: measure projections, unions, tumbling event-time window aggregates.

All aggregates are partial/final hash aggregates (map-side combine), so a hot group key never
moves more than one partial row per task.  Distinct order counts:

* product stats: a two-level aggregate -- first by ``(window, sku, order id)`` with a flag for each kind, then
  by ``(window, sku)`` counting the order-id groups -- which avoids the ``Expand`` that three
  ``count(distinct)`` would add; in batch the first level is one narrow aggregate per order stream (one for order and
  paid lines that come from one pass), in the partitioning of the join by order that the stream comes from;
* province stats: the same by (window, province, order id);
* streaming: the same two levels as chained append-mode aggregates; a state row holds one order, never
  the set of a window's orders.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import APPRAISE_GOOD, KEYWORD_SEARCH
from ..functions.text import keyword_sources, words
from ..functions.timefmt import DATETIME_FMT, TEXT_OFFSET_HOURS, day_from_millis, event_time, millis_to_ntz, with_millis
from ..schemas import (AMOUNT, AMOUNT_SUM, KEYWORD_STATS_COLUMNS, PRODUCT_STATS_COLUMNS,
                       PROVINCE_STATS_COLUMNS, VISITOR_STATS_COLUMNS)
from .joins import _ms
from .lookup import enrich
from .logs import is_entry, is_start



def _l0() -> Column:
    return F.lit(0).cast("bigint")


def _a0() -> Column:
    return F.lit(0).cast(AMOUNT)


def cents(c) -> Column:
    """DECIMAL(18,2) amount -> exact BIGINT cents.  Sums of BIGINT stay on primitive longs (a
    DECIMAL(18,2) sum widens to DECIMAL(28,2), accumulated as java BigDecimal); ANSI mode turns an
    overflow into an error, never a wrong total."""
    return ((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


def from_cents(c) -> Column:
    return ((F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)") * F.lit(Decimal("0.01"))).cast(AMOUNT_SUM)


def tumble(df: DataFrame, ts_ms: str, size: str, watermark: str | None) -> DataFrame:
    """Add event time ``_et`` (watermarked when streaming) for ``window(_et, size)``."""
    d = df.withColumn("_et", event_time(F.col(ts_ms), df.isStreaming))
    if df.isStreaming and watermark is not None:
        d = d.withWatermark("_et", watermark)
    return d


def _wall_clock(c: Column, instant: bool) -> Column:
    """Window bound -> UTC wall-clock text.  Instant (streaming) bounds go through epoch millis so
    the text does not depend on the session time zone; wall-clock (batch) bounds format as is."""
    if instant:
        c = millis_to_ntz(F.unix_millis(c))
    return F.date_format(c, DATETIME_FMT)


def window_bounds(w: str = "_w", instant: bool = False) -> list[Column]:
    return [_wall_clock(F.col(f"{w}.start"), instant).alias("stt"),
            _wall_clock(F.col(f"{w}.end"), instant).alias("edt")]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- visitors ---------------------------------------------------------------------------------

VISITOR_KEYS = ["vc", "ch", "ar", "is_new"]


VISITOR_SUMS = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _visitor_keys() -> list[Column]:
    return [F.col(f"common.{k}").alias(k) for k in VISITOR_KEYS]


def _visitor_rows(df: DataFrame, uv=None, pv=None, sv=None, uj=None, dur=None, keys: list | None = None) -> DataFrame:
    counts = [(c if c is not None else _l0()).alias(n) for n, c in zip(VISITOR_SUMS, (uv, pv, sv, uj, dur))]
    return df.select(*(keys or _visitor_keys()), *counts, "ts")


def visitor_measures(page_log: DataFrame, uv_rows: DataFrame, bounce_rows: DataFrame,
                     repair: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Four measure streams in one shape, unioned: page views (with duration), unique visits,
    sessions (entry pages) and bounces.  No measure depends on the new-visitor flag: rows of an unrepaired
    log are repaired once, by ``repair``, after the union."""
    one = F.lit(1).cast("bigint")
    # a page view and, on entry pages, a session: two rows of one pass over the page log
    view = F.struct(one.alias("pv_ct"), _l0().alias("sv_ct"), F.coalesce(F.col("page.during_time"), _l0()).alias("dur_sum"))
    entry = F.struct(_l0().alias("pv_ct"), one.alias("sv_ct"), _l0().alias("dur_sum"))
    both = page_log.select("common", "ts", F.explode(F.when(is_entry(), F.array(view, entry)).otherwise(F.array(view))).alias("_m"))
    keys = None if repair is None else ["common"]
    rows = union_all([_visitor_rows(both, pv=F.col("_m.pv_ct"), sv=F.col("_m.sv_ct"), dur=F.col("_m.dur_sum"), keys=keys),
                      _visitor_rows(uv_rows, uv=one, keys=keys), _visitor_rows(bounce_rows, uj=one, keys=keys)])
    return rows if repair is None else repair(rows).select(*_visitor_keys(), *VISITOR_SUMS, "ts")


def visitor_stats(measures: DataFrame, size: str = "10 seconds", *, as_of_ms: Column | int,
                  watermark: str | None = "3 seconds") -> DataFrame:
    """Window sums by (vc, ch, ar, is_new); bounces are summed too."""
    d = tumble(measures, "ts", size, watermark)
    g = d.groupBy(F.window("_et", size).alias("_w"), *VISITOR_KEYS).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in VISITOR_SUMS])
    ts = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    return g.select(*window_bounds(instant=measures.isStreaming), *VISITOR_KEYS, *VISITOR_SUMS,
                    ts.alias("ts")).select(*VISITOR_STATS_COLUMNS)


# ---- products ---------------------------------------------------------------------------------

PRODUCT_COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num", "comment_ct",
                  "good_comment_ct"]
PRODUCT_AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
ORDER_KINDS = {"order": "order_ct", "paid": "paid_order_ct", "refund": "refund_order_ct"}


def _product_rows(df: DataFrame, sku: Column, ts: Column, oid: Column | None = None, kind: Column | None = None, **measures: Column) -> DataFrame:
    cols = [sku.cast("bigint").alias("sku_id")]
    cols += [measures[c].cast("bigint").alias(c) for c in PRODUCT_COUNTS if c in measures]
    cols += [measures[c].cast(AMOUNT).alias(c) for c in PRODUCT_AMOUNTS if c in measures]
    cols += [oid.cast("bigint").alias("oid")] if oid is not None else []
    cols += [kind.alias("kind")] if kind is not None else []
    return df.select(*cols, ts.cast("bigint").alias("ts"))


def _seen_rows(page_log: DataFrame) -> DataFrame:
    """Clicks and displays, rows of one pass over the page log: the page's own item comes first, its displays after it."""
    shown = page_log.schema["displays"].dataType
    own = F.struct(*[(F.col("page.item") if f.name == "item" else F.lit(None)).cast(f.dataType).alias(f.name) for f in shown.elementType.fields])
    none = F.array().cast(shown.simpleString())
    items = F.concat(F.array(own), F.when(~is_start(), F.coalesce("displays", none)).otherwise(none))
    seen = page_log.select("ts", F.col("page.page_id").alias("_page"), F.posexplode(items).alias("_pos", "_m"))
    seen = seen.where(F.when(F.col("_pos") == 0, F.col("_page") == "good_detail").otherwise(F.col("_m.item_type") == "sku_id"))
    click = (F.col("_pos") == 0).cast("int")
    return _product_rows(seen, F.col("_m.item").try_cast("bigint"), F.col("ts"), click_ct=click, display_ct=1 - click)


def _line_rows(lines: DataFrame) -> DataFrame:
    """Order and paid rows of ``lines_with_payments``, each with its ``kind``; the measure of the other kind is zero."""
    order, paid = (F.struct(F.lit(k).alias("kind"), F.col(c).alias("ts")) for k, c in (("order", "create_ts"), ("paid", "payment_create_ts")))
    rows = (F.when(F.col("line_first") & F.col("line_paid"), F.array(order, paid)).when(F.col("line_first"), F.array(order))
            .when(F.col("line_paid"), F.array(paid)))
    d = lines.select("sku_id", "order_id", "sku_num", "split_total_amount", F.explode(rows).alias("_k"))

    def only(kind: str, c: str) -> Column:
        return F.when(F.col("_k.kind") == kind, F.col(c)).otherwise(F.lit(0))

    return _product_rows(d, F.col("sku_id"), F.col("_k.ts"), F.col("order_id"), order_sku_num=only("order", "sku_num"),
                         order_amount=only("order", "split_total_amount"), payment_amount=only("paid", "split_total_amount"), kind=F.col("_k.kind"))


def product_streams(page_log: DataFrame, favor: DataFrame, cart: DataFrame, order_wide: DataFrame,
                    payment_wide: DataFrame | None, refund: DataFrame, comment: DataFrame, *,
                    offset_hours: int = TEXT_OFFSET_HOURS) -> list[tuple[str | tuple[str, ...] | None, DataFrame]]:
    """Seven measure streams (page clicks + displays, favor, cart, order, payment, refund,
    comment), each a kind and rows of ``sku_id, ts`` and its own measures.  Order, payment and refund rows have a
    kind and carry the order id ``oid`` for the distinct counts.  Without ``payment_wide`` the order lines are those of
    ``lines_with_payments``: order and payment rows are one stream of two kinds and tell theirs in a column."""
    one = F.lit(1)

    def timed(df: DataFrame, c: str = "create_time") -> DataFrame:
        return with_millis(df, {"_ms": c}, offset_hours)

    seen = _seen_rows(page_log)
    fav = _product_rows(timed(favor), F.col("sku_id"), F.col("_ms"), favor_ct=one)
    crt = _product_rows(timed(cart), F.col("sku_id"), F.col("_ms"), cart_ct=one)
    rfd = _product_rows(timed(refund), F.col("sku_id"), F.col("_ms"), F.col("order_id"), refund_amount=F.col("refund_amount"))
    cmt = _product_rows(timed(comment), F.col("sku_id"), F.col("_ms"),
                        comment_ct=one, good_comment_ct=F.when(F.col("appraise") == APPRAISE_GOOD, 1).otherwise(0))
    if payment_wide is None:
        return [(None, seen), (None, fav), (None, crt), (("order", "paid"), _line_rows(order_wide)), ("refund", rfd), (None, cmt)]
    odr = _product_rows(order_wide, F.col("sku_id"), F.col("create_ts"), F.col("order_id"),
                        order_sku_num=F.col("sku_num"), order_amount=F.col("split_total_amount"))
    read = "payment_create_ts" in payment_wide.columns
    paid = payment_wide.withColumn("_ms", F.col("payment_create_ts")) if read else timed(payment_wide, "payment_create_time")
    pay = _product_rows(paid, F.col("sku_id"), F.col("_ms"), F.col("order_id"), payment_amount=F.col("split_total_amount"))
    return [(None, seen), (None, fav), (None, crt), ("order", odr), ("paid", pay), ("refund", rfd), (None, cmt)]


def product_union(streams: list[tuple[str | tuple[str, ...] | None, DataFrame]]) -> DataFrame:
    """Measure streams in one shape, unioned: what a stream does not measure is zero, ``kind``/``oid`` tell its orders."""
    def rows(kind: str | tuple[str, ...] | None, df: DataFrame) -> DataFrame:
        return df.select("sku_id", *[(F.col(c) if c in df.columns else _l0()).alias(c) for c in PRODUCT_COUNTS],
                         *[(F.col(c) if c in df.columns else _a0()).alias(c) for c in PRODUCT_AMOUNTS], (F.col("kind") if isinstance(kind, tuple) else F.lit(kind).cast("string")).alias("kind"),
                         (F.col("oid") if kind else F.lit(None).cast("bigint")).alias("oid"), "ts")

    return union_all([rows(kind, df) for kind, df in streams])


def product_measures(page_log: DataFrame, favor: DataFrame, cart: DataFrame, order_wide: DataFrame,
                     payment_wide: DataFrame, refund: DataFrame, comment: DataFrame, *,
                     offset_hours: int = TEXT_OFFSET_HOURS) -> DataFrame:
    """The seven measure streams (see ``product_streams``) in one shape, unioned."""
    return product_union(product_streams(page_log, favor, cart, order_wide, payment_wide, refund, comment, offset_hours=offset_hours))


def _stream_sums(kind: str | tuple[str, ...] | None, rows: DataFrame, size: str) -> DataFrame:
    """Level 1 of one stream in the shape of all: by (window start in millis, sku, order id) for a stream of orders, with 1 in
    its order count (of each kind that the order has there); a stream without order ids has nothing to tell apart and is left to level 2."""
    own = [c for c in PRODUCT_COUNTS + PRODUCT_AMOUNTS if c in rows.columns]
    start = F.col("ts") - F.pmod("ts", F.lit(_ms(size)))
    d = rows.where(F.col("ts").isNotNull()).withColumns({"_start": start, **{c: cents(c) for c in own if c in PRODUCT_AMOUNTS}})
    if kind:
        several = kind if isinstance(kind, tuple) else ()
        d = d.groupBy("_start", "sku_id", "oid").agg(*[F.sum(c).alias(c) for c in own],
                                                     *[F.max(F.col("kind") == k).alias(f"_{k}") for k in several])
        counts = {ORDER_KINDS[k]: (F.col("oid").isNotNull() & (F.col(f"_{k}") if several else F.lit(True))).cast("bigint")
                  for k in several or (kind,)}
    else:
        counts = {}
    return d.select("_start", "sku_id", *[(F.col(c) if c in own else _l0()).alias(c) for c in PRODUCT_COUNTS + PRODUCT_AMOUNTS],
                    *[counts.get(c, _l0()).alias(c) for c in ORDER_KINDS.values()])


def product_window_sums(measures: DataFrame | list[tuple[str | tuple[str, ...] | None, DataFrame]], size: str = "10 seconds",
                        watermark: str | None = "0 seconds", day: bool = False) -> DataFrame:
    """Window aggregate by sku: 10 sums + 3 exact distinct order counts; dimension columns not yet
    filled.  Output: ``_w, sku_id`` + measures.  Batch ``product_streams`` are summed stream by stream on their way into
    the union: no wide row of one measure is exchanged, and what a join by order left together is not dealt anew.  There
    ``day`` adds the window's ``dt``, which takes less time from millis than from the formatted window start."""
    if isinstance(measures, list):
        g = union_all([_stream_sums(kind, rows, size) for kind, rows in measures]).groupBy("_start", "sku_id").agg(
            *[F.sum(c).alias(c) for c in PRODUCT_COUNTS + PRODUCT_AMOUNTS], *[F.sum(c).alias(c) for c in ORDER_KINDS.values()])
        w = F.struct(millis_to_ntz("_start").alias("start"), millis_to_ntz(F.col("_start") + F.lit(_ms(size))).alias("end"))
        dt = [day_from_millis("_start").alias("dt")] if day else []
        return g.select(w.alias("_w"), "sku_id", *dt, *PRODUCT_COUNTS, *[from_cents(c).alias(c) for c in PRODUCT_AMOUNTS], *ORDER_KINDS.values())
    d = tumble(measures, "ts", size, watermark)
    d = d.withColumns({c: cents(c) for c in PRODUCT_AMOUNTS})
    w = F.window("_et", size).alias("_w")
    sums = [F.sum(c).alias(c) for c in PRODUCT_COUNTS + PRODUCT_AMOUNTS]
    back = {c: from_cents(c) for c in PRODUCT_AMOUNTS}
    # level 1: one row per (window, sku, order id), whatever kinds the order has there; non-order rows collapse per (window, sku)
    lvl1 = d.groupBy(w, "sku_id", "oid").agg(*sums, *[F.max(F.col("kind") == k).alias(f"_{k}") for k in ORDER_KINDS])
    counts = [F.count_if(F.col(f"_{k}") & F.col("oid").isNotNull()).cast("bigint").alias(n) for k, n in ORDER_KINDS.items()]
    again = F.window("_w", size).alias("_w") if measures.isStreaming else F.col("_w")
    lvl2 = lvl1.groupBy(again, "sku_id").agg(*[F.sum(c).alias(c) for c in PRODUCT_COUNTS + PRODUCT_AMOUNTS], *counts)
    return lvl2.withColumns(back)


def product_dimension(dims: dict[str, DataFrame], unique: bool = False, tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """The sku dimension with the names of its spu, trademark and category3, one row per row of ``dims["sku"]``; with a
    ``tokenizer`` also the words of its name, ``sku_words``."""
    sku = dims["sku"] if tokenizer is None else dims["sku"].withColumn("sku_words", tokenizer(F.col("sku_name")))
    s = enrich(sku, dims["spu"], "spu_id", {"spu_name": "spu_name"}, unique=unique)
    s = enrich(s, dims["trademark"], "tm_id", {"tm_name": "tm_name"}, unique=unique)
    return enrich(s, dims["category3"], "category3_id", {"category3_name": "name"})


def product_stats(measures: DataFrame | list[tuple[str | tuple[str, ...] | None, DataFrame]], dims: dict[str, DataFrame], size: str = "10 seconds", *,
                  as_of_ms: Column | int, watermark: str | None = "0 seconds", unique_dims: bool = False,
                  tokenizer: Callable[[Column], Column] | None = None) -> DataFrame:
    """Window aggregate, then one dimension lookup by sku: spu, trademark and category3 depend on the sku alone and are
    looked up once per sku, not once per sku and window.  So are the words of its name, which a ``tokenizer`` adds as
    ``sku_words``; in batch the rows then carry their ``dt``, too."""
    also = ["sku_words"] if tokenizer is not None else []
    day = ["dt"] if also and isinstance(measures, list) else []
    instant = not isinstance(measures, list) and measures.isStreaming
    g = product_window_sums(measures, size, watermark, bool(day))
    # of a repeated sku the greatest row counts: the ids before the names that follow from them
    g = enrich(g, product_dimension(dims, unique_dims, tokenizer), "sku_id",
               {"sku_name": "sku_name", "sku_price": "price", "spu_id": "spu_id", "tm_id": "tm_id", "category3_id": "category3_id",
                "spu_name": "spu_name", "tm_name": "tm_name", "category3_name": "category3_name",
                **{c: c for c in also}}, unique=unique_dims)
    ts = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    # one projection (every DataFrame step re-analyses the whole plan, so no withColumn loops)
    typed = {c: F.col(c).cast("bigint") for c in PRODUCT_COUNTS + list(ORDER_KINDS.values())}
    typed.update({c: F.col(c).cast(AMOUNT_SUM) for c in PRODUCT_AMOUNTS})
    bounds = dict(zip(("stt", "edt"), window_bounds(instant=instant)))
    out = [bounds[c] if c in bounds else ts.alias("ts") if c == "ts" else
           typed[c].alias(c) if c in typed else F.col(c) for c in PRODUCT_STATS_COLUMNS + also + day]
    return g.select(*out)


# ---- provinces --------------------------------------------------------------------------------

PROVINCE_KEYS = {"province_id": "province_id", "province_name": "province_name",
                 "area_code": "province_area_code", "iso_code": "province_iso_code",
                 "iso_3166_2": "province_3166_2_code"}


def province_stats(order_wide: DataFrame, size: str = "10 seconds", *, as_of_ms: Column | int,
                   watermark: str | None = "0 seconds") -> DataFrame:
    """Orders per province and window: distinct orders and the sum of detail amounts."""
    d = tumble(order_wide, "create_ts", size, watermark)
    keys = [F.col(src).alias(out) for out, src in PROVINCE_KEYS.items()]
    # level 1: one row per (window, province, order); level 2 counts them
    lvl1 = d.groupBy(F.window("_et", size).alias("_w"), *keys, "order_id").agg(F.sum(cents("split_total_amount")).alias("_cents"))
    again = F.window("_w", size).alias("_w") if order_wide.isStreaming else F.col("_w")
    g = lvl1.groupBy(again, *PROVINCE_KEYS).agg(
        from_cents(F.sum("_cents")).alias("order_amount"), F.count("order_id").cast("bigint").alias("order_count"))
    ts = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    return g.select("*", *window_bounds(instant=order_wide.isStreaming), ts.alias("ts")).select(*PROVINCE_STATS_COLUMNS)


# ---- keywords ---------------------------------------------------------------------------------

def search_pages(page_log: DataFrame) -> DataFrame:
    """Search result pages carrying a search text."""
    return page_log.filter((F.col("page.page_id") == "good_list") & F.col("page.item").isNotNull())


def keyword_search_stats(page_log: DataFrame, size: str = "10 seconds", *, as_of_ms: Column | int,
                         watermark: str | None = "2 seconds", tokenizer=words) -> DataFrame:
    """Search keywords per window: every word of the whole search text, counted."""
    s = search_pages(page_log).select(F.explode(tokenizer(F.col("page.item"))).alias("keyword"), "ts")
    d = tumble(s, "ts", size, watermark)
    g = d.groupBy(F.window("_et", size).alias("_w"), "keyword").agg(F.count(F.lit(1)).alias("ct"))
    ts = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    return g.select("keyword", "ct", F.lit(KEYWORD_SEARCH).alias("source"), *window_bounds(instant=page_log.isStreaming),
                    ts.alias("ts")).select(*KEYWORD_STATS_COLUMNS)


def keyword_product_stats(product_stats_df: DataFrame, *, as_of_ms: Column | int, tokenizer=words) -> DataFrame:
    """Product stats rows -> (keyword of the sku name) x (count, source) rows; no aggregation.
    A product with no word or no positive count gives no row (inner laterals).  Words that the lookup cut once per sku
    (``sku_words``) are not cut again, and a ``dt`` of the rows is kept."""
    ts = as_of_ms if isinstance(as_of_ms, Column) else F.lit(as_of_ms).cast("bigint")
    some = (F.col("click_ct") > 0) | (F.col("cart_ct") > 0) | (F.col("order_ct") > 0)   # no word is cut for the others
    of = [c for c in ("stt", "edt", "dt") if c in product_stats_df.columns]
    cut = F.col("sku_words") if "sku_words" in product_stats_df.columns else tokenizer(F.col("sku_name"))
    # the counts first: their rows are built once per product, not once per word
    p = product_stats_df.where(some).select(cut.alias("_words"), F.explode(keyword_sources("click_ct", "cart_ct", "order_ct")).alias("_cs"), *of)
    p = p.select(F.explode("_words").alias("keyword"), F.col("_cs.ct").alias("ct"), F.col("_cs.source").alias("source"), *of)
    return p.select(*KEYWORD_STATS_COLUMNS[:-1], ts.alias("ts"), *[c for c in of if c == "dt"])
