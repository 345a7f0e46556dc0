"""DuckDB SQL twins of the registered queries (the correctness oracle).

The text restates each query's rules independently in ANSI-ish SQL (DuckDB dialect) over the
driver's tables; it shares no code with the Spark plans.  Building blocks are CTEs resolved in
dependency order.  Rounding of the visitor ratios uses integer HALF_UP arithmetic so the oracle
does not depend on floating-point division.
"""

from __future__ import annotations

from ..functions.codes import CODE_LISTS
from ..operators.reports import SPU_COLUMNS
from ..sources.tables import AS_OF_MS, CONFIG_CHANGES, ROUTING_CONFIG

FMT = "'%Y-%m-%d %H:%M:%S'"
WORD = r"'([\p{L}\p{N}]+)'"
DAY = "INTERVAL 1 DAY"
HOUR = "INTERVAL 1 HOUR"
BOUNCE_MS = 4 * 3_600_000
AGE_YEAR_MS = 365 * 24 * 3_600_000


def txt_ms(ts: str) -> str:
    """epoch millis of a timestamp written as text at second resolution and read back (UTC)."""
    return f"epoch_ms(strptime(strftime({ts}, {FMT}), {FMT}))"


def day_of(stt: str = "stt") -> str:
    return f"replace(substr({stt}, 1, 10), '-', '')"


CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTE[name] = (deps, body)


# ---- behaviour log ------------------------------------------------------------------------------
cte("ev", (), """
  SELECT event_id, ts AS ts_raw, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) // 1000 AS ts_ms, (event_id * 7) % (SELECT count(*) FROM part) AS item_id
  FROM events""")
cte("lg", ("ev",), """
  SELECT ev.event_id AS seq, CAST(ev.user_id AS VARCHAR) AS mid, ev.ts_ms AS ts, ev.k, ev.event_id,
         ev.user_id, ev.event_type, ev.item_id, ev.event_type = 'signup' AS is_start,
         CASE ev.event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'good_list'
              WHEN 'purchase' THEN 'trade' ELSE 'home' END AS page_id,
         CASE WHEN ev.k < 50 THEN NULL WHEN ev.k < 55 THEN '' ELSE 'home' END AS last_page_id,
         CASE WHEN ev.event_type = 'click' THEN p.p_name ELSE CAST(ev.item_id AS VARCHAR) END AS item,
         CASE WHEN ev.event_type = 'click' THEN 'keyword' ELSE 'sku_id' END AS item_type,
         CAST(round(ev.value * 100, 0) AS BIGINT) AS during_time,
         CASE WHEN ev.k % 3 = 0 THEN '0' ELSE '1' END AS is_new0,
         'v' || CAST(ev.k % 2 AS VARCHAR) AS vc, 'ch' || CAST(ev.user_id % 4 AS VARCHAR) AS ch,
         'ar' || CAST(ev.user_id % 5 AS VARCHAR) AS ar,
         strftime(epoch_ms(ev.ts_ms), '%Y%m%d') AS dt
  FROM ev LEFT JOIN part p ON ev.event_type = 'click' AND p.p_partkey = ev.item_id""")
cte("fst", ("lg",), """
  SELECT mid, arg_min(dt, seq) AS first_dt FROM lg WHERE is_new0 = '1' GROUP BY mid""")
cte("rl", ("lg", "fst"), """
  SELECT lg.*, CASE WHEN lg.is_new0 = '1' AND lg.dt <> fst.first_dt THEN '0' ELSE lg.is_new0 END AS is_new
  FROM lg LEFT JOIN fst ON lg.mid = fst.mid""")
cte("pl", ("rl",), "SELECT * FROM rl WHERE NOT is_start")
cte("ent", ("pl",), "SELECT * FROM pl WHERE coalesce(last_page_id, '') = ''")
cte("uv", ("ent",), """
  SELECT * FROM (SELECT ent.*, lag(dt) OVER (PARTITION BY mid ORDER BY seq) AS prev_dt FROM ent)
  WHERE prev_dt IS NULL OR prev_dt <> dt""")
cte("nx", ("pl",), """
  SELECT pl.*, coalesce(last_page_id, '') = '' AS entry,
         lead(ts) OVER (PARTITION BY mid ORDER BY ts, seq) AS next_ts,
         lead(coalesce(last_page_id, '') = '') OVER (PARTITION BY mid ORDER BY ts, seq) AS next_entry
  FROM pl""")
cte("bw", ("nx",), f"SELECT * FROM nx WHERE entry AND (next_ts IS NULL OR next_ts - ts >= {BOUNCE_MS})")
cte("bd", ("nx",), f"SELECT * FROM nx WHERE entry AND (next_ts IS NULL OR next_ts - ts >= {BOUNCE_MS} OR next_entry)")
cte("disp", ("pl",), """
  SELECT pl.seq, pl.ts, pl.page_id, CAST((pl.event_id + r.i) % (SELECT count(*) FROM part) AS VARCHAR) AS item,
         CASE WHEN r.i % 2 = 0 THEN 'sku_id' ELSE 'activity_id' END AS item_type,
         CAST(r.i + 1 AS BIGINT) AS display_order, CAST(r.i + 1 AS VARCHAR) AS pos_id
  FROM pl JOIN range(0, 3) r(i) ON r.i < pl.k % 4""")

# ---- orders -------------------------------------------------------------------------------------
cte("oi", (), f"""
  SELECT o.o_orderkey AS id, CAST(c.c_nationkey AS BIGINT) AS province_id,
         CASE o.o_orderstatus WHEN 'F' THEN '1004' WHEN 'P' THEN '1002' ELSE '1001' END AS order_status,
         o.o_custkey AS user_id, CAST(o.o_totalprice AS DECIMAL(18,2)) AS total_amount,
         strftime(o.o_orderdate, {FMT}) AS create_time, strftime(o.o_orderdate, '%Y-%m-%d') AS create_date,
         {txt_ms('o.o_orderdate')} AS create_ts
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
cte("od_ship", (), f"""
  SELECT l_orderkey AS order_id, l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS order_price, CAST(l_extendedprice AS DECIMAL(18,2)) AS split_total_amount,
         {txt_ms('l_shipdate')} AS create_ts
  FROM lineitem""")
cte("od_order", (), f"""
  SELECT l.l_orderkey AS order_id, l.l_partkey AS sku_id, CAST(l.l_quantity AS BIGINT) AS sku_num,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS order_price, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS split_total_amount,
         {txt_ms('o.o_orderdate')} AS create_ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
cte("du", (), """
  SELECT c_custkey AS id, strftime(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer""")
cte("dp", (), """
  SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS area_code,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso_code,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || '-' || substr(r_name, 1, 2) AS iso_3166_2
  FROM nation JOIN region ON n_regionkey = r_regionkey""")
cte("ds", (), """
  SELECT p_partkey AS id, p_name AS sku_name, CAST(p_retailprice AS DECIMAL(18,2)) AS price, p_partkey // 10 AS spu_id,
         CAST(split_part(p_brand, '#', 2) AS BIGINT) AS tm_id, CAST(length(p_type) * 100 + ascii(p_type) AS BIGINT) AS category3_id
  FROM part""")
cte("dspu", (), "SELECT id, 'spu-' || CAST(id AS VARCHAR) AS spu_name FROM (SELECT DISTINCT p_partkey // 10 AS id FROM part)")
cte("dtm", (), "SELECT DISTINCT CAST(split_part(p_brand, '#', 2) AS BIGINT) AS id, p_brand AS tm_name FROM part")
cte("dc3", (), "SELECT DISTINCT CAST(length(p_type) * 100 + ascii(p_type) AS BIGINT) AS id, p_type AS name FROM part")
cte("ow", ("oi", "od_order", "du", "dp", "ds", "dspu", "dtm", "dc3"), f"""
  SELECT oi.id AS order_id, d.sku_id, ds.sku_name, d.sku_num, d.order_price, d.split_total_amount,
         oi.province_id, dp.name AS province_name, dp.area_code AS province_area_code,
         dp.iso_code AS province_iso_code, dp.iso_3166_2 AS province_3166_2_code, oi.order_status, oi.user_id,
         CAST(({AS_OF_MS} - epoch_ms(strptime(du.birthday, '%Y-%m-%d'))) // {AGE_YEAR_MS} AS INTEGER) AS user_age,
         du.gender AS user_gender, oi.total_amount, oi.create_time, oi.create_date, ds.spu_id, dspu.spu_name,
         ds.tm_id, dtm.tm_name, ds.category3_id, dc3.name AS category3_name, oi.create_ts
  FROM oi JOIN od_order d ON oi.id = d.order_id AND d.create_ts BETWEEN oi.create_ts - 5 AND oi.create_ts + 5
  LEFT JOIN du ON du.id = oi.user_id LEFT JOIN dp ON dp.id = oi.province_id LEFT JOIN ds ON ds.id = d.sku_id
  LEFT JOIN dspu ON dspu.id = ds.spu_id LEFT JOIN dtm ON dtm.id = ds.tm_id LEFT JOIN dc3 ON dc3.id = ds.category3_id""")
cte("pinfo", (), f"""
  SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_custkey AS user_id,
         ['1101', '1102', '1103'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS payment_type,
         CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount, 'order ' || CAST(o_orderkey AS VARCHAR) AS subject,
         strftime(o_orderdate, {FMT}) AS payment_create_time,
         strftime(o_orderdate + to_minutes(CAST(o_orderkey % 60 AS INTEGER)), {FMT}) AS callback_time
  FROM orders WHERE o_orderstatus IN ('F', 'P')""")
cte("pw", ("pinfo", "ow"), f"""
  SELECT p.payment_id, p.order_id, p.user_id, p.total_amount, p.payment_type, p.subject, p.payment_create_time,
         p.callback_time, ow.create_time AS order_create_time, ow.sku_id, ow.sku_name, ow.split_total_amount,
         ow.province_name, ow.tm_name
  FROM pinfo p JOIN ow ON p.order_id = ow.order_id
   AND ow.create_ts BETWEEN epoch_ms(strptime(p.callback_time, {FMT})) - 1800000 AND epoch_ms(strptime(p.callback_time, {FMT}))""")

# ---- summary tables -----------------------------------------------------------------------------
cte("vm", ("pl", "uv", "ent", "bw"), """
  SELECT vc, ch, ar, is_new, 0::BIGINT AS uv_ct, 1::BIGINT AS pv_ct, 0::BIGINT AS sv_ct, 0::BIGINT AS uj_ct,
         coalesce(during_time, 0)::BIGINT AS dur_sum, ts FROM pl
  UNION ALL SELECT vc, ch, ar, is_new, 1, 0, 0, 0, 0, ts FROM uv
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 1, 0, 0, ts FROM ent
  UNION ALL SELECT vc, ch, ar, is_new, 0, 0, 0, 1, 0, ts FROM bw""")
cte("vs", ("vm",), f"""
  SELECT strftime(b, {FMT}) AS stt, strftime(b + {HOUR}, {FMT}) AS edt, vc, ch, ar, is_new,
         CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(sv_ct) AS BIGINT) AS sv_ct,
         CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum, CAST({AS_OF_MS} AS BIGINT) AS ts
  FROM (SELECT *, time_bucket({HOUR}, epoch_ms(ts)) AS b FROM vm) GROUP BY b, vc, ch, ar, is_new""")
_Z = "CAST(0 AS DECIMAL(18,2))"
cte("pm", ("pl", "disp", "ev", "ow", "pw"), f"""
  SELECT TRY_CAST(item AS BIGINT) AS sku_id, 0::BIGINT AS display_ct, 1::BIGINT AS click_ct, 0::BIGINT AS favor_ct,
         0::BIGINT AS cart_ct, 0::BIGINT AS order_sku_num, 0::BIGINT AS comment_ct, 0::BIGINT AS good_comment_ct,
         {_Z} AS order_amount, {_Z} AS payment_amount, {_Z} AS refund_amount, NULL::VARCHAR AS kind, NULL::BIGINT AS oid, ts
  FROM pl WHERE page_id = 'good_detail'
  UNION ALL SELECT TRY_CAST(item AS BIGINT), 1, 0, 0, 0, 0, 0, 0, {_Z}, {_Z}, {_Z}, NULL, NULL, ts
  FROM disp WHERE item_type = 'sku_id'
  UNION ALL SELECT item_id, 0, 0, 1, 0, 0, 0, 0, {_Z}, {_Z}, {_Z}, NULL, NULL, {txt_ms('ts_raw')}
  FROM ev WHERE event_type = 'click' AND k % 10 = 0
  UNION ALL SELECT item_id, 0, 0, 0, 1, 0, 0, 0, {_Z}, {_Z}, {_Z}, NULL, NULL, {txt_ms('ts_raw')}
  FROM ev WHERE event_type = 'purchase'
  UNION ALL SELECT sku_id, 0, 0, 0, 0, sku_num, 0, 0, split_total_amount, {_Z}, {_Z}, 'order', order_id, create_ts FROM ow
  UNION ALL SELECT sku_id, 0, 0, 0, 0, 0, 0, 0, {_Z}, split_total_amount, {_Z}, 'paid', order_id,
         epoch_ms(strptime(payment_create_time, {FMT})) FROM pw
  UNION ALL SELECT l_partkey, 0, 0, 0, 0, 0, 0, 0, {_Z}, {_Z}, CAST(l_extendedprice AS DECIMAL(18,2)), 'refund', l_orderkey,
         {txt_ms('l_shipdate')} FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT l_partkey, 0, 0, 0, 0, 0, 1, CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END, {_Z}, {_Z}, {_Z}, NULL, NULL,
         {txt_ms('l_shipdate')} FROM lineitem WHERE l_returnflag = 'A'""")
cte("ps0", ("pm",), f"""
  SELECT strftime(b, {FMT}) AS stt, strftime(b + {DAY}, {FMT}) AS edt, sku_id,
         CAST(sum(display_ct) AS BIGINT) AS display_ct, CAST(sum(click_ct) AS BIGINT) AS click_ct,
         CAST(sum(favor_ct) AS BIGINT) AS favor_ct, CAST(sum(cart_ct) AS BIGINT) AS cart_ct,
         CAST(sum(order_sku_num) AS BIGINT) AS order_sku_num, CAST(sum(comment_ct) AS BIGINT) AS comment_ct,
         CAST(sum(good_comment_ct) AS BIGINT) AS good_comment_ct, sum(order_amount) AS order_amount,
         sum(payment_amount) AS payment_amount, sum(refund_amount) AS refund_amount,
         CAST(count(DISTINCT CASE WHEN kind = 'order' THEN oid END) AS BIGINT) AS order_ct,
         CAST(count(DISTINCT CASE WHEN kind = 'paid' THEN oid END) AS BIGINT) AS paid_order_ct,
         CAST(count(DISTINCT CASE WHEN kind = 'refund' THEN oid END) AS BIGINT) AS refund_order_ct
  FROM (SELECT *, time_bucket({DAY}, epoch_ms(ts)) AS b FROM pm) GROUP BY b, sku_id""")
cte("pse", ("ps0", "ds", "dspu", "dtm", "dc3"), f"""
  SELECT ps0.*, ds.sku_name, ds.price AS sku_price, ds.spu_id, dspu.spu_name, ds.tm_id, dtm.tm_name,
         ds.category3_id, dc3.name AS category3_name, CAST({AS_OF_MS} AS BIGINT) AS ts, {day_of('ps0.stt')} AS dt
  FROM ps0 LEFT JOIN ds ON ds.id = ps0.sku_id LEFT JOIN dspu ON dspu.id = ds.spu_id
  LEFT JOIN dtm ON dtm.id = ds.tm_id LEFT JOIN dc3 ON dc3.id = ds.category3_id""")
cte("prs", ("ow",), f"""
  SELECT strftime(b, {FMT}) AS stt, strftime(b + {DAY}, {FMT}) AS edt, province_id, province_name,
         province_area_code AS area_code, province_iso_code AS iso_code, province_3166_2_code AS iso_3166_2,
         sum(split_total_amount) AS order_amount, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
         CAST({AS_OF_MS} AS BIGINT) AS ts
  FROM (SELECT *, time_bucket({DAY}, epoch_ms(create_ts)) AS b FROM ow)
  GROUP BY b, province_id, province_name, province_area_code, province_iso_code, province_3166_2_code""")
cte("ks", ("pl",), f"""
  SELECT kw AS keyword, CAST(count(*) AS BIGINT) AS ct, 'SEARCH' AS source, strftime(b, {FMT}) AS stt,
         strftime(b + {DAY}, {FMT}) AS edt, CAST({AS_OF_MS} AS BIGINT) AS ts
  FROM (SELECT unnest(regexp_extract_all(lower(item), {WORD}, 1)) AS kw, time_bucket({DAY}, epoch_ms(ts)) AS b
        FROM pl WHERE page_id = 'good_list' AND item IS NOT NULL)
  GROUP BY b, kw""")
cte("kp", ("pse",), f"""
  SELECT keyword, s.ct AS ct, s.source AS source, stt, edt, CAST({AS_OF_MS} AS BIGINT) AS ts
  FROM (SELECT keyword, unnest(list_filter([{{'ct': click_ct, 'source': 'CLICK'}}, {{'ct': cart_ct, 'source': 'CART'}},
                                            {{'ct': order_ct, 'source': 'ORDER'}}], lambda x: x.ct > 0)) AS s, stt, edt
        FROM (SELECT unnest(regexp_extract_all(lower(sku_name), {WORD}, 1)) AS keyword, click_ct, cart_ct, order_ct, stt, edt
              FROM pse))""")
cte("kall", ("ks", "kp"), f"SELECT *, {day_of()} AS dt FROM (SELECT * FROM ks UNION ALL SELECT * FROM kp)")

# ---- change records -----------------------------------------------------------------------------
def _map(*pairs: tuple[str, str]) -> str:
    return ("map([" + ", ".join(f"'{k}'" for k, _ in pairs) + "], ["
            + ", ".join(f"CAST({v} AS VARCHAR)" for _, v in pairs) + "])")


cte("cdc", (), " UNION ALL ".join([
    "SELECT c_custkey AS seq, 'user_info' AS tbl, 'insert' AS type, " + _map(
        ("id", "c_custkey"), ("name", "c_name"),
        ("birthday", "strftime(DATE '1960-01-01' + CAST(c_custkey % 15000 AS INTEGER), '%Y-%m-%d')"),
        ("gender", "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END"), ("segment", "c_mktsegment")) + " AS data FROM customer",
    "SELECT c_custkey + 1099511627776, 'user_info', 'update', " + _map(("id", "c_custkey"), ("name", "upper(c_name)"))
    + " FROM customer WHERE c_acctbal < 0",
    "SELECT p_partkey, 'sku_info', 'insert', " + _map(
        ("id", "p_partkey"), ("sku_name", "p_name"), ("price", "CAST(p_retailprice AS DECIMAL(18,2))"),
        ("spu_id", "p_partkey // 10"), ("tm_id", "split_part(p_brand, '#', 2)"),
        ("category3_id", "length(p_type) * 100 + ascii(p_type)"), ("size", "p_size")) + " FROM part",
    "SELECT n_nationkey, 'base_province', 'insert', " + _map(("id", "n_nationkey"), ("name", "n_name"),
                                                            ("region_id", "n_regionkey")) + " FROM nation",
    "SELECT o_orderkey, 'order_info', 'insert', " + _map(
        ("id", "o_orderkey"), ("user_id", "o_custkey"), ("order_status", "'1001'"),
        ("total_amount", "CAST(o_totalprice AS DECIMAL(18,2))"), ("create_time", f"strftime(o_orderdate, {FMT})"),
        ("priority", "o_orderpriority")) + " FROM orders",
    "SELECT o_orderkey + 1099511627776, 'order_info', 'update', " + _map(("id", "o_orderkey"), ("order_status", "'1004'"))
    + " FROM orders WHERE o_orderstatus = 'F'",
    "SELECT l_orderkey, 'order_detail', 'insert', " + _map(
        ("order_id", "l_orderkey"), ("sku_id", "l_partkey"), ("sku_num", "CAST(l_quantity AS BIGINT)"),
        ("order_price", "CAST(l_extendedprice AS DECIMAL(18,2))"), ("create_time", f"strftime(l_shipdate, {FMT})"),
        ("line", "l_linenumber")) + " FROM lineitem",
    "SELECT o_orderkey, 'payment_info', 'insert', " + _map(
        ("id", "o_orderkey"), ("order_id", "o_orderkey"), ("total_amount", "CAST(o_totalprice AS DECIMAL(18,2))"))
    + " FROM orders WHERE o_orderstatus IN ('F', 'P')",
    "SELECT s_suppkey, 'supplier_info', 'insert', " + _map(("id", "s_suppkey"), ("name", "s_name")) + " FROM supplier",
    "SELECT r_regionkey, NULL, 'insert', " + _map(("id", "r_regionkey"), ("name", "r_name")) + " FROM region",
    "SELECT r_regionkey, 'base_region', 'insert', map([]::VARCHAR[], []::VARCHAR[]) FROM region",
]))
cte("cfg", (), " UNION ALL ".join(
    f"SELECT '{src}' AS source_table, '{op}' AS operate_type, '{st}' AS sink_type, '{tbl}' AS sink_table, "
    f"'{cols}' AS sink_columns" for src, op, st, tbl, cols, *_ in ROUTING_CONFIG))
cte("cln", ("cdc",), "SELECT * FROM cdc WHERE tbl IS NOT NULL AND data IS NOT NULL AND cardinality(data) > 0")
cte("rt", ("cln", "cfg"), """
  SELECT cln.seq, cln.tbl, cln.type, cfg.sink_type, cfg.sink_table,
         map_from_entries(list_filter(map_entries(cln.data), lambda e: list_contains(string_split(cfg.sink_columns, ','), e.key))) AS data
  FROM cln JOIN cfg ON cln.tbl = cfg.source_table AND cln.type = cfg.operate_type""")
cte("names", (), r"SELECT lower(regexp_replace(p_name, '[^\p{L}\p{N}]+', '', 'g')) AS run, count(*) AS n FROM part GROUP BY 1")
cte("dict", (), r"""SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(string_split_regex(p_name || ' ' || p_type, '[^\p{L}\p{N}]+')) AS w FROM part)
  WHERE length(w) BETWEEN 3 AND 7""")
cte("hits", ("names", "dict"), """SELECT run, p, max(len) AS len FROM (
    SELECT run, p, unnest(range(3, 8)) AS len FROM (SELECT run, unnest(range(1, length(run) + 1)) AS p FROM names WHERE run <> ''))
  SEMI JOIN dict ON substr(run, p, len) = w AND p + len - 1 <= length(run) GROUP BY run, p""")
cte("steps", ("names", "hits"), """SELECT run, list_reduce(list_prepend({'next': CAST(1 AS BIGINT), 'out': CAST([] AS STRUCT(p BIGINT, len BIGINT)[])},
    list_transform(list_sort(list({'p': p, 'len': len})), lambda h: {'next': h.p, 'out': [{'p': h.p, 'len': h.len}]})),
    lambda s, h: CASE WHEN h.next < s.next THEN s ELSE {'next': h.next + h.out[1].len, 'out': list_concat(s.out, h.out)} END).out AS taken
  FROM hits GROUP BY run""")
cte("segs", ("names", "steps"), """SELECT run, unnest(list_concat(
    list_transform(taken, lambda t: substr(run, t.p, t.len)),
    list_filter(list_transform(range(0, len(taken) + 1), lambda i: substr(run,
      CASE WHEN i = 0 THEN 1 ELSE taken[i].p + taken[i].len END,
      CASE WHEN i = len(taken) THEN length(run) + 1 ELSE taken[i + 1].p END - CASE WHEN i = 0 THEN 1 ELSE taken[i].p + taken[i].len END)),
      lambda x: x <> ''))) AS keyword, n
  FROM (SELECT run, n, coalesce(taken, []) AS taken FROM names LEFT JOIN steps USING (run) WHERE run <> '')""")
cte("feed", (), " UNION ALL ".join(
    f"SELECT {seq} AS fseq, '{change}' AS change, '{r[0]}' AS src, '{r[1]}' AS op, '{sink or r[3]}' AS sink_table, '{r[4]}' AS sink_columns"
    for seq, change, r, sink in ((seq, change, ROUTING_CONFIG[i], sink) for seq, change, i, sink in CONFIG_CHANGES)))
cte("rta", ("cln", "feed"), """
  SELECT cln.seq, cln.tbl, cln.type, feed.sink_table,
         map_from_entries(list_filter(map_entries(cln.data), lambda e: list_contains(string_split(feed.sink_columns, ','), e.key))) AS data
  FROM cln ASOF JOIN feed ON cln.tbl = feed.src AND cln.type = feed.op AND cln.seq >= feed.fseq WHERE change <> 'delete'""")
cte("um", ("cln", "cfg"), """
  SELECT seq, tbl, type FROM cln WHERE NOT EXISTS
    (SELECT 1 FROM cfg WHERE cfg.source_table = cln.tbl AND cfg.operate_type = cln.type)""")

# ---- reports ------------------------------------------------------------------------------------


def _top(idc: str, name: str, n: int, extra: str = "") -> str:
    return f"""
  SELECT * FROM (
    SELECT dt, {idc}, {name}, sum(order_amount) AS order_amount {extra},
           CAST(row_number() OVER (PARTITION BY dt ORDER BY sum(order_amount) DESC, {idc} ASC NULLS FIRST) AS INTEGER) AS rank
    FROM pse GROUP BY dt, {idc}, {name} HAVING sum(order_amount) > 0)
  WHERE rank <= {n}"""


cte("btm", ("pse",), _top("tm_id", "tm_name", 10))
cte("bc3", ("pse",), _top("category3_id", "category3_name", 10))
cte("bspu", ("pse",), _top("spu_id", "spu_name", 10, ", CAST(sum(order_ct) AS BIGINT) AS order_ct"))
cte("vsd", ("vs",), f"SELECT *, {day_of()} AS dt FROM vs")
cte("vbn", ("vsd",), """
  SELECT dt, is_new, CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct,
         CAST(sum(sv_ct) AS BIGINT) AS sv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct, CAST(sum(dur_sum) AS BIGINT) AS dur_sum
  FROM vsd GROUP BY dt, is_new""")
cte("vbh", ("vsd",), """
  SELECT dt, CAST(hour(CAST(stt AS TIMESTAMP)) AS INTEGER) AS hr,
         CAST(sum(CASE WHEN is_new = '1' THEN uv_ct ELSE 0 END) AS BIGINT) AS new_uv,
         CAST(sum(uv_ct) AS BIGINT) AS uv_ct, CAST(sum(pv_ct) AS BIGINT) AS pv_ct, CAST(sum(uj_ct) AS BIGINT) AS uj_ct
  FROM vsd GROUP BY dt, hr""")
cte("hd", ("vbh",), """
  SELECT d.dt, CAST(h.i AS INTEGER) AS hr, lpad(CAST(h.i AS VARCHAR), 2, '0') AS hr_label,
         CAST(coalesce(b.uv_ct, 0) AS BIGINT) AS uv_ct, CAST(coalesce(b.pv_ct, 0) AS BIGINT) AS pv_ct,
         CAST(coalesce(b.new_uv, 0) AS BIGINT) AS new_uv
  FROM (SELECT DISTINCT dt FROM vbh) d CROSS JOIN range(0, 24) h(i)
  LEFT JOIN vbh b ON b.dt = d.dt AND b.hr = h.i""")
cte("ktop", ("kall",), """
  SELECT dt, rank, keyword, ct FROM (
    SELECT dt, keyword, CAST(sum(ct * CASE source WHEN 'SEARCH' THEN 10 WHEN 'ORDER' THEN 3 WHEN 'CART' THEN 2
                                               WHEN 'CLICK' THEN 1 ELSE 0 END) AS BIGINT) AS ct,
           CAST(row_number() OVER (PARTITION BY dt ORDER BY sum(ct) DESC, keyword ASC NULLS FIRST) AS INTEGER) AS rank
    FROM kall GROUP BY dt, keyword)
  WHERE rank <= 20""")
cte("gm", ("pse",), "SELECT dt, coalesce(sum(order_amount), 0) AS gmv FROM pse GROUP BY dt")


def _ratio_rows() -> str:
    def side(p: str) -> dict[str, str]:
        uv, pv, sv, uj, dur = (f"{p}_{c}" for c in ("uv", "pv", "sv", "uj", "dur"))

        def guard(v: str) -> str:
            return f"CASE WHEN {uv} = 0 THEN 0.0 WHEN {sv} = 0 THEN NULL ELSE {v} END"
        r1 = f"((2 * {dur} + {sv}) // (2 * {sv}))"
        return {
            "uv_ct": f"CAST({uv} AS DOUBLE)",
            "pv_ct": f"CAST({pv} AS DOUBLE)",
            "uj_rate": guard(f"((2 * {uj} * 10000 + {sv}) // (2 * {sv})) / 100.0"),
            "dur_per_sv": guard(f"((2 * {r1} + 100) // 200) / 10.0"),
            "pv_per_sv": guard(f"((2 * {pv} * 100 + {sv}) // (2 * {sv})) / 100.0"),
        }
    from ..operators.reports import VISITOR_ROW_LABELS
    n, o = side("n"), side("o")
    parts = []
    for i, (k, label) in enumerate(VISITOR_ROW_LABELS):
        parts.append(f"SELECT dt, {i} AS pos, '{label}' AS type, CAST({n[k]} AS DOUBLE) AS new, "
                     f"CAST({o[k]} AS DOUBLE) AS old FROM g")
    sums = ", ".join(
        f"sum(CASE WHEN is_new = '1' THEN {c}_ct ELSE 0 END) AS n_{c}, "
        f"sum(CASE WHEN is_new = '1' THEN 0 ELSE {c}_ct END) AS o_{c}" for c in ("uv", "pv", "sv", "uj"))
    sums += (", sum(CASE WHEN is_new = '1' THEN dur_sum ELSE 0 END) AS n_dur, "
             "sum(CASE WHEN is_new = '1' THEN 0 ELSE dur_sum END) AS o_dur")
    return f"WITH g AS (SELECT dt, {sums} FROM vbn GROUP BY dt) " + " UNION ALL ".join(parts)


cte("vt", ("vbn",), _ratio_rows())


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][0]:
            visit(d)
        order.append(n)
    for n in names:
        visit(n)
    if not order:
        return ""
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]}\n)" for n in order) + "\n"


def q(body: str, *names: str) -> str:
    return _with(*names) + body


FLAT = "SELECT seq, mid, is_new, ts, dt, page_id, last_page_id FROM "

RECORD = "SELECT seq, tbl AS \"table\", type, sink_table, CAST(cardinality(data) AS BIGINT) AS n_cols, data['id'] AS id FROM rt "

ORACLE: dict[str, str] = {
    "cdc_clean": q("SELECT seq, tbl AS \"table\", type, CAST(cardinality(data) AS BIGINT) AS n_keys, data['id'] AS id FROM cln",
                   "cln"),
    "cdc_route_fact": q(RECORD + "WHERE sink_type = 'kafka'", "rt"),
    "cdc_route_dim": q(RECORD + "WHERE sink_type = 'hbase'", "rt"),
    "cdc_unmatched": q("SELECT seq, tbl AS \"table\", type FROM um", "um"),
    "keyword_segment": q("SELECT keyword, CAST(sum(n) AS BIGINT) AS ct FROM segs GROUP BY keyword", "segs"),
    "cdc_route_asof": q("""SELECT seq, tbl AS "table", type, sink_table, CAST(cardinality(data) AS BIGINT) AS n_cols, data['id'] AS id FROM rta""", "rta"),
    "cdc_column_filter": q("""SELECT seq, tbl AS "table", type, sink_table, e.key AS key, e.value AS value
        FROM (SELECT *, unnest(map_entries(data)) AS e FROM rt WHERE sink_type IN ('kafka', 'hbase'))""", "rt"),
    "dim_upsert_merge": q("""SELECT id, max(CASE WHEN k = 'name' THEN v END) AS name, max(CASE WHEN k = 'birthday' THEN v END) AS birthday,
        max(CASE WHEN k = 'gender' THEN v END) AS gender
        FROM (SELECT id, e.key AS k, arg_max(e.value, seq) AS v
              FROM (SELECT seq, data['id'] AS id, unnest(map_entries(data)) AS e FROM rt
                    WHERE sink_type = 'hbase' AND sink_table = 'dim_user_info' AND type IN ('insert', 'update'))
              GROUP BY id, e.key)
        GROUP BY id""", "rt"),
    "dim_upsert_merge_stream": q("""SELECT dimension, key, k AS "column", arg_max(v, seq) AS value FROM (
        SELECT seq, sink_table AS dimension, CASE sink_table WHEN 'dim_base_province' THEN data['name']
            WHEN 'dim_sku_info' THEN '["' || data['tm_id'] || '","' || data['id'] || '"]' ELSE data['id'] END AS key,
          unnest(map_keys(data)) AS k, unnest(map_values(data)) AS v
        FROM rt WHERE sink_type = 'hbase' AND type IN ('insert', 'update')) GROUP BY dimension, key, k""", "rt"),
    "log_split_start": q("SELECT seq, mid, is_new, ts, 'icon' AS entry, CAST(k * 10 AS BIGINT) AS loading_time "
                         "FROM rl WHERE is_start", "rl"),
    "log_split_page": q("SELECT seq, mid, is_new, ch, ts, page_id, last_page_id, item, item_type, during_time, "
                        "CAST(k % 4 AS BIGINT) AS n_displays FROM pl", "pl"),
    "display_explode": q("SELECT seq, page_id, item, item_type, display_order, pos_id FROM disp", "disp"),
    "new_visitor_repair": q("SELECT seq, mid, dt, is_new FROM rl", "rl"),
    "session_entry": q(FLAT + "ent", "ent"),
    "unique_visit": q(FLAT + "uv", "uv"),
    "bounce_as_written": q(FLAT + "bw", "bw"),
    "bounce_as_documented": q(FLAT + "bd", "bd"),
    "order_interval_join": q("""SELECT oi.id AS order_id, d.sku_id, d.sku_num, CAST(d.split_total_amount AS DOUBLE) AS split_total_amount,
        oi.province_id, oi.order_status, oi.create_time
        FROM oi JOIN od_ship d ON oi.id = d.order_id AND d.create_ts BETWEEN oi.create_ts - 5 AND oi.create_ts + 5""",
                             "oi", "od_ship"),
    "order_interval_join_30d": q(f"""SELECT oi.id AS order_id, d.sku_id, d.sku_num, CAST(d.split_total_amount AS DOUBLE) AS split_total_amount,
        oi.province_id, oi.order_status, oi.create_time
        FROM oi JOIN od_ship d ON oi.id = d.order_id
         AND d.create_ts BETWEEN oi.create_ts - {30 * 86_400_000} AND oi.create_ts + {30 * 86_400_000}""",
                                 "oi", "od_ship"),
    "order_wide": q("""SELECT order_id, sku_id, sku_name, sku_num, CAST(order_price AS DOUBLE) AS order_price,
        CAST(split_total_amount AS DOUBLE) AS split_total_amount, province_id, province_name, province_area_code,
        province_iso_code, province_3166_2_code, order_status, user_id, user_age, user_gender,
        CAST(total_amount AS DOUBLE) AS total_amount, create_time, create_date, spu_id, spu_name, tm_id, tm_name,
        category3_id, category3_name FROM ow""", "ow"),
    "user_age": q(f"""SELECT id, birthday, gender,
        CAST(({AS_OF_MS} - epoch_ms(strptime(birthday, '%Y-%m-%d'))) // {AGE_YEAR_MS} AS INTEGER) AS user_age FROM du""", "du"),
    "payment_wide": q("""SELECT payment_id, order_id, user_id, CAST(total_amount AS DOUBLE) AS total_amount, payment_type,
        subject, payment_create_time, callback_time, order_create_time, sku_id, sku_name,
        CAST(split_total_amount AS DOUBLE) AS split_total_amount, province_name, tm_name FROM pw""", "pw"),
    "visitor_union": q("SELECT * FROM vm", "vm"),
    "visitor_stats": q("SELECT * FROM vs", "vs"),
    "product_union": q("""SELECT sku_id, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, comment_ct, good_comment_ct,
        CAST(order_amount AS DOUBLE) AS order_amount, CAST(payment_amount AS DOUBLE) AS payment_amount,
        CAST(refund_amount AS DOUBLE) AS refund_amount, kind, CAST(oid AS VARCHAR) AS oid, ts FROM pm""", "pm"),
    "product_stats": q("""SELECT stt, edt, sku_id, display_ct, click_ct, favor_ct, cart_ct, order_sku_num, comment_ct,
        good_comment_ct, CAST(order_amount AS DOUBLE) AS order_amount, CAST(payment_amount AS DOUBLE) AS payment_amount,
        CAST(refund_amount AS DOUBLE) AS refund_amount, order_ct, paid_order_ct, refund_order_ct FROM ps0""", "ps0"),
    "product_stats_enriched": q("""SELECT stt, edt, sku_id, sku_name, CAST(sku_price AS DOUBLE) AS sku_price, spu_id, spu_name,
        tm_id, tm_name, category3_id, category3_name, display_ct, click_ct, favor_ct, cart_ct, order_sku_num,
        CAST(order_amount AS DOUBLE) AS order_amount, order_ct, CAST(payment_amount AS DOUBLE) AS payment_amount,
        paid_order_ct, refund_order_ct, CAST(refund_amount AS DOUBLE) AS refund_amount, comment_ct, good_comment_ct, ts
        FROM pse""", "pse"),
    "province_stats": q("""SELECT stt, edt, province_id, province_name, area_code, iso_code, iso_3166_2,
        CAST(order_amount AS DOUBLE) AS order_amount, order_count, ts FROM prs""", "prs"),
    "keyword_search": q("SELECT * FROM ks", "ks"),
    "keyword_product": q("SELECT * FROM kp", "kp"),
    "keyword_explode": q(f"""SELECT keyword, CAST(count(*) AS BIGINT) AS ct FROM
        (SELECT unnest(regexp_extract_all(lower(text), {WORD}, 1)) AS keyword FROM documents) GROUP BY keyword"""),
    "gmv": q("SELECT dt, CAST(gmv AS DOUBLE) AS gmv FROM gm", "gm"),
    "by_trademark": q("SELECT dt, tm_id, tm_name, CAST(order_amount AS DOUBLE) AS order_amount, rank FROM btm", "btm"),
    "by_category3": q("SELECT dt, category3_id, category3_name, CAST(order_amount AS DOUBLE) AS order_amount, rank FROM bc3",
                      "bc3"),
    "by_spu": q("SELECT dt, spu_id, spu_name, CAST(order_amount AS DOUBLE) AS order_amount, order_ct, rank FROM bspu",
                "bspu"),
    "by_province": q("""SELECT dt, province_name, CAST(sum(order_amount) AS DOUBLE) AS order_amount
        FROM (SELECT *, """ + day_of() + """ AS dt FROM prs) GROUP BY dt, province_id, province_name""", "prs"),
    "visitor_by_new_flag": q("SELECT * FROM vbn", "vbn"),
    "visitor_by_hour": q("SELECT * FROM vbh", "vbh"),
    "hour_densify": q("SELECT * FROM hd", "hd"),
    "visitor_transpose": q("SELECT * FROM vt", "vt"),
    "keyword_topn": q("SELECT * FROM ktop", "ktop"),
    "name_value_list": q("""SELECT dt, to_json({'status': 0, 'msg': '', 'data': list({'name': keyword, 'value': ct} ORDER BY rank)}) AS json
        FROM ktop GROUP BY dt""", "ktop"),
    "table_rows": q("SELECT dt, rank, spu_name, CAST(order_amount AS DOUBLE) AS order_amount, order_ct FROM bspu", "bspu"),
    "series_arrays": q("""SELECT dt, to_json({'status': 0, 'data': {'categories': list(tm_name ORDER BY rank),
        'series': [{'data': list(order_amount ORDER BY rank)}]}}) AS json FROM btm GROUP BY dt""", "btm"),
    "hour_series": q("""SELECT dt, to_json({'status': 0, 'data': {'categories': list(hr_label ORDER BY hr),
        'series': [{'name': 'uv', 'data': list(uv_ct ORDER BY hr)}, {'name': 'pv', 'data': list(pv_ct ORDER BY hr)},
                   {'name': '新用户', 'data': list(new_uv ORDER BY hr)}]}}) AS json FROM hd GROUP BY dt""", "hd"),
    "scalar_envelope": q("SELECT dt, to_json({'status': 0, 'data': gmv}) AS json FROM gm", "gm"),
    "spu_document": q("""SELECT dt, to_json({'status': 0, 'data': {'columns': [""" + ", ".join(
        f"{{'name': '{label}', 'id': '{c}'}}" for label, c in SPU_COLUMNS) + "], 'rows': list({" + ", ".join(
        f"'{c}': {c}" for _, c in SPU_COLUMNS) + "} ORDER BY rank)}}) AS json FROM bspu GROUP BY dt", "bspu"),
    "code_decode": q(" UNION ALL ".join(
        f"SELECT '{name}' AS code_list, {c} AS code, CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CODE_LISTS[name].items())
        + f" END AS meaning, CAST(count(*) AS BIGINT) AS ct FROM {source} GROUP BY {c}" for name, source, c in (
            ("order_status", "oi", "order_status"), ("payment_type", "(SELECT CAST(1101 + o_orderkey % 3 AS VARCHAR) AS payment_type "
             "FROM orders WHERE o_orderstatus IN ('F', 'P'))", "payment_type"),
            ("appraise", "(SELECT CASE WHEN l_linenumber % 3 = 0 THEN '1201' ELSE '1202' END AS appraise FROM lineitem WHERE l_returnflag = 'A')",
             "appraise"))), "oi"),
}

# one day of a report is its every-day answer on that day
VISIT_DAY, ORDER_DAY, EMPTY_DAY = "20240115", "19960225", "19000101"
for _name, _day in (("by_trademark", ORDER_DAY), ("by_province", ORDER_DAY), ("keyword_topn", VISIT_DAY),
                    ("hour_densify", VISIT_DAY), ("visitor_transpose", VISIT_DAY)):
    ORACLE[f"{_name}_day"] = f"SELECT * FROM ({ORACLE[_name]}) WHERE dt = '{_day}'"
ORACLE["gmv_day"] = (f"SELECT '{ORDER_DAY}' AS dt, coalesce(sum(gmv), 0) AS gmv FROM ({ORACLE['gmv']}) WHERE dt = '{ORDER_DAY}'")
ORACLE["hour_densify_empty_day"] = f"""SELECT '{EMPTY_DAY}' AS dt, CAST(h AS INTEGER) AS hr, lpad(CAST(h AS VARCHAR), 2, '0') AS hr_label,
  CAST(0 AS BIGINT) AS uv_ct, CAST(0 AS BIGINT) AS pv_ct, CAST(0 AS BIGINT) AS new_uv FROM range(0, 24) t(h)"""
ORACLE["province_map"] = q("""SELECT dt, to_json({'status': 0, 'data': {'mapData': list({'name': province_name, 'value': order_amount}
  ORDER BY province_name)}}) AS json FROM (SELECT dt, province_name, sum(order_amount) AS order_amount
  FROM (SELECT *, """ + day_of() + """ AS dt FROM prs) GROUP BY dt, province_id, province_name) GROUP BY dt""", "prs")
ORACLE["category3_list"] = q("""SELECT dt, to_json({'status': 0, 'data': list({'name': category3_name, 'value': order_amount}
  ORDER BY rank)}) AS json FROM bc3 GROUP BY dt""", "bc3")
ORACLE["config_latest"] = f"""SELECT "table" AS source_table, type AS operate_type, 'kafka' AS sink_type,
  'dwd_' || "table" || '_' || CAST(max(seq) AS VARCHAR) AS sink_table FROM ({ORACLE['cdc_clean']}) GROUP BY "table", type"""
ORACLE["keyword_search_sql"] = ORACLE["keyword_search"]

# streaming twins answer exactly what their batch query answers
for _name in ("unique_visit", "bounce_as_written", "bounce_as_documented", "new_visitor_repair", "order_interval_join", "visitor_stats",
              "keyword_search", "product_stats", "province_stats", "order_wide", "payment_wide", "cdc_route_fact"):
    ORACLE[f"{_name}_stream"] = ORACLE[_name]
ORACLE["order_wide_json_stream"] = ORACLE["order_wide"]
ORACLE["keyword_product_stream"] = ORACLE["keyword_product"]
ORACLE["visitor_report_stream"] = ORACLE["visitor_stats"]
