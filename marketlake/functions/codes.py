"""Business code lists and decoding.

Decoding is a ``create_map`` lookup evaluated inside generated code: the lists are fixed and
tiny, so no join (and no broadcast) is involved.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the source system's codes) -------------------------------------
ORDER_STATUS = {
    "1001": "unpaid",
    "1002": "paid",
    "1003": "cancelled",
    "1004": "finished",
    "1005": "refunding",
    "1006": "refunded",
}
PAYMENT_TYPE = {
    "1101": "alipay",
    "1102": "wechat",
    "1103": "unionpay",
}
APPRAISE = {
    "1201": "good",
    "1202": "neutral",
    "1203": "bad",
    "1204": "auto",
}
REFUND_REASON = {
    "1301": "quality problem",
    "1302": "not as described",
    "1303": "out of stock",
    "1304": "wrong size",
    "1305": "ordered by mistake",
    "1306": "changed mind",
    "1307": "other",
}
COUPON_STATUS = {
    "1401": "unused",
    "1402": "in use",
    "1403": "used",
}
REFUND_TYPE = {
    "1501": "refund only",
    "1502": "return and refund",
}
SOURCE_TYPE = {
    "2401": "user query",
    "2402": "promotion",
    "2403": "recommendation",
    "2404": "activity",
}
ACTIVITY_RULE_TYPE = {
    "3101": "amount off",
    "3102": "quantity discount",
    "3103": "percent off",
}
COUPON_TYPE = {
    "3201": "amount off",
    "3202": "quantity discount",
    "3203": "voucher",
}
COUPON_RANGE_TYPE = {
    "3301": "category3",
    "3302": "trademark",
    "3303": "spu",
}
APPRAISE_GOOD = "1201"
KEYWORD_SEARCH = "SEARCH"
KEYWORD_CLICK = "CLICK"
KEYWORD_CART = "CART"
KEYWORD_ORDER = "ORDER"
# report weight of each keyword source; anything else weighs 0
KEYWORD_WEIGHT = {"SEARCH": 10, "ORDER": 3, "CART": 2, "CLICK": 1}
# -----------------------------------------------------------------------------------------------

CODE_LISTS = {
    "order_status": ORDER_STATUS,
    "payment_type": PAYMENT_TYPE,
    "appraise": APPRAISE,
    "refund_reason": REFUND_REASON,
    "coupon_status": COUPON_STATUS,
    "refund_type": REFUND_TYPE,
    "source_type": SOURCE_TYPE,
    "activity_rule_type": ACTIVITY_RULE_TYPE,
    "coupon_type": COUPON_TYPE,
    "coupon_range_type": COUPON_RANGE_TYPE,
}


def decode(code, codes: dict[str, str]) -> Column:
    """Code -> description; unknown codes give NULL."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    c = F.col(code) if isinstance(code, str) else code
    return F.try_element_at(m, c)


def keyword_weight(source) -> Column:
    c = F.col(source) if isinstance(source, str) else source
    expr = None
    for k, w in KEYWORD_WEIGHT.items():
        expr = (F.when(c == k, F.lit(w)) if expr is None else expr.when(c == k, F.lit(w)))
    return expr.otherwise(F.lit(0))
