"""Keyword tokenizer and the counts-to-rows generator (Column -> Column).

Both return arrays that callers ``explode`` (inner: a row with no element disappears, like a
lateral join with a table function).  They stay JVM-side: no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import KEYWORD_CART, KEYWORD_CLICK, KEYWORD_ORDER

# A word is a maximal run of letters or digits of any script, lower-cased.
WORD_PATTERN = r"([\p{L}\p{N}]+)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text) -> Column:
    """Text -> ARRAY<STRING> of words over the whole text (no prefix, no cap)."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(WORD_PATTERN), 1)


def keyword_sources(click_ct, cart_ct, order_ct) -> Column:
    """(click, cart, order) counts -> ARRAY<STRUCT<ct BIGINT, source STRING>>, one per count > 0,
    in the order CLICK, CART, ORDER."""
    items = [
        F.struct(_c(click_ct).cast("bigint").alias("ct"), F.lit(KEYWORD_CLICK).alias("source")),
        F.struct(_c(cart_ct).cast("bigint").alias("ct"), F.lit(KEYWORD_CART).alias("source")),
        F.struct(_c(order_ct).cast("bigint").alias("ct"), F.lit(KEYWORD_ORDER).alias("source")),
    ]
    # a concatenation, not a filter with a lambda: it stays inside generated code
    return F.concat(*[F.when(x["ct"] > 0, F.array(x)).otherwise(F.array().cast("array<struct<ct:bigint,source:string>>")) for x in items])
