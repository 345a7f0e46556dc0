"""SQL surface: temporary views and SQL-defined functions, for jobs written as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.logs import CORRUPT, parse_once
from ..schemas import PAGE_VIEW

WORDS = r"""CREATE OR REPLACE TEMPORARY FUNCTION keyword_words(content STRING) RETURNS TABLE(keyword STRING)
RETURN SELECT explode(regexp_extract_all(lower(content), r'([\p{L}\p{N}]+)', 1))"""

SOURCES = """CREATE OR REPLACE TEMPORARY FUNCTION keyword_counts(click_ct BIGINT, cart_ct BIGINT, order_ct BIGINT)
RETURNS TABLE(ct BIGINT, source STRING)
RETURN SELECT s.ct, s.source FROM VALUES (1) AS one(x)
  LATERAL VIEW explode(filter(array(named_struct('ct', click_ct, 'source', 'CLICK'), named_struct('ct', cart_ct, 'source', 'CART'),
                                    named_struct('ct', order_ct, 'source', 'ORDER')), x -> x.ct > 0)) e AS s"""

KEYWORD_SEARCH_SQL = """
SELECT keyword, count(*) AS ct, 'SEARCH' AS source,
       date_format(date_trunc('DAY', event_time), 'yyyy-MM-dd HH:mm:ss') AS stt,
       date_format(date_trunc('DAY', event_time) + INTERVAL 1 DAY, 'yyyy-MM-dd HH:mm:ss') AS edt,
       CAST({as_of_ms} AS BIGINT) AS ts
FROM page_view, LATERAL keyword_words(page['item'])
WHERE page['page_id'] = 'good_list' AND page['item'] IS NOT NULL
GROUP BY keyword, date_trunc('DAY', event_time)"""


def topic_view(raw: DataFrame, name: str, schema: StructType = PAGE_VIEW, value: str = "value") -> DataFrame:
    """Declare a JSON topic as a named table: parsed against ``schema``, ``event_time`` from its ``ts``."""
    rows = parse_once(raw, value, schema)
    rows = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT).withColumn("event_time", F.timestamp_millis("ts"))
    rows.createOrReplaceTempView(name)
    return rows


def register(spark: SparkSession) -> None:
    """Create the table functions in the session."""
    spark.sql(WORDS)
    spark.sql(SOURCES)


def page_view(page_log: DataFrame) -> DataFrame:
    """The page log as SQL jobs declare it: ``common`` and ``page`` as text maps, ``ts``, ``event_time`` (UTC
    wall clock)."""
    def text_map(column: str) -> F.Column:
        names = page_log.schema[column].dataType.names
        return F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"{column}.{n}").cast("string"))]).alias(column)

    wall = (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("ts") / 1000).cast("decimal(18,6)")))
    return page_log.select(text_map("common"), text_map("page"), "ts", wall.alias("event_time"))
