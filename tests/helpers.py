"""Builders for hand-written log and fact rows."""

from __future__ import annotations

from pyspark.sql import Row

from marketlake.schemas import LOG
from pyspark.sql.types import LongType, StructField, StructType

LOG_WITH_SEQ = StructType([StructField("seq", LongType())] + LOG.fields)


def log_row(seq, mid, ts, *, is_new="1", page_id="home", last=None, item=None, during=None, start=None,
            displays=None, vc="v1", ch="ch1", ar="ar1"):
    common = Row(mid=mid, uid=mid, vc=vc, ch=ch, ar=ar, md=None, os=None, ba=None, is_new=is_new)
    page = None if start else Row(page_id=page_id, last_page_id=last, item=item, item_type=None,
                                  during_time=during, source_type=None)
    disp = None if displays is None else [Row(item=i, item_type=t, display_type=None, order=None, pos_id=None)
                                          for i, t in displays]
    return (seq, common, start, page, disp, None, ts)


def log_df(spark, rows):
    return spark.createDataFrame(rows, LOG_WITH_SEQ)


DAY = 86_400_000
