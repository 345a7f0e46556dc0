"""The three order-dependent visitor operators, batch form (exact rules of the source).

* ``repair_new_flag``: a visitor's first ``is_new='1'`` day (by arrival order ``seq``) is kept;
  ``is_new='1'`` on any later or earlier *other* day becomes ``'0'``; ``'0'`` rows never count.
  Batch: one aggregate per visitor (``min_by``, map-side combined) joined back -- no window.
* ``unique_visits``: among entry pages, a row is a daily unique visit when the previous entry
  page of the same visitor (by ``seq``) is on another day or absent.
* ``bounces``: an entry page is a bounce when the visitor's next page (any kind, by ``ts``) is
  absent or at least ``within`` later; ``mode='as_documented'`` also counts an entry page
  followed within ``within`` by another entry page.

The streaming forms (same names, stateful processors) live in ``marketlake.streaming.processors``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import ymd_from_millis
from .joins import _ms
from .logs import is_entry, split_page
from .neighbors import bucket_of, neighbor
from .order import bucket, is_composite

# Bucket widths of the neighbour search: rows of one visitor inside one bucket go to one task.
SEQ_BUCKET = 1 << 22           # arrival positions
TS_BUCKET_MS = 3_600_000       # one hour of event time
MOST_ROWS = 1_000_000          # rows of one visitor in one window; a bucket that holds more is cut


def _mid(df: DataFrame) -> DataFrame:
    return df.withColumn("_mid", F.col("common.mid"))


def repair_new_flag(log: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Return ``log`` with ``common.is_new`` repaired (rows and columns otherwise unchanged).  ``of`` is the whole log
    that tells the first days, where ``log`` holds only some of its rows, or what was made of them."""
    if log.isStreaming:
        raise ValueError("streaming input: use marketlake.streaming.processors.repair_new_flag_stream")
    cols = log.columns
    d = _mid(log).withColumn("_dt", ymd_from_millis(F.col("ts")))
    whole = d if of is None else _mid(of).withColumn("_dt", ymd_from_millis(F.col("ts")))
    first = (whole.filter(F.col("common.is_new") == "1").groupBy("_mid")
             .agg(F.min_by("_dt", "seq").alias("_first_dt")).withColumnRenamed("_mid", "_first_mid"))
    j = d.join(first, F.col("_mid").eqNullSafe(F.col("_first_mid")), "left")
    fixed = F.when((F.col("common.is_new") == "1") & (F.col("_dt") != F.col("_first_dt")), F.lit("0")) \
        .otherwise(F.col("common.is_new"))
    return j.withColumn("common", F.col("common").withField("is_new", fixed)).select(*cols)


def unique_visits(page_log: DataFrame, *, seq_bucket: int = SEQ_BUCKET, most: int | None = None) -> DataFrame:
    """Daily unique visits (rows of ``page_log``).  Buckets of a number are bounded by their width; those of a
    composite key are cut from ``most`` (or ``MOST_ROWS``) rows on."""
    if page_log.isStreaming:
        raise ValueError("streaming input: use marketlake.streaming.processors.unique_visits_stream")
    cols = page_log.columns
    e = _mid(page_log.filter(is_entry())).withColumn("_dt", ymd_from_millis(F.col("ts")))
    e = neighbor(e, ["_mid"], ["seq"], ["_dt"], direction="prev", bucket=bucket(e, "seq", seq_bucket), name="_prev",
                 most=most or (MOST_ROWS if is_composite(e) else None))
    keep = F.col("_prev").isNull() | (F.col("_prev._dt") != F.col("_dt"))
    return e.filter(keep).select(*cols)


def bounces(page_log: DataFrame, within: str = "10 seconds", mode: str = "as_written", *,
            ts_bucket_ms: int = TS_BUCKET_MS, most: int | None = MOST_ROWS) -> DataFrame:
    """Bounce rows (entry pages of ``page_log``) under the rules in the module docstring."""
    if page_log.isStreaming:
        raise ValueError("streaming input: use marketlake.streaming.processors.bounces_stream")
    if mode not in ("as_written", "as_documented"):
        raise ValueError(mode)
    cols = page_log.columns
    d = _mid(page_log).withColumn("_entry", is_entry())
    d = neighbor(d, ["_mid"], ["ts", "seq"], ["ts", "_entry"], direction="next",
                 bucket=bucket_of("ts", ts_bucket_ms), name="_next", most=most)
    gap_ok = (F.col("_next.ts") - F.col("ts")) >= F.lit(_ms(within))
    cond = F.col("_next").isNull() | gap_ok
    if mode == "as_documented":
        cond = cond | F.col("_next._entry")
    return d.filter(F.col("_entry") & cond).select(*cols)


def page_log_of(log: DataFrame) -> DataFrame:
    """Repaired page log: the page output of the detail layer."""
    return split_page(repair_new_flag(log))
