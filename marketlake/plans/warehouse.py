"""The batch plan of the whole warehouse over the driver tables.

``Warehouse`` builds each layer lazily and memoises the DataFrame (a logical plan, not data), so
queries that share a layer share its plan text.  ``materialize`` writes a layer to a table under
the shared root and reads it back (cuts lineage; survives executor loss; lets several reports
scan one aggregate table instead of recomputing it).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import joins, logs, stats, visitors
from ..operators.reports import with_day
from ..schemas import KEYWORD_STATS_COLUMNS
from ..session import shared_root
from ..sources import tables as T
from ..sources.readers import report_table


@dataclass(frozen=True)
class Params:
    """Durations of the driver-data profile (the source's own defaults are in brackets)."""
    window: str = "1 day"                 # product / province / keyword windows [10 seconds]
    visitor_window: str = "1 hour"        # visitor windows, fine enough for the hour report [10 seconds]
    bounce_within: str = "4 hours"        # [10 seconds]
    order_within: str = "5 milliseconds"  # order x detail [5 milliseconds]
    payment_within: str = "1800 seconds"  # [1800 seconds]
    as_of_ms: int = T.AS_OF_MS            # pinned "now"
    top_n: int = 10
    keyword_top_n: int = 20


@dataclass
class Warehouse:
    spark: SparkSession
    sf_dir: str
    params: Params = field(default_factory=Params)
    timings: dict[str, float] = field(default_factory=dict)

    # ---- inputs -------------------------------------------------------------------------------
    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        s, d = self.spark, self.sf_dir
        return {"user": T.dim_user(s, d), "province": T.dim_province(s, d), "sku": T.dim_sku(s, d),
                "spu": T.dim_spu(s, d), "trademark": T.dim_trademark(s, d), "category3": T.dim_category3(s, d)}

    @cached_property
    def log(self) -> DataFrame:
        return T.log_events(self.spark, self.sf_dir)

    @cached_property
    def parsed_log(self) -> DataFrame:
        """Raw text -> typed rows (exercises the parser on the landed-text form)."""
        return logs.parse_log(T.raw_log(self.spark, self.sf_dir))

    # ---- detail layer -------------------------------------------------------------------------
    @cached_property
    def repaired_log(self) -> DataFrame:
        return visitors.repair_new_flag(self.parsed_log)

    @cached_property
    def page_log(self) -> DataFrame:
        return logs.split_page(visitors.repair_new_flag(self.log))

    # Readers of the page log that need no searched text, or no repaired flag, read it without the join that gives
    # them: the rows are the same.
    @cached_property
    def plain_log(self) -> DataFrame:
        """The log without searched texts, not repaired.  Visits and bounces do not depend on the new-visitor flag, so
        what is found in this log is repaired afterwards, once."""
        return T.log_events(self.spark, self.sf_dir, names=False)

    def repaired(self, rows: DataFrame) -> DataFrame:
        return visitors.repair_new_flag(rows, of=self.plain_log)

    # ---- middle layer -------------------------------------------------------------------------
    @cached_property
    def unique_visits(self) -> DataFrame:
        return self.repaired(visitors.unique_visits(logs.split_page(self.plain_log)))

    def bounces(self, mode: str = "as_written") -> DataFrame:
        return self.repaired(visitors.bounces(logs.split_page(self.plain_log), self.params.bounce_within, mode))

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order x detail interval join, before the dimension lookups."""
        s, d = self.spark, self.sf_dir
        return joins.order_detail_join(T.order_info(s, d), T.order_detail(s, d, time="order"),
                                       self.params.order_within)

    @cached_property
    def order_wide(self) -> DataFrame:
        return joins.enrich_order_wide(self.order_lines, self.dims, self.params.as_of_ms, unique_dims=True)

    @cached_property
    def payment_wide(self) -> DataFrame:
        return joins.payment_wide(T.payment_info(self.spark, self.sf_dir), self.order_wide,
                                  within=self.params.payment_within)

    # ---- summary layer ------------------------------------------------------------------------
    @cached_property
    def visitor_measures(self) -> DataFrame:
        pages = logs.split_page(self.plain_log)
        return stats.visitor_measures(pages, visitors.unique_visits(pages), visitors.bounces(pages, self.params.bounce_within),
                                      self.repaired)

    @cached_property
    def visitor_stats(self) -> DataFrame:
        return stats.visitor_stats(self.visitor_measures, self.params.visitor_window, as_of_ms=self.params.as_of_ms)

    @cached_property
    def product_streams(self) -> list[tuple[str | tuple[str, ...] | None, DataFrame]]:
        """Product measures read the order lines before enrichment: the lookups are left joins on
        unique keys, so the rows are the same and no dimension is joined twice (product stats look
        the dimensions up after aggregating)."""
        s, d = self.spark, self.sf_dir
        lines = joins.lines_with_payments(T.payment_info(s, d), self.order_lines, within=self.params.payment_within)
        pages = logs.split_page(T.log_events(s, d, names=False))
        return stats.product_streams(pages, T.favor_info(s, d), T.cart_info(s, d), lines, None,
                                     T.order_refund_info(s, d), T.comment_info(s, d))

    @cached_property
    def product_measures(self) -> DataFrame:
        return stats.product_union(self.product_streams)

    @cached_property
    def product_stats(self) -> DataFrame:
        return stats.product_stats(self.product_streams, self.dims, self.params.window, as_of_ms=self.params.as_of_ms,
                                   unique_dims=True)

    @cached_property
    def province_stats(self) -> DataFrame:
        return stats.province_stats(self.order_wide, self.params.window, as_of_ms=self.params.as_of_ms)

    @cached_property
    def keyword_search_stats(self) -> DataFrame:
        return stats.keyword_search_stats(logs.split_page(self.log), self.params.window, as_of_ms=self.params.as_of_ms)

    @cached_property
    def keyword_product_days(self) -> DataFrame:
        """Keywords of the products with the day of their window, which is read once per product and window."""
        p = stats.product_stats(self.product_streams, self.dims, self.params.window, as_of_ms=self.params.as_of_ms,
                                unique_dims=True, tokenizer=words)
        return stats.keyword_product_stats(p, as_of_ms=self.params.as_of_ms)

    @cached_property
    def keyword_product_stats(self) -> DataFrame:
        return self.keyword_product_days.select(*KEYWORD_STATS_COLUMNS)

    @cached_property
    def keyword_stats(self) -> DataFrame:
        return stats.union_all([with_day(self.keyword_search_stats), self.keyword_product_days])

    # ---- materialisation ----------------------------------------------------------------------
    def materialize(self, df: DataFrame, name: str, partition_by: str | None = "dt") -> DataFrame:
        """Write ``df`` under the shared root (``dt``-partitioned when it has stt) and read it back."""
        path = f"{shared_root(self.spark)}/tables/{name}"   # one place per table: a new build replaces it
        out = with_day(df) if (partition_by == "dt" and "stt" in df.columns) else df
        if partition_by and partition_by in out.columns:
            # range-partition by (day, window, first column): each task writes a contiguous run of
            # days (few files per day instead of one per task per day) and a large day still
            # spans several tasks
            keys = [partition_by] + [c for c in ("stt", out.columns[0]) if c in out.columns and c != partition_by]
            w = out.repartitionByRange(*keys).write.mode("overwrite").partitionBy(partition_by)
        else:
            w = out.write.mode("overwrite")
        t0 = time.time()
        w.parquet(path)
        self.timings[name] = round(time.time() - t0, 3)
        back = report_table(self.spark, path)
        # partition discovery would type dt as an integer; reports compare it as yyyyMMdd text
        return back.withColumn("dt", F.col("dt").cast("string")) if "dt" in back.columns else back
