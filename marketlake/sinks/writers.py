"""Sinks: topics, topic-routed records, day-partitioned report tables, console (dimensions: ``dimensions``).

Streaming writes go through ``foreachBatch`` where a batch must land in several places or be
merged; every streaming query gets a ``checkpointLocation`` under the shared root.  File sinks are
exactly-once (batch id -> deterministic output folder); the Kafka sink is at-least-once.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reports import with_day


def as_json_value(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows -> ``value`` JSON text (null fields omitted)."""
    cols = columns or df.columns
    return df.select(F.to_json(F.struct(*cols)).alias("value"))


def to_topic(df: DataFrame, topic: str, options: dict[str, str], checkpoint: str):
    """Stream rows as JSON to one Kafka topic; a fixed ``checkpoint`` lets a restart go on."""
    w = as_json_value(df).writeStream.format("kafka").options(**options).option("topic", topic)
    return w.option("checkpointLocation", checkpoint).start()


def to_routed_topics(df: DataFrame, options: dict[str, str], checkpoint: str):
    """Each record to the topic named by its ``sink_table``; payload = its ``data``."""
    out = df.select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))
    w = out.writeStream.format("kafka").options(**options)
    return w.option("checkpointLocation", checkpoint).start()


def write_routed_files(batch: DataFrame, root: str, batch_id: int) -> None:
    """File form of topic routing: ``root/sink_table=<t>/batch=<id>/`` (idempotent per batch)."""
    out = batch.select("sink_table", F.to_json("data").alias("value"))
    out.write.mode("overwrite").partitionBy("sink_table").json(os.path.join(root, f"_batch={batch_id}"))


def append_report(df: DataFrame, path: str, columns: list[str], batch_id: int | None = None) -> None:
    """Aggregate rows in sink column order, partitioned by day.  With ``batch_id`` (foreachBatch) the rows
    go to a folder of that batch, rewritten on a replay, so nothing is counted twice.  Rows of a day come together
    first, or every task would write a file for every day (the planner splits a large day where it runs adaptively)."""
    out = with_day(df).select(*columns, "dt").hint("rebalance", "dt").write.partitionBy("dt")
    if batch_id is None:
        out.mode("append").parquet(path)
    else:
        out.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))


def append_report_jdbc(df: DataFrame, url: str, table: str, columns: list[str], batch_size: int = 5000,
                       properties: dict[str, str] | None = None) -> None:
    """Relational form of the report sink (positional column order, batched inserts)."""
    w = df.select(*columns).write.format("jdbc").option("url", url).option("dbtable", table)
    w = w.option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()


def console(df: DataFrame, name: str = "debug"):
    """Opt-in debug sink."""
    return df.writeStream.format("console").option("truncate", "false").queryName(name).start()
