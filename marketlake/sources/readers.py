"""Sources: raw text lines, JSON lines, Kafka topics, parquet snapshots, JDBC tables.

A stream of JSON strings is a DataFrame with one ``value STRING`` column, whatever the transport.
Kafka needs the spark-sql-kafka package on the classpath; file kinds need nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import order

KINDS = ("kafka", "text", "json-files", "parquet")


def source(spark: SparkSession, kind: str, where: str, *, streaming: bool = False,
           schema: StructType | None = None, starting_offsets: str | None = None,
           options: dict[str, str] | None = None) -> DataFrame:
    """Open a source.

    * ``kafka``: ``where`` = topic (``kafka.bootstrap.servers`` in ``options``); returns ``value STRING``
      plus ``seq``, the composite arrival key (``operators.order``): record timestamp (ms), partition, offset
      (keyless producers spread one visitor over partitions).  ``starting_offsets`` maps to
      ``startingOffsets`` (``latest`` for the SQL-table flavour, committed offsets otherwise).
    * ``text``: landed raw log files (one JSON object per line) -> ``value STRING`` and ``seq``
      (modification time, file, line number).  A stream gives ``split_lines``; ``jobs.start_landing`` numbers them
      batch by batch (a streaming plan cannot count a file before it reads it).
    * ``json-files``: newline-delimited JSON parsed with ``schema`` (required).
    * ``parquet``: typed snapshot (``schema`` required when streaming).
    """
    opts = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if kind == "kafka":
        opts["subscribe"] = where
        if starting_offsets:
            opts["startingOffsets"] = starting_offsets
        df = reader.format("kafka").options(**opts).load()
        return df.select(F.col("value").cast("string").alias("value"),
                         order.key(F.unix_millis("timestamp"), order.partition_text(F.col("partition")), F.col("offset")).alias("seq"))
    if kind == "text":
        lines = reader.options(**opts).text(where)
        return order.split_lines(lines) if streaming else order.numbered_lines(order.split_lines(lines))
    if kind == "json-files":
        if schema is None:
            raise ValueError("json-files needs a declared schema")
        return reader.schema(schema).options(**opts).json(where)
    if kind == "parquet":
        if schema is not None:
            reader = reader.schema(schema)
        return reader.options(**opts).parquet(where)
    raise ValueError(f"unknown source kind {kind!r}; expected one of {KINDS}")


def jdbc_table(spark: SparkSession, url: str, table: str, *, properties: dict[str, str] | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Read a relational table (routing config, dimension snapshot, report table).

    With ``partition_column`` the read is split into ``num_partitions`` parallel range scans.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    return reader.load()


def snake_to_camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def camel_columns(df: DataFrame) -> DataFrame:
    """Rename snake_case columns to camelCase (driver-side names only; no data moves)."""
    return df.withColumnsRenamed({c: snake_to_camel(c) for c in df.columns})


def report_table(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """Day-partitioned aggregate table; a literal ``dt`` filter prunes partitions at the scan."""
    df = spark.read.parquet(path)
    return df if date is None else df.filter(F.col("dt") == F.lit(date))
