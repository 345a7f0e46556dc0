"""Arrival order of records as a composite key.

``seq`` is either one number (the driver tables) or a struct ``(time, part, place, row)`` that orders records by
time, then by where they lie: a topic's partition and offset, or a file and the line in it.  Structs compare
field by field, so windows, ``min_by``/``max_by`` and sorts take either; nothing is folded into one number, so no
two records share a key however many lines a file or partitions a topic has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

KEY = StructType([StructField("time", LongType()), StructField("part", StringType()),
                  StructField("place", LongType()), StructField("row", LongType())])
#: Between the fields of a key's text: lower than any character of a path.
GAP = "\u0001"


def key(time: Column, part: Column, place: Column, row: Column | None = None) -> Column:
    """A composite arrival key; ``part`` must order as text."""
    row = F.lit(0) if row is None else row
    return F.struct(time.cast("long").alias("time"), part.cast("string").alias("part"), place.cast("long").alias("place"),
                    row.cast("long").alias("row"))


def partition_text(partition: Column) -> Column:
    """A partition number as text of one width, so that text order is number order."""
    return F.lpad(partition.cast("string"), 10, "0")


def is_composite(df: DataFrame, name: str = "seq") -> bool:
    return isinstance(df.schema[name].dataType, StructType)


def as_text(c: Column) -> Column:
    """A composite key as text of the same order (numbers in sixteen hexadecimal digits)."""
    digits = [F.lpad(F.hex(c[n]), 16, "0") for n in ("time", "place", "row")]
    return F.concat(digits[0], F.lit(GAP), c["part"], F.lit(GAP), digits[1], F.lit(GAP), digits[2])


def from_text(c: Column) -> Column:
    """The composite key of its text."""
    f = F.split(c, GAP)
    number = lambda i: F.conv(F.get(f, F.lit(i)), 16, 10).cast("long")
    return key(number(0), F.get(f, F.lit(1)), number(2), number(3))


def bucket(df: DataFrame, name: str, width: int) -> Column:
    """A bucket that never falls along the order: of ``width`` positions, or of an hour where the key is
    composite (``neighbor`` cuts the buckets that hold too much)."""
    c = F.col(name)
    return F.floor((c["time"] / 3_600_000) if is_composite(df, name) else c / F.lit(width)).cast("bigint")


def split_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Landed text with the file and the split that each line comes from: ``value, _time, _file, _start``."""
    at = F.col("_metadata")
    return lines.select(F.col(text).alias("value"), F.unix_millis(at["file_modification_time"]).alias("_time"),
                        at["file_path"].alias("_file"), at["file_block_start"].alias("_start"))


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``value`` and ``seq`` = (modification time, file, line number) of ``split_lines`` (batch, or one micro-batch,
    which holds whole files).

    Two passes: the lines of every file split are counted (one small row per split), a running sum over a
    file's splits gives each split the number its first line has, and every line adds its place in the split."""
    rows = lines.withColumn("_id", F.monotonically_increasing_id())      # rises along a split
    splits = rows.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_file", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    numbered = rows.join(splits, ["_file", "_start"])
    return numbered.select("value", key(F.col("_time"), F.col("_file"), F.col("_id") + F.col("_shift")).alias("seq"))
