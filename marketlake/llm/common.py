"""Helpers shared by the operators: package shipping, reliable checkpoints, row keys, components."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, new_location

# ASCII white space as the contracts spell it; a word is a run of anything else.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Text that a Python worker takes in hand at a time (a longer single text is taken whole).
PART_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Give executors this package (once per context) so functions pickle by reference and the
    models they load stay cached in reused Python workers.  The archive is put under the shared root."""
    sc = spark.sparkContext
    if getattr(sc, "_marketlake_shipped", False):
        return
    package, archive = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(os.path.basename(package), os.path.relpath(full, package)))
    path = f"{new_location(spark, 'packages')}/marketlake_pkg.zip"
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(sc._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(archive.getvalue()))
    out.close()
    sc.addPyFile(path)
    sc._marketlake_shipped = True


def parts(batches: Iterator[pa.RecordBatch], *text: str, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in parts whose text (a column, or a field of a struct column) holds about ``most`` bytes, at
    least one row: what a worker has in hand does not grow with Spark's batches."""
    for batch in batches:
        column = batch.column(text[0])
        for field in text[1:]:
            column = column.field(field)
        upto = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(upto):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
        del batch, column
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def text_digest(column: str = "text") -> Column:
    """Tells apart rows that repeat a doc_id with another text (part of the row key)."""
    return F.xxhash64(whole_text(column))


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint under ``spark.checkpoint.dir``."""
    return cut_lineage(df)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) edges by alternating large-star / small-star rounds.

    Returns (node, root) for every node that has an edge; root is the smallest node reachable.
    Each round is a pair of keyed aggregations (a node's minimum is combined map-side; no
    neighbour list is ever collected) and is checkpointed; the number of rounds follows the
    logarithm of the longest path."""
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct())
    while True:
        before = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before[0] == 0:
            break
        # large-star: every neighbour above u is linked to the smallest of u and its neighbours
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small-star: every lower neighbour of u, and u, is linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(low, "u")
        small = (linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        e = materialize(small)
        after = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(after) == tuple(before):
            break
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
