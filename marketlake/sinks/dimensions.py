"""Dimension tables: keyed, bucketed, copy-on-write, versioned.

A table is created from its routing config: key columns (one or several), columns and extension text are stored
in its definition; ``SALT_BUCKETS=n`` in the extension sets the number of buckets.  A row is ``(id, data)``: ``id``
is the canonical text of the configured key, ``data`` its columns as a text map.  Rows lie in buckets by a hash of
``id``.  A merge reads and rewrites only the buckets that its changes touch; a version is a manifest that names,
for every bucket, the folder that holds it, so untouched buckets are shared between versions.  A version is there
once its manifest is; a merge that broke off half way leaves none and is repeated from the same base.  The newest
``KEPT`` versions stay readable; older manifests go, and with them the folders that only they name.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.routing import APPLIED, key_text, merge_dimension
from . import files

BUCKETS, KEPT = 16, 8
ROWS = "id string, data map<string,string>"


def columns_of(sink_columns: str | None, sink_pk: str | None = None) -> tuple[list[str], list[str]]:
    """(key columns, all columns with the key first) of a configured dimension; names are split exactly on ``,``."""
    key = [c for c in (sink_pk or "id").split(",") if c]
    return key, key + [c for c in (sink_columns or "").split(",") if c and c not in key]


class Dimension:
    """The dimension table under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    # ---- definition --------------------------------------------------------------------------------
    def create(self, sink_columns: str | None, sink_pk: str | None = None, sink_extend: str | None = None) -> bool:
        """Create the empty table (version 0) if it is not there; False if it is (its definition stays)."""
        if files.exists(self.spark, f"{self.root}/_table.json"):
            return False
        key, columns = columns_of(sink_columns, sink_pk)
        salt = re.search(r"(?i)\bSALT_BUCKETS\s*=\s*(\d+)", sink_extend or "")
        self._commit(0, {})
        files.write_json(self.spark, f"{self.root}/_table.json", {
            "key": key, "columns": columns, "extend": sink_extend or "", "buckets": int(salt.group(1)) if salt else BUCKETS})
        return True

    @property
    def definition(self) -> dict:
        return files.read_json(self.spark, f"{self.root}/_table.json")

    # ---- versions ----------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        return files.numbered(self.spark, f"{self.root}/_versions", "v=")

    def _manifest(self, version: int) -> dict[str, str]:
        return files.read_json(self.spark, f"{self.root}/_versions/v={version}.json")

    def _commit(self, version: int, held: dict[str, str]) -> None:
        files.write_json(self.spark, f"{self.root}/_versions/v={version}.json", held)

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*[f"{self.root}/{f}" for f in sorted(folders)])

    def read(self, version: int | None = None) -> DataFrame:
        """``(id, data)`` of a version (the newest one by default)."""
        version = self.versions()[-1] if version is None else version
        return self._rows(list(self._manifest(version).values()))

    def table(self, version: int | None = None) -> DataFrame:
        """A version with one STRING column for each configured column, the key first."""
        return self.read(version).select(*[F.col("data")[c].alias(c) for c in self.definition["columns"]])

    # ---- merge -------------------------------------------------------------------------------------
    def merge(self, changes: DataFrame, version: int) -> int:
        """Write ``version`` = the newest version below it with ``changes`` (seq, type, data) applied; the number of
        buckets rewritten.  Repeating a merge gives the same version again."""
        defined = self.definition
        base = max(v for v in self.versions() if v < version)
        held = self._manifest(base)
        rows = changes.where(F.col("type").isin(*APPLIED)).select("seq", "type", "data", key_text(defined["key"]).alias("id"))
        rows = rows.where("id is not null").withColumn("bucket", self._bucket(defined["buckets"])).persist()
        try:
            touched = sorted(r.bucket for r in rows.select("bucket").distinct().collect())     # at most the buckets
            if touched:
                old = self._rows([held[str(b)] for b in touched if str(b) in held])
                merged = merge_dimension(old, rows, defined["key"]).withColumn("bucket", self._bucket(defined["buckets"]))
                merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/v={version}")
        finally:
            rows.unpersist()
        self._commit(version, held | {str(b): f"data/v={version}/bucket={b}" for b in touched})
        self.retire()
        return len(touched)

    @staticmethod
    def _bucket(n: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")

    def retire(self, kept: int = KEPT) -> None:
        """Drop the versions before the newest ``kept`` ones, and the folders that no version names any more."""
        versions = self.versions()
        old, stay = versions[:-kept], versions[-kept:]
        if not old:
            return
        named = {f for v in stay for f in self._manifest(v).values()}
        gone = {f for v in old for f in self._manifest(v).values()} - named
        for v in old:
            files.delete(self.spark, f"{self.root}/_versions/v={v}.json")
        for f in sorted(gone):
            files.delete(self.spark, f"{self.root}/{f}")


def pinned(spark: SparkSession, folder: str, batch_id: int, dims: dict[str, Dimension], kept: int = KEPT // 2) -> dict[str, int]:
    """The version of each dimension that a batch reads.

    Chosen the first time the batch asks and written beside its output before anything is read, so a replayed batch
    reads what it read first.  Pins of long finished batches go; a dimension keeps more versions than batches keep pins,
    as long as it is merged no more often than batches are written."""
    path = f"{folder}/_pins/batch={batch_id}.json"
    if not files.exists(spark, path):
        files.write_json(spark, path, {name: d.versions()[-1] for name, d in dims.items()})
        for old in files.numbered(spark, f"{folder}/_pins", "batch=")[:-kept]:
            files.delete(spark, f"{folder}/_pins/batch={old}.json")
    return files.read_json(spark, path)
