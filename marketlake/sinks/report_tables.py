"""Report tables that a stream appends to: a folder per batch and day, merged into one folder per day.

A streaming report writes ``batch=<id>/dt=<day>`` for each micro-batch, so a day that windows reach for weeks ends up
in as many folders.  ``compact`` merges the folders of the days that new batches touched; the others stay as they are.
Readers go by manifests and never by what lies in the folder:

* ``_manifests/batch=<id>.json``: a batch and its days, written once all its rows are there;
* ``_compacted/v=<n>.json``: the folder of each merged day, and the last batch that is merged into them.

``read`` takes the newest version's days and the published batches after it, so it sees the same rows before, during
and after a merge.  A published batch stays as it is: its replay writes nothing, so it may be merged at once (a table
belongs to the checkpoint of its job; a job that starts anew needs a new table).  Folders that were replaced stay until
``KEPT`` later versions are there, for readers that listed them.  One merge runs at a time; one that died leaves nothing
that counts and is done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from . import files, writers

#: Versions of the merged days that keep their folders.
KEPT = 2


def add_batch(df: DataFrame, root: str, columns: list[str], batch_id: int) -> None:
    """The rows of one micro-batch, published when they are complete.  Repeating a published batch changes nothing."""
    spark = df.sparkSession
    if batch_id <= _newest(spark, root)["through"] or files.exists(spark, f"{root}/_manifests/batch={batch_id}.json"):
        return
    if not files.exists(spark, f"{root}/_schema.json"):
        files.write_json(spark, f"{root}/_schema.json", df.select(*columns).schema.jsonValue())
    writers.append_report(df, root, columns, batch_id)
    files.publish(spark, root, batch_id, {"days": _days(spark, f"{root}/batch={batch_id}")})


def _days(spark: SparkSession, folder: str) -> list[str]:
    return [n[len("dt="):] for n in files.names(spark, folder) if n.startswith("dt=")]


def versions(spark: SparkSession, root: str) -> list[int]:
    return files.numbered(spark, f"{root}/_compacted", "v=")


def _version(spark: SparkSession, root: str, version: int | None) -> dict:
    return {"through": -1, "days": {}} if version is None else files.read_json(spark, f"{root}/_compacted/v={version}.json")


def _newest(spark: SparkSession, root: str) -> dict:
    found = versions(spark, root)
    return _version(spark, root, found[-1] if found else None)


def _batches(spark: SparkSession, root: str, after: int) -> dict[int, list[str]]:
    """The days of every published batch after a given one."""
    ids = [i for i in files.numbered(spark, f"{root}/_manifests", "batch=") if i > after]
    return {i: files.read_json(spark, f"{root}/_manifests/batch={i}.json")["days"] for i in ids}


def folders(spark: SparkSession, root: str, date: str | None = None) -> list[str]:
    """The day folders that count now, of all days or of one."""
    now = _newest(spark, root)
    found = [f"{folder}/dt={day}" for day, folder in now["days"].items() if date in (None, day)]
    for i, days in _batches(spark, root, now["through"]).items():
        found += [f"batch={i}/dt={day}" for day in days if date in (None, day)]
    return sorted(found)


def _rows(spark: SparkSession, root: str, found: list[str]) -> DataFrame:
    kept = StructType.fromJson(files.read_json(spark, f"{root}/_schema.json"))
    schema = StructType([*kept.fields, StructField("dt", StringType())])
    if not found:
        return spark.createDataFrame([], schema)
    listed = StructType([*kept.fields, StructField("batch", StringType()), StructField("dt", StringType())])
    return spark.read.schema(listed).option("basePath", root).parquet(*[f"{root}/{f}" for f in found]).select(*schema.names)


def read(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """The table, or one day of it (only that day's folders are listed)."""
    return _rows(spark, root, folders(spark, root, date))


def compact(spark: SparkSession, root: str) -> list[str]:
    """Merge the published batches into their days; the days that were rewritten.

    The rows are spread by day and first column with no fixed number of tasks, so a small day becomes one file and a
    large one several."""
    now = _newest(spark, root)
    batches = _batches(spark, root, now["through"])
    if not batches:
        return []
    touched = sorted({day for days in batches.values() for day in days})
    version = max(versions(spark, root), default=0) + 1
    target = f"batch=days-{version}"
    found = [f"{now['days'][day]}/dt={day}" for day in touched if day in now["days"]]
    found += [f"batch={i}/dt={day}" for i, days in batches.items() for day in days]
    if found:
        rows = _rows(spark, root, found)
        rows.repartitionByRange("dt", rows.columns[0]).write.mode("overwrite").partitionBy("dt").parquet(f"{root}/{target}")
    files.write_json(spark, f"{root}/_compacted/v={version}.json",
                     {"through": max(batches), "days": now["days"] | {day: target for day in touched}})
    retire(spark, root)
    return touched


def retire(spark: SparkSession, root: str, kept: int = KEPT) -> None:
    """Drop the versions before the newest ``kept``, and the folders and batches that none of these needs."""
    found = versions(spark, root)
    if len(found) <= kept:
        return
    stay = [_version(spark, root, v) for v in found[-kept:]]
    named = {f"{folder}/dt={day}" for v in stay for day, folder in v["days"].items()}
    for v in found[:-kept]:
        for day, folder in _version(spark, root, v)["days"].items():
            if f"{folder}/dt={day}" not in named:
                files.delete(spark, f"{root}/{folder}/dt={day}")
        files.delete(spark, f"{root}/_compacted/v={v}.json")
    oldest = min(v["through"] for v in stay)
    for i in files.numbered(spark, f"{root}/_manifests", "batch="):
        if i <= oldest:
            files.delete(spark, f"{root}/batch={i}")
            files.delete(spark, f"{root}/_manifests/batch={i}.json")
