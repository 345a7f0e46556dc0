"""Small control files (table definitions, manifests, pinned versions) on whatever file system the root lies on."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(the path's file system, the path class)."""
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path_of


def exists(spark: SparkSession, path: str) -> bool:
    fs, path_of = file_system(spark, path)
    return fs.exists(path_of(path))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, path_of = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path_of(folder))) if fs.exists(path_of(folder)) else []


def write_json(spark: SparkSession, path: str, value) -> None:
    """The file appears whole or not at all; an older one is replaced."""
    fs, path_of = file_system(spark, path)
    folder, name = path.rsplit("/", 1)
    draft = path_of(f"{folder}/_draft-{name}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    fs.delete(path_of(path), False)
    if not fs.rename(draft, path_of(path)):
        raise OSError(f"could not publish {path}")


def read_json(spark: SparkSession, path: str):
    fs, path_of = file_system(spark, path)
    stream = fs.open(path_of(path))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, path_of = file_system(spark, path)
    fs.delete(path_of(path), True)


def numbered(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """The numbers n of the files ``<prefix><n>.json`` in a folder, rising."""
    found = [n[len(prefix):-5] for n in names(spark, folder) if n.startswith(prefix) and n.endswith(".json")]
    return sorted(int(n) for n in found if n.isdigit())


# ---- batches that are published as a whole ---------------------------------------------------------

def publish(spark: SparkSession, root: str, batch_id: int, outputs: dict) -> None:
    """One manifest names all outputs of a batch: folders (relative to ``root``) or versions.  Until it is there, no
    reader that goes by manifests sees any of them."""
    write_json(spark, f"{root}/_manifests/batch={batch_id}.json", outputs)


def published(spark: SparkSession, root: str) -> dict[int, dict]:
    """batch id -> outputs of the batches that are complete."""
    ids = numbered(spark, f"{root}/_manifests", "batch=")
    return {i: read_json(spark, f"{root}/_manifests/batch={i}.json") for i in ids}
