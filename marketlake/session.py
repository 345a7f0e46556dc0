"""Session construction and shared-storage locations.

Nothing here hard-codes a machine-local folder for cluster runs: the lineage-cutting and
streaming-checkpoint root is read from ``spark.checkpoint.dir``; a temporary folder is only
chosen when that setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a production profile wants; each can be overridden by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # broadcast only below this size; Catalyst checks file statistics at planning time and
    # AQE re-checks actual shuffle sizes at runtime, falling back to sort-merge beyond it.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = "local[*]", app: str = "marketlake",
                  shuffle_partitions: int | None = None, time_zone: str = "UTC",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the profile above.

    On a cluster pass ``master=None`` and let spark-submit decide.  ``shuffle_partitions`` is left to the
    cluster's own setting unless given (AQE merges small partitions but does not split those of an
    ordinary aggregate, so on a cluster it should be about shuffle bytes / 128 MB).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.sql.session.timeZone"] = time_zone
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and lineage-cutting tables.

    Read from ``spark.checkpoint.dir``.  Only when it is unset on a local master (tests on one
    machine) a fresh temporary folder is created and recorded in the session, so later calls
    agree; off local mode executors would not see such a folder, so there it must be set.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="marketlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def new_location(spark: SparkSession, kind: str) -> str:
    """A fresh sub-folder of the shared root (one per streaming query / materialised table)."""
    return os.path.join(shared_root(spark), kind, uuid.uuid4().hex)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss) under the shared root."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)
