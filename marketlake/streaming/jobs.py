"""Structured Streaming jobs: each layer is one streaming query from files (or Kafka) to a sink.

``stage`` writes a batch DataFrame as the time-ordered file input of a stream; ``run_available_now`` runs a
streaming DataFrame to completion (``Trigger.AvailableNow``) into a parquet sink and reads it back.
Checkpoints and outputs live under the shared root (``spark.checkpoint.dir``), so a restarted
query resumes from its checkpoint.

Event-time operators only emit what the watermark has closed.  Jobs that must flush everything at
the end of a finite input get a *sentinel* row far in the future as their last micro-batch, which
pushes the watermark past every real row; the sentinel's own output is dropped afterwards.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StringType, StructType

from ..operators import joins, logs, order, routing, stats
from ..schemas import CHANGE, SINK_HBASE
from ..session import new_location
from ..sinks import files, report_tables, writers
from ..sinks.dimensions import Dimension, pinned
from .processors import ensure_state_store

SENTINEL = "__end_of_input__"
SENTINEL_SHIFT_MS = 400 * 86_400_000


#: Fewest micro-batches of a staged input, and rows of a file.  A batch is a file for every core at most: a larger
#: input runs in more batches, not in larger files.
MIN_BATCHES, ROWS_PER_FILE = 4, 250_000

#: Batches that a checkpoint can go back to (a restart needs the last one).
BATCHES_KEPT = 4


@dataclass(frozen=True)
class Staged:
    """Files that a stream reads in event-time order, so many for each micro-batch."""
    path: str
    schema: StructType
    files_per_batch: int = 1


@contextmanager
def _conf(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session while something is run or started (a query keeps those that it was started with)."""
    names = {k: "spark.sql." + k.replace("__", ".") for k in values}
    before = {k: spark.conf.get(n, None) for k, n in names.items()}
    try:
        for k, n in names.items():
            spark.conf.set(n, values[k])
        yield
    finally:
        for k, n in names.items():
            spark.conf.unset(n) if before[k] is None else spark.conf.set(n, before[k])


def _shuffles_freed(spark: SparkSession):
    """What is run here leaves no shuffle files: without this they stay until the driver happens to collect its garbage."""
    return _conf(spark, classic__shuffleDependency__fileCleanup__enabled="true")


@contextmanager
def landed(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once and read back: staging goes over its input three times, its end row a fourth.  The landed copy
    is deleted at the end; what has been staged from it stays."""
    spark = df.sparkSession
    path = new_location(spark, f"landed/{name}")
    try:
        with _shuffles_freed(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files.delete(spark, path)


def _layout(spark: SparkSession, rows: int) -> tuple[int, int]:
    """(micro-batches, files of one) of an input of so many rows."""
    found = max(MIN_BATCHES, -(-rows // ROWS_PER_FILE))
    width = min(spark.sparkContext.defaultParallelism, -(-found // MIN_BATCHES))
    return -(-found // width), width


def _write(df: DataFrame, path: str) -> None:
    with _shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)


def stage(df: DataFrame, name: str, order: str, sentinel: DataFrame | None = None,
          shape: Callable[[DataFrame], DataFrame] | None = None) -> Staged:
    """Write ``df`` as the file input of a stream, in ``order``: file after file, the sentinel in a last one of its own.
    A micro-batch is one file of about ``ROWS_PER_FILE`` rows for every core; the number of batches follows the rows.
    A ``shape`` (of a topic: JSON text) is given to the rows when they are in order: its text is not shuffled."""
    spark = df.sparkSession
    path = new_location(spark, f"stream-in/{name}")
    batches, width = _layout(spark, df.count())
    rows = df.repartitionByRange(batches * width, order).sortWithinPartitions(order)
    rows = rows if shape is None else shape(rows)
    _write(rows, path)
    found = _data_files(spark, path)
    if sentinel is not None:
        last = sentinel.select(*df.columns).coalesce(1)
        (last if shape is None else shape(last)).write.mode("append").parquet(path)
        found += [f for f in _data_files(spark, path) if f not in found]
    _in_turn(spark, path, found)
    return Staged(path, rows.schema, width)


def stage_together(inputs: list[tuple[DataFrame, str, Column]], shape: Callable[[DataFrame], DataFrame] | None = None) -> list[Staged]:
    """Write several inputs ``(rows, name, event time in epoch millis)`` as the file inputs of one streaming join, by one
    clock: batch i of each holds about the same span of time, so the join keeps only what lies near the end of a span.
    ``shape`` as in ``stage``.

    Inputs cut each by their own rows run apart (the shorter one is at its end when the longer one has just begun), and
    the join must hold all that one is ahead."""
    spark = inputs[0][0].sparkSession
    counts = [df.count() for df, _, _ in inputs]
    batches = max(_layout(spark, n)[0] for n in counts)
    clock = stats.union_all([df.select(at.cast("long").alias("_at")) for df, _, at in inputs])
    cuts = clock.agg(F.percentile_approx("_at", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    staged = []
    for (df, name, at), n in zip(inputs, counts):
        path = new_location(spark, f"stream-in/{name}")
        width = min(spark.sparkContext.defaultParallelism, max(1, -(-n // (ROWS_PER_FILE * batches))))
        batch = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: c < F.col("_at")))
        place = (batch * width + F.pmod(F.xxhash64(*df.columns), F.lit(width))).cast("int")
        placed = df.withColumn("_at", at.cast("long")).withColumn("_place", place)
        placed = placed.repartitionById(batches * width, F.col("_place")).sortWithinPartitions("_at")
        rows = placed.drop("_at", "_place")
        rows = rows if shape is None else shape(rows)
        _write(rows, path)
        _in_turn(spark, path, _data_files(spark, path))
        staged.append(Staged(path, rows.schema, width))
    return staged


def _in_turn(spark: SparkSession, path: str, found: list[str]) -> None:
    """The file source takes files by modification time: make that their order."""
    fs, path_of = files.file_system(spark, path)
    first = int(time.time()) - len(found)
    for i, f in enumerate(found):
        fs.setTimes(path_of(f), (first + i) * 1000, -1)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    """The folder's data files by name (their names carry the partition number)."""
    fs, path_of = files.file_system(spark, path)
    found = [s.getPath().toString() for s in fs.listStatus(path_of(path))]
    return sorted(f for f in found if f.endswith(".parquet"))


def read_staged(spark: SparkSession, staged: Staged) -> DataFrame:
    return (spark.readStream.schema(staged.schema).option("maxFilesPerTrigger", staged.files_per_batch)
            .parquet(staged.path))


def _stream_conf(spark: SparkSession):
    """Settings that a query starts with.  A micro-batch is a file for every core, so it is dealt over as many state
    partitions: more of them only add stores to be loaded, committed and written in every batch (a checkpoint keeps the
    number that it began with).  The checkpoint keeps the state of the last ``BATCHES_KEPT`` batches, not of a hundred."""
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    kept = min(int(spark.conf.get("spark.sql.streaming.minBatchesToRetain")), BATCHES_KEPT)
    return _conf(spark, shuffle__partitions=str(parts), streaming__minBatchesToRetain=str(kept),
                 classic__shuffleDependency__fileCleanup__enabled="true")


def run_available_now(df: DataFrame, name: str, output_mode: str = "append",
                      foreach: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_state_store(df)
    out = new_location(spark, f"stream-out/{name}")
    ck = new_location(spark, f"checkpoints/{name}")
    w = df.writeStream.option("checkpointLocation", ck).trigger(availableNow=True).outputMode(output_mode)
    with _stream_conf(spark):
        if foreach is not None:
            q = w.foreachBatch(lambda b, i: foreach(b, i, out)).start()
        else:
            q = w.format("parquet").start(out)
    q.awaitTermination()
    if foreach is not None:
        return spark.read.parquet(out) if _has_files(spark, out) else spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(out)


def _has_files(spark: SparkSession, path: str) -> bool:
    fs, path_of = files.file_system(spark, path)
    return fs.exists(path_of(path))


def sentinel(df: DataFrame, ts_col: str, key_col: str, key=SENTINEL) -> DataFrame:
    """One row copied from the latest row, keyed ``key``, far after every real row."""
    last = df.orderBy(F.desc(ts_col)).limit(1)
    return last.withColumn(key_col, F.lit(key).cast(df.schema[key_col].dataType)).withColumn(
        ts_col, F.col(ts_col) + F.lit(SENTINEL_SHIFT_MS))


# ---- the layer jobs ---------------------------------------------------------------------------

def detail_log_stream(raw: DataFrame) -> DataFrame:
    """Raw log text stream -> repaired flat log (new-visitor repair is stateful)."""
    from .processors import flatten_log, repair_new_flag_stream
    return repair_new_flag_stream(flatten_log(logs.parse_log(raw)))


def visitor_stats_stream(measures: DataFrame, size: str, as_of_ms: int, watermark: str = "3 seconds") -> DataFrame:
    return stats.visitor_stats(measures, size, as_of_ms=as_of_ms, watermark=watermark)


def order_lines_stream(order_info: DataFrame, order_detail: DataFrame, within: str,
                       watermark: str = "3 seconds") -> DataFrame:
    return joins.order_detail_join(order_info, order_detail, within, watermark)


def routed_facts_stream(raw_changes: DataFrame, config: DataFrame) -> DataFrame:
    """Change-record text stream -> routed fact records (config joined per micro-batch)."""
    return routing.facts(routing.route(routing.clean_changes(routing.parse_changes(raw_changes)), config))


# ---- jobs: source -> operator -> sink, each with a fixed name, checkpoint and output folder ------

def start(df: DataFrame, name: str, root: str, *, trigger: dict | None = None,
          write: Callable[[DataFrame, int, str], None] | None = None):
    """Start the job ``name``: checkpoint ``root/checkpoints/name``, output ``root/name``.  Both are
    fixed, so a restarted job goes on where it stopped; ``write`` (batch, batch id, output
    folder) must rewrite a batch's own folder, so a replayed batch changes nothing."""
    ensure_state_store(df)
    out = f"{root}/{name}"
    w = df.writeStream.queryName(name).option("checkpointLocation", f"{root}/checkpoints/{name}")
    w = w.trigger(**(trigger or {"availableNow": True}))
    with _stream_conf(df.sparkSession):
        if write is None:
            return w.outputMode("append").format("parquet").start(out)
        return w.foreachBatch(lambda b, i: write(b, i, out)).start()


class LateRows(StreamingQueryListener):
    """Writes, for every micro-batch of the job ``name`` that lost rows to the watermark, how many: one small file per
    batch beside the job's output, so the count covers the whole run, restarts included.  Rows are counted where the
    stateful operator takes them in (after the partial aggregate, where there is one)."""

    def __init__(self, spark: SparkSession, name: str, root: str):
        self.spark, self.name, self.folder = spark, name, f"{root}/{name}/_late"
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        if p["name"] == self.name:
            late = sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
            if late:
                files.write_json(self.spark, f"{self.folder}/batch={p['batchId']}.json", late)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def run_counted(df: DataFrame, name: str, root: str, **how) -> int:
    """Run the job ``name`` to its end with a ``LateRows`` listener; the late rows of all its batches so far."""
    spark = df.sparkSession
    listener = LateRows(spark, name, root)
    spark.streams.addListener(listener)
    try:
        query = start(df, name, root, **how)
        query.awaitTermination()
        listener.ended.wait(60)       # progress comes before the end on the same bus
    finally:
        spark.streams.removeListener(listener)
    return late_rows(spark, name, root)


def late_rows(spark: SparkSession, name: str, root: str) -> int:
    """Rows that the watermark has dropped as late in all batches of the job ``name``."""
    folder = f"{root}/{name}/_late"
    return sum(files.read_json(spark, f"{folder}/batch={i}.json") for i in files.numbered(spark, folder, "batch="))


def _rewrite(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").parquet(folder)


def start_landing(lines: DataFrame, root: str, *, trigger: dict | None = None):
    """Landed text (``source(kind="text", streaming=True)``) -> ``root/landed`` rows (value, seq): every line with its
    number in its file, one folder per batch.  Jobs that need arrival order read this folder as their stream."""
    return start(lines, "landed", root, trigger=trigger,
                 write=lambda b, i, out: _rewrite(order.numbered_lines(b), f"{out}/batch={i}"))


def write_log_outputs(batch: DataFrame, batch_id: int, root: str) -> None:
    """One micro-batch of the repaired flat log -> start / page / display outputs with all their fields."""
    seq = F.col("seq") if batch.schema["seq"].dataType != StringType() else order.from_text(F.col("seq"))
    b = batch.select(seq.alias("seq"), "is_new", F.col("payload").alias("value")).persist()
    try:
        log = logs.parse_log(b).withColumn("common", F.col("common").withField("is_new", F.col("is_new")))
        part = f"batch={batch_id}"
        _rewrite(logs.split_start(log).select("seq", "is_new", "common", "start", "err", "ts"), f"{root}/start/{part}")
        _rewrite(logs.split_page(log).select("seq", "is_new", "common", "page", "displays", "err", "ts"), f"{root}/page/{part}")
        _rewrite(logs.explode_displays(log), f"{root}/display/{part}")
    finally:
        b.unpersist()


def start_detail_layer(raw: DataFrame, root: str, *, trigger: dict | None = None):
    """Raw log text stream -> parse -> new-visitor repair (stateful) -> ``root/detail_log/{start,page,display}``."""
    from .processors import flatten_log, repair_new_flag_stream
    typed = logs.parse_log(raw.withColumn("payload", F.col("value")))
    return start(repair_new_flag_stream(flatten_log(typed)), "detail_log", root, trigger=trigger, write=write_log_outputs)


def start_dead_letters(raw: DataFrame, root: str, *, trigger: dict | None = None):
    """Lines of the log stream that are no JSON object -> ``root/dead_log``."""
    return start(logs.dirty_log(raw), "dead_log", root, trigger=trigger)


def write_changes(read_config: Callable[[SparkSession], DataFrame]) -> Callable[[DataFrame, int, str], None]:
    """One micro-batch of change records -> routed facts, dimension versions, dead letters, published together.

    The config is read anew for every batch, so a change of routing takes effect with the next one.  A dimension
    table is created, by its configured key, columns and extension, when its config first names it; the batch's
    changes make its version ``batch id + 1``.  Dimension changes without their key are dead letters.  Every output
    belongs to the batch and is rewritten on a replay; a last manifest names all of them, and ``read_changes``
    shows a batch only once it is there."""
    def write(batch: DataFrame, batch_id: int, out: str) -> None:
        spark = batch.sparkSession
        b = batch
        parsed = logs.parse_once(b, "value", CHANGE).persist()       # one parse serves every output of the batch
        good = parsed.where(F.col(logs.CORRUPT).isNull()).drop(logs.CORRUPT)
        try:
            config = routing.current_config(read_config(spark))
            routed = routing.route(routing.clean_changes(good), config)
            part = f"batch={batch_id}"
            writers.write_routed_files(routing.facts(routed), f"{out}/facts", batch_id)
            _rewrite(parsed.where(F.col(logs.CORRUPT).isNotNull()).select(*[c for c in b.columns if c != "value"], F.col(logs.CORRUPT).alias("value")),
                     f"{out}/dead/{part}")
            extend = F.max("sink_extend") if "sink_extend" in config.columns else F.lit(None).cast("string")
            tables = config.where(F.col("sink_type") == SINK_HBASE).groupBy("sink_table").agg(
                F.max("sink_columns").alias("sink_columns"), F.max("sink_pk").alias("sink_pk"), extend.alias("sink_extend")).collect()   # one row per dimension
            dims, versions, keyless = routing.dims(routed), {}, []
            for t in tables:
                store = Dimension(spark, f"{out}/dims/{t.sink_table}")
                store.create(t.sink_columns, t.sink_pk, t.sink_extend)
                mine = dims.where(F.col("sink_table") == t.sink_table)
                store.merge(mine, batch_id + 1)
                versions[t.sink_table] = batch_id + 1
                keyless.append(mine.where(routing.key_text(store.definition["key"]).isNull()))
            lost = [d.select(*[c for c in b.columns if c != "value"], "sink_table", F.to_json("data").alias("value")) for d in keyless]
            if lost:
                _rewrite(stats.union_all(lost), f"{out}/keyless/{part}")
            files.publish(spark, out, batch_id, {"facts": f"facts/_{part}", "dead": f"dead/{part}", "dims": versions,
                                                 "keyless": f"keyless/{part}" if lost else None})
        finally:
            parsed.unpersist()
    return write


def read_changes(spark: SparkSession, out: str, output: str) -> DataFrame:
    """``facts`` (sink_table, value), ``dead`` or ``keyless`` of the published batches of a change layer."""
    folders = [f"{out}/{b[output]}" for b in files.published(spark, out).values() if b[output]]
    if output == "facts":
        return stats.union_all([spark.read.schema("value string, sink_table string").json(f) for f in folders])
    return spark.read.parquet(*folders)


def read_dimension(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A dimension of a change layer as of its newest published batch."""
    newest = max(b["dims"].get(table, 0) for b in files.published(spark, out).values())
    return Dimension(spark, f"{out}/dims/{table}").table(newest)


def start_change_layer(raw: DataFrame, root: str, read_config: Callable[[SparkSession], DataFrame], *,
                       trigger: dict | None = None):
    """Change-record text stream (seq, value) -> ``root/changes/{facts,dims,dead}``."""
    return start(raw, "changes", root, trigger=trigger, write=write_changes(read_config))


def write_order_wide(read_dims: Callable[..., dict], dims: Callable[[SparkSession], dict[str, Dimension]] | None,
                     as_of_ms: int | None) -> Callable[[DataFrame, int, str], None]:
    """One micro-batch of order lines -> its folder, enriched.  With ``dims`` the batch's dimension versions are pinned
    before they are read, and ``read_dims(spark, versions)`` reads those, on a replay too."""
    def write(batch: DataFrame, batch_id: int, out: str) -> None:
        spark = batch.sparkSession
        now = as_of_ms if as_of_ms is not None else int(time.time() * 1000)
        found = read_dims(spark) if dims is None else read_dims(spark, pinned(spark, out, batch_id, dims(spark)))
        _rewrite(joins.enrich_order_wide(batch, found, now), f"{out}/batch={batch_id}")
    return write


def start_order_wide(orders: DataFrame, details: DataFrame, root: str, read_dims: Callable[..., dict], *,
                     dims: Callable[[SparkSession], dict[str, Dimension]] | None = None,
                     within: str = "5 milliseconds", as_of_ms: int | None = None, trigger: dict | None = None):
    """Order and detail fact streams -> ``root/order_wide``; every batch reads the dimensions anew, by pinned versions
    where they are kept as ``Dimension`` tables."""
    return start(order_lines_stream(orders, details, within), "order_wide", root, trigger=trigger,
                 write=write_order_wide(read_dims, dims, as_of_ms))


def start_payment_wide(payments: DataFrame, wide: DataFrame, root: str, *, within: str = "1800 seconds", trigger: dict | None = None):
    return start(joins.payment_wide(payments, wide, within=within), "payment_wide", root, trigger=trigger)


def start_unique_visits(flat_pages: DataFrame, root: str, *, trigger: dict | None = None):
    from .processors import unique_visits_stream
    return start(unique_visits_stream(flat_pages), "unique_visit", root, trigger=trigger)


def start_bounces(flat_pages: DataFrame, root: str, *, within: str = "10 seconds", mode: str = "as_written", trigger: dict | None = None):
    from .processors import bounces_stream
    return start(bounces_stream(flat_pages, within, mode), f"bounce_{mode}", root, trigger=trigger)


def start_report(df: DataFrame, name: str, columns: list[str], root: str, *, merge_every: int | None = None,
                 trigger: dict | None = None):
    """A window aggregate (visitor, product, province, keyword) -> its day-partitioned report table
    (``report_tables.read``).  With ``merge_every`` the folders of that many batches are merged into their days."""
    def write(batch: DataFrame, batch_id: int, out: str) -> None:
        report_tables.add_batch(batch, out, columns, batch_id)
        if merge_every and (batch_id + 1) % merge_every == 0:
            report_tables.compact(batch.sparkSession, out)
    return start(df, name, root, trigger=trigger, write=write)
