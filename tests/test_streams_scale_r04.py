"""What a stream costs: calls for a group of visitors, state rows and partitions, files that are left behind."""

import os
import random
import re

import pandas as pd
from pyspark.sql import functions as F

from marketlake.operators import stats
from marketlake.plans.catalog import QUERIES
from marketlake.session import new_location, shared_root
from marketlake.sinks.writers import as_json_value
from marketlake.streaming import jobs, processors
from test_streaming import FakeState
from helpers import DAY


class Value:
    def __init__(self):
        self.v = None

    exists = lambda self: self.v is not None
    get = lambda self: self.v
    update = lambda self, v: setattr(self, "v", v)
    clear = lambda self: setattr(self, "v", None)


class Rows:
    def __init__(self):
        self.rows = []

    appendValue = lambda self, v: self.rows.append(v)
    get = lambda self: iter(self.rows)
    clear = lambda self: self.rows.clear()


class At:
    def __init__(self, wm):
        self.wm = wm

    getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: self.wm


def _processor(cls):
    value, state, p = Value(), FakeState(), cls()
    state.getValueState, state.getListState = (lambda *_: value), (lambda *_: Rows())
    p.init(state)
    return value, state, p


def _frame(rows):
    return pd.DataFrame([{**{c: None for c in processors.FLAT_COLUMNS}, "seq": s, "mid": m, "ts": t, "dt": str(t // DAY), "is_new": n}
                         for s, m, t, n in rows])


def _log(seed):
    rnd, t = random.Random(seed), 0
    for i in range(400):
        t += rnd.choice([0, 1_000, DAY // 4])
        yield i, rnd.choice(["a", "b", "c", "d", None]), t, rnd.choice(["0", "1", None])


def _batches(rows, size=60):
    """Batches of frames of a few rows each, out of order inside a batch."""
    for lo in range(0, len(rows), size):
        batch = rows[lo: lo + size]
        random.Random(lo).shuffle(batch)
        yield [_frame(batch[i: i + 13]) for i in range(0, len(batch), 13)]


def _loop(rows, rule):
    """A plain loop over the rows of each visitor."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    return sorted(x for mine in by.values() for x in rule(mine))


def test_daily_visits_of_a_group_equal_a_loop():
    def rule(mine):
        return [r[0] for before, r in zip([None] + mine, mine) if before is None or before[2] // DAY != r[2] // DAY]

    for seed in range(10):
        rows, got, wm = list(_log(seed)), [], 0
        value, state, p = _processor(processors.DailyVisitGroup)
        for frames in _batches(rows):
            got += [s for f in p.handleInputRows(0, iter(frames), At(wm)) for s in f.seq]
            assert len(state.timers) == 1
            wm = max(int(f.ts.max()) for f in frames)
            if min(state.timers) <= wm:
                list(p.handleExpiredTimer(0, At(wm), At(min(state.timers))))
                assert all(expires > wm for _, expires in p._known().values())
        assert sorted(got) == _loop(rows, rule)
        list(p.handleExpiredTimer(0, At(wm + 2 * DAY), At(wm)))
        assert not value.exists() and not state.timers


def test_new_visitors_of_a_group_equal_a_loop():
    def rule(mine):
        first = next((r[2] // DAY for r in mine if r[3] == "1"), None)
        return [(r[0], "0" if r[3] == "1" and r[2] // DAY != first else str(r[3])) for r in mine]

    for seed in range(10):
        rows = list(_log(seed))
        _, _, p = _processor(processors.NewVisitorRepair)
        got = [(s, str(n)) for frames in _batches(rows) for f in p.handleInputRows(0, iter(frames), None) for s, n in zip(f.seq, f.is_new)]
        assert sorted(got) == _loop(rows, rule)


def test_a_stream_has_a_state_partition_for_every_core_and_keeps_a_few_versions(spark):
    usual, cores = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism
    src, root = new_location(spark, "in"), new_location(spark, "out")
    schema = "vc string, ch string, ar string, is_new string, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long, ts long"
    for t in range(2):
        spark.createDataFrame([("v", "c", "a", "1", 0, 1, 0, 0, 0, t)], schema).coalesce(1).write.mode("append").parquet(src)
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        s = jobs.visitor_stats_stream(spark.readStream.schema(schema).parquet(src), "10 seconds", 0)
        query = jobs.start(s, "visitors", root)
        query.awaitTermination()
        assert spark.conf.get("spark.sql.shuffle.partitions") == "17"
        assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "100"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    state = f"{root}/checkpoints/visitors/state/0".replace("file:", "")
    assert len([x for x in os.listdir(state) if x.isdigit()]) == min(17, cores)
    offsets = f"{root}/checkpoints/visitors/offsets/0".replace("file:", "")
    assert '"spark.sql.shuffle.partitions":"%d"' % min(17, cores) in open(offsets).read()
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"


def test_staging_leaves_neither_a_landed_copy_nor_shuffle_files(spark):
    df = spark.range(1_000).select("id", (F.col("id") % 7).alias("k")).repartition(3, "k")
    with jobs.landed(df, "ids") as back:
        path = back.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
        staged = jobs.stage(back, "ids", "id", jobs.sentinel(back, "id", "k", -1), shape=as_json_value)
    assert not os.path.exists(path)
    text = [r.value for r in spark.read.parquet(staged.path).collect()]
    assert staged.schema.names == ["value"] and len(text) == 1_001 and sum('"k":-1' in x for x in text) == 1


def test_an_order_is_one_state_row_whatever_kinds_it_has(spark):
    m = stats.product_union([(k, spark.createDataFrame([(1, 7, 0)], "sku_id long, oid long, ts long")) for k in ("order", "paid", "refund")]
                            + [(None, spark.createDataFrame([(1, 0)], "sku_id long, ts long"))])
    g = stats.product_window_sums(m, "10 seconds")
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", g._jdf.queryExecution().executedPlan().toString())
    assert any("oid" in k for k in keys) and not any("kind" in k for k in keys)
    assert [(r.order_ct, r.paid_order_ct, r.refund_order_ct) for r in g.collect()] == [(1, 1, 1)]


def test_streams_leave_no_landed_copy(spark):
    assert QUERIES["keyword_product_stream"](spark, "/root/testdata/sf0.001").count() > 0
    folder = f"{shared_root(spark)}/landed/product_stats".replace("file:", "")
    assert os.path.isdir(folder) and not os.listdir(folder)
