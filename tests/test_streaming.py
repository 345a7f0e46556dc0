import os

import pandas as pd
from pyspark.sql import functions as F

from marketlake.operators import visitors
from marketlake.schemas import TABLE_PROCESS
from marketlake.session import new_location
from marketlake.sinks import files
from marketlake.sinks.dimensions import Dimension
from marketlake.streaming import jobs
from marketlake.streaming.processors import FLAT_COLUMNS, bounce_step, flatten_log, unique_visits_stream
from helpers import DAY, log_df, log_row


def _rows(spec):
    return pd.DataFrame([{**{c: None for c in FLAT_COLUMNS}, "seq": s, "mid": "m", "ts": t, "last_page_id": lp}
                         for s, t, lp in spec])


def test_bounce_step_waits_for_the_watermark():
    buf = _rows([(1, 0, None), (2, 9_999, "home")])
    emitted, keep, timer = bounce_step(buf, wm=5_000, within_ms=10_000, documented=False)
    assert emitted.empty and len(keep) == 2 and timer == 10_000  # the follower is not final yet
    emitted, keep, _ = bounce_step(buf, wm=10_000, within_ms=10_000, documented=False)
    assert emitted.empty and keep.empty  # follower within 10 s: no bounce, state released
    alone = _rows([(1, 0, None)])
    emitted, keep, timer = bounce_step(alone, wm=9_999, within_ms=10_000, documented=False)
    assert emitted.empty and timer == 10_000
    emitted, keep, _ = bounce_step(alone, wm=10_000, within_ms=10_000, documented=False)
    assert list(emitted.seq) == [1] and keep.empty


def test_unique_visit_stream_restart_equals_batch(spark):
    b = 19675 * DAY  # in-order data, none of it late for the watermark of the restarted run
    rows = [log_row(1, "m1", b), log_row(2, "m1", b + 10, last="home"), log_row(3, "m1", b + 20),
            log_row(4, "m2", b + 30), log_row(5, "m1", b + DAY), log_row(6, "m1", b + DAY + 7),
            log_row(7, "m2", b + DAY + 8), log_row(8, "m2", b + DAY + 9)]
    flat = flatten_log(log_df(spark, rows))
    src = new_location(spark, "test-in")
    out = new_location(spark, "test-out")
    ck = new_location(spark, "test-ck")

    def run():
        s = unique_visits_stream(spark.readStream.schema(flat.schema).parquet(src))
        q = (s.writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
             .format("parquet").start(out))
        q.awaitTermination()

    flat.filter("seq <= 4").coalesce(1).write.mode("append").parquet(src)
    run()
    flat.filter("seq > 4").coalesce(1).write.mode("append").parquet(src)
    run()  # restarted from the checkpoint: state (last day per visitor) carries over
    got = sorted(r.seq for r in spark.read.parquet(out).collect())
    batch = sorted(r.seq for r in visitors.unique_visits(log_df(spark, rows)).collect())
    assert got == batch == [1, 4, 5, 7]


def test_sentinel_is_latest(spark):
    df = spark.createDataFrame([("a", 1), ("b", 5)], "k string, ts long")
    s = jobs.sentinel(df, "ts", "k").first()
    assert s.k == jobs.SENTINEL and s.ts == 5 + jobs.SENTINEL_SHIFT_MS


def test_detail_layer_side_outputs(spark):
    from marketlake.operators import logs as L
    from marketlake.plans.warehouse import Warehouse
    from marketlake.sources import tables as T
    sf = "/root/testdata/sf0.001"
    raw = T.raw_log(spark, sf)
    staged = jobs.stage(raw, "raw_test", order="seq")
    root = new_location(spark, "detail-test")
    jobs.start_detail_layer(jobs.read_staged(spark, staged), root).awaitTermination()
    w = Warehouse(spark, sf)
    start = spark.read.parquet(root + "/detail_log/start")
    page = spark.read.parquet(root + "/detail_log/page")
    disp = spark.read.parquet(root + "/detail_log/display")
    assert {r.e for r in start.select(F.col("start")["entry"].alias("e")).distinct().collect()} == {"icon"}
    assert start.count() == L.split_start(w.repaired_log).count()
    exp_page = {(r.seq, r.is_new) for r in w.repaired_log.filter(~L.is_start()).select(
        "seq", F.col("common.is_new").alias("is_new")).collect()}
    assert {(r.seq, r.is_new) for r in page.select("seq", "is_new").collect()} == exp_page
    exp_disp = sorted((r.seq, r.item, r.page_id) for r in L.explode_displays(w.parsed_log).collect())
    assert sorted((r.seq, r.item, r.page_id) for r in disp.collect()) == exp_disp


def _text(spark, rows, schema="seq long, value string"):
    return spark.createDataFrame(rows, schema)


def test_change_layer_follows_its_config_and_survives_a_replay(spark):
    import json
    root, src = new_location(spark, "changes"), new_location(spark, "changes-in")
    config = {"rows": [("user_info", "insert", "hbase", "dim_user", "id,name", "id")]}
    names = ["source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk"]
    read_config = lambda s: s.createDataFrame(config["rows"], names)

    def change(seq, table, type_, data):
        return (seq, json.dumps({"table": table, "type": type_, "data": data}))

    def run():
        raw = spark.readStream.schema("seq long, value string").parquet(src)
        jobs.start_change_layer(raw, root, read_config).awaitTermination()

    _text(spark, [change(1, "user_info", "insert", {"id": "1", "name": "a", "x": "no"}), change(2, "orders", "insert", {"id": "7"}),
                  (3, "not json")]).coalesce(1).write.mode("append").parquet(src)
    run()
    config["rows"] = config["rows"] + [("user_info", "update", "hbase", "dim_user", "id,name", "id"),
                                       ("orders", "insert", "kafka", "dwd_orders", None, "id")]
    _text(spark, [change(4, "user_info", "update", {"id": "1", "name": "b"}), change(5, "orders", "insert", {"id": "8"})]
          ).coalesce(1).write.mode("append").parquet(src)
    run()
    snap = lambda: [(r.id, r.data) for r in Dimension(spark, root + "/changes/dims/dim_user").read().collect()]
    assert snap() == [("1", {"id": "1", "name": "b"})]
    facts = spark.read.json(root + "/changes/facts/_batch=1")
    assert [r.value for r in facts.collect()] == ['{"id":"8"}']          # the order of batch 0 had no route yet
    assert [r.value for r in spark.read.parquet(root + "/changes/dead/batch=0").collect()] == ["not json"]
    batch = _text(spark, [change(4, "user_info", "update", {"id": "1", "name": "b"}), change(5, "orders", "insert", {"id": "8"})])
    jobs.write_changes(read_config)(batch, 1, root + "/changes")        # replayed
    assert snap() == [("1", {"id": "1", "name": "b"})]
    assert spark.read.json(root + "/changes/facts/_batch=1").count() == 1


def test_report_job_restarts_midway(spark):
    """Product windows, stopped after two of four files and restarted from the checkpoint."""
    from marketlake.operators import stats
    from marketlake.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    m = w.product_measures.persist()
    staged = jobs.stage(m, "restart", "ts", jobs.sentinel(m, "ts", "sku_id", -1))
    staged_files = jobs._data_files(spark, staged.path)
    order = sorted(staged_files, key=lambda f: os.path.getmtime(f.replace("file:", "")))
    root, src = new_location(spark, "restart-out"), new_location(spark, "restart-in")
    fs, path_of = files.file_system(spark, src)
    fs.mkdirs(path_of(src))

    def run():
        stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(src)
        g = stats.product_window_sums(stream, w.params.window)
        g = g.select(*stats.window_bounds(instant=True), "sku_id", "order_ct", "click_ct")
        jobs.start_report(g, "product_stats", ["stt", "edt", "sku_id", "order_ct", "click_ct"], root).awaitTermination()

    for part in (order[:2], order[2:]):
        for f in part:
            name = f.rsplit("/", 1)[1]
            os.link(f.replace("file:", ""), os.path.join(src, name))
        run()
    got = spark.read.parquet(root + "/product_stats").where("sku_id <> -1")
    batch = stats.product_window_sums(m, w.params.window)
    batch = batch.select(*stats.window_bounds(), "sku_id", "order_ct", "click_ct")
    key = lambda df: sorted((r.stt, r.sku_id, r.order_ct, r.click_ct) for r in df.collect())
    assert key(got) == key(batch)
    m.unpersist()


def test_order_wide_job_reads_dimensions_per_batch(spark):
    from marketlake.plans.warehouse import Warehouse
    from marketlake.sources import tables as T
    sf = "/root/testdata/sf0.001"
    w = Warehouse(spark, sf)
    orders = jobs.read_staged(spark, jobs.stage(T.order_info(spark, sf), "ow-o", "create_ts"))
    details = jobs.read_staged(spark, jobs.stage(T.order_detail(spark, sf, time="order"), "ow-d", "create_ts"))
    root = new_location(spark, "ow")
    jobs.start_order_wide(orders, details, root, lambda s: Warehouse(s, sf).dims, as_of_ms=w.params.as_of_ms).awaitTermination()
    out = spark.read.parquet(root + "/order_wide")
    assert out.count() == w.order_wide.count() and out.select("batch").distinct().count() >= 3


def test_late_rows_are_dropped_and_counted(spark):
    src, root = new_location(spark, "late-in"), new_location(spark, "late-out")
    schema = "vc string, ch string, ar string, is_new string, uv_ct long, pv_ct long, sv_ct long, uj_ct long, dur_sum long, ts long"
    row = lambda ts: ("v", "c", "a", "1", 0, 1, 0, 0, 0, ts)

    def run(*times):
        spark.createDataFrame([row(t) for t in times], schema).coalesce(1).write.mode("append").parquet(src)
        s = jobs.visitor_stats_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), "10 seconds", 0)
        return jobs.run_counted(s, "late", root)

    assert run(1_000, 100_000) == 0
    assert run(2_000, 101_000) == 1      # its window closed when the first batch moved the watermark
    for i in range(102):                 # more micro-batches than a query remembers the progress of
        spark.createDataFrame([row(3_000), row(110_000 + i)], schema).coalesce(1).write.mode("append").parquet(src)
    assert run(4_000, 15_000, 200_000) == 1 + 102 + 2
    assert jobs.late_rows(spark, "late", root) == 105


CHANGE_ROWS = "seq long, type string, data map<string,string>"


def test_dimension_is_keyed_and_bucketed_by_its_config(spark):
    root = new_location(spark, "dim")
    dim = Dimension(spark, root)
    assert dim.create("name,code,region", "code", "SALT_BUCKETS = 4 , TTL = 9") is True and dim.create("x", "y") is False
    assert dim.definition == {"key": ["code"], "columns": ["code", "name", "region"], "extend": "SALT_BUCKETS = 4 , TTL = 9", "buckets": 4}
    rows = [(i, "insert", {"code": f"c{i}", "name": f"n{i}"}) for i in range(40)] + [(50, "insert", {"name": "no key"})]
    assert dim.merge(spark.createDataFrame(rows, CHANGE_ROWS), 1) == 4
    assert dim.table().count() == 40 and dim.table().columns == ["code", "name", "region"]
    touched = dim.merge(spark.createDataFrame([(60, "update", {"code": "c7", "region": "r"}), (61, "delete", {"code": "c8"})], CHANGE_ROWS), 2)
    assert touched == 1                                     # one bucket rewritten, the others shared
    one, two = dim._manifest(1), dim._manifest(2)
    assert sum(one[b] != two[b] for b in one) == 1 and set(one) == set(two)
    got = {r.code: (r.name, r.region) for r in dim.table().collect()}
    assert got == {f"c{i}": (f"n{i}", "r" if i == 7 else None) for i in range(40)}
    assert {r.code: r.region for r in dim.table(1).collect()}["c7"] is None         # the older version is still there


def test_composite_keys_keep_their_rows_apart(spark):
    dim = Dimension(spark, new_location(spark, "dim"))
    dim.create("a,b,v", "a,b")
    rows = [(1, "insert", {"a": "x", "b": "y|z", "v": "1"}), (2, "insert", {"a": "x|y", "b": "z", "v": "2"}),
            (3, "update", {"a": "x", "b": "y|z", "v": "3"}), (4, "insert", {"a": "x", "v": "4"})]
    dim.merge(spark.createDataFrame(rows, CHANGE_ROWS), 1)
    assert sorted(tuple(r) for r in dim.table().collect()) == [("x", "y|z", "3"), ("x|y", "z", "2")]


def test_dimension_versions_survive_a_broken_merge_and_are_retired(spark):
    dim = Dimension(spark, new_location(spark, "dim"))
    dim.create("id,n", None, "SALT_BUCKETS=2")
    change = lambda v: spark.createDataFrame([(v, "update", {"id": str(v % 3), "n": str(v)})], CHANGE_ROWS)
    for v in range(1, 4):
        dim.merge(change(v), v)
    files.delete(spark, f"{dim.root}/_versions/v=3.json")   # as if the merge of version 3 had broken off before its manifest
    assert {r.id: r.n for r in dim.table().collect()} == {"1": "1", "2": "2"}
    dim.merge(change(3), 3)                                 # the replay
    dim.merge(change(3), 3)
    assert {r.id: r.n for r in dim.table().collect()} == {"0": "3", "1": "1", "2": "2"}
    for v in range(4, 16):
        dim.merge(change(v), v)
    assert dim.versions() == list(range(8, 16))
    named = {f for v in dim.versions() for f in dim._manifest(v).values()}
    there = {f"data/{v}/{b}" for v in files.names(spark, f"{dim.root}/data") for b in files.names(spark, f"{dim.root}/data/{v}") if b.startswith("bucket=")}
    assert there == named
    assert {r.id: r.n for r in dim.table().collect()} == {"0": "15", "1": "13", "2": "14"}


def test_a_replayed_batch_reads_the_dimension_versions_it_read_first(spark):
    """The dimension changes between a batch and its replay; a later batch sees the change."""
    out, dim = new_location(spark, "pin"), Dimension(spark, new_location(spark, "dim"))
    dim.create("id,name")
    dim.merge(spark.createDataFrame([(1, "insert", {"id": "1", "name": "old"})], CHANGE_ROWS), 1)
    batch = spark.createDataFrame([(1,)], "id long")
    seen = []

    def read_dims(s, versions):
        seen.append({r.id: r.name for r in dim.table(versions["d"]).collect()})
        raise KeyboardInterrupt                             # the batch dies after its first read

    write = jobs.write_order_wide(read_dims, lambda s: {"d": dim}, 0)
    for batch_id, change in ((5, "new"), (5, "newer"), (6, None)):
        try:
            write(batch, batch_id, out)
        except KeyboardInterrupt:
            pass
        if change:
            dim.merge(spark.createDataFrame([(2, "update", {"id": "1", "name": change})], CHANGE_ROWS), dim.versions()[-1] + 1)
    assert seen == [{"1": "old"}, {"1": "old"}, {"1": "newer"}]


def test_outputs_of_a_batch_appear_together(spark, monkeypatch):
    """A crash between two outputs shows neither; the replay shows both."""
    import json
    out = new_location(spark, "publish")
    config = spark.createDataFrame([("user_info", "insert", "hbase", "dim_user", "code,name", "code", None),
                                    ("orders", "insert", "kafka", "dwd_orders", None, "id", None)], TABLE_PROCESS)
    rec = lambda seq, table, data: (seq, json.dumps({"table": table, "type": "insert", "data": data}))
    first = _text(spark, [rec(1, "user_info", {"code": "a", "name": "A"}), rec(2, "orders", {"id": "7"})])
    second = _text(spark, [rec(3, "user_info", {"code": "b", "name": "B"}), rec(4, "orders", {"id": "8"}), rec(5, "user_info", {"name": "lost"})])
    write = jobs.write_changes(lambda s: config)
    write(first, 0, out)
    real = Dimension.merge

    def dies(self, changes, version):
        real(self, changes, version)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(Dimension, "merge", dies)
    try:
        write(second, 1, out)
    except RuntimeError:
        pass
    shown = lambda: ([r.value for r in jobs.read_changes(spark, out, "facts").collect()],
                     sorted(r.code for r in jobs.read_dimension(spark, out, "dim_user").collect()))
    assert shown() == (['{"id":"7"}'], ["a"])
    monkeypatch.undo()
    write(second, 1, out)
    assert sorted(shown()[0]) == ['{"id":"7"}', '{"id":"8"}'] and shown()[1] == ["a", "b"]
    assert [r.value for r in jobs.read_changes(spark, out, "keyless").collect()] == ['{"name":"lost"}']


def _frames(spark, rows, batches, root, build):
    """Rows through a stream in some micro-batches and small frames -> the rows that come out, in a batch form too."""
    flat = flatten_log(log_df(spark, rows))
    usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 500)
    try:
        edges = [rows[i * len(rows) // batches][0] for i in range(batches)] + [10**9]
        src = f"{root}/in"
        for lo, hi in zip(edges, edges[1:]):
            flat.where(F.col("seq").between(lo, hi - 1)).repartition(3).write.mode("append").parquet(f"{src}/p={lo}")
        stream = spark.readStream.schema(flat.schema).option("maxFilesPerTrigger", 3).option("recursiveFileLookup", "true").parquet(src)
        return jobs.run_available_now(build(stream), "frames")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)


def _log_of_a_bot(n=6_000):
    """In order of time; every second row is one visitor's, many at the same instant."""
    import random
    rnd, t, rows = random.Random(6), 19675 * DAY, []
    for i in range(n):
        t += rnd.choice([0, 0, 1_000, 9_000, 11_000, 60_000])
        rows.append(log_row(i, "bot" if i % 2 else f"m{rnd.randrange(9)}", t, last=rnd.choice([None, "", "home"]), is_new=rnd.choice("01")))
    # a last row far later pushes the watermark past all others
    return rows + [log_row(n, "end", t + 400 * DAY)]


def test_visitor_state_in_frames_equals_batch(spark):
    """A visitor with half of all rows comes in many frames a batch; the three rules equal their batch forms."""
    from marketlake.streaming.processors import bounces_stream, repair_new_flag_stream
    rows = _log_of_a_bot()
    batch = log_df(spark, rows)
    page = batch.where("common.mid <> 'end'")
    seqs = lambda df: sorted(r.seq for r in df.where("seq < 6000").select("seq").collect())
    got = _frames(spark, rows, 3, new_location(spark, "fr"), repair_new_flag_stream)
    want = {r.seq: r.n for r in visitors.repair_new_flag(page).select("seq", F.col("common.is_new").alias("n")).collect()}
    assert {r.seq: r.is_new for r in got.where("seq < 6000").collect()} == want
    assert seqs(_frames(spark, rows, 3, new_location(spark, "fr"), unique_visits_stream)) == seqs(visitors.unique_visits(page))
    for mode in ("as_written", "as_documented"):
        got = _frames(spark, rows, 4, new_location(spark, "fr"), lambda s: bounces_stream(s, "10 seconds", mode))  # noqa: B023
        assert seqs(got) == seqs(visitors.bounces(page, "10 seconds", mode))


class FakeState:
    """The state calls that the processors make, on a dictionary."""

    def __init__(self):
        self.d, self.v, self.timers, self.writes = {}, None, set(), 0

    def getMapState(self, *_):
        return self

    def getValueState(self, *_):
        other = FakeState()
        other.exists, other.get, other.update = (lambda: other.v is not None), (lambda: other.v), (lambda v: setattr(other, "v", v))
        return other

    def updateValue(self, k, v):
        self.d[k] = v
        self.writes += 1

    def getValue(self, k):
        return self.d[k]

    def keys(self):
        return list(self.d)

    def removeKey(self, k):
        del self.d[k]

    def listTimers(self):
        return list(self.timers)

    def deleteTimer(self, t):
        self.timers.discard(t)

    def registerTimer(self, t):
        self.timers.add(t)


def test_open_rows_are_appended_not_rewritten():
    """Frames that come before the watermark moves add one value each; what is decided goes, slice by slice."""
    from marketlake.streaming.processors import BounceDetector
    state, p = FakeState(), BounceDetector(10_000)
    p.init(state)
    for i in range(50):
        assert list(p._run(iter([_rows([(i, 1_000 * i, None if i % 2 else "home")])]), 0)) == []
    assert len(state.d) == 50 and state.writes == 50
    out = pd.concat(p._run(iter(()), 30_000)) if (got := list(p._run(iter(()), 30_000))) else pd.DataFrame(columns=["seq"])
    assert got == [] and len(out) == 0                       # every entry page has a successor a second later
    assert min(k[0] for k in state.d) == 2 and state.timers  # the slice that the watermark stands in stays
    last = pd.concat(p._run(iter(()), 10**9))
    assert list(last.seq) == [49] and not state.d and not state.timers


def test_unique_visit_state_expires(spark):
    """The day of the last entry page is forgotten one day after it: the timer fires, the state is empty."""
    from marketlake.streaming.processors import DailyUniqueVisit

    class Value:
        def __init__(self):
            self.v = None

        exists = lambda self: self.v is not None
        get = lambda self: self.v

        def update(self, v):
            self.v = v

        def clear(self):
            self.v = None

    class Info:
        def __init__(self, at):
            self.at = at

        def getExpiryTimeInMs(self):
            return self.at

    value, state, p = Value(), FakeState(), DailyUniqueVisit()
    state.getValueState, state.getListState = (lambda *_: value), (lambda *_: None)
    p.init(state)
    first = _rows([(1, 5, None), (2, 6, None)]).assign(dt="2024-01-01")
    assert list(pd.concat(p.handleInputRows("m", iter([first]), None)).seq) == [1]
    assert state.timers == {6 + DAY} and value.v == ("2024-01-01", 6 + DAY)
    list(p.handleExpiredTimer("m", None, Info(DAY)))         # an older timer changes nothing
    assert value.exists()
    list(p.handleExpiredTimer("m", None, Info(6 + DAY)))
    assert not value.exists()
