"""Report tables of published batches: the same rows before, during and after their folders are merged."""

import pytest
from pyspark.sql import functions as F

from marketlake.session import new_location
from marketlake.sinks import files, report_tables, writers
from marketlake.streaming import jobs

ROWS = "stt string, edt string, k long, n long"
COLUMNS = ["stt", "edt", "k", "n"]


def _day(d, k, n):
    return (f"2024-01-{d:02d} 00:00:00", f"2024-01-{d + 1:02d} 00:00:00", k, n)


def _add(spark, root, batch_id, rows):
    report_tables.add_batch(spark.createDataFrame(rows, ROWS), root, COLUMNS, batch_id)


BATCHES = [[_day(1, 1, 10), _day(1, 2, 20), _day(2, 1, 5)], [], [_day(2, 2, 6), _day(1, 1, 10)], [_day(3, None, 7)]]
ALL = [("20240101", 1, 10), ("20240101", 1, 10), ("20240101", 2, 20), ("20240102", 1, 5), ("20240102", 2, 6), ("20240103", None, 7)]


@pytest.fixture
def root(spark):
    path = new_location(spark, "report-table")
    for i, rows in enumerate(BATCHES):
        _add(spark, path, i, rows)
    return path


def _sorted(rows):
    return sorted(rows, key=str)


def test_merged_days_show_the_same_rows(spark, root):
    shown = lambda date=None: _sorted((r.dt, r.k, r.n) for r in report_tables.read(spark, root, date).collect())
    assert shown() == _sorted(ALL) and len(report_tables.folders(spark, root, "20240101")) == 2
    assert report_tables.compact(spark, root) == ["20240101", "20240102", "20240103"]
    assert shown() == _sorted(ALL)
    assert report_tables.folders(spark, root, "20240101") == ["batch=days-1/dt=20240101"]
    assert shown("20240102") == [("20240102", 1, 5), ("20240102", 2, 6)] and shown("20231231") == []
    assert report_tables.compact(spark, root) == []
    # only the days of new batches are rewritten
    _add(spark, root, 4, [_day(2, 9, 9)])
    assert len(report_tables.folders(spark, root, "20240102")) == 2
    assert report_tables.compact(spark, root) == ["20240102"]
    assert report_tables.folders(spark, root) == ["batch=days-1/dt=20240101", "batch=days-1/dt=20240103", "batch=days-2/dt=20240102"]
    assert shown() == _sorted([*ALL, ("20240102", 9, 9)])


def test_a_merge_that_dies_changes_nothing(spark, root, monkeypatch):
    def dies(spark, path, value):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(files, "write_json", dies)
    with pytest.raises(RuntimeError):
        report_tables.compact(spark, root)
    monkeypatch.undo()
    assert files.exists(spark, f"{root}/batch=days-1") and report_tables.versions(spark, root) == []
    rows = lambda: _sorted((r.dt, r.k, r.n) for r in report_tables.read(spark, root).collect())
    assert rows() == _sorted(ALL)
    report_tables.compact(spark, root)
    assert rows() == _sorted(ALL)


def test_a_replay_counts_once_and_a_broken_batch_not_at_all(spark, root, monkeypatch):
    rows = lambda: _sorted((r.dt, r.k, r.n) for r in report_tables.read(spark, root).collect())
    _add(spark, root, 3, BATCHES[3])
    assert rows() == _sorted(ALL)
    real = writers.append_report

    def dies(*args):
        real(*args)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(writers, "append_report", dies)
    with pytest.raises(RuntimeError):
        _add(spark, root, 4, [_day(2, 9, 9)])
    monkeypatch.undo()
    assert rows() == _sorted(ALL)                      # its rows lie there but are not published
    report_tables.compact(spark, root)
    assert rows() == _sorted(ALL)
    _add(spark, root, 3, [_day(5, 5, 5)])              # a merged batch stays as it is
    _add(spark, root, 4, [_day(2, 9, 9)])
    assert rows() == _sorted([*ALL, ("20240102", 9, 9)])


def test_replaced_folders_stay_for_a_while(spark, root):
    report_tables.compact(spark, root)
    before = report_tables.read(spark, root)
    _add(spark, root, 4, [_day(1, 4, 4)])
    report_tables.compact(spark, root)
    assert _sorted((r.dt, r.k, r.n) for r in before.collect()) == _sorted(ALL)     # listed before the second merge
    assert files.exists(spark, f"{root}/batch=0")
    _add(spark, root, 5, [_day(1, 5, 5)])
    report_tables.compact(spark, root)
    assert report_tables.versions(spark, root) == [2, 3]
    assert not files.exists(spark, f"{root}/batch=0") and not files.exists(spark, f"{root}/batch=days-1/dt=20240101")
    assert files.exists(spark, f"{root}/batch=days-1/dt=20240102")                 # still the newest of its day
    assert files.numbered(spark, f"{root}/_manifests", "batch=") == [5]
    assert report_tables.read(spark, root).count() == len(ALL) + 2


def test_empty_tables_have_their_columns(spark):
    path = new_location(spark, "report-table")
    _add(spark, path, 0, [])
    assert report_tables.read(spark, path).columns == [*COLUMNS, "dt"] and report_tables.read(spark, path).count() == 0
    assert report_tables.compact(spark, path) == [] and report_tables.read(spark, path).count() == 0


def test_report_job_merges_while_it_runs(spark):
    """Six micro-batches in two runs, merged after every second one, against the batch of all rows."""
    src, out = new_location(spark, "report-in"), new_location(spark, "report-job")
    rows = [_day(1 + i % 3, i, i * i) for i in range(60)]
    for lo in (0, 30):
        for i in range(lo, lo + 30, 10):
            spark.createDataFrame(rows[i:i + 10], ROWS).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(src)
        jobs.start_report(stream, "r", COLUMNS, out, merge_every=2).awaitTermination()
    got = report_tables.read(spark, f"{out}/r")
    assert sorted(map(tuple, got.select(*COLUMNS).collect())) == sorted(rows)
    assert got.where(F.col("dt") == "20240101").count() == 20
    assert len(report_tables.folders(spark, f"{out}/r", "20240101")) == 1
