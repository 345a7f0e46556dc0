"""New-visitor repair, daily unique visits and bounces: fixtures and randomized checks against a
plain-Python statement of the rules."""

import random

import pytest
from pyspark.sql import functions as F

from marketlake.operators import visitors
from helpers import DAY, log_df, log_row


def _flags(df):
    return [r["is_new"] for r in df.orderBy("seq").select("seq", F.col("common.is_new").alias("is_new")).collect()]


def test_repair_fixture(spark):
    rows = [log_row(1, "m1", 0, is_new="1"), log_row(2, "m1", 1, is_new="1"), log_row(3, "m1", DAY, is_new="1"),
            log_row(4, "m1", DAY + 1, is_new="0"), log_row(5, "m2", 0, is_new="0"), log_row(6, "m2", DAY, is_new="1")]
    out = visitors.repair_new_flag(log_df(spark, rows))
    assert _flags(out) == ["1", "1", "0", "0", "0", "1"]


def test_repair_uses_arrival_order_not_time(spark):
    # the day-2 row arrives first, so day 2 is the first new-visitor day
    rows = [log_row(1, "m1", DAY, is_new="1"), log_row(2, "m1", 0, is_new="1")]
    assert _flags(visitors.repair_new_flag(log_df(spark, rows))) == ["1", "0"]


def test_unique_visit_fixture(spark):
    rows = [log_row(1, "m1", 0), log_row(2, "m1", 10, last="home"), log_row(3, "m1", 20),
            log_row(4, "m1", DAY), log_row(5, "m1", 30)]
    out = visitors.unique_visits(log_df(spark, rows))
    assert sorted(r.seq for r in out.collect()) == [1, 4, 5]


@pytest.mark.parametrize("gap,expected_written,expected_documented", [
    (None, [1], [1]),
    (9_999, [], []),
    (10_000, [1], [1]),
])
def test_bounce_single_follower(spark, gap, expected_written, expected_documented):
    rows = [log_row(1, "m1", 0)]
    if gap is not None:
        rows.append(log_row(2, "m1", gap, last="home"))
    df = log_df(spark, rows)
    assert sorted(r.seq for r in visitors.bounces(df, "10 seconds").collect()) == expected_written
    assert sorted(r.seq for r in visitors.bounces(df, "10 seconds", "as_documented").collect()) == expected_documented


def test_bounce_two_entries(spark):
    df = log_df(spark, [log_row(1, "m1", 0), log_row(2, "m1", 5_000)])
    assert sorted(r.seq for r in visitors.bounces(df, "10 seconds").collect()) == [2]
    assert sorted(r.seq for r in visitors.bounces(df, "10 seconds", "as_documented").collect()) == [1, 2]


# ---- randomized: plain-Python statement of the rules ----------------------------------------------

def _py_repair(rows):
    first, out = {}, {}
    for seq, mid, ts, is_new, _ in sorted(rows):
        if is_new != "1":
            out[seq] = is_new
            continue
        day = ts // DAY
        first.setdefault(mid, day)
        out[seq] = "1" if first[mid] == day else "0"
    return out


def _py_uv(rows):
    last, keep = {}, []
    for seq, mid, ts, _, last_page in sorted(rows):
        if last_page not in (None, ""):
            continue
        day = ts // DAY
        if last.get(mid) != day:
            keep.append(seq)
        last[mid] = day
    return sorted(keep)


def _py_bounce(rows, within, documented):
    by_mid = {}
    for seq, mid, ts, _, last_page in rows:
        by_mid.setdefault(mid, []).append((ts, seq, last_page in (None, "")))
    keep = []
    for evs in by_mid.values():
        evs.sort()
        for i, (ts, seq, entry) in enumerate(evs):
            if not entry:
                continue
            nxt = evs[i + 1] if i + 1 < len(evs) else None
            if nxt is None or nxt[0] - ts >= within or (documented and nxt[2]):
                keep.append(seq)
    return sorted(keep)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_python(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for seq in range(300):
        mid = f"m{rnd.randrange(6)}"
        ts = rnd.randrange(4 * DAY) if rnd.random() < 0.5 else rnd.randrange(40_000)
        rows.append((seq, mid, ts, rnd.choice("01"), rnd.choice([None, "", "home", "cart"])))
    df = log_df(spark, [log_row(s, m, t, is_new=n, last=lp) for s, m, t, n, lp in rows])
    got = {r.seq: r.is_new for r in visitors.repair_new_flag(df).select("seq", F.col("common.is_new").alias("is_new")).collect()}
    assert got == _py_repair(rows)
    # tiny bucket widths force the two-level neighbour search across many buckets
    uv = visitors.unique_visits(df, seq_bucket=7)
    assert sorted(r.seq for r in uv.collect()) == _py_uv(rows)
    for doc in (False, True):
        b = visitors.bounces(df, "10 seconds", "as_documented" if doc else "as_written", ts_bucket_ms=3_000)
        assert sorted(r.seq for r in b.collect()) == _py_bounce(rows, 10_000, doc)
