"""Streaming forms of the three order-dependent visitor operators (arbitrary state API v2).

They work on the *flat* log row (``flatten_log``), keyed by a group of visitors (a hash of ``mid``), so that a call costs one
vectorised step for all of them and not one for each.  A group's rows of one micro-batch come as an iterator of frames
and are never put together: what a worker holds is one frame, or a few values a row, or one slice of the group's time,
however many rows a visitor has.

* ``NewVisitorRepair``  -- value state: the first new-visitor day of every visitor of the group.  Frames whose visitors
  are all known pass through; the others wait in a list state until the batch has settled them.
* ``DailyVisitGroup``   -- value state: the day of the previous entry page of every visitor; an event-time timer clears
  it one day after the last write (the source's one-day state TTL).  With more than one frame, visitor, order, day and
  time of each row are held, the rows themselves wait in a list state.  ``DailyUniqueVisit`` is the same for one visitor.
* ``BounceDetector``    -- map state: page rows whose fate is still open, packed under (slice of
  ``within`` of event time, number).  New rows are appended; a call reads the slices that the watermark has
  reached and the slice after them, and files again what stays open of those.  An entry row is decided once its
  successor can no longer change (the successor is older than the watermark, or the watermark passed
  ``ts + within``); a successor two slices on is more than ``within`` away and decides nothing.  Rows older than
  the watermark are late and dropped.

Results equal the batch forms for rows whose outcome is closed by the watermark.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from ..functions.timefmt import ymd_from_millis
from ..operators import order

# The processors are the only Python that runs on executors.  Pickle this module by value so a
# worker needs pandas and pyspark, not this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

S, L = StringType(), LongType()
FLAT_LOG = StructType([StructField(n, t, True) for n, t in [
    ("seq", L), ("mid", S), ("ts", L), ("dt", S), ("is_new", S), ("vc", S), ("ch", S), ("ar", S),
    ("page_id", S), ("last_page_id", S), ("item", S), ("item_type", S), ("during_time", L),
    ("is_start", BooleanType()), ("payload", S),
]])
FLAT_COLUMNS = [f.name for f in FLAT_LOG.fields]


def flatten_log(log: DataFrame) -> DataFrame:
    """Typed log rows -> the flat row the stateful processors and the summary jobs read.

    A composite ``seq`` becomes text of the same order.  A ``payload`` column on the input (the raw JSON line) is
    carried; otherwise it is NULL."""
    c, p = "common", "page"
    start = F.coalesce(F.size(F.col("start")), F.lit(-1)) > 0
    seq = order.as_text(F.col("seq")) if order.is_composite(log) else F.col("seq")
    return log.select(
        seq.alias("seq"), F.col(f"{c}.mid").alias("mid"), "ts", ymd_from_millis(F.col("ts")).alias("dt"),
        F.col(f"{c}.is_new").alias("is_new"), F.col(f"{c}.vc").alias("vc"), F.col(f"{c}.ch").alias("ch"),
        F.col(f"{c}.ar").alias("ar"), F.col(f"{p}.page_id").alias("page_id"),
        F.col(f"{p}.last_page_id").alias("last_page_id"), F.col(f"{p}.item").alias("item"),
        F.col(f"{p}.item_type").alias("item_type"), F.col(f"{p}.during_time").alias("during_time"),
        start.alias("is_start"),
        (F.col("payload") if "payload" in log.columns else F.lit(None).cast("string")).alias("payload"))


def _schema(flat: DataFrame) -> StructType:
    """The flat row with the input's kind of ``seq``."""
    return StructType([flat.schema["seq"] if f.name == "seq" else f for f in FLAT_LOG.fields])


def pack(pdf: pd.DataFrame) -> bytes:
    """A frame as one value of a state (read back by the same version of this job only)."""
    return pickle.dumps(pdf[FLAT_COLUMNS], pickle.HIGHEST_PROTOCOL)


def unpack(data: bytes) -> pd.DataFrame:
    return pickle.loads(data)


def _is_entry(pdf: pd.DataFrame) -> pd.Series:
    return pdf["last_page_id"].isna() | (pdf["last_page_id"] == "")


def _visitors(pdf: pd.DataFrame) -> list:
    """The visitor of every row as a key of a dictionary; rows without one are one visitor's."""
    return [None if none else mid for mid, none in zip(pdf["mid"], pdf["mid"].isna())]


def _set_timer(handle: StatefulProcessorHandle, wanted: int | None) -> None:
    """``wanted`` as the only timer of the key."""
    set_already = set(handle.listTimers())
    for t in set_already - {wanted}:
        handle.deleteTimer(t)
    if wanted is not None and wanted not in set_already:
        handle.registerTimer(wanted)


class Waiting:
    """Frames that are needed again after the last one: a single frame stays in hand, more go to a list state."""

    def __init__(self, state):
        self.state, self.only, self.n = state, None, 0

    def add(self, pdf: pd.DataFrame) -> None:
        if self.n == 1:
            self.state.appendValue((pack(self.only),))
            self.only = None
        if self.n:
            self.state.appendValue((pack(pdf),))
        else:
            self.only = pdf
        self.n += 1

    def again(self) -> Iterator[pd.DataFrame]:
        if self.n == 1:
            yield self.only
        elif self.n:
            for (data,) in self.state.get():
                yield unpack(bytes(data))
            self.state.clear()


class NewVisitorRepair(StatefulProcessor):
    """One group of visitors: a call settles the first new-visitor days of all that are in it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_days", "days binary")
        self.held = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = unpack(bytes(self.first.get()[0])) if self.first.exists() else {}
        waiting, found = Waiting(self.held), {}
        for pdf in rows:
            if not len(pdf):
                continue
            new = pdf.loc[pdf["is_new"] == "1", ["mid", "seq", "dt"]]
            new = new[np.array([m not in known for m in _visitors(new)], bool)].sort_values("seq", kind="stable").drop_duplicates("mid")
            for mid, seq, day in zip(_visitors(new), new["seq"], new["dt"]):
                if mid not in found or seq < found[mid][0]:
                    found[mid] = (seq, day)
            if len(new):
                waiting.add(pdf)
            else:                       # the days of all its visitors were known before this batch
                yield self._repaired(pdf, known)
        settled = {mid: day for mid, (_, day) in found.items() if not pd.isna(day)}
        if settled:
            known.update(settled)
            self.first.update((pickle.dumps(known, pickle.HIGHEST_PROTOCOL),))
        for pdf in waiting.again():
            yield self._repaired(pdf, known)

    def _repaired(self, pdf: pd.DataFrame, known: dict) -> pd.DataFrame:
        first = pd.Series([known.get(m) for m in _visitors(pdf)], index=pdf.index, dtype=object)
        pdf.loc[(pdf["is_new"] == "1") & first.notna() & (pdf["dt"] != first), "is_new"] = "0"
        return pdf[FLAT_COLUMNS]

    def close(self) -> None:
        pass


DAY_MS = 86_400_000


class DailyUniqueVisit(StatefulProcessor):
    """The rule for one visitor, a call for each of them (``DailyVisitGroup`` is what the stream runs).  Input: entry
    pages only."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_day", "day string, expires long")
        self.held = handle.getListState("waiting", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting, seqs, days, latest = Waiting(self.held), [], [], None
        for pdf in rows:
            if len(pdf):
                seqs.append(pdf["seq"].to_numpy())
                days.append(pdf["dt"].to_numpy())
                latest = max(int(pdf["ts"].max()), latest if latest is not None else int(pdf["ts"].max()))
                waiting.add(pdf)
        if latest is None:
            return
        sizes = [len(s) for s in seqs]
        in_order = np.argsort(np.concatenate(seqs), kind="stable")
        day = np.concatenate(days)[in_order]
        known = self.last.get() if self.last.exists() else None
        first_of_day = np.ones(len(day), bool)
        first_of_day[1:] = day[1:] != day[:-1]
        if known is not None:
            first_of_day[0] = day[0] != known[0]
            self.handle.deleteTimer(known[1])
        keep = np.empty(len(day), bool)
        keep[in_order] = first_of_day
        expires = latest + DAY_MS
        self.last.update((day[-1], expires))
        self.handle.registerTimer(expires)
        lo = 0
        for pdf, n in zip(waiting.again(), sizes):
            yield pdf.loc[keep[lo: lo + n], FLAT_COLUMNS]
            lo += n

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists() and self.last.get()[1] <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        yield pd.DataFrame(columns=FLAT_COLUMNS)

    def close(self) -> None:
        pass


class DailyVisitGroup(StatefulProcessor):
    """``DailyUniqueVisit`` for a group of visitors at once.  Value state: day of the last entry page and expiry of every
    visitor that had one in the last day; one timer, at the earliest expiry, takes out all that have expired."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_days", "visitors binary")
        self.held = handle.getListState("waiting", "rows binary")

    def _known(self) -> dict:
        return unpack(bytes(self.last.get()[0])) if self.last.exists() else {}

    def _keep(self, known: dict, wm: int) -> None:
        if known:
            self.last.update((pickle.dumps(known, pickle.HIGHEST_PROTOCOL),))
        elif self.last.exists():
            self.last.clear()
        _set_timer(self.handle, max(min(expires for _, expires in known.values()), wm + 1) if known else None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        waiting, frames = Waiting(self.held), []
        for pdf in rows:
            if len(pdf):
                frames.append(pdf[["mid", "seq", "dt", "ts"]])
                waiting.add(pdf)
        if not frames:
            return
        sizes, rows_of = [len(f) for f in frames], pd.concat(frames, ignore_index=True)
        visitor, names = pd.factorize(rows_of["mid"], use_na_sentinel=False)
        names = [None if pd.isna(m) else m for m in names]
        in_order = rows_of.assign(_v=visitor).sort_values(["_v", "seq"], kind="stable").index.to_numpy()
        v, day = visitor[in_order], rows_of["dt"].to_numpy()[in_order]
        begins = np.append(True, v[1:] != v[:-1])
        first_of_day = begins | np.append(True, day[1:] != day[:-1])
        known = self._known()
        for i in np.flatnonzero(begins):
            before = known.get(names[v[i]])
            first_of_day[i] = before is None or day[i] != before[0]
        keep = np.empty(len(day), bool)
        keep[in_order] = first_of_day
        latest = rows_of["ts"].groupby(visitor).max()
        for i in np.flatnonzero(np.append(begins[1:], True)):
            known[names[v[i]]] = (day[i], int(latest[v[i]]) + DAY_MS)
        self._keep(known, timerValues.getCurrentWatermarkInMs())
        lo = 0
        for pdf, n in zip(waiting.again(), sizes):
            yield pdf.loc[keep[lo: lo + n], FLAT_COLUMNS]
            lo += n

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        wm = timerValues.getCurrentWatermarkInMs()
        self._keep({m: k for m, k in self._known().items() if k[1] > wm}, wm)
        yield pd.DataFrame(columns=FLAT_COLUMNS)

    def close(self) -> None:
        pass


def bounce_step(buf: pd.DataFrame, wm: int, within_ms: int, documented: bool, end: int | None = None):
    """One evaluation of the bounce rule over the open rows of some visitors at watermark ``wm``; rows from ``end`` on
    are only looked at as successors.

    Returns ``(emitted rows, rows to keep open, next timer or None)``.
    """
    if buf.empty:
        return buf, buf, None
    b = buf.assign(_v=pd.factorize(buf["mid"], use_na_sentinel=False)[0])
    b = b.sort_values(["_v", "ts", "seq"], kind="stable").reset_index(drop=True)
    entry, ts, visitor = _is_entry(b).to_numpy(bool), b["ts"].to_numpy("int64"), b.pop("_v").to_numpy()
    has_next = np.append(visitor[1:] == visitor[:-1], False)
    nts, nentry = np.append(ts[1:], 0), np.append(entry[1:], False) & has_next
    decided = entry & ((has_next & (nts < wm)) | (ts + within_ms <= wm))
    bounce = ~has_next | (nts - ts >= within_ms)
    if documented:
        bounce = bounce | nentry
    mine = np.ones(len(b), bool) if end is None else ts < end
    open_entry = entry & ~decided & mine
    emitted, keep = b[decided & bounce & mine], b[open_entry | ((ts >= wm) & mine)]
    if not open_entry.any():
        return emitted, keep, None
    due = np.where(has_next, np.minimum(ts + within_ms, nts + 1), ts + within_ms)
    return emitted, keep, int(due[open_entry].min())


#: Rows that are packed together, and worked on together, whatever slices they lie in.
SMALL = 20_000


def _together(frames: list[pd.DataFrame]) -> pd.DataFrame | None:
    return pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0] if frames else None


class BounceDetector(StatefulProcessor):
    def __init__(self, within_ms: int, documented: bool = False):
        self.within_ms = within_ms
        self.documented = documented
        self.width = max(1, within_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open_rows", "slice long, number long", "rows binary")

    def _put(self, pdf: pd.DataFrame) -> list[tuple]:
        """File rows under the slice of the first of them; many rows slice by slice.  Their keys."""
        parts, keys = [pdf] if len(pdf) <= SMALL else [part for _, part in pdf.groupby(pdf["ts"] // self.width)], []
        for part in parts:
            keys.append((int(part["ts"].min()) // self.width, self.number))
            self.open.updateValue(keys[-1], (pack(part),))
            self.number += 1
        return keys

    def _read(self, pool: pd.DataFrame | None, keys: list[tuple]) -> pd.DataFrame | None:
        frames = ([pool] if pool is not None else []) + [unpack(bytes(self.open.getValue(k)[0])) for k in keys]
        return _together(frames)

    def _run(self, rows: Iterator[pd.DataFrame], wm: int) -> Iterator[pd.DataFrame]:
        filed: dict[int, list[tuple]] = {}
        for k in self.open.keys():
            filed.setdefault(k[0], []).append(k)
        self.number = max((k[1] for ks in filed.values() for k in ks), default=-1) + 1
        new, n = [], 0
        for pdf in rows:
            pdf = pdf.loc[pdf["ts"] >= wm, FLAT_COLUMNS]  # late rows are dropped; the others lie at the watermark or after it
            if len(pdf):
                new.append(pdf)
                n += len(pdf)
            if n > SMALL:       # many: they go to the state and come back slice by slice; few stay in hand
                for k in self._put(_together(new)):
                    filed.setdefault(k[0], []).append(k)
                new, n = [], 0
        names, pool, loaded, kept, timer = sorted(filed), _together(new), [], [], None

        def load(up_to: int) -> None:
            nonlocal pool
            keys = []
            while names and names[0] <= up_to:
                keys += filed[names.pop(0)]
            loaded.extend(keys)
            pool = self._read(pool, keys)

        reached = (wm - 1) // self.width      # the last slice that the watermark has come to
        while names or pool is not None:
            here = min(names[:1] + ([int(pool["ts"].min()) // self.width] if pool is not None else []))
            if here > reached:                # look at it when the watermark has come to it
                timer = min(x for x in (timer, here * self.width + 1) if x is not None)
                break
            load(here)
            while names and names[0] <= reached and len(pool) <= SMALL:      # few rows: slices together
                load(names[0])
            last = max(here, min(reached, names[0] - 2 if names else reached))
            load(last + 1)                    # successors of the last slice's rows
            end = (last + 1) * self.width
            ts = pool["ts"]
            emitted, keep, due = bounce_step(pool[ts < end + self.width], wm, self.within_ms, self.documented, end)
            rest = pool[ts >= end]
            pool = rest if len(rest) else None
            if due is not None:
                timer = due if timer is None else min(timer, due)
            if len(keep):
                kept.append(keep)
            if len(emitted):
                yield emitted[FLAT_COLUMNS]
        for k in loaded:
            self.open.removeKey(k)
        left = _together(kept + ([pool] if pool is not None else []))
        if left is not None:
            self._put(left)
        _set_timer(self.handle, None if timer is None else max(timer, wm + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from self._run(rows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._run(iter(()), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


#: Groups of visitors (part of a checkpoint: a running job keeps its number).
VISITOR_GROUPS = 256

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_state_store(df: DataFrame) -> None:
    """The state API v2 runs on the RocksDB state store, and the state of joins and windows belongs there too, not in the
    executors' heaps; select it for new streaming queries of this session when another provider is configured
    (existing checkpoints keep theirs).  All stores of an executor share one bounded cache, and a commit writes what
    changed, not the whole store, unless the session says otherwise."""
    conf = df.sparkSession.conf
    key = "spark.sql.streaming.stateStore.providerClass"
    if conf.get(key, None) != ROCKSDB:
        conf.set(key, ROCKSDB)
    # no job reads the number of rows in a store: counting them costs a read for every write and removal
    for name, value in (("boundedMemoryUsage", "true"), ("changelogCheckpointing.enabled", "true"), ("trackTotalNumberOfRows", "false")):
        key = f"spark.sql.streaming.stateStore.rocksdb.{name}"
        if conf.get(key, None) is None:
            conf.set(key, value)


def _groups(flat: DataFrame) -> DataFrame:
    """The rows with the group of their visitor: a call for a visitor and micro-batch costs more than its rows do."""
    return flat.withColumn("_group", F.pmod(F.xxhash64("mid"), F.lit(VISITOR_GROUPS)))


def _with_event_time(flat: DataFrame, watermark: str) -> DataFrame:
    return flat.withColumn("_et", F.timestamp_millis("ts")).withWatermark("_et", watermark)


def repair_new_flag_stream(flat: DataFrame) -> DataFrame:
    ensure_state_store(flat)
    return _groups(flat).groupBy("_group").transformWithStateInPandas(
        statefulProcessor=NewVisitorRepair(), outputStructType=_schema(flat), outputMode="Append", timeMode="None")


def unique_visits_stream(flat_pages: DataFrame, watermark: str = "3 seconds") -> DataFrame:
    ensure_state_store(flat_pages)
    entries = flat_pages.filter(F.coalesce(F.col("last_page_id"), F.lit("")) == "")
    return _with_event_time(_groups(entries), watermark).groupBy("_group").transformWithStateInPandas(
        statefulProcessor=DailyVisitGroup(), outputStructType=_schema(flat_pages), outputMode="Append", timeMode="EventTime")


def bounces_stream(flat_pages: DataFrame, within: str = "10 seconds", mode: str = "as_written",
                   watermark: str = "0 seconds") -> DataFrame:
    from ..operators.joins import _ms
    ensure_state_store(flat_pages)
    proc = BounceDetector(_ms(within), mode == "as_documented")
    return _with_event_time(_groups(flat_pages), watermark).groupBy("_group").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=_schema(flat_pages), outputMode="Append", timeMode="EventTime")
