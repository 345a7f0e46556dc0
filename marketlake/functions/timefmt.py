"""Time helpers (Column -> Column).

Batch event time is ``TIMESTAMP_NTZ`` read as a UTC wall clock, so every batch result is
independent of the session zone.  Streaming needs ``TIMESTAMP`` (``withWatermark`` rejects NTZ);
``event_time`` picks the right type from ``df.isStreaming``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"

# Fixed value: the year length of the age rule (365 days, no leap years).
AGE_YEAR_MS = 365 * 24 * 3600 * 1000
# Business databases write ``yyyy-MM-dd HH:mm:ss`` wall-clock text.  The original source system
# wrote it at UTC+8 (pass ``offset_hours=8``); the driver tables are naive UTC, so the default is 0
# and every text time lines up with the epoch-millis ``ts`` of the behaviour log.
TEXT_OFFSET_HOURS = 0

DT_FMT = "yyyyMMdd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
DATE_FMT = "yyyy-MM-dd"
# Text that a cast reads as DATETIME_FMT does; the cast takes a fraction of the pattern's time.
DATETIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_millis(ts) -> Column:
    """Epoch millis of a wall-clock timestamp read as UTC."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _c(ts))


def millis_to_ntz(ms) -> Column:
    """Inverse of ``ntz_to_millis``: UTC wall clock of epoch millis as TIMESTAMP_NTZ."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH_NTZ))


def millis_to_ts(ms) -> Column:
    """Epoch millis as an instant (TIMESTAMP), for streaming watermarks."""
    return F.timestamp_millis(_c(ms))


def event_time(ms, streaming: bool) -> Column:
    return millis_to_ts(ms) if streaming else millis_to_ntz(ms)


def ymd(ts) -> Column:
    """``yyyyMMdd`` of a timestamp (the day key of the log layer and the report filter)."""
    return F.date_format(_c(ts), DT_FMT)


def ymd_from_millis(ms) -> Column:
    return ymd(millis_to_ntz(ms))


def day_from_millis(ms) -> Column:
    """The day of ``DATETIME_FMT`` text without its separators, straight from epoch millis."""
    day = F.lit(86_400_000)
    date = F.date_from_unix_date(((_c(ms) - F.pmod(_c(ms), day)) / day).cast("int"))
    return F.replace(F.substring(date.cast("string"), 1, 10), F.lit("-"), F.lit(""))


def datetime_str(ts) -> Column:
    return F.date_format(_c(ts), DATETIME_FMT)


def parse_datetime(s) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> TIMESTAMP_NTZ (wall clock, no zone)."""
    c = _c(s)
    return F.coalesce(F.when(c.rlike(DATETIME_SHAPE), c.try_cast("timestamp_ntz")), F.to_timestamp_ntz(c, F.lit(DATETIME_FMT)))


def text_to_millis(s, offset_hours: int = TEXT_OFFSET_HOURS) -> Column:
    """Epoch millis of a ``yyyy-MM-dd HH:mm:ss`` text written at UTC+``offset_hours``."""
    return ntz_to_millis(parse_datetime(s)) - F.lit(offset_hours * 3_600_000)


def with_millis(df: DataFrame, times: dict[str, str], offset_hours: int = TEXT_OFFSET_HOURS) -> DataFrame:
    """Add ``{output name: text column}`` as epoch millis, each text read once per row: a one-element generator, as in
    ``logs.parse_once``, because a filter on the millis (of a window, of a join) would read the text again below it."""
    read = F.struct(*[text_to_millis(F.col(c), offset_hours).alias(name) for name, c in times.items()])
    return df.select("*", F.inline(F.array(read)))


def age_years(birthday, as_of_ms, offset_hours: int = TEXT_OFFSET_HOURS) -> Column:
    """Whole years of 365 days between a ``yyyy-MM-dd`` birthday (local midnight) and ``as_of_ms``.

    Integral division truncates toward zero, like chained long divisions.
    """
    birth_ms = ntz_to_millis(F.to_timestamp_ntz(_c(birthday), F.lit(DATE_FMT))) - F.lit(offset_hours * 3_600_000)
    # millis stay far below 2**53, so the double quotient truncates exactly
    return ((_c(as_of_ms) - birth_ms) / F.lit(AGE_YEAR_MS)).cast("bigint").cast("int")


def hour_label(hr) -> Column:
    """Zero-padded hour label ``00``..``23``."""
    return F.lpad(_c(hr).cast("string"), 2, "0")
