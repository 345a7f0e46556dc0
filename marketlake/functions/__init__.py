"""Scalar helpers: every function maps Columns to a Column and stays inside codegen."""

from .codes import decode, keyword_weight
from .ratios import bounce_rate, pages_per_session, seconds_per_session
from .text import keyword_sources, words
from .timefmt import (age_years, datetime_str, event_time, hour_label, millis_to_ntz,
                      millis_to_ts, ntz_to_millis, parse_datetime, text_to_millis, ymd,
                      ymd_from_millis)

__all__ = [
    "age_years", "bounce_rate", "datetime_str", "decode", "event_time", "hour_label",
    "keyword_sources", "keyword_weight", "millis_to_ntz", "millis_to_ts", "ntz_to_millis",
    "pages_per_session", "parse_datetime", "seconds_per_session", "text_to_millis", "words",
    "ymd", "ymd_from_millis",
]
