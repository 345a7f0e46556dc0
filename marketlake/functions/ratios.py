"""Visitor ratios of the dashboard (Column -> Column).

All three guard on ``uv_ct = 0`` (-> 0) but divide by ``sv_ct``; a zero ``sv_ct`` with visitors
gives NULL here instead of an error.  Decimal division rounds HALF_UP like the source.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dec(c) -> Column:
    return _c(c).cast("decimal(20,0)")


def _guard(uv, value: Column, scale: int) -> Column:
    return F.when(_c(uv) == 0, F.lit(0).cast(f"decimal(20,{scale})")).otherwise(value)


def bounce_rate(uj, sv, uv) -> Column:
    """``uj * 100 / sv`` at scale 2."""
    v = F.round(_dec(uj) * 100 / F.nullif(_dec(sv), F.lit(0)), 2).cast("decimal(20,2)")
    return _guard(uv, v, 2)


def seconds_per_session(dur, sv, uv) -> Column:
    """``round(round(dur / sv, 0) / 1000, 1)`` -- the double rounding is deliberate."""
    per = F.round(_dec(dur) / F.nullif(_dec(sv), F.lit(0)), 0)
    v = F.round(per / 1000, 1).cast("decimal(20,1)")
    return _guard(uv, v, 1)


def pages_per_session(pv, sv, uv) -> Column:
    """``pv / sv`` at scale 2."""
    v = F.round(_dec(pv) / F.nullif(_dec(sv), F.lit(0)), 2).cast("decimal(20,2)")
    return _guard(uv, v, 2)
