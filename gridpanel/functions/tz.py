"""Local wall clock -> UTC.

Works on TIMESTAMP_NTZ with ``convert_timezone``, so the result never
depends on the session time zone.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .calendar import col, hour_floor


def local_to_utc(ts, zone: str, nonexistent: str = "shift_forward") -> Column:
    """Read a naive local timestamp in ``zone`` and return naive UTC.

    Ambiguous autumn hours take the daylight-saving (earlier) reading. A time in
    the spring gap is moved to the first valid instant, the next full hour
    (``shift_forward``); ``nonexistent='shift_by_gap'`` keeps the plain
    conversion (moved by the gap's length). A gap time is one whose UTC round
    trip does not return it.
    """
    src, utc = F.lit(zone), F.lit("UTC")
    t = col(ts)
    out = F.convert_timezone(src, utc, t)
    if nonexistent == "shift_forward":
        in_gap = F.convert_timezone(utc, src, out) != t
        nxt = hour_floor(t) + F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), F.lit(0))
        out = F.when(in_gap, F.convert_timezone(src, utc, nxt)).otherwise(out)
    return out


def utc_to_local(ts, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(ts))
