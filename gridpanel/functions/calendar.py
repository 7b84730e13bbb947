"""Calendar expressions (F1-F7, S7 bounds).

All are column expressions on TIMESTAMP_NTZ / DATE, so they run inside
whole-stage codegen and never depend on the session time zone.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from ..schemas import BASELINE_HOUR, FOURIER_ORDER, HOURS


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(ts) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying NTZ (``date_trunc`` would return LTZ)."""
    t = col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def date_of(ts) -> Column:
    """date part."""
    return F.to_date(col(ts))


def time_of(ts) -> Column:
    """time-of-day part as ``HH:mm:ss`` text."""
    return F.date_format(col(ts), "HH:mm:ss")


def weekday_iso(ts) -> Column:
    """Monday = 1 .. Sunday = 7 (Spark ``weekday`` gives Monday = 0)."""
    return (F.weekday(col(ts)) + 1).cast("int")


def hour_of_day(ts) -> Column:
    """0..23."""
    return F.hour(col(ts)).cast("int")


def shift(ts, days: int = 0, hours: int = 0) -> Column:
    """fixed-duration shift of a timestamp (negative = earlier)."""
    return col(ts) + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(0), F.lit(0))


def trend(d, fit_start) -> Column:
    """linear trend, 1 on the first fit date, continued out of sample."""
    return (F.datediff(col(d), F.lit(fit_start).cast("date") if isinstance(fit_start, str)
                       else col(fit_start)) + 1).cast("double")


def days_in_year(d) -> Column:
    return F.dayofyear(F.make_date(F.year(col(d)), F.lit(12), F.lit(31)))


def year_fraction(d) -> Column:
    """Position in the calendar year: (day of year - 1) / days in that year."""
    return (F.dayofyear(col(d)) - 1) / days_in_year(d)


def fourier_terms(d, order: int = FOURIER_ORDER) -> list[Column]:
    """annual Fourier terms ``sin_k``, ``cos_k`` for k = 1..order."""
    r = year_fraction(d)
    out = []
    for k in range(1, order + 1):
        out.append(F.sin(F.lit(2 * math.pi * k) * r).alias(f"sin_{k}"))
        out.append(F.cos(F.lit(2 * math.pi * k) * r).alias(f"cos_{k}"))
    return out


def fourier_names(order: int = FOURIER_ORDER) -> list[str]:
    return [f"{p}_{k}" for k in range(1, order + 1) for p in ("sin", "cos")]


def weekly_dummies(d, fit_start, period: int = 7) -> list[Column]:
    """position in a 7-day cycle counted from the fit start; level 0 dropped."""
    pos = F.pmod(F.datediff(col(d), F.lit(fit_start).cast("date") if isinstance(fit_start, str)
                            else col(fit_start)), F.lit(period))
    return [(pos == k).cast("int").alias(f"s{k + 1}_{period}") for k in range(1, period)]


def hour_dummies(ts, baseline: int | None = BASELINE_HOUR, levels=HOURS,
                 prefix: str = "hour") -> list[Column]:
    """one-hot of hour of day over a declared level list, baseline removed."""
    h = F.hour(col(ts))
    return [(h == k).cast("int").alias(f"{prefix}_{k:02d}") for k in levels if k != baseline]


def calendar_features(df, ts: str = "prediction_datetime", d: str = "date",
                      fit_start=None, order: int = FOURIER_ORDER):
    """J10 as expressions: weekday, hour, trend and Fourier terms in place, no join."""
    cols = [weekday_iso(ts).alias("weekday"), hour_of_day(ts).alias("hour_of_day")]
    if fit_start is not None:
        cols.append(trend(d, fit_start).alias("trend"))
    cols += fourier_terms(d, order)
    return df.select("*", *cols)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, without any time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col(ts))


def hours_between(a, b) -> Column:
    return F.timestamp_diff("HOUR", col(a), col(b))
