"""Last/next known value and gap filling.

Skew-safe two-level form: the ordered window runs inside (series, day)
groups only, and values are carried across days through a one-row-per-day
summary. A series that holds a third of all rows is still split by day, and
the per-day summary is bounded by the calendar.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.spine import spine_between


def _bucket(ts: str):
    return F.to_date(F.col(ts))


def last_known(df: DataFrame, keys, ts: str, value: str, out: str | None = None,
               direction: str = "forward") -> DataFrame:
    """Last non-null ``value`` at or before each row (``direction='backward'``:
    first non-null at or after). Adds column ``out``."""
    keys = list(keys)
    out = out or f"{value}_{'last' if direction == 'forward' else 'next'}"
    fwd = direction == "forward"
    d = df.withColumn("_b", _bucket(ts))
    w_in = Window.partitionBy(*keys, "_b").orderBy(ts)
    w_in = w_in.rowsBetween(Window.unboundedPreceding, 0) if fwd else w_in.rowsBetween(0, Window.unboundedFollowing)
    pick = F.last if fwd else F.first
    d = d.withColumn("_within", pick(value, ignorenulls=True).over(w_in))
    # per (series, day): the edge value a later (earlier) day inherits; days with
    # no known value are kept so they receive a carry as well
    agg = F.max_by if fwd else F.min_by
    known = F.when(F.col(value).isNotNull(), F.col(ts))
    summary = d.groupBy(*keys, "_b").agg(agg(value, known).alias("_edge"))
    w_day = Window.partitionBy(*keys).orderBy("_b")
    w_day = w_day.rowsBetween(Window.unboundedPreceding, -1) if fwd else w_day.rowsBetween(1, Window.unboundedFollowing)
    carry = summary.withColumn("_carry", pick("_edge", ignorenulls=True).over(w_day)).select(*keys, "_b", "_carry")
    return (d.join(carry, [*keys, "_b"], "left")
            .withColumn(out, F.coalesce("_within", "_carry")).drop("_b", "_within", "_carry"))


def fill_missing_hours(df: DataFrame, keys, ts: str, value_cols) -> DataFrame:
    """add the missing hours of each series between its first and last hour,
    each a copy of the previous hour's row (a run of missing hours repeats the
    last present row)."""
    keys = list(keys)
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    spine = spine_between(bounds, "_lo", "_hi", ts, keys)
    src = spine.join(df.select(*keys, ts, F.struct(*value_cols).alias("_row")), [*keys, ts], "left")
    src = last_known(src, keys, ts, "_row", "_prev_row")
    return src.select(*keys, ts, *[F.coalesce(F.col("_row")[v], F.when(F.col("_row").isNull(),
                                                                       F.col("_prev_row")[v])).alias(v)
                                   for v in value_cols],
                      F.col("_row").isNull().alias("filled"))


def neighbour_mean_repair(df: DataFrame, keys, ts: str, value: str) -> DataFrame:
    """Q9: missing hours (between the series' bounds) get the mean of the previous
    and next known values."""
    keys = list(keys)
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    spine = spine_between(bounds, "_lo", "_hi", ts, keys)
    full = spine.join(df.select(*keys, ts, value), [*keys, ts], "left")
    full = last_known(full, keys, ts, value, "_prev", "forward")
    full = last_known(full, keys, ts, value, "_next", "backward")
    return full.select(*keys, ts, F.coalesce(F.col(value), (F.col("_prev") + F.col("_next")) / 2).alias(value),
                       F.col(value).isNull().alias("repaired"))
