"""Exact-time lag features.

The history is shifted forward by each lag, the lags are folded into one row
per (unit, direction, hour) by a grouped aggregate, and the features are left
joined once on the exact key. A missing history hour gives a null lag, never
the previous row's value (so no row-offset ``lag()``).

At scale: the history is shuffled once (one copy per lag, map-side partially
aggregated) and the feature table once, both hashed on the full key
(unit, direction, hour), so a unit holding a third of all rows still spreads
over all tasks; a per-unit window would put it in one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import PANEL_KEY
from ..sources.tables import drop_null_rows, fill_numeric_nulls


def shifted_history(history: DataFrame, value: str = "target", days=(2, 7),
                    key=PANEL_KEY) -> DataFrame:
    """One row per key hour *receiving* the lags: ``<value>_<d>d_ago`` columns.

    Where the history holds a key hour more than once, its largest value counts."""
    *ids, ts = key
    exploded = (history.select(*ids, ts, value)
                .select(*ids, value, F.explode(F.array(*[F.lit(d) for d in days])).alias("_lag"),
                        F.col(ts).alias("_ts"))
                .select(*ids, value, "_lag",
                        (F.col("_ts") + F.make_dt_interval(F.col("_lag"))).alias(ts)))
    return exploded.groupBy(*ids, ts).agg(
        *[F.max(F.when(F.col("_lag") == d, F.col(value))).alias(f"{value}_{d}d_ago") for d in days])


def add_lags(features: DataFrame, history: DataFrame, value: str = "target", days=(2, 7),
             mode: str = "inference", key=PANEL_KEY) -> DataFrame:
    """Value exactly ``d`` days earlier for the same unit and direction.

    ``mode='train'`` drops rows with any null (lags missing); inference fills
    numeric nulls with 0.
    """
    out = features.join(shifted_history(history, value, days, key), list(key), "left")
    if mode == "train":
        return drop_null_rows(out)
    return fill_numeric_nulls(out)


def add_lag_inner(features: DataFrame, history: DataFrame, value: str = "target", days: int = 2,
                  key=PANEL_KEY) -> DataFrame:
    """A single lag; rows without it are removed (inner join)."""
    lagged = shifted_history(history, value, (days,), key)
    return features.join(lagged, list(key), "inner")


def add_lags_clustered(features: DataFrame, history: DataFrame, value: str = "target", days=(2, 7),
                       mode: str = "inference", key=PANEL_KEY) -> DataFrame:
    """J3 on a history clustered by the full key (``sinks.write_clustered`` with ``value``, one row a key).

    The features look for the hour ``d`` days before their own, so the join is
    on the history's own keys and its side is read bucket by bucket, without an
    exchange; the features move once per lag. For blocks that are small beside
    the history. Same rows as ``add_lags``."""
    *ids, ts = key
    held = history.select(*[F.col(c).alias(f"_h_{c}") for c in key], F.col(value).alias("_value"))
    out = features
    for d in days:
        asked = out.withColumn("_want", F.col(ts) - F.make_dt_interval(F.lit(d)))
        same = [F.col(c) == F.col(f"_h_{c}") for c in ids] + [F.col("_want") == F.col(f"_h_{ts}")]
        out = asked.join(held, same, "left").select(*out.columns, F.col("_value").alias(f"{value}_{d}d_ago"))
    return drop_null_rows(out) if mode == "train" else fill_numeric_nulls(out)
