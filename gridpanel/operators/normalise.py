"""Target normalisation and group statistics.

Fit and apply are separate: a fitted statistic is a small DataFrame (one row
per group) saved with the model and left-joined when applying, so scoring
data never recomputes it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numeric import ratio
from .sizing import checked_broadcast, key_bound


def normalise_by_capacity(df: DataFrame, mode: str = "train", value: str = "target",
                          capacity: str = "installed_capacity") -> DataFrame:
    """``target / installed_capacity`` in train mode; passthrough at inference.
    Zero or null capacity gives null (no error)."""
    if mode != "train":
        return df
    return df.withColumn(value, ratio(value, capacity))


def denormalise_by_capacity(df: DataFrame, value: str = "prediction",
                            capacity: str = "installed_capacity") -> DataFrame:
    """F14 inverse (always returns the frame, D3)."""
    return df.withColumn(value, F.col(value) * F.col(capacity))


def group_max(df: DataFrame, keys=("prediction_unit_id",), value: str = "target",
              name: str = "max_value") -> DataFrame:
    """G1: max per key; partial aggregation before the shuffle."""
    return df.groupBy(*keys).agg(F.max(value).alias(name))


def with_group_stat(df: DataFrame, keys, value: str = "target", fn: str = "max",
                    name: str | None = None) -> DataFrame:
    """J11 (one pass): group statistic on every row via aggregate + join back.

    The aggregate is map-side combined, so a hot group costs no more than any
    other; a window over the group would place it whole in one task. The
    statistic is broadcast if its counted size allows, so rows do not move.
    """
    name = name or f"{fn}_{value}"
    stat = df.groupBy(*keys).agg(getattr(F, fn)(value).alias(name))
    return df.join(checked_broadcast(stat, proven_rows=key_bound(df, keys)), list(keys), "left")


def apply_unit_max(df: DataFrame, max_values: DataFrame, keys=("prediction_unit_id",),
                   value: str = "target", fill_unseen: bool = True) -> DataFrame:
    """F15 forward: divide by the saved unit max.

    The reference filled NaN with 1.0 after the join, which left unseen units
    null (D4); ``fill_unseen`` uses 1.0 for them instead, and
    ``fill_unseen=False`` keeps the reference's null.
    """
    mv = checked_broadcast(max_values)
    j = df.join(mv, list(keys), "left")
    m = F.coalesce(F.nanvl(F.col("max_value"), F.lit(1.0)), F.lit(1.0)) if fill_unseen \
        else F.nanvl(F.col("max_value"), F.lit(1.0))
    return j.withColumn(value, ratio(F.col(value), m)).drop("max_value")


def invert_unit_max(df: DataFrame, max_values: DataFrame, keys=("prediction_unit_id",),
                    value: str = "target") -> DataFrame:
    """F15 inverse: multiply by the saved unit max."""
    mv = checked_broadcast(max_values)
    return (df.join(mv, list(keys), "left")
            .withColumn(value, F.col(value) * F.col("max_value")).drop("max_value"))


def normalise_by_eic(df: DataFrame, value: str = "target") -> DataFrame:
    """F16: value per EIC."""
    return df.withColumn(value, ratio(value, "eic_count"))


def segment_mean_double_log(df: DataFrame, keys=("is_business", "product_type"),
                            value: str = "target") -> DataFrame:
    """F13 + F16: divide by the segment mean, then ``log1p`` twice."""
    j = with_group_stat(df, keys, value, "avg", "segment_mean")
    return j.withColumn(f"{value}_dlog", F.log1p(F.log1p(ratio(value, "segment_mean"))))


def fill_nan(df: DataFrame, cols, value: float = 1.0) -> DataFrame:
    """NaN -> value; nulls untouched."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(value)) for c in cols})


def centre_by_group(df: DataFrame, keys, value: str) -> DataFrame:
    """Subtract each group's mean (long form)."""
    j = with_group_stat(df, keys, value, "avg", "_mean")
    return j.withColumn(f"{value}_centred", F.col(value) - F.col("_mean")).drop("_mean")


def window_group_max(df: DataFrame, keys, value: str = "target") -> DataFrame:
    """J11 as a window, for small bounded groups only (e.g. 24 hours of a day)."""
    return df.withColumn(f"max_{value}", F.max(value).over(Window.partitionBy(*keys)))
