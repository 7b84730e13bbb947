"""Target + client assembly and direction split."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import SEGMENT_KEY
from .sizing import checked_broadcast, counted_rows


def assemble_client(target: DataFrame, client: DataFrame, mode: str = "train") -> DataFrame:
    """J1 (train): join client facts of the same day. J2 (inference): facts known
    two days earlier (``date_when_predicting``). Inner join on segment + date.

    Output keeps the target columns, adds ``date`` (date of the hour) and the
    client facts ``eic_count``, ``installed_capacity``.
    """
    t = target.withColumn("date", F.to_date("prediction_datetime"))
    c = client.select(*SEGMENT_KEY, F.col("date").alias("_cdate"), "eic_count", "installed_capacity")
    c = checked_broadcast(c, counted=counted_rows(client))
    day = F.col("date") if mode == "train" else F.col("date_when_predicting")
    cond = [t[k] == c[k] for k in SEGMENT_KEY] + [day == c["_cdate"]]
    return t.join(c, cond, "inner").drop(*[c[k] for k in SEGMENT_KEY]).drop("_cdate")


def with_targets(features: DataFrame, targets: DataFrame, value: str = "target") -> DataFrame:
    """Features next to the truth of the same ``row_id`` (inner join; rows without one go, a repeated id repeats).

    A ``value`` column of the features themselves is replaced."""
    return features.drop(value).join(targets.select("row_id", value), "row_id")


def split_by_direction(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(production, consumption). Prefer keeping ``is_consumption`` as a key."""
    return df.filter(~F.col("is_consumption")), df.filter(F.col("is_consumption"))


def join_on_date_of(left: DataFrame, right: DataFrame, ts: str, right_date: str, keys=(),
                    how: str = "inner") -> DataFrame:
    """Join on the date of a timestamp (computed key); ``right`` is broadcast if its counted size allows."""
    right = checked_broadcast(right)
    cond = [left[k] == right[k] for k in keys] + [F.to_date(left[ts]) == right[right_date]]
    out = left.join(right, cond, how)
    for k in keys:
        out = out.drop(right[k])
    return out


def unit_slice(df: DataFrame, unit, col: str = "prediction_unit_id") -> DataFrame:
    """Rows of one unit (a filter; pushed to the scan when the column is stored)."""
    return df.filter(F.col(col) == unit)
