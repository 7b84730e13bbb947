"""Truth history, block replay as one set-based plan, submission assembly
(T1, T2, T4, U1, J13, J20, S6)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schemas import PANEL_KEY
from ..sources.tables import fill_numeric_nulls


def update_history(history: DataFrame, new: DataFrame, key=PANEL_KEY, value: str = "target",
                   per_series_mark: bool = False) -> DataFrame:
    """Append the new rows strictly newer than the latest hour already held, then
    drop full duplicates.

    ``per_series_mark=False`` reproduces the global mark (a slow unit's late rows
    are dropped for every unit); ``True`` keeps each series' own mark, and rows
    of series not yet in the history are all kept."""
    *ids, ts = key
    cols = [*key, value]
    h, n = history.select(*cols), new.select(*cols)
    if per_series_mark:
        marks = h.groupBy(*ids).agg(F.max(ts).alias("_mark"))
        fresh = n.join(marks, ids, "left").filter(F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))) \
            .drop("_mark")
    else:
        mark = h.select(F.max(ts)).scalar()
        fresh = n.filter(F.col(ts) > mark)
    return h.unionByName(fresh).distinct()


def extend_clustered_history(history: DataFrame, new: DataFrame, key=PANEL_KEY, value: str = "target") -> DataFrame:
    """T1 with the global mark on a history clustered by the key: its duplicates go bucket by bucket and only the new
    rows move. New rows are newer than every held one, so the two parts share no row. Same rows as ``update_history``."""
    *ids, ts = key
    cols = [*key, value]
    mark = history.select(F.max(ts)).scalar()
    fresh = new.select(*cols).filter(F.col(ts) > mark)
    return history.select(*cols).distinct().unionByName(fresh.distinct())


def with_reveal_block(truth: DataFrame, delay_blocks: int = 2) -> DataFrame:
    """Block in which a truth row becomes known (revealed ``delay_blocks`` later)."""
    return truth.withColumn("revealed_block", F.col("data_block_id") + delay_blocks)


def visible_lags(rows: DataFrame, truth: DataFrame, days=(2, 7), value: str = "target",
                 key=PANEL_KEY, block: str = "data_block_id") -> DataFrame:
    """T2 lag features as seen by the block loop: the value ``d`` days earlier
    counts only if it was revealed in a block not after the row's own block. A
    truth hour revealed more than once counts as it was first revealed.

    One shuffle of the (exploded) truth and one of the rows, on the full key."""
    *ids, ts = key
    ex = (truth.select(*ids, ts, value, "revealed_block")
          .select(*ids, value, "revealed_block", F.explode(F.array(*[F.lit(d) for d in days])).alias("_lag"),
                  F.col(ts).alias("_ts"))
          .select(*ids, value, "revealed_block", "_lag", (F.col("_ts") + F.make_dt_interval(F.col("_lag"))).alias(ts)))
    agg = ex.groupBy(*ids, ts).agg(
        *[F.min(F.when(F.col("_lag") == d, F.struct("revealed_block", value))).alias(f"_seen{d}") for d in days])
    j = rows.join(agg, list(key), "left")
    return j.withColumns({f"{value}_{d}d_ago": F.when(F.col(f"_seen{d}.revealed_block") <= F.col(block), F.col(f"_seen{d}.{value}"))
                          for d in days}).drop(*[f"_seen{d}" for d in days])


def persistence_backtest(test: DataFrame, truth: DataFrame, delay_blocks: int = 2, keep=()) -> DataFrame:
    """T2 with the simplest scorer: every test row of every block predicted by the
    value two days earlier as known at that block (0 when not known, T4 inference rule)."""
    lagged = visible_lags(test, with_reveal_block(truth, delay_blocks), (2,))
    out = lagged.select("row_id", "data_block_id", *keep, F.col("target_2d_ago").alias("prediction"))
    return fill_numeric_nulls(out, cols=["prediction"])


def complete_submission(template: DataFrame, predictions: DataFrame) -> DataFrame:
    """J13 + U1: predictions (any number of parts, e.g. both directions) left-joined
    onto the template's rows by ``row_id``; the template's target replaced, missing -> 0.0."""
    parts = predictions if isinstance(predictions, (list, tuple)) else [predictions]
    allp = parts[0].select("row_id", "prediction")
    for p in parts[1:]:
        allp = allp.unionByName(p.select("row_id", "prediction"))
    t = template.drop("target")
    return (t.join(allp, "row_id", "left")
            .withColumn("target", F.coalesce(F.col("prediction"), F.lit(0.0))).drop("prediction"))


def night_zero(rows: DataFrame, day_predictions: DataFrame) -> DataFrame:
    """Predictions made for daylight rows only, left-joined onto all rows; night -> 0."""
    return (rows.join(day_predictions.select("row_id", "prediction"), "row_id", "left")
            .withColumn("prediction", F.coalesce(F.col("prediction"), F.lit(0.0))))
