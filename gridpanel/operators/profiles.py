"""Profiles and accuracy aggregates.

All are grouped aggregates with map-side partial aggregation. Exact medians
run only on bounded groups (a unit's day); ``approx=True`` switches to
``percentile_approx``, and ``daily_sketches`` keeps mergeable sketches, for
unbounded ones.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import hour_of_day


def hourly_fraction_profile(df: DataFrame, value: str = "target", by=("is_consumption",)) -> DataFrame:
    """Min and mean of a (normalised) value by hour of day x ``by``."""
    return (df.groupBy(hour_of_day("prediction_datetime").alias("hour"), *by)
            .agg(F.min(value).alias(f"min_{value}"), F.avg(value).alias(f"mean_{value}")))


def daily_mean_by(df: DataFrame, by, value: str = "target", ts: str = "prediction_datetime") -> DataFrame:
    """Mean by day x category."""
    return df.groupBy(F.to_date(ts).alias("date"), *by).agg(F.avg(value).alias(f"mean_{value}"))


def daily_mean_std(df: DataFrame, keys=("prediction_unit_id", "is_consumption"), value: str = "target",
                   ts: str = "prediction_datetime") -> DataFrame:
    """Daily mean and sample std per series."""
    return (df.groupBy(*keys, F.to_date(ts).alias("date"))
            .agg(F.avg(value).alias("daily_mean"), F.stddev_samp(value).alias("daily_std")))


def second_level(daily: DataFrame, keys=("prediction_unit_id",)) -> DataFrame:
    """Mean and std of the daily means per unit."""
    return daily.groupBy(*keys).agg(F.avg("daily_mean").alias("mean_of_daily_mean"),
                                    F.stddev_samp("daily_mean").alias("std_of_daily_mean"))


def daily_mean_var_median(df: DataFrame, keys=("prediction_unit_id",), value: str = "target",
                          per_eic: bool = False, ts: str = "prediction_datetime",
                          approx: bool = False) -> DataFrame:
    """Daily mean, sample variance (named ``daily_var``; the reference called it
    ``daily_std``, D9) and median eic_count; optionally value / eic_count first."""
    v = F.try_divide(F.col(value), F.col("eic_count")) if per_eic else F.col(value)
    med = F.percentile_approx("eic_count", 0.5) if approx else F.median("eic_count")
    return (df.groupBy(*keys, F.to_date(ts).alias("date"))
            .agg(F.avg(v).alias("daily_mean"), F.var_samp(v).alias("daily_var"), med.alias("eic_count")))


def daily_medians(df: DataFrame, keys=("prediction_unit_id",), cols=("prediction", "target"),
                  ts: str = "prediction_datetime", log_space: bool = False) -> DataFrame:
    """Daily median (exact, interpolated) of prediction and truth per unit,
    plus the daily mean of the truth for comparison."""
    def tr(c):
        return F.log1p(F.col(c)) if log_space else F.col(c)
    return (df.groupBy(*keys, F.to_date(ts).alias("date"))
            .agg(*[F.median(tr(c)).alias(f"median_{c}") for c in cols],
                 F.avg(tr(cols[-1])).alias(f"mean_{cols[-1]}")))


SKETCH_K = 800              # of the KLL sketches: a few KB each
RANK_ERROR = 0.01           # bound of the error in rank that SKETCH_K keeps (some 0.4 % is expected at 99 % confidence)


def daily_sketches(df: DataFrame, keys=("prediction_unit_id",), cols=("target",), ts: str = "prediction_datetime",
                   k: int = SKETCH_K) -> DataFrame:
    """G6/G7 for groups without bound: ``keys..., date`` and a mergeable quantile sketch ``<col>_sketch`` of each
    column's non-null, non-NaN values.

    A sketch is bounded whatever its group's size and is built before the
    shuffle, so a hot unit or day moves as a few KB per task. Store the result
    by date: a new day adds its rows, and any span of days is answered from
    them (``merged_quantiles``) without reading the values again."""
    values = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols]
    return df.groupBy(*keys, F.to_date(ts).alias("date")).agg(
        *[F.kll_sketch_agg_double(v, F.lit(k)).alias(f"{c}_sketch") for c, v in zip(cols, values)])


def merged_quantiles(sketches: DataFrame, keys=("prediction_unit_id",), cols=("target",), quantiles=(0.5,)) -> DataFrame:
    """``keys...`` and, of each column, ``<col>_n`` and ``<col>_q`` (an array, one value per quantile), from sketches
    merged over their days. A group without a value has n 0 and null. Values are members of the group, so with an even
    count the median is one of the two middle values; ranks are within ``RANK_ERROR`` of those asked for."""
    merged = sketches.groupBy(*keys).agg(*[F.kll_merge_agg_double(f"{c}_sketch").alias(f"_{c}") for c in cols])
    out = []
    for c in cols:
        n = F.coalesce(F.kll_sketch_get_n_double(f"_{c}"), F.lit(0))
        out += [n.alias(f"{c}_n"), F.when(n > 0, F.array(*[F.kll_sketch_get_quantile_double(f"_{c}", F.lit(float(q))) for q in quantiles])).alias(f"{c}_q")]
    return merged.select(*keys, *out)


def rank_errors(df: DataFrame, estimates: DataFrame, keys, value: str, estimate: str, quantile: float) -> DataFrame:
    """``keys..., n, rank_error``: how far an estimated quantile is, in rank, from the exact one. The share of values
    below the estimate and the share not above it enclose the ranks it stands for; the error is the distance to them."""
    v, e = F.col(value), F.col(estimate)
    known = estimates.select(*keys, estimate)
    shares = (df.filter(v.isNotNull() & ~F.isnan(v)).join(known, list(keys)).groupBy(*keys)
              .agg(F.count(F.lit(1)).alias("n"), F.avg((v < e).cast("double")).alias("_below"), F.avg((v <= e).cast("double")).alias("_upto")))
    q = F.lit(float(quantile))
    return shares.select(*keys, "n", F.greatest(F.lit(0.0), F.col("_below") - q, q - F.col("_upto")).alias("rank_error"))


def collapse_repeats(df: DataFrame, keys=("row_id", "prediction_unit_id")) -> DataFrame:
    """Mean of every numeric column over repeated rows of a key."""
    num = [c for c, t in df.dtypes if c not in keys and t in ("double", "float", "int", "bigint")]
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in num])


def time_bounds(df: DataFrame, ts: str) -> DataFrame:
    """One-row (min, max)."""
    return df.agg(F.min(ts).alias("start"), F.max(ts).alias("end"))


def rmse(df: DataFrame, pred: str = "prediction", truth: str = "target", by=()) -> DataFrame:
    """G11."""
    err = F.col(pred) - F.col(truth)
    return df.groupBy(*by).agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n"))


def r_squared(df: DataFrame, pred: str = "prediction", truth: str = "target", by=()) -> DataFrame:
    """``1 - SS_res / SS_tot`` in one pass, over rows where both are non-null. The total is the population
    variance times n, whose running update does not cancel as a difference of large sums does."""
    y, e = F.col(truth), F.col(pred) - F.col(truth)
    g = df.filter(y.isNotNull() & F.col(pred).isNotNull()).groupBy(*by).agg(
        F.sum(e * e).alias("_ssr"), F.var_pop(y).alias("_var"), F.count(F.lit(1)).alias("_n"))
    return g.select(*by, (1 - F.try_divide(F.col("_ssr"), F.col("_var") * F.col("_n"))).alias("r2"))


def histogram(df: DataFrame, value: str, bins: int = 15) -> DataFrame:
    """Fixed-width bins between the data's min and max (max falls in the last bin)."""
    b = df.select(F.min(value).alias("lo"), F.max(value).alias("hi"))
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    width = (hi - lo) / bins
    idx = F.least(F.floor(F.try_divide(F.col(value) - lo, width)), F.lit(bins - 1)).cast("int")
    return (df.filter(F.col(value).isNotNull())
            .groupBy(F.coalesce(idx, F.lit(0)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (lo + F.col("bin") * width).alias("left_edge"), "n"))


def mean_per_date(df: DataFrame, value: str, ts: str) -> DataFrame:
    """G14."""
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.avg(value).alias(f"mean_{value}"))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """G15."""
    return df.select(c).distinct()


def pivot_series(df: DataFrame, index, units, value: str, fn: str = "count", unit: str = "prediction_unit_id",
                 direction: str = "is_consumption") -> DataFrame:
    """One column per (unit, direction), ``<fn>_<unit>_<0|1>``, over declared units: row counts, or an aggregate of
    a value such as an error. Combinations without rows give null (count: 0)."""
    labels = [f"{u}_{d}" for u in units for d in (0, 1)]
    tag = F.concat_ws("_", F.col(unit).cast("string"), F.col(direction).cast("int").cast("string"))
    wide = df.withColumn("_tag", tag).groupBy(*index).pivot("_tag", labels).agg(getattr(F, fn)(value))
    cells = [F.coalesce(F.col(f"`{x}`"), F.lit(0)) if fn == "count" else F.col(f"`{x}`") for x in labels]
    return wide.select(*index, *[c.alias(f"{fn}_{x}") for c, x in zip(cells, labels)])
