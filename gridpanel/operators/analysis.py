"""Residual and trajectory analysis (A1 PCA, A2 autocorrelation)."""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..session import cut_lineage


ROWS = 512          # series, or buckets of them, that a task holds as dense arrays at once


def _flat(*columns):
    """Row numbers, and the elements of each column of arrays (null: none) end to end. Arrays of numbers, and not of
    structs, reach Python as they are, without an object for each element."""
    size = [0 if a is None else len(a) for a in columns[0]]
    whole = [np.concatenate([np.empty(0), *[a for a in c if a is not None]]) for c in columns]
    return np.repeat(np.arange(len(size)), size), whole[0].astype("int64"), *whole[1:]


def acf(df: DataFrame, keys, ts: str, value: str, nlags: int = 72) -> DataFrame:
    """A2: autocorrelation per series at lags 1..nlags hours,
    ``sum_t (x_t - m)(x_{t+k} - m) / sum_t (x_t - m)^2`` over exact-time pairs.

    Each series is cut into buckets of ``nlags`` hours, one array per bucket. A
    bucket joins the next one, which together hold every pair that starts in
    it, and gives its ``nlags`` lag sums at once; those are summed per series.
    Rows move once, and a long or hot series spreads over its buckets. The
    series' mean comes off at the end, from the sums of the pairs' sides, so no
    row meets its series; values are first taken relative to the mean of all,
    so that little cancels."""
    keys = list(keys)
    x = df.select(*keys, F.timestamp_diff("HOUR", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts)).alias("_h"),
                  F.col(value).cast("double").alias("_c")).filter(F.col("_c").isNotNull() & F.col("_h").isNotNull())
    level = x.select(F.coalesce(F.avg(F.when(~F.isnan("_c"), F.col("_c"))), F.lit(0.0))).scalar()
    bucket = F.floor(F.col("_h") / nlags)
    cells = x.groupBy(*keys, bucket.alias("_b")).agg(
        F.collect_list(F.struct((F.col("_h") - bucket * nlags).cast("int").alias("i"), (F.col("_c") - level).alias("c"))).alias("_x"))
    later = cells.select(*keys, (F.col("_b") - 1).alias("_b"), F.col("_x").alias("_y"))
    both = cells.join(later, [*keys, "_b"], "left")
    sums_of = ("num", "left", "right", "pairs")
    schema = T.StructType([*df.select(*keys).schema.fields, T.StructField("lag", T.IntegerType()),
                           *[T.StructField(n, T.DoubleType()) for n in sums_of]])

    def sums(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), ROWS):
                part = pdf.iloc[lo:lo + ROWS]
                x, seen = np.zeros((len(part), 2 * nlags)), np.zeros((len(part), 2 * nlags))
                squares = None
                for side, of in ((0, "x"), (nlags, "y")):
                    r, i, c = _flat(part[f"_{of}i"], part[f"_{of}c"])
                    np.add.at(x, (r, i + side), c)
                    np.add.at(seen, (r, i + side), 1)
                    squares = np.bincount(r, c * c, len(part)) if side == 0 else squares
                own, here = x[:, :nlags], seen[:, :nlags]
                by_lag = lambda f: np.stack([f(k) for k in range(nlags + 1)], 1)                       # noqa: E731
                num = by_lag(lambda k: (own * x[:, k:k + nlags]).sum(1))
                pairs = by_lag(lambda k: (here * seen[:, k:k + nlags]).sum(1))
                left = by_lag(lambda k: (own * seen[:, k:k + nlags]).sum(1))
                right = by_lag(lambda k: (here * x[:, k:k + nlags]).sum(1))
                # lag 0 is about single rows: their squares, their sum, their number
                num[:, 0] = squares
                left[:, 0] = right[:, 0] = own.sum(1)
                pairs[:, 0] = here.sum(1)
                r, k = np.nonzero(pairs)
                yield pd.DataFrame({**{c_: part[c_].to_numpy()[r] for c_ in keys}, "lag": k.astype("int32"),
                                    **{n: v[r, k] for n, v in zip(sums_of, (num, left, right, pairs))}})

    arrays = both.select(*keys, *[F.col(f"_{of}")[f].alias(f"_{of}{f}") for of in "xy" for f in "ic"])
    total = arrays.mapInPandas(sums, schema).groupBy(*keys, "lag").agg(*[F.sum(n).alias(f"_{n}") for n in sums_of])
    mean = F.col("_left") / F.col("_pairs")
    whole = total.filter("lag = 0").select(*keys, mean.alias("_m"), (F.col("_num") - mean * F.col("_left")).alias("_den"))
    about = F.col("_num") - F.col("_m") * (F.col("_left") + F.col("_right")) + F.col("_pairs") * F.col("_m") * F.col("_m")
    return total.filter("lag > 0").join(whole, keys).select(*keys, "lag", F.try_divide(about, F.col("_den")).alias("acf"))


def pacf_from_acf(acf_df: DataFrame, keys, nlags: int = 72) -> DataFrame:
    """A2: partial autocorrelation by the Durbin-Levinson recursion, per series on
    its (at most ``nlags``-row) ACF table; missing lags count as 0.

    A series is one row with its lags; the recursion runs over all series of a batch at once."""
    keys = list(keys)
    schema = T.StructType([*acf_df.select(*keys).schema.fields, T.StructField("lag", T.IntegerType()), T.StructField("pacf", T.DoubleType())])
    lags = F.collect_list(F.struct(F.col("lag").cast("int").alias("k"), F.coalesce(F.col("acf").cast("double"), F.lit(float("nan"))).alias("r")))
    series = (acf_df.groupBy(*keys).agg(F.filter(lags, lambda v: v["k"].between(1, nlags)).alias("_r"))
              .select(*keys, F.col("_r")["k"].alias("_k"), F.col("_r")["r"].alias("_r")))

    def run(batches):
        for pdf in batches:
            for lo in range(0, len(pdf), ROWS):
                part = pdf.iloc[lo:lo + ROWS]
                n = len(part)
                r = np.zeros((n, nlags + 1))
                row, k, value = _flat(part["_k"], part["_r"])
                good = np.isfinite(value)
                r[row[good], k[good]] = value[good]
                out, phi, var, live = np.zeros((n, nlags + 1)), np.zeros((n, nlags + 1)), np.ones(n), np.ones(n, bool)
                for k in range(1, nlags + 1):
                    live &= var > 0
                    a = np.where(live, (r[:, k] - (phi[:, 1:k] * r[:, 1:k][:, ::-1]).sum(1)) / np.where(live, var, 1.0), 0.0)
                    phi[:, 1:k] -= a[:, None] * phi[:, 1:k][:, ::-1].copy()
                    phi[:, k] = out[:, k] = a
                    var = var * (1 - a * a)
                yield pd.DataFrame({**{c: np.repeat(part[c].to_numpy(), nlags) for c in keys}, "lag": np.tile(np.arange(1, nlags + 1, dtype="int32"), n),
                                    "pacf": out[:, 1:].ravel()})

    return series.mapInPandas(run, schema)


def date_range(df: DataFrame, date_col: str) -> list:
    """All dates between the data's first and last (two values reach the driver; a calendar's length)."""
    lo, hi = df.agg(F.min(date_col), F.max(date_col)).first()
    return [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)] if lo is not None else []


MAX_DATES = 4096            # of a PCA: the driver holds a dates x dates matrix (eleven years of days)


def trajectories(df: DataFrame, unit, date_col: str, value: str, dates) -> DataFrame:
    """A1 input: ``unit..., trajectory``: one row per unit (a column or several), its daily means less their own mean,
    an array with an element per date (days without a value: 0, the mean).

    Dates are places of an array and not columns, so a plan is as wide for ten
    years as for ten days. Stored, as a PCA passes over it several times."""
    unit = [unit] if isinstance(unit, str) else list(unit)
    if len(dates) > MAX_DATES:
        raise ValueError(f"{len(dates)} dates; at most {MAX_DATES} are taken")
    first, n = (dates[0] if dates else None), len(dates)
    daily = (df.groupBy(*unit, F.date_diff(date_col, F.lit(first).cast("date")).alias("_i")).agg(F.avg(value).alias("_v"))
             .filter(F.col("_v").isNotNull() & F.col("_i").between(0, n - 1)))
    cells = daily.groupBy(*unit).agg(F.avg("_v").alias("_m"), F.collect_list(F.struct("_i", "_v")).alias("_d"))
    schema = T.StructType([*df.select(*unit).schema.fields, T.StructField("trajectory", T.ArrayType(T.DoubleType(), False))])

    def dense(batches):
        for pdf in batches:
            x = np.zeros((len(pdf), n))
            for r, (cell, m) in enumerate(zip(pdf["_d"], pdf["_m"])):
                for d in cell:
                    x[r, d["_i"]] = d["_v"] - m
            yield pdf[unit].assign(trajectory=list(x))

    return cut_lineage(cells.mapInPandas(dense, schema))


@dataclass
class TrajectoryPCA:
    """A PCA over units: ``axes`` (dates x k) and ``means`` by date, the share of the variance that each axis takes and
    the variance (sum over dates, divisor n - 1)."""
    axes: np.ndarray
    means: np.ndarray
    explained: np.ndarray
    variance: float


def fit_pca(x: DataFrame, k: int = 10) -> TrajectoryPCA:
    """A1: principal components of ``trajectories`` over units; ``k`` is cut to the number of dates."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.stat import Summarizer
    v = x.select(array_to_vector("trajectory").alias("_x"))
    stats = v.select(Summarizer.metrics("mean", "variance").summary(F.col("_x")).alias("s")).select("s.mean", "s.variance").first()
    model = PCA(k=min(k, len(stats["mean"])), inputCol="_x", outputCol="_p").fit(v)
    return TrajectoryPCA(model.pc.toArray(), stats["mean"].toArray(), model.explainedVariance.toArray(), float(stats["variance"].toArray().sum()))


def pca_reconstruct(x: DataFrame, unit, dates, k: int = 10, column_means: bool = False, model: TrajectoryPCA | None = None) -> DataFrame:
    """A1: each unit of ``trajectories`` rebuilt from its projection on ``k`` components. The date means that PCA takes
    away are not added back, as in the reference, unless ``column_means``. Returns long ``unit..., date, value,
    reconstructed``; nothing for an empty table."""
    unit = [unit] if isinstance(unit, str) else list(unit)
    labels = np.array([str(d) for d in dates], dtype=object)
    schema = T.StructType([*x.select(*unit).schema.fields, T.StructField("date", T.StringType()),
                           T.StructField("value", T.DoubleType()), T.StructField("reconstructed", T.DoubleType())])
    if model is None:
        if x.isEmpty():
            return x.sparkSession.createDataFrame([], schema)
        model = fit_pca(x, k)
    axes, means = model.axes, model.means

    def recon(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            m = np.stack(pdf["trajectory"])
            r = ((m - means) @ axes) @ axes.T + (means if column_means else 0.0)
            yield pd.DataFrame({**{c: np.repeat(pdf[c].to_numpy(), len(labels)) for c in unit}, "date": np.tile(labels, len(pdf)),
                                "value": m.ravel(), "reconstructed": r.ravel()})

    return x.select(*unit, "trajectory").mapInPandas(recon, schema)
