"""Numeric expressions: coordinate keys, safe ratios, log transforms, errors."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .calendar import col


def scaled_coord(c) -> Column:
    """coordinate rounded to 3 decimals, times 10, as an integer join key."""
    return F.round(F.round(col(c), 3) * 10, 3).cast("bigint")


def ratio(num, den) -> Column:
    """``num / den`` that is null (not an error) when ``den`` is 0 or null."""
    return F.try_divide(col(num), col(den))


def log1p(c) -> Column:
    """F12."""
    return F.log1p(col(c))


def expm1(c) -> Column:
    """F12 inverse."""
    return F.expm1(col(c))


def double_log(c, mean) -> Column:
    """``log1p(log1p(x / mean))``."""
    return F.log1p(F.log1p(ratio(c, mean)))


def double_log_inverse(c, mean) -> Column:
    return F.expm1(F.expm1(col(c))) * col(mean)


def error_columns(pred: str = "prediction", truth: str = "target") -> list[Column]:
    """error, squared error and fractional error ``err / (truth + 1)``."""
    err = col(pred) - col(truth)
    return [err.alias("error"), (err * err).alias("sq_error"),
            ratio(err, col(truth) + 1).alias("frac_error")]


def flags_as_int(df: DataFrame, cols) -> DataFrame:
    """boolean/integer key alignment before a join."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def apply_transform(df: DataFrame, columns, fn) -> DataFrame:
    """apply a named column transform to each listed column in one projection.

    Each column gets its own result (the reference wrote column 0 into all of them, D2).
    """
    return df.withColumns({c: fn(F.col(c)) for c in columns})


TRANSFORMS = {
    "log1p": (F.log1p, F.expm1),
    "identity": (lambda c: c, lambda c: c),
}


def forward(df: DataFrame, columns, name: str = "log1p") -> DataFrame:
    return apply_transform(df, columns, TRANSFORMS[name][0])


def inverse(df: DataFrame, columns, name: str = "log1p") -> DataFrame:
    return apply_transform(df, columns, TRANSFORMS[name][1])
