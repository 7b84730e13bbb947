"""Query registry: name -> (Spark callable, oracle SQL or None)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from .fixtures import with_fixtures

REGISTRY: dict[str, tuple[Callable, str | None]] = {}


def query(name: str, sql: str | None = None, fixtures=()):
    def deco(fn):
        REGISTRY[name] = (fn, with_fixtures(sql, *fixtures) if sql else None)
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6, cols=None) -> DataFrame:
    """Report projection: round double columns so two engines hash alike.

    Written as ``round(x * 10^d) / 10^d`` on the binary double, the same steps
    DuckDB's ``round(x, d)`` takes (Spark's decimal rounding differs at ties)."""
    cols = cols or [c for c, t in df.dtypes if t in ("double", "float")]
    scale = float(10 ** digits)
    return df.withColumns({c: F.round(F.col(c) * scale) / scale for c in cols})
