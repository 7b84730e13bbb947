"""Size-checked broadcast.

A dimension or statistic side of a join is stored first (a table in the shared
folder, so it is computed once), and its rows are counted by the
same job. If rows times row width is within the bound, the join gets a broadcast
hint, and the fact table keeps its partitioning: it never shuffles on a date,
an hour or a key of a few values. Beyond the bound the side joins by shuffle,
where adaptive execution splits skewed keys.

A side whose row count follows from its key types (booleans) needs no count.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from ..session import cut_lineage

BROADCAST_BYTES = 32 << 20


def row_bytes(schema: T.StructType) -> int:
    """Estimated width of a row: 8 bytes a value, 64 for strings and nested values."""
    flat = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return 16 + sum(8 if isinstance(f.dataType, flat) else 64 for f in schema.fields)


def stored(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read back, and its number of rows, from one job."""
    seen = Observation()
    kept = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return kept, seen.get["n"]


def dimension(df: DataFrame) -> DataFrame:
    """A side that several joins use: stored and counted once. It remembers its count (``counted_rows``), so that a
    join which only picks or renames its columns need not store it again."""
    kept, n = stored(df)
    kept.counted_rows = n
    return kept


def counted_rows(df: DataFrame) -> int | None:
    """The count that ``dimension`` took of this frame, if it made it."""
    return df.__dict__.get("counted_rows")


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, proven_rows: int | None = None,
                      counted: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted (or proven) size is within ``max_bytes``, else as a stored table.

    ``counted``: rows of the stored table that ``df`` picks columns of."""
    width = row_bytes(df.schema)
    if counted is not None:
        return F.broadcast(df) if counted * width <= max_bytes else df
    if proven_rows is not None and proven_rows * width <= max_bytes:
        return F.broadcast(df)
    if df.isStreaming:
        return df
    kept, n = stored(df)
    return F.broadcast(kept) if n * width <= max_bytes else kept


def key_bound(df: DataFrame, keys) -> int | None:
    """Most distinct key values that the key types allow (booleans and null), if they bound it."""
    kinds = dict(df.dtypes)
    return 3 ** len(keys) if all(kinds[k] == "boolean" for k in keys) else None
