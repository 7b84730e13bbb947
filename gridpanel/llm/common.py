"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names (all executors share it)."""
    master = spark.sparkContext.master or ""
    base = ensure_checkpoint_dir(spark, allow_local=master.startswith("local[") or master == "local")
    return f"{base.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back with its schema."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, col: str, max_bytes: int):
    """Row slices of ``batch`` whose ``col`` holds about ``max_bytes`` bytes; a longer value is a slice of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes + 16)
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lens[i] - 1`` of every ``i``, laid end to end."""
    total = int(lens.sum())
    before = np.cumsum(lens) - lens
    return np.repeat(starts - before, lens) + np.arange(total)
