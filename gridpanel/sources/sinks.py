"""Sinks (S5, S6)."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None,
                mode: str = "overwrite") -> None:
    """Derived tables as parquet (default) or CSV with header, optionally partitioned."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def append_submission(df: DataFrame, path: str) -> None:
    """Append one block's ``row_id, target`` to the submission folder (CSV)."""
    df.select("row_id", "target").write.mode("append").option("header", True).csv(path)


def write_clustered(df: DataFrame, path: str, keys, buckets: int, value: str | None = None) -> DataFrame:
    """S5 as a clustered table: rows hashed by ``keys`` into ``buckets``, sorted within them, and the table opened.

    Joins and groupings on these keys (a group by more keys included) then read
    the table without an exchange; only the other side moves. Choose buckets of
    a few hundred MB; one task writes a bucket, so each is one sorted file.
    ``value``: keep one row a key, that of the largest value, so that a join
    adds no rows. The table is external, under a fresh name of the session's
    catalog; ``open_clustered`` finds the folder in another session."""
    keys = list(keys)
    if value is not None:
        df = df.groupBy(*keys).agg(F.max(value).alias(value))
    name = f"clustered_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def open_clustered(spark: SparkSession, path: str, schema, keys, buckets: int) -> DataFrame:
    """A folder that ``write_clustered`` filled, in a session whose catalog does not know it."""
    name, names = f"clustered_{uuid.uuid4().hex}", ", ".join(f"`{k}`" for k in keys)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(name)


def write_submission_block(df: DataFrame, path: str, block: int) -> None:
    """S6, safe to repeat: the submission rows of one block in ``path/block=N``, which a second call overwrites."""
    df.select("row_id", "target").write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/block={block}")


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    """All blocks of a submission: ``row_id, target, block``."""
    return (spark.read.schema("row_id long, target double, block int").option("header", True).csv(path))
