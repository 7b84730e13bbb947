"""Two-pass external shuffle into shards of equal row counts.

Pass 1 scatters records uniformly into memory-sized buckets by a seeded hash
of their id. Pass 2 loads one bucket at a time, puts it in a canonical order,
Fisher-Yates shuffles it with a generator seeded by (seed, bucket) and writes
it. The bucket's offset (the rows of all earlier buckets) plus the place in
the bucket is a record's place in the global permutation; shard ``s`` holds
the places ``[ceil(s * n / shards), ceil((s + 1) * n / shards))``, so row
counts differ by one at most, slots have no gap, and all but a few buckets
write to one shard.

The result depends on the rows and the seed only, not on input splits, task
order or retries. Rows of an id that is more frequent than a bucket is large
are scattered by a hash of all their columns and of their number among equal
rows: such rows are counted before the shuffle, and the count is dealt out in
pieces, so that a table that is mostly one repeated row spreads like any other.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, shared_path

BUCKET_BYTES = 64 << 20         # text of a bucket on average; its count is one number on the driver
CELLS_PER_BUCKET = 64
PIECE = 4096                    # equal rows that one task deals out


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A random permutation of ``range(n)``: each place, from the last, swaps with one not after it."""
    order = list(range(n))
    picks = rng.integers(0, np.arange(1, n + 1)) if n else []
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def row_size(text: Column) -> Column:
    """Bytes of the UTF-8 text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def shuffle_into_shards(df: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                        seed: int = 11, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all rows of ``df`` under ``path`` (Parquet, a folder for each shard) and return them read back,
    with the columns ``shard`` (int) and ``slot`` (long, from 0 without gaps in each shard).

    Columns of ``df`` that have these names are replaced. Null ids, null and
    empty texts and repeated rows are rows like any other (equal rows differ
    in nothing, so their relative order is no matter); an empty table gives an
    empty result; one huge row is a bucket of its own size."""
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_size(F.col(text_col))), F.lit(0)).alias("b")).first()
    # enough buckets to keep every task busy, and none larger than the bound on average
    buckets = max(4 * parts, -(-total["b"] // bucket_bytes))
    per_bucket = max(1, total["n"] // buckets)
    cells = buckets * CELLS_PER_BUCKET
    # ids with more rows than a bucket: at most ``buckets`` of them, so this side is bounded
    heavy = materialise(df.groupBy(F.col(id_col).alias("__id")).count().filter(F.col("count") > per_bucket + 64)
                        .select("__id", F.lit(True).alias("__heavy")), "heavy-ids")
    place = lambda h: F.floor(F.pmod(h, F.lit(cells)) / CELLS_PER_BUCKET).cast("long")                    # noqa: E731
    columns = [F.col(c) for c in df.columns]
    if heavy.isEmpty():
        scattered = df.withColumn("__bucket", place(F.xxhash64(F.lit(seed), F.col(id_col))))
    else:
        marked = df.join(F.broadcast(heavy), F.col(id_col).eqNullSafe(F.col("__id")), "left")
        light = marked.filter("__heavy is null").select(*columns, place(F.xxhash64(F.lit(seed), F.col(id_col))).alias("__bucket"))
        whole = F.xxhash64(F.lit(seed), *columns)
        counted = marked.filter("__heavy").groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__row", whole)
        pieces = counted.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(PIECE).cast("long"))))
        dealt = (pieces.repartition("__row", "__from")
                 .withColumn("__no", F.explode(F.sequence("__from", F.least(F.col("__from") + PIECE, F.col("__n")) - 1))))
        scattered = light.unionByName(dealt.select(*columns, place(F.xxhash64(F.lit(seed), "__row", "__no")).alias("__bucket")))
    counts = np.zeros(buckets + 1, np.int64)
    for r in scattered.groupBy("__bucket").count().collect():          # one number for each bucket
        counts[r["__bucket"] + 1] = r["count"]
    offsets = np.cumsum(counts)
    shared = spark.sparkContext.broadcast(offsets)
    names = df.columns
    out_type = ", ".join(f"`{c}` {t}" for c, t in df.dtypes) + ", shard int, slot long"
    n = total["n"]
    bounds = np.array([-(-s * n // shards) for s in range(shards + 1)], np.int64)

    def pass_two(table: pa.Table) -> pa.Table:
        b = table.column("__bucket")[0].as_py()
        order = canonical(table, names, id_col)
        order = order[fisher_yates(len(order), np.random.default_rng([seed, b]))]
        place = shared.value[b] + np.arange(len(order))
        shard = np.searchsorted(bounds, place, side="right") - 1
        out = table.select(names).take(pa.array(order))
        return out.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(place - bounds[shard]))

    # where the data fill more buckets than the session has partitions, a task still reads about one bucket's bytes
    wanted = -(-total["b"] // bucket_bytes)
    if wanted > parts:
        scattered = scattered.repartition(wanted, "__bucket")
    (scattered.groupBy("__bucket").applyInArrow(pass_two, out_type)
     .write.partitionBy("shard").parquet(path))
    back = spark.read.schema(out_type).parquet(path)
    return back.select(*names, "shard", "slot")


def canonical(table: pa.Table, names: list[str], id_col: str) -> np.ndarray:
    """Row order by id (nulls last), then by the row's content where ids repeat."""
    ids = table.column(id_col)
    order = pc.sort_indices(ids).to_numpy().copy()
    values = ids.take(pa.array(order)).to_pylist()
    lo = 0
    for hi in range(1, len(values) + 1):
        if hi == len(values) or values[hi] != values[lo]:
            if hi - lo > 1:
                same = table.select(names).take(pa.array(order[lo:hi])).to_pylist()
                order[lo:hi] = order[lo:hi][sorted(range(hi - lo), key=lambda i: repr([same[i][c] for c in names]))]
            lo = hi
    return order


def shard_digest(docs: DataFrame, shards: int = 8, **options) -> DataFrame:
    """doc_id, size, text_crc32 (null text: of no bytes), law, shard, slot, grown_shard of every row, read back
    from the written shards."""
    spark = docs.sparkSession
    back = shuffle_into_shards(docs, shared_path(spark, "shards"), shards, **options)
    return back.select("doc_id", row_size(F.col("text")).alias("size"),
                       F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
