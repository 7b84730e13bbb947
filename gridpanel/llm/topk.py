"""Exact top-k inner products by norm-bucketed retrieval.

Candidate vectors are ordered by length and dealt into chunks of neighbouring
lengths; query vectors are dealt into blocks. A task gets one block and one
chunk, and walks the chunk in buckets of ``BUCKET`` rows of falling length.
A query's running k-th score ``t``, its own length and the bucket's largest
length give a local cosine threshold ``t / (|q| max|p|)``:

- above 1, no vector of the bucket can reach ``t``: the bucket is skipped;
- from ``COORD_FROM`` on, coordinate pruning: in the query's largest
  coordinates, a vector must lie within the angle of the threshold, and the
  sorted coordinate lists of the bucket give the rows that do;
- below it, length pruning: only rows of length ``t / |q|`` or more stay.

Products of the rows that stay are then verified in exact integers. Each task
returns its k best per query; a window merges them.

The chunk of the longest vectors is searched first, by all queries. Its k-th
score is a query's floor, and since no product exceeds the lengths' product, a
query then goes only to chunks with ``|q| max|p| >= floor``, and a chunk only
to blocks of queries that ask for it.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise

BUCKET = 1024
CHUNK_ROWS = 8192
QUERY_BLOCK = 2048
COORD_FROM = 0.4
FOCUS = 4
BROADCAST_ROWS = 200_000        # (block, chunk) rows that may be broadcast
SLACK = 1e-9            # relative margin for rounding in bounds
LONGEST = 2.0 ** 31.5           # vectors shorter than this have products within long


def scaled(embedding: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of every component, as long (beyond its range: its nearest value, which callers refuse)."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(embedding: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    return embedding.isNotNull() & F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products of all rows of ``a`` with all of ``b``, which must lie in the long range."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    bound = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if bound < 2.0 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


class Best:
    """The k best (score, id, row) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k, self.lists = k, [[] for _ in range(n)]
        self.floor = np.full(n, -np.inf)

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray):
        keep = np.flatnonzero(scores >= self.floor[q])
        if not len(keep):
            return
        if len(keep) > self.k:
            keep = keep[np.lexsort((rows[keep], ids[keep], -scores[keep]))[:self.k]]
        merged = self.lists[q] + list(zip((-scores[keep]).tolist(), ids[keep].tolist(), rows[keep].tolist()))
        merged.sort()
        self.lists[q] = merged[:self.k]
        if len(self.lists[q]) == self.k:
            self.floor[q] = -self.lists[q][-1][0]


def search(queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray,
           k: int, floors: np.ndarray | None = None) -> Best:
    """The k best of ``vectors`` for each query, its own row left out; scores below a query's floor need not be found."""
    best = Best(len(queries), k)
    if floors is not None:
        best.floor = floors.astype(float)
    lengths = np.sqrt((vectors.astype(float) ** 2).sum(1))
    order = np.lexsort((ids, -lengths))
    vectors, ids, rows, lengths = vectors[order], ids[order], rows[order], lengths[order]
    q_len = np.sqrt((queries.astype(float) ** 2).sum(1))
    q_unit = queries / np.maximum(q_len, 1e-300)[:, None]
    focus = np.argsort(-np.abs(q_unit), axis=1)[:, :FOCUS]
    for lo in range(0, len(vectors), BUCKET):
        part, part_ids, part_rows, part_len = (x[lo:lo + BUCKET] for x in (vectors, ids, rows, lengths))
        reach = q_len * part_len[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(reach > 0, best.floor / reach, np.where(best.floor > 0, np.inf, -np.inf)) - SLACK
        by_coord = (local >= COORD_FROM) & (local <= 1)
        by_length = local < COORD_FROM
        unit = lists = None
        for q in np.flatnonzero(by_coord):
            if unit is None:
                unit = part / np.maximum(part_len, 1e-300)[:, None]
                lists = np.argsort(unit, axis=0, kind="stable")
                ordered = np.take_along_axis(unit, lists, 0)
            angle, own = np.arccos(local[q]), np.arccos(np.clip(q_unit[q, focus[q]], -1, 1))
            low = np.where(own + angle >= np.pi, -1, np.cos(np.minimum(own + angle, np.pi))) - SLACK
            high = np.where(own <= angle, 1, np.cos(np.maximum(own - angle, 0))) + SLACK
            span = [(np.searchsorted(ordered[:, f], a, "left"), np.searchsorted(ordered[:, f], b, "right"))
                    for f, a, b in zip(focus[q], low, high)]
            least = min(range(len(span)), key=lambda i: span[i][1] - span[i][0])
            found = lists[span[least][0]:span[least][1], focus[q][least]]
            inside = unit[found[:, None], focus[q]]
            found = found[((inside >= low) & (inside <= high)).all(1) & (part_rows[found] != query_rows[q])]
            if len(found):
                best.offer(q, exact_products(queries[q:q + 1], part[found])[0], part_ids[found], part_rows[found])
        chosen = np.flatnonzero(by_length)
        if len(chosen):
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(q_len[chosen] > 0, best.floor[chosen] / q_len[chosen], -np.inf)
            stay = np.searchsorted(-part_len, -(least * (1 - SLACK) - SLACK), side="right")
            stay = np.where(least > 0, stay, len(part))
            scores = exact_products(queries[chosen], part[:int(stay.max(initial=0))])
            for q, n, s in zip(chosen, stay, scores):
                other = np.flatnonzero(part_rows[:n] != query_rows[q])
                best.offer(q, s[other], part_ids[other], part_rows[other])
    return best


def _matrix(col: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as one integer matrix; shorter vectors end in zeros."""
    values = col.to_pylist()
    out = np.zeros((len(values), width), np.int64)
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest integer inner products over all other rows.

    Ties go to the smaller id. Rows whose id is null, and vectors that are
    null or hold a null or non-finite component, take no part. A repeated row
    is a candidate of its twin, as only a query's own row is left out. Vectors
    of different lengths meet as if the shorter ended in zeros. Vectors so long
    that a product may leave the long range are an error (``LONGEST``). Other
    columns are ignored; an empty table or query set gives an empty result."""
    spark = vectors.sparkSession
    base = materialise(vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
                       .select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vec_col), scale).alias("v"),
                               is_query.alias("q"), F.monotonically_increasing_id().alias("row")), "vectors")
    size = base.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("nq")).first()
    if not size["nq"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    blocks = -(-size["nq"] // QUERY_BLOCK)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    chunked = materialise(
        base.withColumn("len", length).repartitionByRange(-(-size["n"] // CHUNK_ROWS), F.desc("len"), "id", "row")
        .select("id", "v", "row", "len", F.spark_partition_id().alias("chunk")), "chunks")
    longest = chunked.groupBy("chunk").agg(F.max("len").alias("reach"))            # about n / CHUNK_ROWS numbers
    if longest.agg(F.max("reach")).first()[0] >= LONGEST:
        raise ValueError(f"a vector of length {LONGEST:.3g} or more: inner products may leave the long range")
    first = longest.agg(F.min("chunk")).first()[0]
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    queries = materialise(base.filter("q").select("id", "v", "row", block.alias("block"), length.alias("len")), "queries")

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows if right.num_rows else 0
        out = []
        if n:
            width = max(max(map(len, t.column("v").to_pylist()), default=0) for t in (left, right))
            q_ids, q_rows = left.column("id").to_pylist(), left.column("row").to_numpy()
            best = search(_matrix(left.column("v"), width), q_rows, _matrix(right.column("v"), width),
                          right.column("id").to_numpy(), right.column("row").to_numpy(), k, left.column("floor").to_numpy())
            out = [(q_ids[i], int(q_rows[i]), vec, -neg, row) for i, found in enumerate(best.lists) for neg, vec, row in found]
        return pa.table(dict(zip(("query_id", "query_row", "vec_id", "score", "row"),
                                 [pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)])))

    def searched(asked: DataFrame, offered: DataFrame) -> DataFrame:
        return (asked.select("id", "v", "row", "block", "chunk", "floor").groupBy("block", "chunk")
                .cogroup(offered.select("id", "v", "row", "block", "chunk").groupBy("block", "chunk"))
                .applyInArrow(task, "query_id long, query_row long, vec_id long, score long, row long"))

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    top = materialise(searched(queries.withColumns({"chunk": F.lit(first), "floor": F.lit(float("-inf"))}), chunked.filter(F.col("chunk") == first).withColumn("block", every_block)), "first-chunk")
    asked = materialise(later_chunks(queries, top, chunked.filter(F.col("chunk") != first), k), "asked")
    pairs = materialise(asked.select("block", "chunk").distinct(), "pairs")
    if pairs.count() <= BROADCAST_ROWS:
        pairs = F.broadcast(pairs)
    rest = searched(asked, chunked.join(pairs, "chunk"))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return top.unionAll(rest).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def later_chunks(queries: DataFrame, top: DataFrame, chunked: DataFrame, k: int) -> DataFrame:
    """``queries`` once for each ``chunk`` of ``chunked`` that may hold one of their ``k`` best, given those of the first one.

    A query with fewer than ``k`` results so far goes to all. Chunks are few (a row each), so their list goes with
    every query as an array; a tie at the floor is still looked for."""
    floors = top.groupBy("query_row").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("floor"))
    reach = chunked.groupBy("chunk").agg(F.max("len").alias("reach"))
    chunks = reach.select(F.array_sort(F.collect_list(F.struct("chunk", "reach")))).scalar()
    known = queries.join(floors, queries["row"] == floors["query_row"], "left").drop("query_row").withColumn("chunks", chunks)
    floor = F.when(F.col("found") >= k, F.col("floor").cast("double")).otherwise(F.lit(float("-inf")))
    known = known.withColumn("floor", floor)
    may = lambda c: F.col("len") * c["reach"] * (1 + SLACK) >= F.col("floor")                                                      # noqa: E731
    return (known.withColumn("c", F.explode(F.filter("chunks", may))).select("id", "v", "row", "block", F.col("c.chunk").alias("chunk"), "floor"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM r)
WHERE rank <= 5
"""
