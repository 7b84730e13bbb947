"""Centroid clustering (Lloyd rounds) with exact integer distances from bit planes.

A vector of 64 integer components is stored as ``bits`` planes: plane ``p`` is
one uint64 that holds bit ``p`` of every component, in two's complement (the
top plane weighs ``-2^(bits-1)``). Then

    v . c  =  sum over planes p, q of  w_p * w_q * popcount(V_p & C_q)

is exact, and so is ``|v|^2 - 2 v.c + |c|^2``. Vectors are packed once into a
written table (``bits`` words each, against 64 components before); every round
reads only that table, assigns in tasks and sends one partial sum per cluster
and task through the shuffle. The driver holds the centroids alone.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise
from .topk import scaled, usable

COMPONENTS = 64
MAX_BITS = 28           # 64 * (2^28)^2 stays within long
MAX_CENTROIDS = 10_000  # they travel with every task
ROWS = 2048             # vectors compared at a time in a task


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """(n, 64) integers as (n, bits) bit planes."""
    return np.stack([np.packbits((values >> p & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")[:, 0]
                     for p in range(bits)], axis=1)


def unpack(planes: np.ndarray) -> np.ndarray:
    """(n, bits) bit planes as (n, 64) integers."""
    n, bits = planes.shape
    set_bits = np.unpackbits(np.ascontiguousarray(planes, "<u8").view(np.uint8).reshape(n, bits, 8), axis=2, bitorder="little")
    return np.einsum("nbc,b->nc", set_bits, weights(bits))


def weights(bits: int) -> np.ndarray:
    w = np.int64(1) << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def norms(planes: np.ndarray) -> np.ndarray:
    w = weights(planes.shape[1])
    return sum(((w[p] * w * np.bitwise_count(planes[:, p, None] & planes)).sum(1) for p in range(len(w))), np.zeros(len(planes), np.int64))


def dots(planes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Integer products of all rows with all centroids, both as planes."""
    w = weights(planes.shape[1])
    out = np.zeros((len(planes), len(centroids)), np.int64)
    for p in range(len(w)):
        for q in range(len(w)):
            out += w[p] * w[q] * np.bitwise_count(planes[:, p, None] & centroids[None, :, q])
    return out


def nearest(planes: np.ndarray, norm: np.ndarray, centroids: np.ndarray, centroid_norms: np.ndarray):
    """Number of the nearest centroid (ties: the smaller) and the squared distance of each row."""
    which, far = np.zeros(len(planes), np.int32), np.zeros(len(planes), np.int64)
    for lo in range(0, len(planes), ROWS):
        part = slice(lo, lo + ROWS)
        distance = norm[part, None] - 2 * dots(planes[part], centroids) + centroid_norms
        which[part] = distance.argmin(1)
        far[part] = distance.min(1)
    return which, far


def _planes(col: pa.Array, bits: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<u8").reshape(-1, bits)


def pack_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> tuple[DataFrame, int]:
    """A written table ``(id, planes, norm)`` of the vectors with 64 finite components, and the number of planes.

    Components become ``floor(scale * x)``. Any of 2^27 or more in absolute
    value is an error, as distances could leave the long range."""
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter(_whole())
    ends = kept.select(scaled(F.col("v"), scale).alias("v")).agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high")).first()
    bits = 1 + max([int(x).bit_length() if x >= 0 else int(-x - 1).bit_length() for x in ends if x is not None], default=0)
    if bits > MAX_BITS:
        raise ValueError(f"components from {ends['low']} to {ends['high']} need {bits} bits; at most {MAX_BITS} keep distances exact")

    def task(batches):
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, COMPONENTS)
            planes = pack(np.floor(x * scale).astype(np.int64), bits)
            yield pa.record_batch({"id": batch.column("id"), "planes": pa.array([r.tobytes() for r in planes.astype("<u8")], pa.binary()),
                                   "norm": pa.array(norms(planes))})

    id_type = dict(kept.dtypes)["id"]
    return materialise(kept.mapInArrow(task, f"id {id_type}, planes binary, norm long"), "bit-planes"), bits


def _whole() -> Column:
    return (F.size("v") == COMPONENTS) & usable(F.col("v"))


def seeds(vectors: DataFrame, k: int, prefix: str, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> np.ndarray:
    """Components of the ``k`` kept vectors whose ``sha256(prefix + id)`` is smallest, in that order (k rows at most).

    Rows of one id come in the order of their components; those without an id come last."""
    kept = vectors.select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).alias("v")).filter(_whole())
    first = (kept.select(F.sha2(F.concat(F.lit(prefix), "id"), 256).alias("h"), scaled(F.col("v"), scale).alias("v"))
             .orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect())
    return np.array([r["v"] for r in first], np.int64).reshape(-1, COMPONENTS)


def _assign(packed: DataFrame, bits: int, centroids: np.ndarray) -> DataFrame:
    planes = pack(centroids, bits)
    lengths = norms(planes)

    def task(batches):
        for batch in batches:
            which, far = nearest(_planes(batch.column("planes"), bits), batch.column("norm").to_numpy(), planes, lengths)
            yield pa.record_batch({"id": batch.column("id"), "cluster": pa.array(which), "distance": pa.array(far)})

    return packed.mapInArrow(task, f"id {dict(packed.dtypes)['id']}, cluster int, distance long")


def _sums(packed: DataFrame, bits: int, centroids: np.ndarray) -> list:
    """One row per non-empty cluster: its number, its count and the exact sums of its components."""
    planes = pack(centroids, bits)
    lengths = norms(planes)

    def task(batches):
        count, total = np.zeros(len(planes), np.int64), np.zeros((len(planes), COMPONENTS), np.int64)
        for batch in batches:
            rows = _planes(batch.column("planes"), bits)
            which, _ = nearest(rows, batch.column("norm").to_numpy(), planes, lengths)
            order = np.argsort(which, kind="stable")
            present, starts = np.unique(which[order], return_index=True)
            if len(present):
                total[present] += np.add.reduceat(unpack(rows[order]), starts, axis=0)
                count += np.bincount(which, minlength=len(count))
        some = np.flatnonzero(count)
        yield pa.record_batch({"cluster": pa.array(some.astype(np.int32)), "n": pa.array(count[some]),
                               "total": pa.array(total[some].tolist(), pa.list_(pa.int64()))})

    partial = packed.mapInArrow(task, "cluster int, n long, total array<long>")
    return (partial.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[j]).alias(f"s{j}") for j in range(COMPONENTS)])
            .collect())


def refine(packed: DataFrame, bits: int, centroids: np.ndarray, rounds: int) -> np.ndarray:
    """``rounds`` of: assign every vector, then move each non-empty centroid to the floor of its mean."""
    centroids = centroids.copy()
    for _ in range(rounds):
        for row in _sums(packed, bits, centroids):
            centroids[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(COMPONENTS)]
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, prefix: str = "2:", id_col: str = "vec_id",
            vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of each vector with 64 finite components.

    Other rows (null, shorter, longer, with null, NaN or infinite components)
    are left out and other columns ignored. Repeated rows and rows without an
    id are assigned like any other; with fewer than ``k`` kept vectors each is
    a seed. Equal centroids: the smaller number gets all, the other stays as
    it is. No kept vector: an empty result. ``k`` is at most ``MAX_CENTROIDS``."""
    if not 0 < k <= MAX_CENTROIDS:
        raise ValueError(f"k must be from 1 to {MAX_CENTROIDS}")
    spark = vectors.sparkSession
    packed, bits = pack_vectors(vectors, id_col, vec_col, scale)
    centroids = seeds(vectors, k, prefix, id_col, vec_col, scale)
    if len(centroids):
        centroids = refine(packed, bits, centroids, rounds)
        assigned = materialise(_assign(packed, bits, centroids), "clusters")
    else:
        assigned = packed.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    inertia = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(c, d, sum(inertia.values()), digest[c]) for c, d in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(facts), "cluster")                # k rows at most
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _oracle(k: int = 40, rounds: int = 5) -> str:
    parts = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) = {COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM kept QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, min([d, c])[2] AS c, min([d, c])[1] AS d
  FROM (SELECT r, c, CAST(list_inner_product(k.v, k.v) - 2 * list_inner_product(k.v, o.v) + list_inner_product(o.v, o.v) AS BIGINT) AS d
        FROM kept k CROSS JOIN c{i} o) GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.v, o.v) AS v
  FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS v
    FROM (SELECT c, j, CAST(sum(v[j]) AS BIGINT) AS s, count(*) AS n
          FROM (SELECT a.c, k.v, unnest(range(1, {COMPONENTS + 1})) AS j FROM a{i} a JOIN kept k USING (r)) GROUP BY c, j)
    GROUP BY c) m USING (c))""")
    return ",".join(parts) + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(o.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (r) JOIN c{rounds} o ON o.c = a.c
"""


ORACLE = _oracle()
