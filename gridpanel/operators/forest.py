"""Forests whose trees each see a bounded bag of rows.

Spark's own forest passes over all rows for every group of nodes and walks every
tree for each of them, also for those that are not in the tree's bag. Here each
row is dealt once to the trees that draw it, and a tree grows in the task that
holds its bag: what a fit costs beyond one pass over the rows is trees times
bag, however many rows there are. Bags are drawn, and splits chosen, as Spark's
forest does it: Poisson counts, thresholds between at most 32 bins, the largest
fall of the variance over all columns, grown until nothing falls.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

BINS = 32
BIN_ROWS = 10_000           # rows that the thresholds are taken from, as Spark's forest does
BAG_ROWS = 100_000          # draws of a tree that a task holds at most; larger bags are Spark's forest's
_CELLS = 1 << 20            # sums of a level's nodes that are held at once


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between the values of a column: all midpoints, or those at even shares of the rows."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= most:
        return middle
    held, stride = np.cumsum(counts), len(values) / (most + 1)
    out, target = [], stride
    for i in range(1, len(found)):
        if abs(held[i - 1] - target) < abs(held[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def binned(x: np.ndarray, edges) -> np.ndarray:
    """Bin of each value: the number of thresholds below it; NaN is above all."""
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1).astype("uint8")


def _best_splits(codes, node, w, wy, nodes: int):
    """Per node the column, the last bin to the left and the fall of the squared error of its best split."""
    f = codes.shape[1]
    at = ((node[:, None] * f + np.arange(f)) * BINS + codes).ravel()
    held = lambda v: np.bincount(at, np.repeat(v, f), nodes * f * BINS).reshape(nodes, f, BINS).cumsum(2)      # noqa: E731
    lw, ly = held(w), held(wy)
    rw, ry = lw[:, :, -1:] - lw, ly[:, :, -1:] - ly
    with np.errstate(divide="ignore", invalid="ignore"):
        fall = ly * ly / lw + ry * ry / rw - (ly[:, :, -1:] ** 2 / lw[:, :, -1:])
    fall = np.where((lw > 0) & (rw > 0), fall, -1.0).reshape(nodes, -1)
    best = fall.argmax(1)
    return best // BINS, best % BINS, fall[np.arange(nodes), best]


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, max_depth: int):
    """A tree on one bag, level by level: column, cut, left child (0: a leaf; the right one follows) and value by node."""
    mean = np.average(y, weights=w)
    y = y - mean
    node, nodes, first = np.zeros(len(y), dtype=np.int64), 1, 0
    out = []
    for depth in range(max_depth + 1):
        sums = [np.bincount(node, v, nodes) for v in (w, w * y, w * y * y)]
        column, cut, left = np.zeros(nodes, "int16"), np.zeros(nodes, "uint8"), np.zeros(nodes, "int32")
        out.append((column, cut, left, sums[1] / sums[0] + mean))
        if depth == max_depth:
            break
        # only nodes with a spread are looked at, so many of them at a time
        open_ = np.flatnonzero(sums[2] - sums[1] ** 2 / sums[0] > 1e-12 * sums[2])
        rank = np.full(nodes, -1)
        rank[open_] = np.arange(len(open_))
        inside = np.flatnonzero(rank[node] >= 0)
        inside = inside[np.argsort(rank[node[inside]], kind="stable")]
        place = rank[node[inside]]
        fall, step = np.zeros(len(open_)), max(1, _CELLS // (codes.shape[1] * BINS))
        for lo in range(0, len(open_), step):
            hi = min(lo + step, len(open_))
            a, b = np.searchsorted(place, [lo, hi])
            rows = inside[a:b]
            column[open_[lo:hi]], cut[open_[lo:hi]], fall[lo:hi] = _best_splits(codes[rows], place[a:b] - lo, w[rows], w[rows] * y[rows], hi - lo)
        split = open_[fall > 1e-12 * sums[2][open_]]
        first += nodes
        left[split] = first + 2 * np.arange(len(split))
        rows = np.flatnonzero(left[node] > 0)
        was = node[rows]
        codes, y, w = codes[rows], y[rows], w[rows]
        node = left[was] - first + (codes[np.arange(len(rows)), column[was]] > cut[was])
        nodes = 2 * len(split)
        if not nodes:
            break
    return tuple(np.concatenate(v) for v in zip(*out))


def value_of(codes: np.ndarray, tree) -> np.ndarray:
    """The value of each row's leaf."""
    column, cut, left, value = tree
    wide, flat = codes.shape[1], codes.ravel()
    at, rows = np.zeros(len(codes), dtype=np.int64), np.arange(len(codes))
    while True:
        here = at[rows]
        inner = left[here] > 0
        rows, here = rows[inner], here[inner]
        if not len(rows):
            return value[at]
        at[rows] = left[here] + (flat[rows * wide + column[here]] > cut[here])


@dataclass
class BaggedForest:
    """Fitted trees (a model's state: nodes in trees, not rows) and the thresholds of the columns."""
    features: list
    edges: list
    trees: list

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        held = df.sparkSession.sparkContext.broadcast((self.edges, self.trees))

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            edges, trees = held.value
            codes, of = np.unique(binned(np.column_stack(columns), edges), axis=0, return_inverse=True)
            return pd.Series((sum(value_of(codes, t) for t in trees) / len(trees))[of.ravel()])

        return df.withColumn(out, score(*[F.col(f"`{c}`").cast("double") for c in self.features]))


def fit_bagged_forest(train: DataFrame, n: int, features, target: str, num_trees: int, rate: float, max_depth: int, seed: int) -> BaggedForest:
    """``num_trees`` trees over the ``n`` rows of ``train`` (``_features`` vector and ``target``); a row is in each bag a
    Poisson(``rate``) number of times.

    A row's draws of all trees together are Poisson(``rate * num_trees``), each
    of a tree picked evenly, which is the same law. Draws go by the partition's
    own seed, so a task that runs again deals the same."""
    from pyspark.ml.functions import vector_to_array
    rows = train.select(vector_to_array("_features").alias("x"), F.col(target).alias("y"))
    some = rows if n <= BIN_ROWS else rows.sample(BIN_ROWS / n, seed=seed)
    x = np.array([r["x"] for r in some.select("x").collect()], dtype=float).reshape(-1, len(features))
    edges = [thresholds(x[:, j], min(BINS, n) - 1) for j in range(len(features))]

    def deal(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for pdf in batches:
            times = rng.poisson(rate * num_trees, len(pdf))
            pdf, times = pdf[times > 0], times[times > 0]
            for lo in range(0, len(pdf), 500):
                part, drawn = pdf.iloc[lo:lo + 500], times[lo:lo + 500]
                row = np.repeat(np.arange(len(part)), drawn)
                pairs, count = np.unique(row * num_trees + rng.integers(num_trees, size=len(row)), return_counts=True)
                row, tree = np.divmod(pairs, num_trees)
                codes = np.array([c.tobytes() for c in binned(np.stack(part["x"]), edges)], dtype=object)
                yield pd.DataFrame({"tree": tree.astype("int32"), "codes": codes[row], "y": part["y"].to_numpy()[row], "w": count.astype("int32")})

    def one(key, pdf):
        codes = np.frombuffer(b"".join(pdf["codes"]), "uint8").reshape(len(pdf), -1)
        tree = grow(codes, pdf["y"].to_numpy(), pdf["w"].to_numpy(dtype=float), max_depth)
        return pd.DataFrame({"tree": [key[0]], **{k: [v.tobytes()] for k, v in zip(("column", "cut", "left", "value"), tree)}})

    bags = rows.mapInPandas(deal, "tree int, codes binary, y double, w int").repartition(num_trees, "tree")
    grown = bags.groupBy("tree").applyInPandas(one, "tree int, column binary, cut binary, left binary, value binary").collect()
    trees = [tuple(np.frombuffer(r[k], kind) for k, kind in (("column", "int16"), ("cut", "uint8"), ("left", "int32"), ("value", "float64")))
             for r in sorted(grown, key=lambda r: r["tree"])]
    return BaggedForest(list(features), edges, trees)
