"""Model fitting and scoring.

Grouped OLS (many small models: per unit, per segment slice, per hour block)
sums the upper triangle of ``[X y]'[X y]`` per group and solves the normal
equations with a pseudo-inverse (minimum-norm for rank-deficient designs).
Narrow designs sum the products as JVM aggregates. Wide ones keep one
accumulator per group and partition in numpy and sum the partial triangles in
the JVM, element by element, with map-side combining. In both, a group's
partial is one row per partition, whatever the group's size.

Formula regressions with hundreds of terms are products of a few categorical
levels with a few numeric columns: ``fit_blocked_ols`` sums one small Gram
matrix per cell of levels in one pass, expands them to the full normal
equations (model state) and scores rows by a lookup of their cell's
coefficients. Forests use ``RandomForestRegressor``, or where a tree's bag of rows
fits a task, ``forest.fit_bagged_forest``.
"""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import calendar as C
from ..session import cut_lineage
from .forest import BAG_ROWS, BaggedForest, fit_bagged_forest
from .sizing import checked_broadcast, counted_rows, key_bound


def _training_frame(df: DataFrame, exprs: list, label: str, prefix: str) -> DataFrame:
    """Assemble the design into one vector column next to the label and cut the
    lineage (reliable checkpoint): the solvers pass over it several times, and a
    lost executor then re-reads the checkpoint instead of the whole feature plan."""
    from pyspark.ml.feature import VectorAssembler
    x = df.select(*[e.cast("double").alias(f"{prefix}{i}") for i, e in enumerate(exprs)],
                  F.col(label).cast("double").alias(label))
    va = VectorAssembler(inputCols=[f"{prefix}{i}" for i in range(len(exprs))], outputCol="_features",
                         handleInvalid="skip")
    return cut_lineage(va.transform(x.filter(F.col(label).isNotNull())).select("_features", label))


# ----------------------------------------------------------------- grouped OLS
@dataclass
class GroupedOLS:
    """Fitted grouped linear models: one coefficient vector per group."""
    group_keys: list[str]
    features: list[str]
    intercept: bool
    coefficients: DataFrame          # group keys, n, rank, coef array<double>
    terms: list[str] = field(default_factory=list)

    def predict(self, df: DataFrame, out: str = "prediction", how: str = "inner") -> DataFrame:
        """Dot product of each row with its group's coefficients. ``how='inner'``
        drops rows of groups without a model (M7)."""
        if self.group_keys:
            coefs = checked_broadcast(self.coefficients.select(*self.group_keys, "coef"),
                                      proven_rows=key_bound(df, self.group_keys))
            j = df.join(coefs, self.group_keys, how)
        else:
            j = df.withColumn("coef", self.coefficients.select("coef").scalar())
        return j.withColumn(out, _dot("coef", self.features, self.intercept)).drop("coef")

    def long_coefficients(self) -> DataFrame:
        """One row per (group, term, coefficient)."""
        terms = F.array(*[F.lit(t) for t in self.terms])
        return (self.coefficients.select(*self.group_keys, F.posexplode("coef").alias("i", "coefficient"))
                .withColumn("term", terms[F.col("i")]).drop("i"))


def _dot(coef: str, features, intercept: bool) -> Column:
    """Sum of the products of ``features`` with the elements of the array column ``coef``, as one SQL expression."""
    off = 1 if intercept else 0
    terms = [f"`{coef}`[0]" if intercept else "0.0D"] + [f"`{coef}`[{i + off}] * cast(`{f}` as double)" for i, f in enumerate(features)]
    return F.expr(" + ".join(terms))


JVM_PRODUCTS = 120          # products summed as separate aggregates; wider designs go by accumulators
HELD_BYTES = 64 << 20       # accumulators of one partition before they are passed on


def grouped_grams(df: DataFrame, features, target: str, group_keys=(), intercept: bool = True) -> DataFrame:
    """Group keys, ``n`` and ``gram``: the upper triangle, row by row, of ``[1 X y]'[1 X y]`` summed per group.

    Rows with a null in X or y take no part."""
    features, group_keys = list(features), list(group_keys)
    names = [f"_x{i}" for i in range(len(features))] + ["_y"]
    data = df.select(*group_keys, *[F.col(c).cast("double").alias(n) for c, n in zip([*features, target], names)])
    data = data.dropna(subset=names)
    z = ([F.lit(1.0)] if intercept else []) + [F.col(n) for n in names]
    dim = len(z)
    pairs = [(i, j) for i in range(dim) for j in range(i, dim)]
    if len(pairs) <= JVM_PRODUCTS:
        sums = data.groupBy(*group_keys).agg(F.count(F.lit(1)).alias("n"),
                                             *[F.sum(z[i] * z[j]).alias(f"_g{i}_{j}") for i, j in pairs])
        return sums.select(*group_keys, "n", F.array(*[F.col(f"_g{i}_{j}") for i, j in pairs]).alias("gram"))
    key_fields = list(df.select(*group_keys).schema.fields)
    part_schema = T.StructType(key_fields + [T.StructField("n", T.LongType()), T.StructField("_i", T.IntegerType()), T.StructField("_v", T.DoubleType())])
    upper = np.triu_indices(dim)
    most = max(1, HELD_BYTES // (8 * len(pairs)))

    def partial(batches):
        held: dict = {}

        def out():
            # element by element, so that the sums below need no generator over the whole feature plan
            wide = len(pairs)
            keys = {c: [key[i] for key in held for _ in range(wide)] for i, c in enumerate(group_keys)}
            return pd.DataFrame({**keys, "n": np.repeat([n for n, _ in held.values()], wide),
                                 "_i": np.tile(np.arange(wide, dtype="int32"), len(held)),
                                 "_v": np.concatenate([tri for _, tri in held.values()])})

        for pdf in batches:
            rows = pdf[names].to_numpy(dtype=float)
            if intercept:
                rows = np.hstack([np.ones((len(pdf), 1)), rows])
            where = pdf.groupby(group_keys, sort=False, dropna=False).indices if group_keys else {(): np.arange(len(pdf))}
            for key, at in where.items():
                key = key if isinstance(key, tuple) else (key,)
                n, tri = held.get(key, (0, 0.0))
                held[key] = (n + len(at), tri + (rows[at].T @ rows[at])[upper])
            if len(held) > most:
                yield out()
                held.clear()
        if held:
            yield out()

    sums = data.mapInPandas(partial, part_schema).groupBy(*group_keys, "_i").agg(F.sum("n").alias("n"), F.sum("_v").alias("_v"))
    # one row per group again: a triangle is a model's size
    whole = sums.groupBy(*group_keys).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_t"))
    return whole.select(*group_keys, "n", F.col("_t._v").alias("gram"))


def hour_cells(df: DataFrame, row_cols, target: str, keys=(), ts: str = "prediction_datetime") -> DataFrame:
    """``keys..., ts, n, mom``: rows summed by hour, in the JVM. ``mom`` is the upper triangle, row by row, of
    ``[1 row_cols y]'[1 row_cols y]``.

    Whatever else a design holds depends on the hour alone, so these few sums
    are all that a fit needs of the rows (``grams_of_cells``): keys times hours
    of the calendar, however many rows there are. Rows with a null or NaN in
    ``row_cols`` or y take no part."""
    names = [f"_u{i}" for i in range(len(row_cols) + 1)]
    data = df.select(*keys, F.col(ts).alias("_ts"), *[F.col(c).cast("double").alias(n) for c, n in zip([*row_cols, target], names)]).dropna(subset=names)
    u = [F.lit(1.0), *[F.col(n) for n in names]]
    pairs = [(i, j) for i in range(len(u)) for j in range(i, len(u))]
    sums = data.groupBy(*keys, "_ts").agg(F.count(F.lit(1)).alias("n"), *[F.sum(u[i] * u[j]).alias(f"_s{i}_{j}") for i, j in pairs])
    return sums.select(*keys, F.col("_ts").alias(ts), "n", F.array(*[F.col(f"_s{i}_{j}") for i, j in pairs]).alias("mom"))


def grams_of_cells(cells: DataFrame, times: DataFrame, features, row_cols, group_keys=(), ts: str = "prediction_datetime") -> DataFrame:
    """``grouped_grams`` with an intercept, from ``hour_cells``: ``times`` holds ``ts`` and the features that are not in
    ``row_cols``. Hours that ``times`` lacks, or where it has a null, take no part.

    Within a cell the hour's features are constants, so its matrix is their
    products times the cell's sums."""
    features, row_cols, group_keys = list(features), list(row_cols), list(group_keys)
    of_time = [f for f in features if f not in row_cols]
    known = checked_broadcast(times.select(F.col(ts).alias("_ts"), F.array(*[F.col(c).cast("double") for c in of_time]).alias("_t"))
                              .dropna(subset=["_ts"]).filter(F.forall("_t", lambda x: x.isNotNull() & ~F.isnan(x))), counted=counted_rows(times))
    rows = cells.join(known, F.col(ts) == F.col("_ts")).select(*group_keys, "n", "mom", "_t")
    k, dim = len(row_cols) + 2, len(features) + 2
    place = [0] + [row_cols.index(f) + 1 if f in row_cols else 0 for f in features] + [k - 1]      # of each column among [1 row_cols y]
    factor = [None] + [None if f in row_cols else of_time.index(f) for f in features] + [None]     # and among the hour's features
    small, upper = np.triu_indices(k), np.triu_indices(dim)
    wide = len(upper[0])
    schema = T.StructType(list(cells.select(*group_keys).schema.fields) + [
        T.StructField("n", T.LongType()), T.StructField("_i", T.IntegerType()), T.StructField("_v", T.DoubleType())])
    most = max(1, HELD_BYTES // (8 * wide))

    def partial(batches):
        held: dict = {}

        def out():
            keys = {c: [key[i] for key in held for _ in range(wide)] for i, c in enumerate(group_keys)}
            return pd.DataFrame({**keys, "n": np.repeat([n for n, _ in held.values()], wide),
                                 "_i": np.tile(np.arange(wide, dtype="int32"), len(held)),
                                 "_v": np.concatenate([tri for _, tri in held.values()])})

        for pdf in batches:
            if pdf.empty:
                continue
            a = np.zeros((len(pdf), k, k))
            a[:, small[0], small[1]] = np.stack(pdf["mom"])
            a[:, small[1], small[0]] = np.stack(pdf["mom"])
            t = np.stack(pdf["_t"]) if of_time else np.zeros((len(pdf), 0))
            tau = np.stack([np.ones(len(pdf)) if f is None else t[:, f] for f in factor], 1)
            n = pdf["n"].to_numpy()
            where = pdf.groupby(group_keys, sort=False, dropna=False).indices if group_keys else {(): np.arange(len(pdf))}
            for key, at in where.items():
                key = key if isinstance(key, tuple) else (key,)
                total = 0.0
                for lo in range(0, len(at), 2048):
                    part = at[lo:lo + 2048]
                    total = total + np.einsum("ci,cj,cij->ij", tau[part], tau[part], a[part][:, place][:, :, place])
                before = held.get(key, (0, 0.0))
                held[key] = (before[0] + int(n[at].sum()), before[1] + total[upper])
            if len(held) > most:
                yield out()
                held.clear()
        if held:
            yield out()

    sums = rows.mapInPandas(partial, schema).groupBy(*group_keys, "_i").agg(F.sum("n").alias("n"), F.sum("_v").alias("_v"))
    whole = sums.groupBy(*group_keys).agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_t"))
    return whole.select(*group_keys, "n", F.col("_t._v").alias("gram"))


def solve_grams(grams: DataFrame, group_keys, k: int, rcond: float = 1e-12) -> DataFrame:
    """Group keys, ``n``, ``rank`` and ``coef`` of the normal equations in ``gram`` (see ``grouped_grams``; ``k``
    coefficients): minimum-norm solutions, all groups of a batch at once."""
    group_keys, dim = list(group_keys), k + 1                                   # [X y]
    iu = np.triu_indices(dim)

    def full(tri):
        m = np.zeros((dim, dim))
        m[iu] = tri
        return m + np.triu(m, 1).T
    coef_schema = T.StructType(list(grams.select(*group_keys).schema.fields) + [
        T.StructField("n", T.LongType()), T.StructField("rank", T.IntegerType()),
        T.StructField("coef", T.ArrayType(T.DoubleType()))])

    def solve(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            m = np.stack([full(np.asarray(g, dtype=float)) for g in pdf["gram"]])
            xtx, xty = m[:, :k, :k], m[:, :k, k]
            if k:
                beta = np.einsum("gij,gj->gi", np.linalg.pinv(xtx, rcond=rcond, hermitian=True), xty)
                rank = np.linalg.matrix_rank(xtx, hermitian=True)
            else:
                beta, rank = np.zeros((len(pdf), 0)), np.zeros(len(pdf), dtype=int)
            out = pdf[group_keys].copy() if group_keys else pd.DataFrame(index=pdf.index)
            out["n"] = pdf["n"].astype("int64").to_numpy()
            out["rank"] = np.asarray(rank, dtype="int32")
            out["coef"] = [b.tolist() for b in beta]
            yield out

    return grams.select(*group_keys, "n", "gram").mapInPandas(solve, coef_schema)


def fit_grouped_ols(df: DataFrame, features, target: str, group_keys=(), intercept: bool = True,
                    rcond: float = 1e-12) -> GroupedOLS:
    """Ordinary least squares per group (or one global model)."""
    features, group_keys = list(features), list(group_keys)
    k = len(features) + (1 if intercept else 0)
    coefs = solve_grams(grouped_grams(df, features, target, group_keys, intercept), group_keys, k, rcond)
    terms = (["intercept"] if intercept else []) + features
    return GroupedOLS(group_keys, features, intercept, coefs, terms)


def block_grams(df: DataFrame, features, target: str, group_keys, block: str = "data_block_id", intercept: bool = True) -> DataFrame:
    """``grouped_grams`` by group and block: what walk-forward fits need of the data, once and for all. Store it, and
    append a block's rows when the block is complete."""
    return grouped_grams(df, features, target, [*group_keys, block], intercept)


def walk_forward_ols(grams: DataFrame, asked: DataFrame, features, group_keys, block: str = "data_block_id", delay_blocks: int = 2,
                     intercept: bool = True, rcond: float = 1e-12) -> DataFrame:
    """T2 with M7: for each (group, block) of ``asked``, the least-squares fit on the group's blocks up to ``block -
    delay_blocks``: ``group_keys..., block, n, rank, coef``. Blocks before the first fit have no row.

    One pass in place of a refit per block: the Gram matrices of a group's
    blocks are summed as running arrays, element by element over the blocks in
    order, and each asked block solves the sum it is allowed to see. A group's
    window holds a row a block. The sums are plain ones: centre columns whose
    mean is large beside their spread."""
    features, group_keys = list(features), list(group_keys)
    k = len(features) + (1 if intercept else 0)
    cells = (k + 1) * (k + 2) // 2
    key = [*group_keys, block]
    # an asked block without truth of its own still gets a place in the order
    spots = asked.select(*key).distinct().select(*key, F.lit(True).alias("_ask"), F.lit(0).cast("long").alias("n"),
                                                 F.array_repeat(F.lit(0.0), cells).alias("gram"))
    known = grams.select(*key, F.lit(False).alias("_ask"), "n", "gram")
    seen = Window.partitionBy(*group_keys).orderBy(block).rangeBetween(Window.unboundedPreceding, -delay_blocks)
    total = [F.sum(F.col("gram")[i]).over(seen) for i in range(cells)]
    running = (known.unionByName(spots).select(*key, "_ask", F.sum("n").over(seen).alias("n"), F.array(*total).alias("gram"))
               .filter(F.col("_ask") & (F.col("n") > 0)))
    return solve_grams(running, key, k, rcond)


def walk_forward_predict(df: DataFrame, fits: DataFrame, features, group_keys, block: str = "data_block_id",
                         intercept: bool = True, out: str = "prediction", how: str = "inner") -> DataFrame:
    """Each row scored by its own group's and block's fit."""
    key = [*group_keys, block]
    joined = df.join(fits.select(*key, "coef"), key, how)
    return joined.withColumn(out, _dot("coef", list(features), intercept)).drop("coef")


def slice_domain(df: DataFrame, columns, most: int = 10_000) -> dict:
    """Values of each slicing column, in order, from the data; more than ``most`` is an error (they become columns)."""
    tags = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("int").alias("v")) for c in columns])
    found = df.select(F.explode(tags).alias("t")).select("t.c", "t.v").filter("v is not null").distinct()
    out = {c: [] for c in columns}
    for r in found.limit(len(out) * most + 1).collect():
        out[r["c"]].append(r["v"])
    for c, values in out.items():
        values.sort()
        if len(values) > most:
            raise ValueError(f"{c} has more than {most} values")
    return out


def fit_slice_models(df: DataFrame, slices: dict, features, target: str, intercept: bool = True) -> GroupedOLS:
    """M6: one model per value of each slicing column (e.g. 16 counties + 2 business
    flags + 4 product types) fitted in one pass: every row is tagged with its
    slice of each column (``slice_col``, ``slice_value``) and the grouped fit runs
    once over all tags. Only declared slices are tagged, so the fit holds no more models than that."""
    tagged = df.select("*", F.explode(_declared_slices(slices)).alias("_slice")).select("*", "_slice.slice_col", "_slice.slice_value").drop("_slice")
    return fit_grouped_ols(tagged, features, target, ["slice_col", "slice_value"], intercept)


def _declared_slices(slices: dict) -> Column:
    """The row's own slice of each slicing column, as far as it is declared."""
    tags = F.array(*[F.struct(F.lit(c).alias("slice_col"), F.col(c).cast("int").alias("slice_value")) for c in slices])
    declared = F.create_map(*[x for c, vs in slices.items() for x in (F.lit(c), F.array(*[F.lit(int(v)) for v in vs]))])
    return F.filter(tags, lambda t: F.array_contains(declared[t["slice_col"]], t["slice_value"]))


def fit_slice_models_by_hour(df: DataFrame, times: DataFrame, slices: dict, features, target: str,
                             ts: str = "prediction_datetime") -> GroupedOLS:
    """M6 where the features depend on the hour alone (trend, season, time of day; ``times`` has them by hour): rows
    are summed by their values of the slicing columns and hour, and only those cells are tagged with their slices."""
    features = list(features)
    cells = hour_cells(df, [], target, list(slices), ts)
    tagged = cells.select(ts, "n", "mom", F.explode(_declared_slices(slices)).alias("_slice")).select(ts, "n", "mom", "_slice.slice_col", "_slice.slice_value")
    keys = ["slice_col", "slice_value"]
    coefs = solve_grams(grams_of_cells(tagged, times, features, [], keys, ts), keys, len(features) + 1)
    return GroupedOLS(keys, features, True, coefs, ["intercept"] + features)


def apply_slice_models_by_hour(df: DataFrame, model: GroupedOLS, times: DataFrame, slices: dict, ts: str = "prediction_datetime") -> DataFrame:
    """M6/J18 for such models: their values by hour, one row an hour, joined onto every row."""
    values = apply_slice_models(times, model, slices)
    names = [f"{c}{v}" for c, vs in slices.items() for v in vs]
    table = checked_broadcast(values.select(F.col(ts).alias("_ts"), *names), counted=counted_rows(times))
    return df.join(table, F.col(ts) == F.col("_ts"), "left").drop("_ts")


def apply_slice_models(df: DataFrame, model: GroupedOLS, slices: dict) -> DataFrame:
    """Every slice model applied to every row, one column per model
    (``county0`` .. ``product_type3``) in a single projection. The coefficient
    table has one row per declared slice (a model's state, a few KB) and is
    read once into literal expressions."""
    rows = {(r["slice_col"], r["slice_value"]): r["coef"] for r in model.coefficients.collect()}
    cols = []
    for c, values in slices.items():
        for v in values:
            coef = rows.get((c, int(v)))
            name = f"{c}{v}"
            if coef is None:
                cols.append(F.lit(None).cast("double").alias(name))
                continue
            terms = [f"double('{float(b)!r}')" for b in coef]                 # one SQL expression per model
            if model.intercept:
                terms = [terms[0], *[f"{b} * cast(`{f}` as double)" for b, f in zip(terms[1:], model.features)]]
            else:
                terms = ["0.0D", *[f"{b} * cast(`{f}` as double)" for b, f in zip(terms, model.features)]]
            cols.append(F.expr(" + ".join(terms)).alias(name))
    return df.select("*", *cols)


# ----------------------------------------------------------- formula models
@dataclass
class BlockDesign:
    """A linear formula of products of categorical levels and numeric columns.

    ``groups``: name -> (level column, declared levels). ``terms``: (group or
    None, numeric column or ``"1"``); a term of a group has a coefficient for
    each of its levels."""
    groups: dict
    terms: list

    @property
    def local(self) -> list[str]:
        """Numeric columns in order of first use."""
        return list(dict.fromkeys(c for _, c in self.terms if c != "1"))

    def cells(self) -> list[tuple]:
        """All combinations of declared levels."""
        out = [()]
        for _, levels in self.groups.values():
            out = [(*c, v) for c in out for v in levels]
        return out

    def parameters(self) -> list[tuple]:
        """(group, level, column) of each coefficient; level None for terms of no group."""
        return [(g, v, c) for g, c in self.terms for v in (self.groups[g][1] if g else [None])]

    def expansion(self, cell: tuple) -> np.ndarray:
        """Matrix from all parameters to the coefficients of [1, local] within a cell."""
        of, place = dict(zip(self.groups, cell)), {"1": 0, **{c: i + 1 for i, c in enumerate(self.local)}}
        out = np.zeros((len(place), len(self.parameters())))
        for j, (g, v, c) in enumerate(self.parameters()):
            if g is None or of[g] == v:
                out[place[c], j] = 1.0
        return out


ROW_LAGS = ["target_2d_ago", "target_7d_ago"]          # the designs' columns that differ between rows of one hour


def date_terms() -> list[str]:
    return ["trend"] + C.fourier_names()


def production_design(ts: str = "prediction_datetime") -> BlockDesign:
    """M1: ``solar_elevation + solar_azimuth + C(hour)*(trend + 6 sin + 6 cos) + target_2d_ago``."""
    return BlockDesign({"hour": (F.hour(F.col(ts)), C.HOURS)},
                       [(None, c) for c in ("solar_elevation", "solar_azimuth", "target_2d_ago")]
                       + [("hour", c) for c in ["1", *date_terms()]])


def consumption_design(ts: str = "prediction_datetime") -> BlockDesign:
    """M2: ``(C(weekday) + C(hour)) * (date cols) + C(weekday)*target_2d_ago + target_7d_ago``."""
    return BlockDesign({"weekday": (C.weekday_iso(ts), list(range(1, 8))), "hour": (F.hour(F.col(ts)), C.HOURS)},
                       [(g, c) for g in ("weekday", "hour") for c in ["1", *date_terms()]]
                       + [("weekday", "target_2d_ago"), (None, "target_7d_ago")])


@dataclass
class BlockedOLS:
    """Coefficients per segment (``{segment values: vector}``) of a block design."""
    design: BlockDesign
    segments: list
    theta: dict

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Every row by the coefficients of its segment and cell; null for a segment without a model."""
        j = self._tagged(df)
        return j.withColumn(out, _dot("_coef", self.design.local, True)).drop("_coef", *[f"_b_{g}" for g in self.design.groups])

    def _tagged(self, df: DataFrame, every_segment: dict | None = None) -> DataFrame:
        """Rows with the coefficients ``_coef`` of their segment and cell; with ``every_segment`` (types of the segment
        columns, which ``df`` then lacks), of all segments."""
        names = [f"_b_{g}" for g in self.design.groups]
        rows = [(*seg, *cell, [float(x) for x in self.design.expansion(cell) @ theta])
                for seg, theta in self.theta.items() for cell in self.design.cells()]
        kinds = every_segment or dict(df.dtypes)
        schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in self.segments], *[f"{n} int" for n in names], "_coef array<double>"])
        # declared levels x segments; past the bound it joins by shuffle
        table = checked_broadcast(df.sparkSession.createDataFrame(rows, schema), counted=len(rows))
        tagged = df.withColumns({n: level.cast("int") for n, (level, _) in zip(names, self.design.groups.values())})
        keys = [*([] if every_segment is not None else self.segments), *names]
        return tagged.join(table, keys, "left") if keys else tagged.join(table, F.lit(True))

    def coefficients(self, spark) -> DataFrame:
        """Segment (text), term, coefficient."""
        rows = [(str(seg), f"{g}[{v}]:{c}" if g else c, float(x)) for seg, theta in self.theta.items()
                for (g, v, c), x in zip(self.design.parameters(), theta)]
        return spark.createDataFrame(rows, "segment string, term string, coefficient double")


def _solve_blocks(grams: DataFrame, design: BlockDesign, segments: list, rcond: float) -> dict:
    """Coefficients of each segment from a Gram matrix per segment and cell (segments x cells rows reach the driver)."""
    names, dim = [f"_b_{g}" for g in design.groups], len(design.local) + 2
    sums: dict = {}
    for r in grams.collect():
        seg, cell = tuple(r[c] for c in segments), tuple(r[n] for n in names)
        m = np.zeros((dim, dim))
        m[np.triu_indices(dim)] = r["gram"]
        m = m + np.triu(m, 1).T
        e = design.expansion(cell)
        xtx, xty = sums.get(seg, (0.0, 0.0))
        sums[seg] = (xtx + e.T @ m[:-1, :-1] @ e, xty + e.T @ m[:-1, -1])
    theta = {}
    for seg, (xtx, xty) in sums.items():
        scale = np.sqrt(np.maximum(np.diag(xtx), 1e-300))
        unit = xtx / scale[:, None] / scale[None, :]
        theta[seg] = np.linalg.pinv(unit, rcond=rcond, hermitian=True) @ (xty / scale) / scale
    return theta


def fit_blocked_ols(df: DataFrame, design: BlockDesign, target: str = "target", segments=(), rcond: float = 1e-11) -> BlockedOLS:
    """M1-M3: least squares of a block design, one model for each value of ``segments`` columns.

    One pass over the rows gives a Gram matrix per segment and cell; what
    reaches the driver is segments x cells small triangles, independent of the
    rows. Minimum-norm solution, so redundant levels need no baseline."""
    names, segments = [f"_b_{g}" for g in design.groups], list(segments)
    tagged = df.withColumns({n: level.cast("int") for n, (level, _) in zip(names, design.groups.values())})
    for n, (_, levels) in zip(names, design.groups.values()):
        tagged = tagged.filter(F.col(n).isin(*levels))
    theta = _solve_blocks(grouped_grams(tagged, design.local, target, [*segments, *names]), design, segments, rcond)
    return BlockedOLS(design, segments, theta)


@dataclass
class HourBlockedOLS(BlockedOLS):
    """``BlockedOLS`` whose design needs, of a row, only its hour and ``row_cols``."""
    times: DataFrame = None
    row_cols: list = field(default_factory=list)
    ts: str = "prediction_datetime"
    kinds: dict = field(default_factory=dict)           # types of the segment columns

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Per segment and hour, the part that the hour decides and the coefficients of ``row_cols``; joined onto the
        rows. Null for a segment without a model and for an hour that ``times`` lacks."""
        fixed = [c for c in self.design.local if c not in self.row_cols]
        by_hour = self._tagged(self.times, every_segment=self.kinds)
        place = {c: i + 1 for i, c in enumerate(self.design.local)}
        base = F.col("_coef")[0]
        for c in fixed:
            base = base + F.col("_coef")[place[c]] * F.col(c).cast("double")
        segments = [F.col(c).alias(f"_g_{c}") for c in self.segments]
        table = by_hour.select(*segments, F.col(self.ts).alias("_ts"), base.alias("_base"),
                               *[F.col("_coef")[place[c]].alias(f"_c_{c}") for c in self.row_cols])
        known = counted_rows(self.times)
        table = checked_broadcast(table, counted=None if known is None else known * max(1, len(self.theta)))
        same = [F.col(c) == F.col(f"_g_{c}") for c in self.segments] + [F.col(self.ts) == F.col("_ts")]
        value = F.col("_base")
        for c in self.row_cols:
            value = value + F.col(f"_c_{c}") * F.col(c).cast("double")
        return df.join(table, same, "left").select(*df.columns, value.alias(out))


def fit_blocked_ols_by_hour(df: DataFrame, times: DataFrame, design: BlockDesign, row_cols, target: str = "target", segments=(),
                            ts: str = "prediction_datetime", rcond: float = 1e-11) -> HourBlockedOLS:
    """``fit_blocked_ols`` where all but ``row_cols`` depends on the hour: ``times`` holds those columns by ``ts``, and
    the design's levels are expressions of ``ts``. Rows are summed by segment and hour in the JVM; wide products are
    formed for those cells only. Same coefficients."""
    segments, row_cols = list(segments), [c for c in design.local if c in set(row_cols)]
    names = [f"_b_{g}" for g in design.groups]
    cells = hour_cells(df, row_cols, target, segments, ts)
    tagged = cells.withColumns({n: level.cast("int") for n, (level, _) in zip(names, design.groups.values())})
    for n, (_, levels) in zip(names, design.groups.values()):
        tagged = tagged.filter(F.col(n).isin(*levels))
    theta = _solve_blocks(grams_of_cells(tagged, times, design.local, row_cols, [*segments, *names], ts), design, segments, rcond)
    kinds = {c: t for c, t in df.dtypes if c in segments}
    return HourBlockedOLS(design, segments, theta, times, row_cols, ts, kinds)


def fit_segmented_ols(df: DataFrame, design: BlockDesign, segment: str = "is_business", target: str = "target") -> BlockedOLS:
    """M3: one formula model per segment, fitted in one pass; rows are scored by their own segment."""
    return fit_blocked_ols(df, design, target, [segment])


@dataclass
class FormulaOLS:
    """A free design (named column expressions) fitted with ``pyspark.ml``."""
    design: dict
    model: object

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        x = df.withColumns({f"_d{i}": c.cast("double") for i, c in enumerate(self.design.values())})
        va = VectorAssembler(inputCols=[f"_d{i}" for i in range(len(self.design))], outputCol="_features",
                             handleInvalid="keep")
        p = self.model.transform(va.transform(x))
        return p.withColumnRenamed("_pred", out).drop("_features", *[f"_d{i}" for i in range(len(self.design))])

    def coefficients(self, spark) -> DataFrame:
        """M14."""
        names = ["intercept"] + list(self.design)
        vals = [float(self.model.intercept)] + [float(v) for v in self.model.coefficients]
        return spark.createDataFrame(list(zip(names, vals)), "term string, coefficient double")


def fit_formula_ols(df: DataFrame, design: dict, target: str = "target", intercept: bool = True) -> FormulaOLS:
    """OLS on a free design (normal equations, no regularisation, no standardisation)."""
    from pyspark.ml.regression import LinearRegression
    train = _training_frame(df, list(design.values()), target, "_d")
    lr = LinearRegression(featuresCol="_features", labelCol=target, predictionCol="_pred", regParam=0.0,
                          fitIntercept=intercept, standardization=False, solver="normal")
    return FormulaOLS(design, lr.fit(train))


# ----------------------------------------------------------- forests, chaining
FOREST_FEATURES = ["eic_count", "installed_capacity", "price_gas_low", "price_gas_high", "price_electricity",
                   "temperature", "dewpoint", "cloudcover_high", "cloudcover_low", "cloudcover_mid",
                   "cloudcover_total", "10_metre_u_wind_component", "10_metre_v_wind_component",
                   "direct_solar_radiation", "surface_solar_radiation_downwards", "snowfall",
                   "total_precipitation"]


@dataclass
class ForestModel:
    features: list
    model: object

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        from pyspark.ml.feature import VectorAssembler
        va = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(self.features))], outputCol="_features",
                             handleInvalid="keep")
        x = df.withColumns({f"_f{i}": F.col(c).cast("double") for i, c in enumerate(self.features)})
        p = self.model.transform(va.transform(x))
        return p.withColumnRenamed("_rf", out).drop("_features", *[f"_f{i}" for i in range(len(self.features))])


MAX_DEPTH = 30              # the deepest tree that Spark grows
FOREST_MEMORY_MB = 256      # node histograms that a task holds at once
FOREST_TASK_ROWS = 500      # rows worth a task of their own


def fit_forest(df: DataFrame, features, target: str, num_trees: int = 200, max_samples: int | None = None,
               max_depth: int = MAX_DEPTH, seed: int = 42) -> ForestModel | BaggedForest:
    """Random forest of fully grown trees. Every tree sees all rows' bootstrap, or about ``max_samples`` rows
    where the caller asks for that (``subsamplingRate = min(1, max_samples / n)``).

    Bags that fit a task grow there (``forest.fit_bagged_forest``); others by Spark's forest, all rows for every level."""
    from pyspark.ml.regression import RandomForestRegressor
    train = _training_frame(df, [F.col(f"`{c}`") for c in features], target, "_f")
    n = train.count()
    rate = 1.0 if max_samples is None else min(1.0, max_samples / max(1, n))
    if max_samples is not None and n and rate * n <= BAG_ROWS:
        return fit_bagged_forest(train, n, features, target, num_trees, rate, max_depth, seed)
    # a stored frame of few files would train in few tasks
    tasks = min(df.sparkSession.sparkContext.defaultParallelism, -(-n // FOREST_TASK_ROWS))
    if train.rdd.getNumPartitions() < tasks:
        train = train.repartition(tasks)
    rf = RandomForestRegressor(featuresCol="_features", labelCol=target, predictionCol="_rf",
                               numTrees=num_trees, subsamplingRate=rate, maxDepth=max_depth, seed=seed,
                               featureSubsetStrategy="all", maxMemoryInMB=FOREST_MEMORY_MB)
    return ForestModel(list(features), rf.fit(train))


@dataclass
class ResidualModel:
    """M4/M5: a second model fitted on ``target - prediction``; predicts the sum."""
    inner: object
    prediction: str = "prediction"

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        p = self.inner.predict(df.withColumnRenamed(self.prediction, "_prev"), "_resid")
        return p.withColumn(out, F.col("_prev") + F.col("_resid")).drop("_prev", "_resid")


def fit_on_residuals(df: DataFrame, fit_fn, target: str = "target", prediction: str = "prediction") -> ResidualModel:
    """M5: ``fit_fn(frame, label_col) -> model with .predict(df, out)``."""
    r = df.withColumn("_residual", F.col(target) - F.col(prediction))
    return ResidualModel(fit_fn(r, "_residual"), prediction)


def fit_residual_forest(df: DataFrame, features=FOREST_FEATURES, target: str = "target",
                        prediction: str = "prediction", **kw) -> ResidualModel:
    """M4."""
    return fit_on_residuals(df, lambda d, y: fit_forest(d, features, y, **kw), target, prediction)


@dataclass
class LogTarget:
    """M8: fit on ``log1p(y)``, predict ``expm1``."""
    inner: object

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return self.inner.predict(df, out).withColumn(out, F.expm1(F.col(out)))


def fit_log_target(df: DataFrame, fit_fn, target: str = "target") -> LogTarget:
    return LogTarget(fit_fn(df.withColumn("_log_target", F.log1p(F.col(target))), "_log_target"))


def time_design_columns(df: DataFrame, ts: str, fit_start, date_col: str = "date") -> DataFrame:
    """Feature frame for the slice models: trend, Fourier terms, hour dummies."""
    d = df if date_col in df.columns else df.withColumn(date_col, F.to_date(ts))
    return d.select("*", C.trend(date_col, fit_start).alias("trend"), *C.fourier_terms(date_col),
                    *C.hour_dummies(ts))


def time_feature_names():
    return ["trend"] + C.fourier_names() + [f"hour_{k:02d}" for k in C.HOURS if k != C.BASELINE_HOUR]
