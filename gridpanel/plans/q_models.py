"""Queries: grouped and global models, feature builders."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..operators import models as M
from ..operators.assemble import assemble_client, with_targets
from ..operators.lags import add_lags
from ..operators.normalise import apply_unit_max, group_max
from ..operators.profiles import r_squared
from ..operators.sizing import dimension
from ..session import cut_lineage
from . import features as FB
from . import pipelines as PL
from .fixtures import SPLIT, load_panel, split_block
from .oracle_sql import solar_select
from .registry import query, rounded

_HOUR = "CAST(hour(prediction_datetime) AS DOUBLE)"


def _unit_hour_ols(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.withColumn("hour", C.hour_of_day("prediction_datetime").cast("double"))
    return t, M.fit_grouped_ols(t, ["hour"], "target", ["prediction_unit_id", "is_consumption"])


@query("m7_per_unit_ols", f"""
SELECT prediction_unit_id, is_consumption, round(regr_intercept(target, {_HOUR}), 6) AS intercept,
       round(regr_slope(target, {_HOUR}), 6) AS slope, count(*) AS n
FROM tgt GROUP BY 1, 2 HAVING count(DISTINCT {_HOUR}) >= 2""", ("tgt",))
def m7_per_unit(spark, sf_dir):
    _, m = _unit_hour_ols(spark, sf_dir)
    c = m.coefficients.filter(F.col("rank") == 2)
    return rounded(c.select("prediction_unit_id", "is_consumption", F.col("coef")[0].alias("intercept"),
                            F.col("coef")[1].alias("slope"), "n"))


@query("t2_m7_walk_forward", f"""
WITH f AS (SELECT row_id, data_block_id, {_HOUR} AS x, regr_intercept(target, {_HOUR}) OVER w AS a, regr_slope(target, {_HOUR}) OVER w AS b, count(*) OVER w AS n,
                  min({_HOUR}) OVER w < max({_HOUR}) OVER w AS several
           FROM tgt WINDOW w AS (PARTITION BY prediction_unit_id, is_consumption ORDER BY data_block_id RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING))
SELECT row_id, data_block_id, n, round(a + b * x, 6) AS prediction FROM f WHERE several""", ("tgt",))
def t2_m7_walk(spark, sf_dir):
    """Every row scored by its unit's model of all blocks known two blocks before, refitted per block in one plan."""
    keys, features = ["prediction_unit_id", "is_consumption"], ["hour"]
    t = load_panel(spark, sf_dir).target.withColumn("hour", C.hour_of_day("prediction_datetime").cast("double"))
    grams = cut_lineage(M.block_grams(t, features, "target", keys))
    fits = M.walk_forward_ols(grams, t, features, keys).filter(F.col("rank") == 2)
    scored = M.walk_forward_predict(t, fits, features, keys).join(fits.select(*keys, "data_block_id", "n"), [*keys, "data_block_id"])
    return rounded(scored.select("row_id", "data_block_id", "n", "prediction"))


@query("m14_coefficients_long", f"""
SELECT prediction_unit_id, is_consumption, 'intercept' AS term, round(regr_intercept(target, {_HOUR}), 6) AS coefficient
FROM tgt GROUP BY 1, 2 HAVING count(DISTINCT {_HOUR}) >= 2
UNION ALL
SELECT prediction_unit_id, is_consumption, 'hour' AS term, round(regr_slope(target, {_HOUR}), 6) AS coefficient
FROM tgt GROUP BY 1, 2 HAVING count(DISTINCT {_HOUR}) >= 2""", ("tgt",))
def m14_long(spark, sf_dir):
    _, m = _unit_hour_ols(spark, sf_dir)
    m.coefficients = m.coefficients.filter(F.col("rank") == 2)
    return rounded(m.long_coefficients())


@query("m7_per_unit_predict", f"""
WITH c AS (SELECT prediction_unit_id, is_consumption, regr_intercept(target, {_HOUR}) AS a,
                  regr_slope(target, {_HOUR}) AS b
           FROM tgt WHERE data_block_id < {SPLIT.format('tgt')} GROUP BY 1, 2 HAVING count(DISTINCT {_HOUR}) >= 2)
SELECT t.row_id, round(c.a + c.b * {_HOUR}, 6) AS prediction
FROM tgt t JOIN c ON t.prediction_unit_id = c.prediction_unit_id AND t.is_consumption = c.is_consumption
WHERE t.data_block_id >= {SPLIT.format('tgt')}""", ("tgt",))
def m7_predict(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.withColumn("hour", C.hour_of_day("prediction_datetime").cast("double"))
    at = split_block(t)
    m = M.fit_grouped_ols(t.filter(F.col("data_block_id") < at), ["hour"], "target",
                          ["prediction_unit_id", "is_consumption"])
    m.coefficients = m.coefficients.filter(F.col("rank") == 2)
    return rounded(m.predict(t.filter(F.col("data_block_id") >= at)).select("row_id", "prediction"))


_ASM = """asm AS (SELECT t.*, c.eic_count, c.installed_capacity
  FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business
   AND t.product_type = c.product_type AND CAST(t.prediction_datetime AS DATE) = c.date)"""


@query("m9_ols_no_intercept", f"""
WITH {_ASM},
s AS (SELECT is_consumption, sum(eic_count * eic_count) AS a11, sum(eic_count * installed_capacity) AS a12,
             sum(installed_capacity * installed_capacity) AS a22, sum(eic_count * target) AS b1,
             sum(installed_capacity * target) AS b2 FROM asm GROUP BY 1)
SELECT is_consumption, round((a22 * b1 - a12 * b2) / (a11 * a22 - a12 * a12), 6) AS b_eic_count,
       round((a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12), 6) AS b_installed_capacity FROM s""",
       ("tgt", "cli"))
def m9_no_intercept(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    a = assemble_client(p.target, p.client, "train")
    m = M.fit_grouped_ols(a, ["eic_count", "installed_capacity"], "target", ["is_consumption"], intercept=False)
    return rounded(m.coefficients.select("is_consumption", F.col("coef")[0].alias("b_eic_count"),
                                         F.col("coef")[1].alias("b_installed_capacity")))


@query("m11_g12_ols_train_r2", f"""
SELECT is_consumption, round(regr_r2(target, {_HOUR}), 6) AS r2 FROM tgt GROUP BY 1""", ("tgt",))
def m11_r2(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.withColumn("hour", C.hour_of_day("prediction_datetime").cast("double"))
    m = M.fit_grouped_ols(t, ["hour"], "target", ["is_consumption"])
    return rounded(r_squared(m.predict(t), by=["is_consumption"]))


SLICES = {"county": [0, 1, 2], "is_business": [0, 1], "product_type": [0, 1]}


@query("m6_j18_slice_model_features")
def m6_slices(spark, sf_dir):
    """22-model form on the fixture's 3 + 2 + 2 slices: fitted on unit-max-normalised
    targets, all slice models applied to every row as features."""
    t = load_panel(spark, sf_dir).target
    mv = group_max(t)
    norm = apply_unit_max(t, mv)
    fs = norm.select(F.min(F.to_date("prediction_datetime"))).scalar()
    hours = norm.select("prediction_datetime").distinct()
    times = dimension(M.time_design_columns(hours, "prediction_datetime", fs))
    slices = M.slice_domain(t, list(SLICES))
    model = M.fit_slice_models_by_hour(norm, times, slices, M.time_feature_names(), "target")
    out = M.apply_slice_models_by_hour(norm, model, times, slices)
    return out.select("row_id", "prediction_unit_id", *[f"{c}{v}" for c, vs in slices.items() for v in vs])


@query("m6_j18_slices_one_feature", f"""
WITH mv AS (SELECT prediction_unit_id, max(target) AS max_value FROM tgt GROUP BY 1),
x AS (SELECT t.row_id, t.prediction_unit_id, t.county, CAST(t.is_business AS INTEGER) AS is_business, t.product_type,
             {_HOUR} AS hour, t.target / nullif(max_value, 0) AS y FROM tgt t JOIN mv USING (prediction_unit_id)),
{", ".join(f"{c}_m AS (SELECT {c} AS v, regr_intercept(y, hour) AS a, regr_slope(y, hour) AS b FROM x GROUP BY 1)" for c in SLICES)}
SELECT row_id, {", ".join(f"round((SELECT a FROM {c}_m WHERE v = {v}) + (SELECT b FROM {c}_m WHERE v = {v}) * hour, 6) AS {c}{v}" for c, vs in SLICES.items() for v in vs)}
FROM x""", ("tgt",))
def m6_one_feature(spark, sf_dir):
    """Slices from the data's own domain, one feature, so that SQL can fit the same models."""
    t = load_panel(spark, sf_dir).target
    x = apply_unit_max(t, group_max(t)).withColumn("hour", C.hour_of_day("prediction_datetime").cast("double"))
    slices = M.slice_domain(t, list(SLICES))
    out = M.apply_slice_models(x, M.fit_slice_models(x, slices, ["hour"], "target"), slices)
    return rounded(out.select("row_id", *[f"{c}{v}" for c, vs in SLICES.items() for v in vs]))


def _dense(spark, sf_dir, consumption):
    p = load_panel(spark, sf_dir)
    return PL.Pipeline(p, p.dense_target, consumption)


@query("m1_production_formula_ols")
def m1_production(spark, sf_dir):
    pipe = _dense(spark, sf_dir, False)
    return pipe.one_stage(pipe.production)


@query("m2_m3_consumption_segmented_ols")
def m2_consumption(spark, sf_dir):
    pipe = _dense(spark, sf_dir, True)
    return pipe.one_stage(pipe.consumption)


def _lagged(spark, sf_dir, consumption):
    """Dense rows of one direction with both lags, and all hours with their features."""
    t = load_panel(spark, sf_dir).dense_target
    rows = add_lags(t.filter(F.col("is_consumption") == consumption), t, "target", (2, 7), "train")
    return rows, FB.hour_features(spark, t, t.select(F.min(F.to_date("prediction_datetime"))).scalar())


def _cells_sql(direction: str, cell: str) -> str:
    return f"""
WITH x AS (SELECT t.row_id, t.is_business, CAST({cell} AS INTEGER) AS cell, t.target AS y, h.target AS x FROM dtgt t
  JOIN dtgt h ON h.prediction_unit_id = t.prediction_unit_id AND h.is_consumption = t.is_consumption AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY
  JOIN dtgt w ON w.prediction_unit_id = t.prediction_unit_id AND w.is_consumption = t.is_consumption AND w.prediction_datetime = t.prediction_datetime - INTERVAL 7 DAY
  WHERE {direction}),
m AS (SELECT is_business, cell, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM x GROUP BY 1, 2)
SELECT row_id, round(a + b * x, 4) AS prediction FROM x JOIN m USING (is_business, cell)"""


@query("m1_hour_cells", _cells_sql("NOT t.is_consumption", "hour(t.prediction_datetime)"), ("dtgt",))
def m1_hour_cells(spark, sf_dir):
    """The production design's hour levels with one row column, which SQL can fit hour by hour."""
    rows, times = _lagged(spark, sf_dir, False)
    design = M.BlockDesign({"hour": (F.hour("prediction_datetime"), C.HOURS)}, [("hour", "1"), ("hour", "target_2d_ago")])
    model = M.fit_blocked_ols_by_hour(rows, times, design, M.ROW_LAGS, segments=["is_business"])
    return rounded(model.predict(rows).select("row_id", "prediction"), 4)


@query("m2_m3_weekday_cells", _cells_sql("t.is_consumption", "isodow(t.prediction_datetime)"), ("dtgt",))
def m2_weekday_cells(spark, sf_dir):
    """The consumption design's weekday levels by business flag."""
    rows, times = _lagged(spark, sf_dir, True)
    design = M.BlockDesign({"weekday": (C.weekday_iso("prediction_datetime"), list(range(1, 8)))}, [("weekday", "1"), ("weekday", "target_2d_ago")])
    model = M.fit_blocked_ols_by_hour(rows, times, design, M.ROW_LAGS, segments=["is_business"])
    return rounded(model.predict(rows).select("row_id", "prediction"), 4)


@query("m4_forest_invariants", """
SELECT DISTINCT is_consumption, true AS better_than_linear, true AS in_range FROM dtgt""", ("dtgt",))
def m4_invariants(spark, sf_dir):
    """By direction: the residual forest (fixed seed) lowers the training error of the linear stage, and no predicted
    residual leaves the range of those it was fitted on."""
    out = []
    for consumption in (False, True):
        pipe = _dense(spark, sf_dir, consumption)
        train = cut_lineage(pipe.features("train"))
        first = (pipe.consumption if consumption else pipe.production)(train)
        staged = cut_lineage(FB.ForestStage(pipe.panel).add(first.predict(train)))
        forest = M.fit_residual_forest(staged, num_trees=20, max_samples=10_000)
        resid = F.col("target") - F.col("_first")
        both = forest.predict(staged).join(staged.select("row_id", F.col("prediction").alias("_first")), "row_id")
        out.append(both.agg((F.avg((F.col("target") - F.col("prediction")) ** 2) < F.avg(resid ** 2)).alias("better_than_linear"),
                            ((F.max(F.col("prediction") - F.col("_first")) <= F.max(resid) + 1e-9)
                             & (F.min(F.col("prediction") - F.col("_first")) >= F.min(resid) - 1e-9)).alias("in_range"))
                   .select(F.lit(consumption).alias("is_consumption"), "better_than_linear", "in_range"))
    return out[0].unionAll(out[1])


@query("m10_forest_invariants", """
SELECT DISTINCT is_consumption, true AS better_than_mean, true AS in_range FROM tgt""", ("tgt",))
def m10_invariants(spark, sf_dir):
    """The direct forest (fixed seed) explains training rows better than their mean, inside the range of the target."""
    p = load_panel(spark, sf_dir)
    a = cut_lineage(FB.forest_stage_features(assemble_client(p.target, p.client, "train"), p))
    scored = M.fit_forest(a, M.FOREST_FEATURES, "target", num_trees=20, max_samples=5000).predict(a)
    return scored.groupBy("is_consumption").agg(
        (F.avg((F.col("target") - F.col("prediction")) ** 2) < F.var_pop("target")).alias("better_than_mean"),
        ((F.max("prediction") <= a.select(F.max("target")).scalar() + 1e-9) & (F.min("prediction") >= a.select(F.min("target")).scalar() - 1e-9)).alias("in_range"))


@query("j14_features_with_targets", f"""
WITH {_ASM}
SELECT a.row_id, a.eic_count, a.installed_capacity, y.target FROM asm a JOIN tgt y ON y.row_id = a.row_id WHERE y.is_consumption""", ("tgt", "cli"))
def j14_with_targets(spark, sf_dir):
    """Features and the truth of one direction, by row id, as a wrapped model joins them before its fit."""
    p = load_panel(spark, sf_dir)
    features = assemble_client(p.target, p.client, "train").select("row_id", "eic_count", "installed_capacity")
    return with_targets(features, p.target.filter("is_consumption"))


@query("m4_m5_m12_m13_stacked_pipeline")
def m13_pipeline(spark, sf_dir):
    """Production: normalise, linear stage, residual forest, denormalise, submission."""
    pipe = _dense(spark, sf_dir, False)
    return pipe.two_stage(pipe.production, PL.fit_forest_stage)


@query("m13_consumption_pipeline")
def m13_consumption(spark, sf_dir):
    """Consumption: linear stage per business flag, residual forest, submission; raw units throughout."""
    pipe = _dense(spark, sf_dir, True)
    return pipe.two_stage(pipe.consumption, PL.fit_forest_stage)


def _two_stage_sql() -> str:
    cap = "t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type"
    return f"""
WITH norm AS (
  SELECT t.*, c.eic_count, c.installed_capacity, t.target / nullif(c.installed_capacity, 0) AS y
  FROM dtgt t JOIN cli c ON {cap} AND CAST(t.prediction_datetime AS DATE) = c.date),
lag AS (
  SELECT r.row_id, l2.y AS x2, l7.y AS x7 FROM dtgt r
  LEFT JOIN norm l2 ON l2.prediction_unit_id = r.prediction_unit_id AND l2.is_consumption = r.is_consumption
    AND l2.prediction_datetime = r.prediction_datetime - INTERVAL 2 DAY
  LEFT JOIN norm l7 ON l7.prediction_unit_id = r.prediction_unit_id AND l7.is_consumption = r.is_consumption
    AND l7.prediction_datetime = r.prediction_datetime - INTERVAL 7 DAY),
train AS (
  SELECT n.row_id, n.county, n.prediction_datetime, n.y, g.x2 FROM norm n JOIN lag g USING (row_id)
  WHERE NOT n.is_consumption AND n.data_block_id < {SPLIT.format('dtgt')} AND n.y IS NOT NULL AND g.x2 IS NOT NULL AND g.x7 IS NOT NULL),
first AS (SELECT regr_intercept(y, x2) AS a, regr_slope(y, x2) AS b FROM train),
station AS (
  SELECT county, arg_min(latitude, (longitude, -latitude)) AS latitude, arg_min(longitude, (longitude, -latitude)) AS longitude
  FROM stn GROUP BY 1),
weather AS (
  SELECT s.county, f.forecast_datetime, coalesce(f.temperature, 0) AS temperature
  FROM station s JOIN (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, forecast_datetime ORDER BY hours_ahead) AS n FROM wf) f
    ON f.latitude = s.latitude AND f.longitude = s.longitude AND f.n = 1),
resid AS (
  SELECT t.y - (a + b * t.x2) AS r, w.temperature FROM train t JOIN weather w
    ON w.county = t.county AND w.forecast_datetime = t.prediction_datetime, first),
second AS (SELECT regr_intercept(r, temperature) AS a, regr_slope(r, temperature) AS b FROM resid),
test AS (SELECT * FROM dtgt WHERE NOT is_consumption AND data_block_id >= {SPLIT.format('dtgt')}),
scored AS (
  SELECT t.row_id, (f.a + f.b * coalesce(g.x2, 0) + s.a + s.b * w.temperature) * c.installed_capacity AS p
  FROM test t JOIN cli c ON {cap} AND t.date_when_predicting = c.date JOIN lag g USING (row_id)
  JOIN weather w ON w.county = t.county AND w.forecast_datetime = t.prediction_datetime, first f, second s)
SELECT t.row_id, t.data_block_id, round(coalesce(p, 0.0), 4) AS target FROM test t LEFT JOIN scored USING (row_id)"""


@query("m5_m13_two_stage_ols", _two_stage_sql(), ("dtgt", "cli", "stn", "wf"))
def m13_two_stage(spark, sf_dir):
    """The stacked pipeline with least squares in both stages: lag of two days, then temperature on the residual."""
    first = lambda d: M.fit_grouped_ols(d, ["target_2d_ago"], "target")                                     # noqa: E731
    second = lambda d: M.fit_on_residuals(d, lambda x, y: M.fit_grouped_ols(x, ["temperature"], y))         # noqa: E731
    return rounded(_dense(spark, sf_dir, False).two_stage(first, second), 4)


@query("m3_segmented_ols", f"""
WITH m AS (SELECT is_business, regr_intercept(target, {_HOUR}) AS a, regr_slope(target, {_HOUR}) AS b FROM dtgt GROUP BY 1)
SELECT row_id, round(m.a + m.b * {_HOUR}, 6) AS prediction FROM dtgt JOIN m USING (is_business)""", ("dtgt",))
def m3_segmented(spark, sf_dir):
    """The segment models' own path on a design of one column, which SQL can fit."""
    t = load_panel(spark, sf_dir).dense_target.withColumn("h", C.hour_of_day("prediction_datetime").cast("double"))
    model = M.fit_segmented_ols(t, M.BlockDesign({}, [(None, "1"), (None, "h")]))
    return rounded(model.predict(t).select("row_id", "prediction"))


@query("m8_log_target_two_regressors", f"""
WITH {_ASM},
x AS (SELECT row_id, ln(1 + installed_capacity) AS u, CAST(eic_count AS DOUBLE) AS v, ln(1 + target) AS y FROM asm WHERE NOT is_consumption),
s AS (SELECT sum(u * u) AS uu, sum(u * v) AS uv, sum(v * v) AS vv, sum(u * y) AS uy, sum(v * y) AS vy FROM x)
SELECT row_id, round(exp(u * (vv * uy - uv * vy) / (uu * vv - uv * uv) + v * (uu * vy - uv * uy) / (uu * vv - uv * uv)) - 1, 5) AS prediction
FROM x, s""", ("tgt", "cli"))
def m8_two(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    a = assemble_client(p.target.filter("NOT is_consumption"), p.client, "train").withColumn("capacity", F.log1p("installed_capacity"))
    m = M.fit_log_target(a, lambda d, y: M.fit_grouped_ols(d, ["capacity", "eic_count"], y, intercept=False))
    return rounded(m.predict(a).select("row_id", "prediction"), 5)


@query("m8_m9_log_target_minimal")
def m8_minimal(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    f = FB.minimal_features(p, FB.solar_of(spark, p.target)).filter(~F.col("is_consumption"))
    cols = ["installed_capacity", "eic_count", "solar_azimuth", "solar_elevation"]
    m = M.fit_log_target(f, lambda d, y: M.fit_grouped_ols(d, cols, y, intercept=False))
    return m.predict(f).select("row_id", "prediction")


@query("m10_forest_capped_samples")
def m10_forest(spark, sf_dir):
    """Direct forest on the assembled features: 100 trees of 1,000 samples, the values of the older, direct forest."""
    p = load_panel(spark, sf_dir)
    a = FB.forest_stage_features(assemble_client(p.target, p.client, "train"), p)
    m = M.fit_forest(a, M.FOREST_FEATURES, "target", num_trees=100, max_samples=1000)
    return m.predict(a).select("row_id", "prediction")


_SOL = """(SELECT unnest(generate_series((SELECT min(prediction_datetime) FROM tgt), (SELECT max(prediction_datetime) FROM tgt),
   INTERVAL 1 HOUR)) AS datetime) h"""


@query("a3_j4_ar_features", f"""
WITH sol AS ({solar_select(_SOL, "datetime", "58.6", "25.01")})
SELECT t.prediction_unit_id, t.row_id, round(ln(1 + c.installed_capacity), 6) AS installed_capacity, c.eic_count,
       round(s.solar_azimuth, 6) AS solar_azimuth, round(s.solar_elevation, 6) AS solar_elevation,
       round(ln(1 + h.target), 6) AS target_previous, round(t.target, 6) AS target
FROM tgt t
JOIN tgt h ON h.prediction_unit_id = t.prediction_unit_id AND NOT h.is_consumption
  AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY
JOIN cli c ON t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type
  AND CAST(t.prediction_datetime AS DATE) = c.date
JOIN sol s ON s.datetime = t.prediction_datetime
WHERE NOT t.is_consumption""", ("tgt", "cli"))
def a3_ar(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    return rounded(FB.ar_features(p, FB.solar_of(spark, p.target)))


@query("a3_minimal_features", f"""
WITH sol AS ({solar_select(_SOL, "datetime", "58.6", "25.01")})
SELECT t.prediction_unit_id, t.row_id, round(ln(1 + c.installed_capacity), 6) AS installed_capacity, c.eic_count,
       round(s.solar_azimuth, 6) AS solar_azimuth, round(s.solar_elevation, 6) AS solar_elevation,
       round(t.target, 6) AS target, t.is_consumption
FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type
  AND CAST(t.prediction_datetime AS DATE) = c.date
JOIN sol s ON s.datetime = t.prediction_datetime""", ("tgt", "cli"))
def a3_minimal(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    return rounded(FB.minimal_features(p, FB.solar_of(spark, p.target)))


def _a4_sql():
    import math
    r = "((dayofyear(d) - 1) / dayofyear(make_date(year(d), 12, 31)))"
    four = ", ".join(f"round({fn}(CAST('{2 * math.pi * k!r}' AS DOUBLE) * {r}), 6) AS {fn}_{k}"
                     for k in range(1, 7) for fn in ("sin", "cos"))
    week = ", ".join(f"CAST((d - fs) % 7 = {k} AS INTEGER) AS s{k + 1}_7" for k in range(1, 7))
    hours = ", ".join(f"CAST(hour(t.prediction_datetime) = {k} AS INTEGER) AS hour_{k:02d}"
                      for k in range(24) if k != 10)
    return f"""
WITH b AS (SELECT min(CAST(prediction_datetime AS DATE)) AS fs FROM tgt),
t AS (SELECT *, CAST(prediction_datetime AS DATE) AS d FROM tgt)
SELECT t.row_id, t.prediction_unit_id, t.is_consumption, round(ln(1 + c.installed_capacity), 6) AS installed_capacity,
       CAST(1.0 AS DOUBLE) AS const, CAST(d - fs + 1 AS DOUBLE) AS trend, {week}, {four}, {hours}
FROM t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type
  AND t.date_when_predicting = c.date, b"""


@query("a4_f3_regression_features", _a4_sql(), ("tgt", "cli"))
def a4_regression(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    fs = p.target.select(F.min(F.to_date("prediction_datetime"))).scalar()
    out = FB.regression_features(p, fs).drop("data_block_id")
    return rounded(out, cols=["installed_capacity"] + C.fourier_names())


def _time_features_sql() -> str:
    base = _a4_sql()
    return base.replace("round(ln(1 + c.installed_capacity), 6) AS installed_capacity,", "t.county, t.is_business, t.product_type,")


@query("a4_make_time_features", _time_features_sql(), ("tgt", "cli"))
def a4_time(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    fs = p.target.select(F.min(F.to_date("prediction_datetime"))).scalar()
    return rounded(FB.make_time_features(p.target, p.client, fs), cols=C.fourier_names())
