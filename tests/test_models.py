import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.operators import analysis as A
from gridpanel.operators import models as M
from gridpanel.operators.profiles import r_squared, rmse


def _planted(spark, n=600):
    rng = np.random.default_rng(0)
    rows = []
    slopes = {0: (2.0, -1.0), 1: (0.5, 3.0), 2: (-2.0, 0.25)}
    for i in range(n):
        g = i % 3
        a, b = rng.normal(), rng.normal()
        s1, s2 = slopes[g]
        rows.append((g, float(a), float(b), 3.0 + s1 * a + s2 * b, 3.0 + 2 * a - b))
    return spark.createDataFrame(rows, "g int, a double, b double, y_group double, y double")


def test_grouped_ols_recovers_planted_coefficients(spark):
    df = _planted(spark).repartition(5)
    m = M.fit_grouped_ols(df, ["a", "b"], "y_group", ["g"])
    got = {r.g: r.coef for r in m.coefficients.collect()}
    assert got[0] == pytest.approx([3.0, 2.0, -1.0], abs=1e-8)
    assert got[1] == pytest.approx([3.0, 0.5, 3.0], abs=1e-8)
    assert got[2] == pytest.approx([3.0, -2.0, 0.25], abs=1e-8)
    glob = M.fit_grouped_ols(df, ["a", "b"], "y").coefficients.first().coef
    assert glob == pytest.approx([3.0, 2.0, -1.0], abs=1e-8)
    pred = m.predict(df)
    assert rmse(pred, "prediction", "y_group").first().rmse < 1e-8
    assert r_squared(pred, "prediction", "y_group").first().r2 == pytest.approx(1.0)
    long = m.long_coefficients().filter("g = 1 AND term = 'b'").first()
    assert long.coefficient == pytest.approx(3.0)


def test_no_intercept_and_slice_models(spark):
    df = _planted(spark).withColumn("y0", 2 * F.col("a") - F.col("b"))
    c = M.fit_grouped_ols(df, ["a", "b"], "y0", intercept=False).coefficients.first().coef
    assert c == pytest.approx([2.0, -1.0], abs=1e-8)
    sl = M.fit_slice_models(df.withColumn("h", F.col("g") % 2), {"g": [0, 1, 2], "h": [0, 1]}, ["a", "b"], "y_group")
    out = M.apply_slice_models(df, sl, {"g": [0, 1, 2], "h": [0, 1, 5]})
    r = out.filter("g = 1").first()
    assert r.g1 == pytest.approx(r.y_group, abs=1e-8)
    assert r.h5 is None                              # no model for an undeclared slice value


def test_rank_deficient_design_is_min_norm(spark):
    df = _planted(spark).withColumn("a2", F.col("a"))
    c = M.fit_grouped_ols(df, ["a", "a2", "b"], "y").coefficients.first()
    assert c.rank == 3
    assert c.coef[1] == pytest.approx(1.0, abs=1e-6) and c.coef[2] == pytest.approx(1.0, abs=1e-6)


def test_segment_models_score_own_segment(spark):
    rows = [(bool(i % 2), float(i % 17), (1.0 if i % 2 else -1.0) * (i % 17)) for i in range(400)]
    df = spark.createDataFrame(rows, "is_business boolean, x double, target double")
    m = M.fit_segmented_ols(df, M.BlockDesign({}, [(None, "1"), (None, "x")]))
    out = m.predict(df)
    assert rmse(out, "prediction", "target").first().rmse < 1e-6


def test_residual_forest_improves_rmse(spark):
    rows = [(float(i % 50), float(i % 7), 0.1 * (i % 50) + (5.0 if i % 7 > 3 else 0.0)) for i in range(2000)]
    df = spark.createDataFrame(rows, "x double, z double, target double")
    lin = M.fit_grouped_ols(df, ["x"], "target")
    p = lin.predict(df)
    before = rmse(p).first().rmse
    rf = M.fit_residual_forest(p, ["x", "z"], num_trees=10, max_depth=4)
    after = rmse(rf.predict(p)).first().rmse
    assert after < 0.5 * before


def test_acf_pacf_consistent(spark):
    import datetime as dt
    rng = np.random.default_rng(1)
    x, rows = 0.0, []
    for h in range(500):
        x = 0.7 * x + rng.normal()
        rows.append((1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(x)))
    df = spark.createDataFrame(rows, "u int, t timestamp_ntz, v double")
    a = A.acf(df, ["u"], "t", "v", 5)
    acf = {r.lag: r.acf for r in a.collect()}
    assert acf[1] == pytest.approx(0.7, abs=0.1)
    p = {r.lag: r.pacf for r in A.pacf_from_acf(a, ["u"], 5).collect()}
    assert p[1] == pytest.approx(acf[1]) and abs(p[2]) < 0.15


def test_wide_design_grouped_ols(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 20))
    rows = [(int(i % 3), *map(float, x[i]), float(x[i] @ np.arange(20) + 1.0 + (i % 3))) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"x{i} double" for i in range(20)) + ", y double")
    m = M.fit_grouped_ols(df.repartition(4), [f"x{i}" for i in range(20)], "y", ["g"])
    got = {r.g: r for r in m.coefficients.collect()}
    for g in range(3):
        assert got[g].n == 300 and got[g].rank == 21
        assert got[g].coef == pytest.approx([1.0 + g] + list(range(20)), abs=1e-8)


def test_blocked_ols_equals_a_dense_solve(spark):
    """Coefficients per hour and weekday, redundant levels included, against least squares on all dummies."""
    rng = np.random.default_rng(5)
    n = 3000
    hour, day = rng.integers(0, 4, n), rng.integers(1, 4, n)
    x, z = rng.normal(size=n), rng.normal(size=n)
    y = hour + 0.5 * day + x * (1 + hour) - 0.3 * x * day + 2 * z + rng.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(int(a), int(b), float(c), float(d), float(e)) for a, b, c, d, e in zip(hour, day, x, z, y)],
                               "hour int, day int, x double, z double, target double").repartition(5)
    design = M.BlockDesign({"hour": (F.col("hour"), [0, 1, 2, 3]), "day": (F.col("day"), [1, 2, 3])},
                           [("hour", "1"), ("day", "1"), ("hour", "x"), ("day", "x"), (None, "z")])
    got = M.fit_blocked_ols(df, design).predict(df).select("hour", "day", "x", "z", "prediction").toPandas()
    dense = np.column_stack([*[(hour == k) for k in range(4)], *[(day == k) for k in range(1, 4)],
                             *[(hour == k) * x for k in range(4)], *[(day == k) * x for k in range(1, 4)], z]).astype(float)
    fitted = dense @ np.linalg.lstsq(dense, y, rcond=None)[0]
    key = lambda h, d, a: (int(h), int(d), round(float(a), 9))                                   # noqa: E731
    expect = {key(*t[:3]): t[3] for t in zip(hour, day, x, fitted)}
    assert len(got) == n
    for r in got.itertuples():
        assert r.prediction == pytest.approx(expect[key(r.hour, r.day, r.x)], abs=1e-6)


def test_wide_grams_keep_partitions_and_bound_accumulators(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 20))
    df = spark.createDataFrame([(int(i % 50), *map(float, x[i])) for i in range(2000)], "g int, " + ", ".join(f"x{i} double" for i in range(20)))
    monkeypatch.setattr(M, "HELD_BYTES", 8 * 200 * 10)             # ten groups' triangles
    rows = M.grouped_grams(df.repartition(6), [f"x{i}" for i in range(19)], "x19", ["g"]).collect()
    assert len(rows) == 50 and all(r.n == 40 for r in rows)
    z = np.column_stack([np.ones(40), x[7::50]])
    assert next(r for r in rows if r.g == 7).gram == pytest.approx((z.T @ z)[np.triu_indices(21)].tolist())
    plan = M.grouped_grams(df, [f"x{i}" for i in range(19)], "x19")._jdf.queryExecution().toString()
    assert "Coalesce" not in plan.split("== Physical Plan ==")[1]


def test_pipelines_predict_in_target_units(spark):
    """Both directions beat the mean of the training targets, and every test row gets a row."""
    from gridpanel.plans import pipelines as PL
    from gridpanel.plans.fixtures import load_panel, split_block
    p = load_panel(spark, "/root/testdata/sf0.01")
    t = p.dense_target
    lo = t.filter(F.col("data_block_id") < split_block(t))
    for consumption in (False, True):
        pipe = PL.Pipeline(p, t, consumption)
        got = pipe.one_stage(lambda d: M.fit_grouped_ols(d, ["target_2d_ago", "target_7d_ago"], "target"))
        joined = got.join(t.select("row_id", F.col("target").alias("truth")), "row_id").toPandas()
        assert len(joined) == t.filter((F.col("data_block_id") >= split_block(t)) & (F.col("is_consumption") == consumption)).count()
        mean = lo.filter(F.col("is_consumption") == consumption).agg(F.avg("target")).first()[0]
        error = ((joined.target - joined.truth) ** 2).mean() ** 0.5
        assert error < 1.5 * ((mean - joined.truth) ** 2).mean() ** 0.5
        assert 0.3 * joined.truth.mean() < joined.target.mean() < 3 * joined.truth.mean()


def test_a_pipeline_stores_its_target(spark, tmp_path):
    """History, hours, test rows and template each summed all events anew; only the training rows still do."""
    import datetime as dt
    from gridpanel.plans import pipelines as PL
    from gridpanel.plans.fixtures import load_panel
    rows = [(2 * i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 2, "view", float(i + 1)) for i in range(24 * 15)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    p = load_panel(spark, str(tmp_path))
    pipe = PL.Pipeline(p, p.dense_target, False)
    train, test = pipe.features("train"), pipe.features("inference")
    for frame in (pipe.history, pipe.rows, test, pipe.submission(test.withColumn("prediction", F.lit(1.0)))):
        assert frame.inputFiles() and not any("events.parquet" in f for f in frame.inputFiles())
    assert "events.parquet" not in pipe.rows.select(pipe.split)._jdf.queryExecution().toString()
    at = 14 * 2 // 3                                        # the first seven days have no lags
    assert train.count() == 24 * (at - 7) and test.count() == 24 * (15 - at)


def test_blocks_and_solar_across_new_year_and_past_2024(spark, tmp_path):
    """Rows around New Year and in 2026 keep their blocks, lags and solar positions."""
    import datetime as dt
    from gridpanel.operators.enrich import add_solar
    from gridpanel.plans import backtest as B
    from gridpanel.plans import features as FB
    from gridpanel.plans.fixtures import load_panel
    days = [dt.datetime(2024, 12, 29, 10) + dt.timedelta(days=i) for i in range(6)] + [dt.datetime(2026, 6, 1, 12)]
    rows = [(i, d, 2, "view", float(i + 1)) for i, d in enumerate(days)]
    spark.createDataFrame([(2 * i, d, u, e, v) for i, d, u, e, v in rows], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double") \
        .write.parquet(str(tmp_path / "events.parquet"))
    t = load_panel(spark, str(tmp_path)).target
    blocks = [r.data_block_id for r in t.orderBy("prediction_datetime").collect()]
    assert blocks[:6] == list(range(blocks[0], blocks[0] + 6)) and len(blocks) == 7
    scored = {r.row_id: r.prediction for r in B.persistence_backtest(t, t).collect()}
    truth = {r.row_id: r.target for r in t.collect()}
    assert scored[4] == pytest.approx(truth[0]) and scored[8] == pytest.approx(truth[4]) and scored[12] == 0.0
    solar = add_solar(t, FB.solar_of(spark, t), how="inner")
    assert solar.count() == 7 and solar.filter("solar_elevation is null").count() == 0


def test_lags_reach_python_as_arrays_of_numbers(spark):
    """An object for each element of a batch of series took gigabytes of the workers' memory."""
    import datetime as dt
    rng = np.random.default_rng(5)
    rows = [(u, dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h)), float(rng.random())) for u in range(700) for h in rng.choice(12, 6, replace=False)]
    df = spark.createDataFrame(rows, "u int, t timestamp_ntz, v double")
    found = A.acf(df, ["u"], "t", "v", 4)
    partial = A.pacf_from_acf(found, ["u"], 4)
    # what a batch holds: plain numbers, end to end
    r, k, v = A._flat([np.array([1, 3]), None, np.array([2])], [np.array([0.5, 0.25]), None, np.array([-1.0])])
    assert (r.tolist(), k.tolist(), v.tolist()) == ([0, 0, 2], [1, 3, 2], [0.5, 0.25, -1.0])
    got = {(x.u, x.lag): x.pacf for x in partial.collect()}
    at = {(x.u, x.lag): x.acf for x in found.collect()}
    assert len(got) == 2800
    for u in range(700):
        a, b = at.get((u, 1), 0.0), at.get((u, 2), 0.0)
        assert got[u, 1] == pytest.approx(a) and got[u, 2] == pytest.approx((b - a * a) / (1 - a * a))
