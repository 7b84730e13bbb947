"""Fits from sums by hour, PCA over long calendars, autocorrelation against numpy, features with targets."""
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.functions import calendar as C
from gridpanel.operators import analysis as A
from gridpanel.operators import models as M
from gridpanel.operators.assemble import with_targets
from gridpanel.operators.sizing import counted_rows, dimension


@pytest.fixture(scope="module")
def panel(spark):
    """Rows with lags over 30 days of hours, three segments; hours with two features, one hour without."""
    rng = np.random.default_rng(7)
    start = dt.datetime(2024, 3, 1)
    rows = []
    for i in range(4000):
        at = start + dt.timedelta(hours=int(rng.integers(0, 24 * 30)))
        lag = [float(v) for v in rng.normal(size=2)]
        rows.append((i, int(rng.integers(0, 3)), at, *lag, float(at.hour + lag[0] * at.isoweekday() - lag[1] + rng.normal())))
    rows += [(4000, 1, start, None, 1.0, 2.0), (4001, 1, start, 1.0, float("nan"), 2.0), (4002, 1, start, 1.0, 1.0, None), (4003, 2, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "row_id long, seg int, prediction_datetime timestamp_ntz, target_2d_ago double, target_7d_ago double, target double").repartition(5)
    hours = [(start + dt.timedelta(hours=h), float(h), float(np.sin(h / 7)) if h else None) for h in range(24 * 30)]
    times = dimension(spark.createDataFrame(hours, "prediction_datetime timestamp_ntz, trend double, wave double"))
    return df, times


def test_cells_give_the_grams_of_the_rows(spark, panel):
    df, times = panel
    features = ["target_7d_ago", "trend", "target_2d_ago", "wave"]
    joined = df.join(times, "prediction_datetime", "left")
    want = {r.seg: r for r in M.grouped_grams(joined, features, "target", ["seg"]).collect()}
    lags = ["target_2d_ago", "target_7d_ago"]
    got = {r.seg: r for r in M.grams_of_cells(M.hour_cells(df, lags, "target", ["seg"]), times, features, lags, ["seg"]).collect()}
    assert set(got) == set(want) == {0, 1, 2}
    for seg in want:
        assert got[seg].n == want[seg].n
        assert np.allclose(got[seg].gram, want[seg].gram, rtol=1e-9)
    assert M.grams_of_cells(M.hour_cells(df.limit(0), lags, "target", ["seg"]), times, features, lags, ["seg"]).count() == 0
    assert counted_rows(times) == 720 and counted_rows(times.select("trend")) is None


def test_blocks_by_hour_equal_blocks_by_row(spark, panel):
    df, times = panel
    design = M.BlockDesign({"weekday": (C.weekday_iso("prediction_datetime"), list(range(1, 8))), "hour": (F.hour("prediction_datetime"), C.HOURS)},
                           [("weekday", "1"), ("hour", "1"), ("weekday", "target_2d_ago"), (None, "target_7d_ago"), (None, "wave"), ("hour", "trend")])
    joined = df.join(times, "prediction_datetime", "left")
    by_row = M.fit_blocked_ols(joined, design, segments=["seg"])
    by_hour = M.fit_blocked_ols_by_hour(df, times, design, M.ROW_LAGS, segments=["seg"])
    assert set(by_row.theta) == set(by_hour.theta)
    want = {r.row_id: r.prediction for r in by_row.predict(joined).select("row_id", "prediction").collect()}
    out = by_hour.predict(df.unionByName(df.limit(1).withColumns({"row_id": F.lit(9000).cast("long"), "seg": F.lit(9)})))
    got = {r.row_id: r.prediction for r in out.collect()}
    assert out.columns == df.columns + ["prediction"]
    assert got.pop(9000) is None                                     # a segment without a model
    assert set(got) == set(want)
    for k, v in want.items():
        assert (v is None and got[k] is None) or (v != v and got[k] != got[k]) or got[k] == pytest.approx(v, abs=1e-7), k


def test_blocks_by_hour_without_training_rows(spark, panel):
    df, times = panel
    design = M.BlockDesign({"hour": (F.hour("prediction_datetime"), C.HOURS)}, [("hour", "1"), (None, "target_2d_ago")])
    model = M.fit_blocked_ols_by_hour(df.limit(0), times, design, M.ROW_LAGS, segments=["seg"])
    out = model.predict(df)
    assert out.count() == df.count() and out.filter("prediction is not null").count() == 0


def test_slices_by_hour_equal_slices_by_row(spark, panel):
    df, times = panel
    times = times.fillna(0.0)
    df = df.withColumn("flag", F.col("row_id") % 2 == 0).filter("target is not null and prediction_datetime is not null")
    slices = M.slice_domain(df, ["seg", "flag"])
    assert slices == {"seg": [0, 1, 2], "flag": [0, 1]}
    joined = df.join(times, "prediction_datetime")
    a = M.apply_slice_models(joined, M.fit_slice_models(joined, slices, ["trend", "wave"], "target"), slices)
    b = M.apply_slice_models_by_hour(df, M.fit_slice_models_by_hour(df, times, slices, ["trend", "wave"], "target"), times, slices)
    names = ["seg0", "seg1", "seg2", "flag0", "flag1"]
    want = {r.row_id: [r[n] for n in names] for r in a.select("row_id", *names).collect()}
    got = {r.row_id: [r[n] for n in names] for r in b.select("row_id", *names).collect()}
    assert set(got) == set(want)
    assert all(np.allclose(got[k], want[k], atol=1e-8) for k in want)


def test_slice_domain_is_bounded(spark):
    with pytest.raises(ValueError):
        M.slice_domain(spark.range(30), ["id"], most=20)


def test_pca_over_two_years_of_dates(spark):
    """A plan that does not grow with the calendar; reconstruction equals numpy's."""
    rng = np.random.default_rng(2)
    units, days = 14, 730
    base = rng.normal(size=(3, days)).cumsum(1)
    x = rng.normal(size=(units, 3)) @ base + rng.normal(scale=0.05, size=(units, days))
    first = dt.date(2022, 1, 1)
    holes = rng.random((units, days)) < 0.1
    rows = [(u, u % 2 == 0, first + dt.timedelta(days=d), float(x[u, d])) for u in range(units) for d in range(days) if not holes[u, d]]
    df = spark.createDataFrame(rows, "u int, side boolean, d date, v double").repartition(4)
    dates = A.date_range(df, "d")
    assert len(dates) == days
    t = A.trajectories(df, ["u", "side"], "d", "v", dates)
    got = A.pca_reconstruct(t, ["u", "side"], dates, 3).toPandas()
    m = np.where(holes, np.nan, x)
    m = np.nan_to_num(m - np.nanmean(m, 1, keepdims=True))
    centred = m - m.mean(0)
    _, _, vt = np.linalg.svd(centred, full_matrices=False)
    want = centred @ vt[:3].T @ vt[:3]
    assert len(got) == units * days
    got = got.sort_values(["u", "date"])
    assert np.allclose(got["value"].to_numpy().reshape(units, days), m, atol=1e-9)
    assert np.allclose(got["reconstructed"].to_numpy().reshape(units, days), want, atol=1e-6)
    assert A.pca_reconstruct(t.limit(0), ["u", "side"], dates).count() == 0
    with pytest.raises(ValueError):
        A.trajectories(df, "u", "d", "v", dates * 6)


@pytest.mark.parametrize("offset", [0.0, 1e4])
def test_acf_equals_numpy(spark, offset):
    rng = np.random.default_rng(3)
    start, rows, series = dt.datetime(2024, 1, 1), [], {}
    for u in range(3):
        v = rng.normal(size=400).cumsum() + offset
        have = rng.random(400) < 0.8
        series[u] = (v, have)
        rows += [(u, start + dt.timedelta(hours=h), float(v[h])) for h in range(400) if have[h]]
    df = spark.createDataFrame(rows + [(1, start, None)], "u int, t timestamp_ntz, v double").repartition(4)
    got = {(r.u, r.lag): r.acf for r in A.acf(df, ["u"], "t", "v", 10).collect()}
    for u, (v, have) in series.items():
        c = np.where(have, v - v[have].mean(), 0.0)
        for k in range(1, 11):
            assert got[u, k] == pytest.approx((c[:-k] * c[k:]).sum() / (c * c).sum(), abs=1e-8)


def test_features_with_targets(spark):
    f = spark.createDataFrame([(1, 2.0, 9.0), (2, 3.0, 9.0), (2, 4.0, 9.0), (None, 1.0, 9.0)], "row_id long, x double, target double")
    y = spark.createDataFrame([(2, 0.5, "a"), (3, 0.7, "b"), (None, 0.1, "c")], "row_id long, target double, other string")
    assert sorted(tuple(r) for r in with_targets(f, y).collect()) == [(2, 3.0, 0.5), (2, 4.0, 0.5)]
