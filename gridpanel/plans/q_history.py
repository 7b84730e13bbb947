"""Queries: history, block backtest, submission, analysis."""
from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..operators import analysis as A
from ..operators.enrich import add_solar
from ..operators.models import fit_grouped_ols
from ..operators.normalise import apply_unit_max, group_max
from ..schemas import PANEL_KEY
from . import backtest as B
from .features import solar_of
from .fixtures import SPLIT, load_panel, split_block
from .oracle_sql import solar_select
from .registry import query, rounded

_H = "SELECT prediction_unit_id, is_consumption, prediction_datetime, target FROM tgt"


# history: all blocks before the split, of every fourth unit only those three blocks earlier (late units);
# new rows: all blocks from three before the split to the end. Together they are the whole table.
_HN = f"""h AS ({_H} WHERE data_block_id < {SPLIT.format('tgt')} - CASE WHEN prediction_unit_id % 4 = 0 THEN 3 ELSE 0 END),
n AS ({_H} WHERE data_block_id >= {SPLIT.format('tgt')} - 3)"""


def _history_and_new(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    at, late = split_block(t), F.when(F.col("prediction_unit_id") % 4 == 0, 3).otherwise(0)
    return t.filter(F.col("data_block_id") < at - late), t.filter(F.col("data_block_id") >= at - 3)


@query("t1_history_high_water", f"""
WITH {_HN}
SELECT * FROM h UNION SELECT * FROM n WHERE prediction_datetime > (SELECT max(prediction_datetime) FROM h)""",
       ("tgt",))
def t1_history(spark, sf_dir):
    return B.update_history(*_history_and_new(spark, sf_dir))


@query("t1_history_per_series_mark", f"""
WITH {_HN},
m AS (SELECT prediction_unit_id, is_consumption, max(prediction_datetime) AS mark FROM h GROUP BY 1, 2)
SELECT * FROM h UNION
SELECT n.* FROM n LEFT JOIN m ON n.prediction_unit_id = m.prediction_unit_id AND n.is_consumption = m.is_consumption
WHERE m.mark IS NULL OR n.prediction_datetime > m.mark""", ("tgt",))
def t1_per_series(spark, sf_dir):
    return B.update_history(*_history_and_new(spark, sf_dir), per_series_mark=True)


@query("t2_t4_j13_u1_block_backtest", f"""
WITH test AS (SELECT * FROM tgt WHERE data_block_id >= {SPLIT.format('tgt')}),
pred AS (SELECT t.row_id, CASE WHEN h.data_block_id + 2 <= t.data_block_id THEN h.target END AS prediction
         FROM test t LEFT JOIN tgt h ON h.prediction_unit_id = t.prediction_unit_id
          AND h.is_consumption = t.is_consumption AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY)
SELECT t.row_id, t.data_block_id, coalesce(p.prediction, 0.0) AS target
FROM test t LEFT JOIN pred p ON t.row_id = p.row_id""", ("tgt",))
def t2_backtest(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    test = t.filter(F.col("data_block_id") >= split_block(t))
    template = test.select("row_id", "data_block_id", F.lit(0.0).alias("target"))
    # both directions at once (U1): a union of two filters of the same plan would do the lag join twice
    return B.complete_submission(template, B.persistence_backtest(test, t))


_SOL = """(SELECT unnest(generate_series((SELECT min(prediction_datetime) FROM tgt), (SELECT max(prediction_datetime) FROM tgt),
   INTERVAL 1 HOUR)) AS datetime) h"""


@query("j20_p11_night_zero", f"""
WITH sol AS ({solar_select(_SOL, "datetime", "58.6", "25.01")}),
rows AS (SELECT t.row_id, t.prediction_unit_id, t.is_consumption, t.prediction_datetime, s.solar_elevation
         FROM tgt t LEFT JOIN sol s ON s.datetime = t.prediction_datetime WHERE NOT t.is_consumption),
day AS (SELECT r.row_id, h.target AS prediction FROM rows r JOIN tgt h
          ON h.prediction_unit_id = r.prediction_unit_id AND h.is_consumption = r.is_consumption
         AND h.prediction_datetime = r.prediction_datetime - INTERVAL 2 DAY
        WHERE r.solar_elevation > 0)
SELECT r.row_id, coalesce(d.prediction, 0.0) AS prediction FROM rows r LEFT JOIN day d ON r.row_id = d.row_id""",
       ("tgt",))
def j20_night(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    rows = add_solar(t.filter("NOT is_consumption"), solar_of(spark, t))
    day = rows.filter(F.col("solar_elevation") > 0)
    from ..operators.lags import add_lag_inner
    preds = add_lag_inner(day, t.select(*PANEL_KEY, "target"), "target", 2) \
        .select("row_id", F.col("target_2d_ago").alias("prediction"))
    return B.night_zero(rows.select("row_id"), preds)


@query("p10_p11_time_window_threshold", """
SELECT row_id, prediction_datetime, target FROM tgt
WHERE prediction_datetime > TIMESTAMP '2024-01-05 00:00:00' AND prediction_datetime < TIMESTAMP '2024-01-12 00:00:00'
  AND target > 10""", ("tgt",))
def p10_p11(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    a = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")      # string -> NTZ: no time zone involved
    b = F.lit("2024-01-12 00:00:00").cast("timestamp_ntz")
    return t.filter((F.col("prediction_datetime") > a) & (F.col("prediction_datetime") < b)
                    & (F.col("target") > 10)).select("row_id", "prediction_datetime", "target")


_ACF_SQL = """
WITH s AS (SELECT prediction_unit_id, is_consumption, avg(target) AS m FROM tgt GROUP BY 1, 2),
c AS (SELECT t.prediction_unit_id, t.is_consumption, t.prediction_datetime, t.target - s.m AS x
      FROM tgt t JOIN s USING (prediction_unit_id, is_consumption)),
d AS (SELECT prediction_unit_id, is_consumption, sum(x * x) AS den FROM c GROUP BY 1, 2),
l AS (SELECT a.prediction_unit_id, a.is_consumption, CAST(date_diff('hour', a.prediction_datetime, b.prediction_datetime) AS INTEGER) AS lag,
             sum(a.x * b.x) AS num
      FROM c a JOIN c b ON a.prediction_unit_id = b.prediction_unit_id AND a.is_consumption = b.is_consumption
       AND b.prediction_datetime > a.prediction_datetime AND b.prediction_datetime <= a.prediction_datetime + INTERVAL 72 HOUR
      GROUP BY 1, 2, 3)
SELECT l.prediction_unit_id, l.is_consumption, l.lag, round(l.num / nullif(d.den, 0), 6) AS acf
FROM l JOIN d USING (prediction_unit_id, is_consumption)"""


@query("a2_acf_72_lags", _ACF_SQL, ("tgt",))
def a2_acf(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    return rounded(A.acf(t, ["prediction_unit_id", "is_consumption"], "prediction_datetime", "target", 72))


def _residuals(spark, sf_dir):
    """Errors of a linear model per unit and direction, over all units."""
    t = load_panel(spark, sf_dir).target.withColumn("hour", C.hour_of_day("prediction_datetime").cast("double"))
    keys = ["prediction_unit_id", "is_consumption"]
    p = fit_grouped_ols(t, ["hour"], "target", keys).predict(t)
    return p.select(*keys, "prediction_datetime", (F.col("prediction") - F.col("target")).alias("error")), keys


@query("a2_pacf_durbin_levinson")
def a2_pacf(spark, sf_dir):
    r, keys = _residuals(spark, sf_dir)
    return A.pacf_from_acf(A.acf(r, keys, "prediction_datetime", "error", 72), keys, 72)


@query("a2_residual_pacf_3_lags", """
WITH m AS (SELECT prediction_unit_id, is_consumption, regr_intercept(target, CAST(hour(prediction_datetime) AS DOUBLE)) AS a,
                  regr_slope(target, CAST(hour(prediction_datetime) AS DOUBLE)) AS b FROM tgt GROUP BY 1, 2),
e AS (SELECT t.prediction_unit_id, t.is_consumption, t.prediction_datetime, a + b * CAST(hour(prediction_datetime) AS DOUBLE) - target AS x
      FROM tgt t JOIN m USING (prediction_unit_id, is_consumption)),
c AS (SELECT prediction_unit_id, is_consumption, prediction_datetime,
             x - avg(x) OVER (PARTITION BY prediction_unit_id, is_consumption) AS x FROM e),
d AS (SELECT prediction_unit_id, is_consumption, sum(x * x) AS den FROM c GROUP BY 1, 2),
l AS (SELECT a.prediction_unit_id, a.is_consumption, date_diff('hour', a.prediction_datetime, b.prediction_datetime) AS lag, sum(a.x * b.x) AS num
      FROM c a JOIN c b ON a.prediction_unit_id = b.prediction_unit_id AND a.is_consumption = b.is_consumption
       AND b.prediction_datetime > a.prediction_datetime AND b.prediction_datetime <= a.prediction_datetime + INTERVAL 3 HOUR GROUP BY 1, 2, 3),
r AS (SELECT d.prediction_unit_id, d.is_consumption,
             coalesce(max(num / nullif(den, 0)) FILTER (lag = 1), 0) AS r1, coalesce(max(num / nullif(den, 0)) FILTER (lag = 2), 0) AS r2,
             coalesce(max(num / nullif(den, 0)) FILTER (lag = 3), 0) AS r3
      FROM d JOIN l USING (prediction_unit_id, is_consumption) GROUP BY 1, 2),
p AS (SELECT *, (r2 - r1 * r1) / (1 - r1 * r1) AS p2, r1 * (1 - r2) / (1 - r1 * r1) AS q1 FROM r)
SELECT prediction_unit_id, is_consumption, CAST(1 AS INTEGER) AS lag, round(r1, 6) AS pacf FROM p
UNION ALL SELECT prediction_unit_id, is_consumption, CAST(2 AS INTEGER), round(p2, 6) FROM p
UNION ALL SELECT prediction_unit_id, is_consumption, CAST(3 AS INTEGER), round((r3 - q1 * r2 - p2 * r1) / (1 - q1 * r1 - p2 * r2), 6) FROM p""", ("tgt",))
def a2_pacf_3(spark, sf_dir):
    r, keys = _residuals(spark, sf_dir)
    return rounded(A.pacf_from_acf(A.acf(r, keys, "prediction_datetime", "error", 3), keys, 3))


def _trajectories(spark, sf_dir):
    """Daily means of unit-max-normalised targets by the day of prediction, one row per unit and direction, and the dates."""
    t = load_panel(spark, sf_dir).target
    keys = ["prediction_unit_id", "is_consumption"]
    norm = apply_unit_max(t, group_max(t, keys), keys)
    dates = A.date_range(norm, "date_when_predicting")
    return A.trajectories(norm, keys, "date_when_predicting", "target", dates), dates


def _by_direction(x, side):
    return x.filter(F.col("is_consumption") == side)


@query("a1_pca_reconstruction")
def a1_pca(spark, sf_dir):
    """Ten components per direction, over all units."""
    x, dates = _trajectories(spark, sf_dir)
    parts = [A.pca_reconstruct(_by_direction(x, side), ["prediction_unit_id", "is_consumption"], dates, 10) for side in (False, True)]
    return parts[0].unionByName(parts[1])


@query("a1_pca_checks", """
SELECT is_consumption, count(DISTINCT prediction_unit_id) AS n_units, true AS orthonormal, true AS trace_is_k, true AS residual_is_unexplained,
       true AS error_falls FROM tgt GROUP BY 1""", ("tgt",))
def a1_checks(spark, sf_dir):
    """What ten components must satisfy: orthonormal axes, a projector of trace ten, a squared error that equals the
    variance left unexplained, and errors that fall with the number of components."""
    x, dates = _trajectories(spark, sf_dir)
    out = []
    for side in (False, True):
        part = _by_direction(x, side)
        n = part.count()
        model = A.fit_pca(part, 10)
        k = model.axes.shape[1]
        errors = []
        for j in (1, 5, k):
            cut = A.TrajectoryPCA(model.axes[:, :j], model.means, model.explained[:j], model.variance)
            built = A.pca_reconstruct(part, "prediction_unit_id", dates, j, column_means=True, model=cut)
            errors.append(built.agg(F.sum((F.col("value") - F.col("reconstructed")) ** 2)).first()[0])
        projector, total = model.axes @ model.axes.T, model.variance * (n - 1)
        out.append((side, n, bool(abs(model.axes.T @ model.axes - np.eye(k)).max() < 1e-8), bool(abs(projector.trace() - min(10, len(dates))) < 1e-8),
                    bool(abs(errors[-1] - total * (1 - model.explained.sum())) < 1e-6 * total), errors[0] > errors[1] > errors[2]))
    return spark.createDataFrame(out, "is_consumption boolean, n_units long, orthonormal boolean, trace_is_k boolean, "
                                      "residual_is_unexplained boolean, error_falls boolean")


@query("a1_pca_all_components", """
WITH n AS (SELECT t.*, t.target / nullif(max(target) OVER (PARTITION BY prediction_unit_id, is_consumption), 0) AS y FROM tgt t),
daily AS (SELECT prediction_unit_id, is_consumption, date_when_predicting AS d, avg(y) AS v FROM n GROUP BY 1, 2, 3),
m AS (SELECT prediction_unit_id, is_consumption, avg(v) AS m FROM daily GROUP BY 1, 2),
days AS (SELECT CAST(unnest(generate_series((SELECT min(date_when_predicting) FROM tgt), (SELECT max(date_when_predicting) FROM tgt), INTERVAL 1 DAY)) AS DATE) AS d)
SELECT m.prediction_unit_id, m.is_consumption, CAST(days.d AS VARCHAR) AS date, round(coalesce(v - m, 0), 6) AS value,
       round(coalesce(v - m, 0), 6) AS reconstructed
FROM m CROSS JOIN days LEFT JOIN daily USING (prediction_unit_id, is_consumption, d)""", ("tgt",))
def a1_pca_all(spark, sf_dir):
    """With as many components as dates, the reconstruction is the (centred) input."""
    x, dates = _trajectories(spark, sf_dir)
    parts = [A.pca_reconstruct(_by_direction(x, side), ["prediction_unit_id", "is_consumption"], dates, len(dates), column_means=True) for side in (False, True)]
    return rounded(parts[0].unionByName(parts[1]))
