"""Queries: profiles, accuracy aggregates, sorts."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profiles as G
from ..operators.assemble import assemble_client
from ..operators.lags import add_lags
from ..operators.normalise import normalise_by_capacity
from ..schemas import PANEL_KEY
from ..session import cut_lineage
from .fixtures import DENSE_UNITS, load_panel
from .registry import query, rounded

_ASM = """asm AS (SELECT t.*, CAST(t.prediction_datetime AS DATE) AS date, c.eic_count, c.installed_capacity,
    t.target / nullif(c.installed_capacity, 0) AS frac
  FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business
   AND t.product_type = c.product_type AND CAST(t.prediction_datetime AS DATE) = c.date)"""

# persistence forecast: the value of the same hour two days earlier (0 when absent)
_PERSIST = """pers AS (SELECT t.*, coalesce(h.target, 0) AS prediction FROM tgt t LEFT JOIN tgt h
  ON h.prediction_unit_id = t.prediction_unit_id AND h.is_consumption = t.is_consumption
 AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY)"""


def _asm(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    a = assemble_client(p.target, p.client, "train")
    return a.withColumn("frac", F.try_divide(F.col("target"), F.col("installed_capacity")))


def _persistence(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    return add_lags(t, t.select(*PANEL_KEY, "target"), "target", (2,), "inference") \
        .withColumnRenamed("target_2d_ago", "prediction")


@query("g2_hourly_fraction_profile", f"""
WITH {_ASM}
SELECT CAST(hour(prediction_datetime) AS INTEGER) AS hour, is_consumption, round(min(frac), 6) AS min_frac,
       round(avg(frac), 6) AS mean_frac FROM asm GROUP BY 1, 2""", ("tgt", "cli"))
def g2_fraction(spark, sf_dir):
    return rounded(G.hourly_fraction_profile(_asm(spark, sf_dir), "frac"))


@query("g2_hourly_mean_by_business", f"""
WITH {_ASM}
SELECT CAST(hour(prediction_datetime) AS INTEGER) AS hour, is_business, round(min(frac), 6) AS min_frac,
       round(avg(frac), 6) AS mean_frac FROM asm GROUP BY 1, 2""", ("tgt", "cli"))
def g2_business(spark, sf_dir):
    return rounded(G.hourly_fraction_profile(_asm(spark, sf_dir), "frac", ("is_business",)))


@query("g3_daily_mean_by_category", """
SELECT CAST(prediction_datetime AS DATE) AS date, is_business, product_type, round(avg(target), 6) AS mean_target
FROM tgt GROUP BY 1, 2, 3""", ("tgt",))
def g3_daily_mean(spark, sf_dir):
    return rounded(G.daily_mean_by(load_panel(spark, sf_dir).target, ["is_business", "product_type"]))


@query("g4_daily_mean_std", """
SELECT prediction_unit_id, is_consumption, CAST(prediction_datetime AS DATE) AS date,
       round(avg(target), 6) AS daily_mean, round(stddev_samp(target), 6) AS daily_std FROM tgt GROUP BY 1, 2, 3""",
       ("tgt",))
def g4_daily(spark, sf_dir):
    return rounded(G.daily_mean_std(load_panel(spark, sf_dir).target))


@query("g5_second_level_daily", """
SELECT prediction_unit_id, round(avg(daily_mean), 6) AS mean_of_daily_mean,
       round(stddev_samp(daily_mean), 6) AS std_of_daily_mean
FROM (SELECT prediction_unit_id, is_consumption, CAST(prediction_datetime AS DATE) AS date, avg(target) AS daily_mean
      FROM tgt GROUP BY 1, 2, 3) d GROUP BY 1""", ("tgt",))
def g5_second(spark, sf_dir):
    return rounded(G.second_level(G.daily_mean_std(load_panel(spark, sf_dir).target)))


@query("g6_daily_mean_var_median", f"""
WITH {_ASM}
SELECT prediction_unit_id, date, round(avg(target), 6) AS daily_mean, round(var_samp(target), 6) AS daily_var,
       median(eic_count) AS eic_count FROM asm GROUP BY 1, 2""", ("tgt", "cli"))
def g6_daily(spark, sf_dir):
    return rounded(G.daily_mean_var_median(_asm(spark, sf_dir)), cols=["daily_mean", "daily_var"])


@query("g6_daily_per_eic", f"""
WITH {_ASM}
SELECT prediction_unit_id, date, round(avg(target / nullif(eic_count, 0)), 6) AS daily_mean,
       round(var_samp(target / nullif(eic_count, 0)), 6) AS daily_var, median(eic_count) AS eic_count
FROM asm GROUP BY 1, 2""", ("tgt", "cli"))
def g6_per_eic(spark, sf_dir):
    return rounded(G.daily_mean_var_median(_asm(spark, sf_dir), per_eic=True), cols=["daily_mean", "daily_var"])


@query("g7_daily_medians", f"""
WITH {_PERSIST}
SELECT prediction_unit_id, CAST(prediction_datetime AS DATE) AS date, round(median(prediction), 6) AS median_prediction,
       round(median(target), 6) AS median_target, round(avg(target), 6) AS mean_target
FROM pers GROUP BY 1, 2""", ("tgt",))
def g7_medians(spark, sf_dir):
    return rounded(G.daily_medians(_persistence(spark, sf_dir)))


@query("g7_daily_medians_log", f"""
WITH {_PERSIST}
SELECT prediction_unit_id, CAST(prediction_datetime AS DATE) AS date,
       round(median(ln(1 + prediction)), 6) AS median_prediction,
       round(median(ln(1 + target)), 6) AS median_target, round(avg(ln(1 + target)), 6) AS mean_target
FROM pers GROUP BY 1, 2""", ("tgt",))
def g7_medians_log(spark, sf_dir):
    return rounded(G.daily_medians(_persistence(spark, sf_dir), log_space=True))


@query("g6_g7_merged_medians", """
SELECT 'unit' AS level, prediction_unit_id AS id, count(*) AS n, true AS within_bound FROM tgt GROUP BY 2
UNION ALL SELECT 'direction', CAST(is_consumption AS INTEGER), count(*), true FROM tgt GROUP BY 2""", ("tgt",))
def g7_merged(spark, sf_dir):
    """Medians over all days from sketches kept by day, by unit and by direction; their rank against the exact one."""
    t = load_panel(spark, sf_dir).target
    keys = ["prediction_unit_id", "is_consumption"]
    days = cut_lineage(G.daily_sketches(t, keys))
    parts = []
    for level, key in (("unit", keys[0]), ("direction", keys[1])):
        medians = G.merged_quantiles(days, [key]).withColumn("median", F.col("target_q")[0])
        error = G.rank_errors(t, medians, [key], "target", "median", 0.5)
        parts.append(medians.join(error, key).select(F.lit(level).alias("level"), F.col(key).cast("int").alias("id"), F.col("target_n").alias("n"),
                                                     ((F.col("rank_error") <= G.RANK_ERROR) & (F.col("n") == F.col("target_n"))).alias("within_bound")))
    return parts[0].unionAll(parts[1])


@query("g9_collapse_fanout", """
WITH s AS (SELECT longitude, latitude, county FROM (
   SELECT *, row_number() OVER (PARTITION BY county ORDER BY longitude, latitude DESC) AS rn FROM stn) x WHERE rn = 1),
w AS (SELECT s.county, w.forecast_datetime, coalesce(w.temperature, 0) AS temperature,
             coalesce(w.direct_solar_radiation, 0) AS direct_solar_radiation
      FROM s LEFT JOIN wf w ON s.latitude = w.latitude AND s.longitude = w.longitude)
SELECT t.row_id, t.prediction_unit_id, round(avg(w.temperature), 6) AS temperature,
       round(avg(w.direct_solar_radiation), 6) AS direct_solar_radiation
FROM tgt t JOIN w ON t.prediction_datetime = w.forecast_datetime AND t.county = w.county GROUP BY 1, 2""",
       ("tgt", "wf", "stn"))
def g9_collapse(spark, sf_dir):
    from ..operators import enrich as E
    p = load_panel(spark, sf_dir)
    st = E.station_per_county(p.station_map, order=(F.col("longitude"), F.negative("latitude")))
    w = E.county_weather(st, p.weather_forecast, ["temperature", "direct_solar_radiation"])
    f = E.add_county_weather(p.target.select("row_id", "prediction_unit_id", "prediction_datetime", "county"), w)
    return rounded(G.collapse_repeats(f.select("row_id", "prediction_unit_id", "temperature",
                                               "direct_solar_radiation")))


@query("g10_time_bounds", "SELECT min(prediction_datetime) AS start, max(prediction_datetime) AS \"end\" FROM tgt",
       ("tgt",))
def g10_bounds(spark, sf_dir):
    return G.time_bounds(load_panel(spark, sf_dir).target, "prediction_datetime")


@query("g11_g12_persistence_accuracy", f"""
WITH {_PERSIST}
SELECT is_consumption, round(sqrt(avg((prediction - target) * (prediction - target))), 6) AS rmse, count(*) AS n,
       round(1 - sum((prediction - target) * (prediction - target))
             / (sum(target * target) - sum(target) * sum(target) / count(target)), 6) AS r2
FROM pers GROUP BY 1""", ("tgt",))
def g11_g12(spark, sf_dir):
    d = _persistence(spark, sf_dir)
    return rounded(G.rmse(d, by=["is_consumption"]).join(G.r_squared(d, by=["is_consumption"]), "is_consumption"))


@query("g13_histogram_15_bins", """
WITH b AS (SELECT min(target) AS lo, max(target) AS hi FROM tgt),
x AS (SELECT CAST(coalesce(least(floor((target - lo) / ((hi - lo) / 15)), 14), 0) AS INTEGER) AS bin, lo, hi
      FROM tgt, b WHERE target IS NOT NULL)
SELECT bin, round(lo + bin * ((hi - lo) / 15), 6) AS left_edge, count(*) AS n FROM x GROUP BY bin, lo, hi""",
       ("tgt",))
def g13_hist(spark, sf_dir):
    return rounded(G.histogram(load_panel(spark, sf_dir).target, "target", 15))


@query("g14_mean_radiation_per_date", """
SELECT CAST(forecast_datetime AS DATE) AS date, round(avg(direct_solar_radiation), 6) AS mean_direct_solar_radiation
FROM wf GROUP BY 1""", ("wf",))
def g14_radiation(spark, sf_dir):
    return rounded(G.mean_per_date(load_panel(spark, sf_dir).weather_forecast, "direct_solar_radiation",
                                   "forecast_datetime"))


@query("g15_distinct_units", "SELECT DISTINCT prediction_unit_id FROM tgt", ("tgt",))
def g15_distinct(spark, sf_dir):
    return G.distinct_values(load_panel(spark, sf_dir).target, "prediction_unit_id")


@query("o1_o3_preview_first_rows", """
SELECT row_id, prediction_unit_id, prediction_datetime, target FROM tgt
ORDER BY prediction_datetime, row_id LIMIT 5""", ("tgt",))
def o3_preview(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    return t.select("row_id", "prediction_unit_id", "prediction_datetime", "target") \
        .orderBy("prediction_datetime", "row_id").limit(5)


def _pivot_units_sql() -> str:
    cells = [(u, d) for u in range(DENSE_UNITS) for d in (0, 1)]
    count = ", ".join(f"count(*) FILTER (prediction_unit_id = {u} AND is_consumption = {bool(d)}) AS count_{u}_{d}" for u, d in cells)
    mean = ", ".join(f"round(avg(target) FILTER (prediction_unit_id = {u} AND is_consumption = {bool(d)}), 6) AS avg_{u}_{d}" for u, d in cells)
    return f"SELECT CAST(prediction_datetime AS DATE) AS date, {count}, {mean} FROM dtgt GROUP BY 1"


@query("g8_pivot_units", _pivot_units_sql(), ("dtgt",))
def g8_units(spark, sf_dir):
    """Counts and means by unit and direction, one row per day."""
    t = load_panel(spark, sf_dir).dense_target.withColumn("date", F.to_date("prediction_datetime"))
    units = range(DENSE_UNITS)
    counts, means = (G.pivot_series(t, ["date"], units, "target", fn) for fn in ("count", "avg"))
    return rounded(counts.join(means, "date"))
