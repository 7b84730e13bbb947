"""Queries: data-quality checks and set operations."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.tz import local_to_utc
from ..operators import quality as Q
from ..operators.fill import fill_missing_hours, neighbour_mean_repair
from .fixtures import SPLIT, load_panel, split_block
from .registry import query, rounded


@query("q1_duplicate_keys", """
SELECT prediction_unit_id, prediction_datetime, count(*) AS n FROM tgt GROUP BY 1, 2 HAVING count(*) > 1""",
       ("tgt",))
def q1_dups(spark, sf_dir):
    return Q.duplicate_keys(load_panel(spark, sf_dir).target, ["prediction_unit_id", "prediction_datetime"])


@query("q3_null_counts", """
SELECT sum(CAST(t.row_id IS NULL AS BIGINT)) AS row_id, sum(CAST(t.prediction_datetime IS NULL AS BIGINT)) AS prediction_datetime,
       sum(CAST(e.euros_per_mwh IS NULL AS BIGINT)) AS euros_per_mwh
FROM tgt t LEFT JOIN elec e ON t.prediction_datetime = e.forecast_datetime""", ("tgt", "elec"))
def q3_nulls(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    e = p.electricity_prices.select("forecast_datetime", "euros_per_mwh")
    j = p.target.select("row_id", "prediction_datetime").join(
        e, F.col("prediction_datetime") == e["forecast_datetime"], "left").drop("forecast_datetime")
    return Q.null_counts(j)


@query("q4_incomplete_forecast_runs", """
WITH tot AS (SELECT count(DISTINCT (latitude, longitude)) AS t FROM wf)
SELECT forecast_datetime, hours_ahead, count(DISTINCT (latitude, longitude)) AS n_present, max(tot.t) AS n_expected
FROM wf, tot GROUP BY 1, 2 HAVING count(DISTINCT (latitude, longitude)) < max(tot.t)""", ("wf",))
def q4_incomplete(spark, sf_dir):
    return Q.incomplete_combinations(load_panel(spark, sf_dir).weather_forecast, ["latitude", "longitude"],
                                     ["forecast_datetime", "hours_ahead"])


@query("q5_series_length", """
SELECT count(*) AS n_series, min(n) AS min_len, max(n) AS max_len, count(DISTINCT n) = 1 AS equal_length
FROM (SELECT latitude, longitude, count(*) AS n FROM wf GROUP BY 1, 2) s""", ("wf",))
def q5_length(spark, sf_dir):
    return Q.series_length_profile(load_panel(spark, sf_dir).weather_forecast, ["latitude", "longitude"])


@query("q6_units_with_gaps", """
SELECT prediction_unit_id, is_consumption, min(prediction_datetime) AS first, max(prediction_datetime) AS last,
       count(DISTINCT prediction_datetime) AS n_present,
       CAST(date_diff('hour', min(prediction_datetime), max(prediction_datetime)) + 1 AS BIGINT) AS n_expected,
       CAST(date_diff('hour', min(prediction_datetime), max(prediction_datetime)) + 1 AS BIGINT)
         - count(DISTINCT prediction_datetime) AS n_missing
FROM tgt GROUP BY 1, 2
HAVING date_diff('hour', min(prediction_datetime), max(prediction_datetime)) + 1 > count(DISTINCT prediction_datetime)""",
       ("tgt",))
def q6_gaps(spark, sf_dir):
    return Q.series_with_gaps(load_panel(spark, sf_dir).target, ["prediction_unit_id", "is_consumption"],
                              "prediction_datetime")


@query("q2_missing_hours_per_unit", """
WITH b AS (SELECT prediction_unit_id, is_consumption, min(prediction_datetime) AS lo, max(prediction_datetime) AS hi
           FROM tgt GROUP BY 1, 2),
s AS (SELECT prediction_unit_id, is_consumption, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS prediction_datetime
      FROM b)
SELECT s.* FROM s ANTI JOIN tgt t ON s.prediction_unit_id = t.prediction_unit_id
  AND s.is_consumption = t.is_consumption AND s.prediction_datetime = t.prediction_datetime""", ("tgt",))
def q2_missing_per_unit(spark, sf_dir):
    return Q.missing_instants(load_panel(spark, sf_dir).target, "prediction_datetime",
                              ["prediction_unit_id", "is_consumption"])


_GAPS = """
WITH d AS (SELECT DISTINCT prediction_unit_id, is_consumption, prediction_datetime AS h FROM tgt),
l AS (SELECT *, lag(h) OVER (PARTITION BY prediction_unit_id, is_consumption ORDER BY h) AS p FROM d),
g AS (SELECT prediction_unit_id, is_consumption, p + INTERVAL 1 HOUR AS first_missing, h - INTERVAL 1 HOUR AS last_missing,
             CAST(date_diff('hour', p, h) - 1 AS BIGINT) AS n_missing FROM l WHERE date_diff('hour', p, h) > 1)
"""


def _gaps(spark, sf_dir):
    return Q.gap_intervals(load_panel(spark, sf_dir).target, "prediction_datetime", ["prediction_unit_id", "is_consumption"])


@query("q2_j19_gap_intervals", _GAPS + "SELECT * FROM g", ("tgt",))
def q2_gaps(spark, sf_dir):
    """Absent hours of each series as intervals, without a spine."""
    return _gaps(spark, sf_dir)


@query("q2_gap_hours", """
WITH b AS (SELECT prediction_unit_id, is_consumption, min(prediction_datetime) AS lo, max(prediction_datetime) AS hi
           FROM tgt GROUP BY 1, 2),
s AS (SELECT prediction_unit_id, is_consumption, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS prediction_datetime
      FROM b)
SELECT s.* FROM s ANTI JOIN tgt t ON s.prediction_unit_id = t.prediction_unit_id
  AND s.is_consumption = t.is_consumption AND s.prediction_datetime = t.prediction_datetime""", ("tgt",))
def q2_gap_hours(spark, sf_dir):
    """The intervals' hours are those that the anti join with a spine finds."""
    return Q.expand_gaps(_gaps(spark, sf_dir), "prediction_datetime", ["prediction_unit_id", "is_consumption"])


@query("q6_gaps_per_unit", _GAPS + """
SELECT prediction_unit_id, is_consumption, count(*) AS n_gaps, CAST(sum(n_missing) AS BIGINT) AS n_missing, max(n_missing) AS longest
FROM g GROUP BY 1, 2""", ("tgt",))
def q6_gaps_per_unit(spark, sf_dir):
    """Series with gaps: how many, how many hours, the longest."""
    return _gaps(spark, sf_dir).groupBy("prediction_unit_id", "is_consumption").agg(
        F.count(F.lit(1)).alias("n_gaps"), F.sum("n_missing").alias("n_missing"), F.max("n_missing").alias("longest"))


@query("q4_missing_members", """
WITH g AS (SELECT DISTINCT origin_datetime, hours_ahead FROM wf), m AS (SELECT DISTINCT latitude, longitude FROM wf)
SELECT g.origin_datetime, g.hours_ahead, m.latitude, m.longitude FROM g CROSS JOIN m
ANTI JOIN wf w ON w.origin_datetime = g.origin_datetime AND w.hours_ahead = g.hours_ahead AND w.latitude = m.latitude AND w.longitude = m.longitude""",
       ("wf",))
def q4_members(spark, sf_dir):
    """The stations that each forecast run lacks at each hour ahead, from presence bitmaps."""
    return Q.missing_members(load_panel(spark, sf_dir).weather_forecast, ["latitude", "longitude"], ["origin_datetime", "hours_ahead"])


@query("q7_u3_segment_day_difference", """
(SELECT county, is_business, product_type, date_when_predicting AS date, 'only_left' AS side FROM tgt
 EXCEPT SELECT county, is_business, product_type, date, 'only_left' FROM cli)
UNION ALL
(SELECT county, is_business, product_type, date, 'only_right' AS side FROM cli
 EXCEPT SELECT county, is_business, product_type, date_when_predicting, 'only_right' FROM tgt)""", ("tgt", "cli"))
def q7_difference(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    keys = ["county", "is_business", "product_type", "date"]
    return Q.key_difference(p.target.withColumnRenamed("date_when_predicting", "date"), p.client, keys)


@query("u3_bag_difference", """
SELECT prediction_unit_id, 'only_left' AS side FROM (
  SELECT prediction_unit_id FROM tgt WHERE is_consumption
  EXCEPT ALL SELECT prediction_unit_id FROM tgt WHERE NOT is_consumption) a
UNION ALL
SELECT prediction_unit_id, 'only_right' AS side FROM (
  SELECT prediction_unit_id FROM tgt WHERE NOT is_consumption
  EXCEPT ALL SELECT prediction_unit_id FROM tgt WHERE is_consumption) b""", ("tgt",))
def u3_bag(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    return Q.key_difference(t.filter("is_consumption"), t.filter("NOT is_consumption"), ["prediction_unit_id"],
                            distinct=False)


@query("q8_table_profile_electricity", """
WITH d AS (SELECT DISTINCT forecast_datetime FROM elec),
s AS (SELECT epoch(forecast_datetime) - epoch(lag(forecast_datetime) OVER (ORDER BY forecast_datetime)) AS step FROM d),
m AS (SELECT CAST(step AS BIGINT) AS step_seconds FROM s WHERE step IS NOT NULL GROUP BY step
      ORDER BY count(*) DESC, step ASC LIMIT 1)
SELECT 'electricity_prices' AS "table", min(forecast_datetime) AS start, max(forecast_datetime) AS "end",
       (SELECT step_seconds FROM m) AS step_seconds, count(*) AS n_rows, 'forecast_datetime' AS key FROM elec""",
       ("elec",))
def q8_profile(spark, sf_dir):
    return Q.table_profile(load_panel(spark, sf_dir).electricity_prices, "forecast_datetime",
                           "electricity_prices", "forecast_datetime")


@query("j19_stations_without_forecast", """
SELECT latitude, longitude, county FROM stn ANTI JOIN (SELECT DISTINCT latitude, longitude FROM wf) w
  USING (latitude, longitude)""", ("stn", "wf"))
def j19_anti(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    return Q.anti_join(p.station_map, p.weather_forecast, ["latitude", "longitude"])


@query("u1_u2_union_distinct", f"""
SELECT * FROM tgt WHERE data_block_id < {SPLIT.format('tgt')} UNION SELECT * FROM tgt WHERE data_block_id >= {SPLIT.format('tgt')} - 5""", ("tgt",))
def u1_u2(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    at = split_block(t)
    return t.filter(F.col("data_block_id") < at).unionByName(t.filter(F.col("data_block_id") >= at - 5)).distinct()


@query("f18_local_to_utc", """
WITH s AS (SELECT row_id, prediction_datetime + to_days(CAST(row_id % 366 AS INTEGER)) AS local FROM tgt),
-- of an hour that occurs twice, the earlier; an hour that is skipped moves to after the gap
u AS (SELECT row_id, local, timezone('UTC', timezone('Europe/Warsaw', local)) AS utc,
             timezone('UTC', timezone('Europe/Warsaw', local - INTERVAL 3 HOUR)) + INTERVAL 3 HOUR AS before FROM s)
SELECT row_id, CASE WHEN timezone('Europe/Warsaw', timezone('UTC', before)) = local THEN before
                    WHEN timezone('Europe/Warsaw', timezone('UTC', utc)) = local THEN utc ELSE before END AS utc_datetime FROM u""", ("tgt",))
def f18_utc(spark, sf_dir):
    """Hours spread over a year, so that rows fall on both clock changes."""
    t = load_panel(spark, sf_dir).target
    local = F.col("prediction_datetime") + F.make_dt_interval((F.col("row_id") % 366).cast("int"))
    return t.select("row_id", local.alias("local")).select("row_id", local_to_utc("local", "Europe/Warsaw").alias("utc_datetime"))


@query("f19_o4_fill_missing_hours", """
WITH b AS (SELECT min(forecast_datetime) AS lo, max(forecast_datetime) AS hi FROM elec),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS forecast_datetime FROM b),
j AS (SELECT s.forecast_datetime, e.euros_per_mwh, e.data_block_id, e.forecast_datetime IS NULL AS filled,
             max(e.forecast_datetime) OVER (ORDER BY s.forecast_datetime ROWS UNBOUNDED PRECEDING) AS src
      FROM s LEFT JOIN elec e ON s.forecast_datetime = e.forecast_datetime)
SELECT j.forecast_datetime, e.euros_per_mwh, e.data_block_id, j.filled
FROM j JOIN elec e ON e.forecast_datetime = j.src""", ("elec",))
def f19_fill(spark, sf_dir):
    e = load_panel(spark, sf_dir).electricity_prices
    return fill_missing_hours(e, [], "forecast_datetime", ["euros_per_mwh", "data_block_id"])


@query("q9_neighbour_mean_repair", """
WITH b AS (SELECT min(forecast_datetime) AS lo, max(forecast_datetime) AS hi FROM elec),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS forecast_datetime FROM b),
j AS (SELECT s.forecast_datetime, e.euros_per_mwh,
        last_value(e.euros_per_mwh IGNORE NULLS) OVER (ORDER BY s.forecast_datetime ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prv,
        first_value(e.euros_per_mwh IGNORE NULLS) OVER (ORDER BY s.forecast_datetime ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt
      FROM s LEFT JOIN elec e ON s.forecast_datetime = e.forecast_datetime)
SELECT forecast_datetime, round(coalesce(euros_per_mwh, (prv + nxt) / 2), 6) AS euros_per_mwh,
       euros_per_mwh IS NULL AS repaired FROM j""", ("elec",))
def q9_repair(spark, sf_dir):
    e = load_panel(spark, sf_dir).electricity_prices
    return rounded(neighbour_mean_repair(e, [], "forecast_datetime", "euros_per_mwh"))
