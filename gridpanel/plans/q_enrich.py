"""Queries: prices, solar, station weather, pivots."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as E
from ..sources import spine
from .features import solar_of
from .fixtures import FIXTURE_STATIONS, load_panel
from .oracle_sql import solar_select
from .registry import query, rounded

_W = ["temperature", "dewpoint", "cloudcover_high", "cloudcover_low", "cloudcover_mid", "cloudcover_total",
      "10_metre_u_wind_component", "10_metre_v_wind_component", "direct_solar_radiation",
      "surface_solar_radiation_downwards", "snowfall", "total_precipitation"]


def _q(c):
    return f'"{c}"'


@query("j5_j6_prices", """
SELECT t.row_id, t.prediction_datetime, coalesce(g.lowest_price_per_mwh, 0) AS price_gas_low,
       coalesce(g.highest_price_per_mwh, 0) AS price_gas_high, coalesce(e.euros_per_mwh, 0) AS price_electricity
FROM tgt t LEFT JOIN gas g ON CAST(t.prediction_datetime AS DATE) = g.forecast_date
LEFT JOIN elec e ON t.prediction_datetime = e.forecast_datetime""", ("tgt", "gas", "elec"))
def j5_j6_prices(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    f = E.add_prices(p.target.select("row_id", "prediction_datetime"), p.gas_prices, p.electricity_prices)
    return f.select("row_id", "prediction_datetime", "price_gas_low", "price_gas_high", "price_electricity")


_HOURS_OF_TARGET = """(SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime
   FROM (SELECT min(prediction_datetime) AS lo, max(prediction_datetime) AS hi FROM tgt) b)"""


@query("s7_s8_solar_over_target_hours", f"""
SELECT datetime, round(solar_azimuth, 6) AS solar_azimuth, round(solar_elevation, 6) AS solar_elevation
FROM ({solar_select(_HOURS_OF_TARGET + " h", "datetime", "58.6", "25.01")}) s""", ("tgt",))
def s8_solar(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    lo, hi = spine.data_bounds(t, "prediction_datetime")
    hours = spine.hour_spine(spark, lo, hi)
    return rounded(spine.solar_for_hours(hours, 58.60, 25.01, "Europe/Tallinn"))


_SOLAR_DEFAULT = """(SELECT unnest(generate_series((SELECT min(prediction_datetime) FROM tgt), (SELECT max(prediction_datetime) FROM tgt),
   INTERVAL 1 HOUR)) AS datetime) h"""


@query("j7_solar_join", f"""
SELECT t.row_id, t.prediction_datetime, round(s.solar_azimuth, 6) AS solar_azimuth,
       round(s.solar_elevation, 6) AS solar_elevation
FROM tgt t LEFT JOIN ({solar_select(_SOLAR_DEFAULT, "datetime", "58.6", "25.01")}) s
  ON t.prediction_datetime = s.datetime""", ("tgt",))
def j7_solar_join(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.select("row_id", "prediction_datetime")
    return rounded(E.add_solar(t, solar_of(spark, t)))


@query("s9_j15_rich_solar", f"""
SELECT datetime, round(solar_elevation, 6) AS solar_elevation, round(solar_azimuth, 6) AS solar_azimuth,
       latitude, longitude
FROM ({solar_select('''(SELECT l.latitude, l.longitude, h.datetime FROM (SELECT DISTINCT latitude, longitude FROM stn_raw) l,
      ''' + _HOURS_OF_TARGET + ''' h)''', "datetime", "latitude", "longitude")}) s""", ("tgt", "stn_raw"))
def s9_rich_solar(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    lo, hi = spine.data_bounds(p.target, "prediction_datetime")
    return rounded(spine.rich_solar_table(p.raw_station_map, lo, hi))


_FIRST_STATION = """(SELECT longitude, latitude, county FROM (
   SELECT *, row_number() OVER (PARTITION BY county ORDER BY longitude, latitude DESC) AS rn FROM stn) x WHERE rn = 1)"""


@query("p13_o2_station_per_county", f"SELECT * FROM {_FIRST_STATION} s", ("stn",))
def p13_station_per_county(spark, sf_dir):
    m = load_panel(spark, sf_dir).station_map
    return E.station_per_county(m, order=(F.col("longitude"), F.negative("latitude")))


@query("p13_station_override", """
SELECT longitude, latitude, county FROM (
  SELECT *, row_number() OVER (PARTITION BY county ORDER BY longitude, latitude DESC) AS rn
  FROM (SELECT latitude, longitude, CASE WHEN latitude = 585 AND longitude = 252 THEN 0 ELSE county END AS county
        FROM stn) o) x WHERE rn = 1""", ("stn",))
def p13_station_override(spark, sf_dir):
    m = load_panel(spark, sf_dir).station_map
    return E.station_per_county(m, overrides={(585, 252): 0},
                                order=(F.col("longitude"), F.negative("latitude")))


def _county_weather_sql(latest: bool) -> str:
    src = "wf"
    if latest:
        src = ("(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY latitude, longitude, forecast_datetime "
               "ORDER BY hours_ahead) AS rn FROM wf) z WHERE rn = 1)")
    wcols = ", ".join(f"coalesce(w.{_q(c)}, 0) AS {_q(c)}" for c in _W)
    out = ", ".join(f"w.{_q(c)}" for c in _W)
    return f"""
WITH s AS {_FIRST_STATION},
w AS (SELECT s.county, w.forecast_datetime, {wcols}
      FROM s LEFT JOIN {src} w ON s.latitude = w.latitude AND s.longitude = w.longitude)
SELECT t.row_id, t.prediction_datetime, t.county, {out}
FROM tgt t JOIN w ON t.prediction_datetime = w.forecast_datetime AND t.county = w.county"""


def _county_weather(spark, sf_dir, latest: bool):
    p = load_panel(spark, sf_dir)
    st = E.station_per_county(p.station_map, order=(F.col("longitude"), F.negative("latitude")))
    fc = E.latest_run(p.weather_forecast) if latest else p.weather_forecast
    w = E.county_weather(st, fc)
    f = E.add_county_weather(p.target.select("row_id", "prediction_datetime", "county"), w)
    return f.select("row_id", "prediction_datetime", "county", *_W)


@query("j8_j9_county_weather_fanout", _county_weather_sql(False), ("tgt", "wf", "stn"))
def j8_j9_fanout(spark, sf_dir):
    return _county_weather(spark, sf_dir, False)


@query("j9_county_weather_latest_run", _county_weather_sql(True), ("tgt", "wf", "stn"))
def j9_latest(spark, sf_dir):
    return _county_weather(spark, sf_dir, True)


def _pivot_sql_cols(alias: str = "") -> str:
    parts = []
    for m in ("temperature", "direct_solar_radiation"):
        for a, b in FIXTURE_STATIONS:
            parts.append(f"max(CASE WHEN {alias}latitude = {a} AND {alias}longitude = {b} THEN {alias}{m} END) "
                         f"AS {m}_{a}_{b}")
    return ", ".join(parts)


@query("g8_pivot_two_measures", f"""
SELECT forecast_datetime, hours_ahead, {_pivot_sql_cols()} FROM wf GROUP BY forecast_datetime, hours_ahead""",
       ("wf",))
def g8_pivot(spark, sf_dir):
    return E.pivot_forecast(load_panel(spark, sf_dir).weather_forecast, FIXTURE_STATIONS)


def _wide_names():
    return [f"{m}_{a}_{b}" for m in ("temperature", "direct_solar_radiation") for a, b in FIXTURE_STATIONS]


@query("j16_forest_features", f"""
WITH wide AS (SELECT forecast_datetime, hours_ahead, {_pivot_sql_cols()} FROM wf GROUP BY forecast_datetime, hours_ahead),
sol AS ({solar_select(_SOLAR_DEFAULT, "datetime", "58.6", "25.01")})
SELECT t.row_id, t.prediction_unit_id, t.is_consumption, c.eic_count, c.installed_capacity,
       {", ".join("w." + n for n in _wide_names())},
       round(s.solar_azimuth, 6) AS solar_azimuth, round(s.solar_elevation, 6) AS solar_elevation
FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type
  AND t.date_when_predicting = c.date
JOIN wide w ON t.prediction_datetime = w.forecast_datetime
JOIN sol s ON t.prediction_datetime = s.datetime""", ("tgt", "cli", "wf"))
def j16_forest_features(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    wide = E.pivot_forecast(p.weather_forecast, FIXTURE_STATIONS)
    out = E.forest_features(p.target, p.client, wide, solar_of(spark, p.target))
    return rounded(out.select("row_id", "prediction_unit_id", "is_consumption", "eic_count", "installed_capacity",
                              *_wide_names(), "solar_azimuth", "solar_elevation"),
                   cols=["solar_azimuth", "solar_elevation"])


@query("f10_location_string", """
SELECT latitude, longitude, concat_ws(',', CAST(latitude AS VARCHAR), CAST(longitude AS VARCHAR)) AS location
FROM stn_raw""", ("stn_raw",))
def f10_location(spark, sf_dir):
    return E.location_strings(load_panel(spark, sf_dir).raw_station_map.select("latitude", "longitude"))
