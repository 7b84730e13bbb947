"""Declared table schemas and value domains.

Plans never depend on data for their width: every dummy, pivot and one-hot
takes its levels from a domain declared here or passed by the caller.
"""
from __future__ import annotations

from pyspark.sql import types as T

TS = T.TimestampNTZType()

PANEL_KEY = ["prediction_unit_id", "is_consumption", "prediction_datetime"]
SEGMENT_KEY = ["county", "is_business", "product_type"]

# Fixed values that must equal the modelled data's conventions.
OFFSHORE_STATIONS = [(57.6, 23.2), (57.6, 24.2)]
WEATHER_COLUMNS = [
    "temperature", "dewpoint", "cloudcover_high", "cloudcover_low", "cloudcover_mid",
    "cloudcover_total", "10_metre_u_wind_component", "10_metre_v_wind_component",
    "direct_solar_radiation", "surface_solar_radiation_downwards", "snowfall",
    "total_precipitation",
]
SOLAR_SITE = (58.60, 25.01, "Europe/Tallinn")
FOURIER_ORDER = 6
HOURS = list(range(24))
WEEKDAYS = list(range(1, 8))
BASELINE_HOUR = 10          # hour-of-day level removed from the time-of-day dummies


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TARGET = _s(("row_id", T.LongType()), ("prediction_unit_id", T.IntegerType()),
            ("county", T.IntegerType()), ("is_business", T.BooleanType()),
            ("product_type", T.IntegerType()), ("is_consumption", T.BooleanType()),
            ("datetime", TS), ("data_block_id", T.LongType()), ("target", T.DoubleType()))
TEST = _s(*[(f.name, f.dataType) for f in TARGET.fields if f.name != "target"],
          ("currently_scored", T.BooleanType()))
CLIENT = _s(("county", T.IntegerType()), ("is_business", T.BooleanType()),
            ("product_type", T.IntegerType()), ("date", T.DateType()),
            ("eic_count", T.LongType()), ("installed_capacity", T.DoubleType()),
            ("data_block_id", T.LongType()))
WEATHER_FORECAST = _s(("latitude", T.DoubleType()), ("longitude", T.DoubleType()),
                      ("origin_datetime", TS), ("hours_ahead", T.IntegerType()),
                      ("forecast_datetime", TS), ("data_block_id", T.LongType()),
                      *[(c, T.DoubleType()) for c in WEATHER_COLUMNS])
WEATHER_HISTORICAL = _s(("latitude", T.DoubleType()), ("longitude", T.DoubleType()),
                        ("datetime", TS), ("temperature", T.DoubleType()),
                        ("direct_solar_radiation", T.DoubleType()), ("data_block_id", T.LongType()))
ELECTRICITY = _s(("forecast_date", TS), ("origin_date", TS),
                 ("euros_per_mwh", T.DoubleType()), ("data_block_id", T.LongType()))
GAS = _s(("forecast_date", T.DateType()), ("origin_date", T.DateType()),
         ("lowest_price_per_mwh", T.DoubleType()), ("highest_price_per_mwh", T.DoubleType()),
         ("data_block_id", T.LongType()))
SOLAR = _s(("datetime", TS), ("solar_azimuth", T.DoubleType()), ("solar_elevation", T.DoubleType()),
           ("latitude", T.DoubleType()), ("longitude", T.DoubleType()))
STATION_TO_COUNTY = _s(("latitude", T.DoubleType()), ("longitude", T.DoubleType()),
                       ("county", T.IntegerType()))
SAMPLE_SUBMISSION = _s(("row_id", T.LongType()), ("target", T.DoubleType()),
                       ("data_block_id", T.LongType()))

RAW_SCHEMAS = {
    "target": TARGET, "test": TEST, "revealed_targets": TARGET, "client": CLIENT,
    "weather_forecast": WEATHER_FORECAST, "weather_historical": WEATHER_HISTORICAL,
    "electricity_prices": ELECTRICITY, "gas_prices": GAS, "solar": SOLAR,
    "station_to_county": STATION_TO_COUNTY, "sample_submission": SAMPLE_SUBMISSION,
}
