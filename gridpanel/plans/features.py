"""Composed feature builders (A3, A4, the stacked pipeline's stages)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import calendar as C
from ..operators import enrich as E
from ..operators.assemble import assemble_client
from ..operators.lags import add_lag_inner, add_lags
from ..operators.normalise import normalise_by_capacity
from ..operators.sizing import dimension
from ..schemas import PANEL_KEY
from ..sources import spine
from .fixtures import Panel


def history_of(panel_target: DataFrame, client: DataFrame, normalise: bool = True) -> DataFrame:
    """Truth history for lags: (unit, direction, hour, target), capacity-normalised
    when the model works in normalised units."""
    a = assemble_client(panel_target, client, "train")
    if normalise:
        a = normalise_by_capacity(a, "train")
    return a.select(*PANEL_KEY, "target")


def linear_features(rows: DataFrame, client: DataFrame, history: DataFrame, mode: str = "train", fit_start=None,
                    solar: DataFrame | None = None, normalise: bool = True) -> DataFrame:
    """Stage 1 of the stacked model: client facts, normalised target (train), exact 2/7-day lags; with ``fit_start``
    the calendar terms and with ``solar`` the solar position, as columns (``hour_features`` has both by hour)."""
    a = assemble_client(rows, client, "train" if mode == "train" else "inference")
    if normalise:
        a = normalise_by_capacity(a, mode)
    if fit_start is not None:
        a = C.calendar_features(a, fit_start=fit_start)
    a = add_lags(a, history, "target", (2, 7), mode)
    if solar is not None:
        a = E.add_solar(a, solar)
    return a


def hour_features(spark, rows: DataFrame, fit_start, ts: str = "prediction_datetime") -> DataFrame:
    """Every hour between the first and last of ``rows`` with all that depends on the hour alone: calendar terms and
    solar position. A row an hour, stored and counted."""
    hours = solar_of(spark, rows, ts).withColumnRenamed("datetime", ts).withColumn("date", F.to_date(ts))
    return dimension(C.calendar_features(hours, ts, fit_start=fit_start))


class ForestStage:
    """Stage 2's sides, prices and county weather (one forecast run per hour when ``latest_run``), stored once."""

    def __init__(self, panel: Panel, latest_run: bool = True):
        st = E.station_per_county(panel.station_map, order=(F.col("longitude"), F.negative("latitude")))
        fc = E.latest_run(panel.weather_forecast) if latest_run else panel.weather_forecast
        self.weather = dimension(E.county_weather(st, fc))
        self.gas, self.electricity = dimension(panel.gas_prices), dimension(panel.electricity_prices)

    def add(self, df: DataFrame) -> DataFrame:
        return E.add_county_weather(E.add_prices(df, self.gas, self.electricity), self.weather)


def forest_stage_features(df: DataFrame, panel: Panel, latest_run: bool = True) -> DataFrame:
    """Stage 2 for a single frame."""
    return ForestStage(panel, latest_run).add(df)


def minimal_features(panel: Panel, solar: DataFrame) -> DataFrame:
    """A3 minimal: same-day client facts + solar; log1p(capacity)."""
    a = assemble_client(panel.target, panel.client, "train")
    a = E.add_solar(a, solar, how="inner")
    return a.select("prediction_unit_id", "row_id", F.log1p("installed_capacity").alias("installed_capacity"),
                    "eic_count", "solar_azimuth", "solar_elevation", "target", "is_consumption")


def ar_features(panel: Panel, solar: DataFrame) -> DataFrame:
    """A3 autoregressive: J4 inner 2-day lag by unit (production rows), client facts,
    solar, log1p of capacity and of the previous value."""
    prod = panel.target.filter(~F.col("is_consumption"))
    lagged = add_lag_inner(prod, prod.select(*PANEL_KEY, "target"), "target", 2) \
        .withColumnRenamed("target_2d_ago", "target_previous")
    a = assemble_client(lagged, panel.client, "train")
    a = E.add_solar(a, solar, how="inner")
    return a.select("prediction_unit_id", "row_id", F.log1p("installed_capacity").alias("installed_capacity"),
                    "eic_count", "solar_azimuth", "solar_elevation",
                    F.log1p("target_previous").alias("target_previous"), "target")


def regression_features(panel: Panel, fit_start) -> DataFrame:
    """A4 (archived): client facts two days earlier, date process (constant, trend,
    weekly seasonal dummies, Fourier), time-of-day dummies without 10:00, log1p capacity."""
    t = panel.target.drop("target")
    a = assemble_client(t, panel.client, "inference")
    d = F.to_date("prediction_datetime")
    a = a.select("*", F.lit(1.0).alias("const"), C.trend(d, fit_start).alias("trend"),
                 *C.weekly_dummies(d, fit_start), *C.fourier_terms(d), *C.hour_dummies("prediction_datetime"))
    a = a.withColumn("installed_capacity", F.log1p("installed_capacity"))
    return a.drop("eic_count", "county", "is_business", "product_type", "data_block_id", "date",
                  "prediction_datetime", "date_when_predicting")


def make_time_features(rows: DataFrame, client: DataFrame, fit_start) -> DataFrame:
    """A4 (archived): time-only regressors: date process (constant, trend, weekly dummies, Fourier) and time-of-day
    dummies without 10:00, for rows whose segment has client facts two days earlier; segment columns stay."""
    a = assemble_client(rows.drop("target"), client, "inference")
    d = F.to_date("prediction_datetime")
    a = a.select("*", F.lit(1.0).alias("const"), C.trend(d, fit_start).alias("trend"), *C.weekly_dummies(d, fit_start),
                 *C.fourier_terms(d), *C.hour_dummies("prediction_datetime"))
    return a.drop("eic_count", "installed_capacity", "data_block_id", "date", "prediction_datetime", "date_when_predicting",
                  "currently_scored")


def solar_of(spark, rows: DataFrame, ts: str = "prediction_datetime") -> DataFrame:
    """S8 table of the default site over the hours of ``rows`` (bounds from the data, not declared)."""
    return spine.solar_table(spark, *spine.data_bounds(rows, ts))
