"""Enrichment joins: prices, solar, station weather, wide forecasts.

Dimension tables (prices by day/hour, station maps, weather by county and hour,
solar positions) are stored, counted and broadcast within a byte bound
(``sizing.checked_broadcast``); past it the planner shuffles.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.encode import location
from ..schemas import WEATHER_COLUMNS
from ..sources.tables import drop_null_rows, fill_numeric_nulls
from .sizing import checked_broadcast, counted_rows


def add_prices(features: DataFrame, gas: DataFrame, electricity: DataFrame,
               date_col: str = "date", ts: str = "prediction_datetime") -> DataFrame:
    """J5 + J6 + P8: daily gas low/high and hourly electricity price, left joined;
    numeric nulls of the whole table set to 0; columns renamed."""
    if date_col not in features.columns:
        features = features.withColumn(date_col, F.to_date(ts))
    g = checked_broadcast(gas.select(F.col("forecast_date").alias("_gdate"), "lowest_price_per_mwh",
                                     "highest_price_per_mwh"), counted=counted_rows(gas))
    e = checked_broadcast(electricity.select(F.col("forecast_datetime").alias("_edt"), "euros_per_mwh"), counted=counted_rows(electricity))
    out = (features.join(g, features[date_col] == g["_gdate"], "left").drop("_gdate")
           .join(e, F.col(ts) == e["_edt"], "left").drop("_edt"))
    return fill_numeric_nulls(out).withColumnsRenamed({
        "lowest_price_per_mwh": "price_gas_low", "highest_price_per_mwh": "price_gas_high",
        "euros_per_mwh": "price_electricity"})


def add_solar(features: DataFrame, solar: DataFrame, extra_keys=(), ts: str = "prediction_datetime",
              how: str = "left") -> DataFrame:
    """Solar position by hour, optionally also by location keys (scaled alike, D8)."""
    s = solar.select(F.col("datetime").alias("_sdt"), *extra_keys, "solar_azimuth", "solar_elevation")
    s = checked_broadcast(s, counted=counted_rows(solar))
    cond = [features[ts] == s["_sdt"]] + [features[k] == s[k] for k in extra_keys]
    out = features.join(s, cond, how).drop("_sdt")
    for k in extra_keys:
        out = out.drop(s[k])
    return out


def station_per_county(station_map: DataFrame, overrides: dict | None = None,
                       order=("longitude", "latitude")) -> DataFrame:
    """P13 + O2: optional keyed county override, then the first station per county
    under a declared total order. One grouped aggregate, no positional edits."""
    m = drop_null_rows(station_map.select("latitude", "longitude", "county"))
    if overrides:
        cty = F.col("county")
        for (lat, lon), county in overrides.items():
            cty = F.when((F.col("latitude") == lat) & (F.col("longitude") == lon), F.lit(county)).otherwise(cty)
        m = m.withColumn("county", cty.cast("int"))
    best = m.groupBy("county").agg(F.min_by(F.struct("latitude", "longitude"),
                                            F.struct(*order)).alias("_s"))
    return best.select("_s.longitude", "_s.latitude", "county")


def latest_run(forecast: DataFrame, keys=("latitude", "longitude", "forecast_datetime")) -> DataFrame:
    """J9 option: keep the run with the smallest ``hours_ahead`` per station-hour; ties go to the
    later block and origin, then to the order of all other values, so the choice is total.

    Grouped ``min_by`` (partial aggregation), groups hold at most the runs of one hour."""
    cols = [c for c in forecast.columns if c not in keys]
    best = forecast.groupBy(*keys).agg(F.min_by(F.struct(*cols), _run_order(forecast, cols)).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.`{c}`").alias(c) for c in cols])


def _run_order(forecast: DataFrame, cols) -> F.Column:
    """Total order of the runs of one station-hour: hours ahead, latest block and origin, then all values."""
    latest = [F.negative(F.col("data_block_id"))] if "data_block_id" in cols else []
    if "origin_datetime" in cols:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        latest.append(F.negative(F.timestamp_diff("SECOND", epoch, F.col("origin_datetime"))))
    return F.struct(F.col("hours_ahead"), *[c.alias(f"o{i}") for i, c in enumerate(latest)],
                    *[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])


def county_weather(station_map: DataFrame, forecast: DataFrame, columns=WEATHER_COLUMNS,
                   keep_hours_ahead: bool = False) -> DataFrame:
    """Station map left join forecasts on integer coordinates; nulls -> 0."""
    m = checked_broadcast(station_map.select("latitude", "longitude", "county"))
    j = m.join(forecast, ["latitude", "longitude"], "left")
    keep = list(columns) + ["forecast_datetime", "county"] + (["hours_ahead"] if keep_hours_ahead else [])
    return fill_numeric_nulls(j).select(*keep)


def add_county_weather(features: DataFrame, weather: DataFrame, ts: str = "prediction_datetime") -> DataFrame:
    """Inner join on (hour, county). Two forecast runs cover an hour, so rows fan
    out unless the forecast was reduced by ``latest_run`` first."""
    w = checked_broadcast(weather.withColumnRenamed("forecast_datetime", "_fdt"), counted=counted_rows(weather))
    return features.join(w, (features[ts] == w["_fdt"]) & (features["county"] == w["county"]),
                         "inner").drop("_fdt").drop(w["county"])


def location_label(lat, lon) -> str:
    """Column-name-safe label of a scaled coordinate pair."""
    return f"{lat}_{lon}"


def pivot_forecast(forecast: DataFrame, locations, measures=("temperature", "direct_solar_radiation"),
                   index=("forecast_datetime", "hours_ahead")) -> DataFrame:
    """Long -> wide over a declared list of (lat, lon) locations, several measures
    at once. Output columns ``<measure>_<lat>_<lon>``."""
    labels = [location_label(a, b) for a, b in locations]
    f = forecast.withColumn("_loc", F.concat_ws("_", F.col("latitude").cast("string"),
                                                F.col("longitude").cast("string")))
    wide = f.groupBy(*index).pivot("_loc", labels).agg(*[F.first(m).alias(m) for m in measures])
    if len(measures) == 1:
        return wide.withColumnsRenamed({lab: f"{measures[0]}_{lab}" for lab in labels})
    return wide.withColumnsRenamed({f"{lab}_{m}": f"{m}_{lab}" for lab in labels for m in measures})


def forest_features(target: DataFrame, client: DataFrame, wide_weather: DataFrame,
                    solar: DataFrame) -> DataFrame:
    """J16 (archived forest builder): target + client known two days earlier, the wide
    all-station forecast row of the hour (two runs -> two rows), then solar; inner joins."""
    from .assemble import assemble_client
    u = assemble_client(target.drop("data_block_id"), client, "inference")
    w = checked_broadcast(wide_weather.drop("hours_ahead").withColumnRenamed("forecast_datetime", "_fdt"))
    j = u.join(w, u["prediction_datetime"] == w["_fdt"], "inner").drop("_fdt")
    j = add_solar(j, solar, how="inner")
    return j.drop("target", "prediction_datetime", "date_when_predicting")


def location_strings(df: DataFrame) -> DataFrame:
    """F10."""
    return df.withColumn("location", location("latitude", "longitude"))
