"""Panels derived from the driver's tables, in Spark and in SQL.

The driver provides generic tables; the forecasting inputs are derived from
them by aggregation, so their size grows with the tables:

- ``target``: one row per (user, direction, hour) of ``events``; the user is
  the production unit, its segment keys follow from the id.
- ``client``: segment x day facts from ``events``.
- ``weather_forecast``: 12 stations x hour x run (two runs cover an hour).
- ``station_to_county``, ``gas_prices`` (purchase events), ``electricity_prices``
  (view events, hours missing), ``daily`` (orders by priority and date).

``FIXTURE_SQL`` holds the same definitions as DuckDB-runnable SQL, already in
cleaned form; ``with_fixtures`` prefixes a query with the CTEs it names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import hour_floor
from ..sources import tables as T


TARGET_SCALE = 0.7390851332151607   # neither it nor its square is near a short decimal


def read_base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_base(spark, sf_dir, "events")


BLOCK_EPOCH = "2024-01-01"          # block 0; blocks are whole days, also across years
DENSE_UNITS = 12                    # units of the dense panel (a multiple of the segment pattern of 6)


def _block(ts) -> F.Column:
    return F.date_diff(F.to_date(ts), F.lit(BLOCK_EPOCH).cast("date")).cast("bigint")


def split_block(target: DataFrame) -> F.Column:
    """First block of the test part: two thirds along the data's blocks, as a scalar subquery."""
    return target.select(F.expr("min(data_block_id) + (max(data_block_id) - min(data_block_id)) * 2 div 3")).scalar()


def _segment_cols(u=None):
    u = F.col("user_id") if u is None else u
    return [(u % 3).cast("int").alias("county"), ((u % 6) >= 3).alias("is_business"),
            (u % 2).cast("int").alias("product_type")]


def raw_target(spark, sf_dir, units: int | None = None) -> DataFrame:
    """Truth rows from all events; ``units`` folds the users into so many units, which fills their hours."""
    ev = _events(spark, sf_dir)
    unit = F.col("user_id") if units is None else F.col("user_id") % units
    return (ev.groupBy(unit.cast("int").alias("prediction_unit_id"), *_segment_cols(unit),
                       ((F.col("event_id") % 2) == 1).alias("is_consumption"),
                       hour_floor("ts").alias("datetime"), _block("ts").alias("data_block_id"))
            # scaled by a constant with a long binary expansion so that derived means
            # and differences never land on a short decimal (a rounding tie)
            .agg(F.min("event_id").alias("row_id"),
                 (F.round(F.sum("value"), 4) * F.lit(TARGET_SCALE)).alias("target"))
            .select("row_id", "prediction_unit_id", "county", "is_business", "product_type",
                    "is_consumption", "datetime", "data_block_id", "target"))


def raw_client(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir)
    return (ev.groupBy(*_segment_cols(), F.to_date("ts").alias("date"), _block("ts").alias("data_block_id"))
            .agg(F.count_distinct("user_id").alias("eic_count"),
                 F.round(F.sum("value"), 4).alias("installed_capacity"))
            .select("county", "is_business", "product_type", "date", "eic_count",
                    "installed_capacity", "data_block_id"))


def _station_cols():
    u = F.col("user_id")
    return [((F.lit(576) + 3 * (u % 4)).cast("double") / 10).alias("latitude"),
            ((F.lit(232) + 10 * (u % 3)).cast("double") / 10).alias("longitude")]


def raw_weather_forecast(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir)
    v = F.col("value")
    per_event = ev.select(*_station_cols(), hour_floor("ts").alias("forecast_datetime"),
                          (F.hour("ts") + 24 * (F.col("event_id") % 2)).cast("int").alias("hours_ahead"),
                          _block("ts").alias("data_block_id"), "value")
    # means are written sum / count so both engines do the same two IEEE steps
    mean = F.round(F.sum(v), 4) / F.count(F.lit(1))
    g = per_event.groupBy("latitude", "longitude", "forecast_datetime", "hours_ahead", "data_block_id").agg(
        mean.alias("temperature"),
        F.min(v).alias("dewpoint"),
        (F.count(F.lit(1)) / 10.0).alias("cloudcover_high"),
        (F.min(v) / 100.0).alias("cloudcover_low"),
        (F.max(v) / 100.0).alias("cloudcover_mid"),
        (mean / 100.0).alias("cloudcover_total"),
        (F.max(v) - F.min(v)).alias("10_metre_u_wind_component"),
        (F.min(v) - mean).alias("10_metre_v_wind_component"),
        F.max(v).alias("direct_solar_radiation"),
        F.round(F.sum(v), 4).alias("surface_solar_radiation_downwards"),
        (F.min(v) / 10.0).alias("snowfall"),
        F.count(F.lit(1)).cast("double").alias("total_precipitation"))
    return g.withColumn("origin_datetime",
                        F.col("forecast_datetime") - F.make_dt_interval(F.lit(0), F.col("hours_ahead")))


def raw_station_map(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir)
    return ev.select(*_station_cols(), (F.col("user_id") % 3).cast("int").alias("county")).distinct()


def raw_gas(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir).filter(F.col("event_type") == "purchase")
    return (ev.groupBy(F.to_date("ts").alias("forecast_date"), _block("ts").alias("data_block_id"))
            .agg(F.min("value").alias("lowest_price_per_mwh"), F.max("value").alias("highest_price_per_mwh"))
            .withColumn("origin_date", F.date_sub("forecast_date", 1)))


def raw_electricity(spark, sf_dir) -> DataFrame:
    ev = _events(spark, sf_dir).filter(F.col("event_type") == "view")
    return (ev.groupBy(hour_floor("ts").alias("forecast_date"), _block("ts").alias("data_block_id"))
            .agg((F.round(F.sum("value"), 4) / F.count(F.lit(1))).alias("euros_per_mwh"))
            .withColumn("origin_date", F.col("forecast_date") - F.expr("interval 1 day")))


def daily_panel(spark, sf_dir) -> DataFrame:
    o = read_base(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("unit"), F.to_date("o_orderdate").alias("date"))
            .agg(F.round(F.sum("o_totalprice"), 2).alias("target"), F.count(F.lit(1)).alias("n")))


# Station coordinates (x10 integers) the forecast fixture produces after the two
# offshore points are removed: latitude 576..585 step 3, longitude 232..252 step 10.
FIXTURE_STATIONS = [(a, b) for a in (576, 579, 582, 585) for b in (232, 242, 252)
                    if (a, b) not in ((576, 232), (576, 242))]


class Panel:
    """Cleaned inputs for one data directory. Each table is built on first use
    (lazy DataFrames), so a query only plans the inputs it reads."""

    _builders = {
        "target": lambda sp, d: T.clean_target(raw_target(sp, d)),
        "dense_target": lambda sp, d: T.clean_target(raw_target(sp, d, DENSE_UNITS)),
        "client": lambda sp, d: T.clean_client(raw_client(sp, d)),
        "raw_weather_forecast": raw_weather_forecast,
        "weather_forecast": lambda sp, d: T.clean_weather_forecast(raw_weather_forecast(sp, d)),
        "raw_station_map": raw_station_map,
        "station_map": lambda sp, d: T.clean_station_map(raw_station_map(sp, d)),
        "gas_prices": lambda sp, d: T.clean_gas(raw_gas(sp, d)),
        "electricity_prices": lambda sp, d: T.clean_electricity(raw_electricity(sp, d)),
        "daily": daily_panel,
    }

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._cache = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        builders = type(self)._builders
        if name not in builders:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = builders[name](self._spark, self._dir)
        return self._cache[name]


def load_panel(spark: SparkSession, sf_dir: str) -> Panel:
    return Panel(spark, sf_dir)


# ---------------------------------------------------------------- SQL side
_SEG = ("CAST(user_id % 3 AS INTEGER) AS county, (user_id % 6 >= 3) AS is_business, "
        "CAST(user_id % 2 AS INTEGER) AS product_type")
SPLIT = "(SELECT min(data_block_id) + (max(data_block_id) - min(data_block_id)) * 2 // 3 FROM {})"
_HOUR = "CAST(date_trunc('hour', ts) AS TIMESTAMP)"
_BLOCK = f"CAST(date_diff('day', DATE '{BLOCK_EPOCH}', CAST(ts AS DATE)) AS BIGINT)"
_LAT = "CAST(576 + 3 * (user_id % 4) AS DOUBLE) / 10"
_LON = "CAST(232 + 10 * (user_id % 3) AS DOUBLE) / 10"

def _target_sql(unit: str) -> str:
    return f"""
SELECT row_id, prediction_unit_id, county, is_business, product_type, is_consumption,
       prediction_datetime, data_block_id, target,
       CAST(prediction_datetime AS DATE) - 2 AS date_when_predicting
FROM (SELECT min(event_id) AS row_id, CAST({unit} AS INTEGER) AS prediction_unit_id, {_SEG},
             (event_id % 2 = 1) AS is_consumption, {_HOUR} AS prediction_datetime,
             {_BLOCK} AS data_block_id, round(sum(value), 4) * CAST('{TARGET_SCALE!r}' AS DOUBLE) AS target
      FROM events GROUP BY 2, 3, 4, 5, 6, 7, 8) x
WHERE target IS NOT NULL AND NOT isnan(target)"""


FIXTURE_SQL = {
    # cleaned target: datetime renamed, date_when_predicting added; dtgt: users folded into few units
    "tgt": _target_sql("user_id"),
    "dtgt": _target_sql(f"user_id % {DENSE_UNITS}"),
    "cli": f"""
SELECT {_SEG}, CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS eic_count,
       round(sum(value), 4) AS installed_capacity, {_BLOCK} AS data_block_id
FROM events GROUP BY 1, 2, 3, 4, 7""",
    "wf_raw": f"""
SELECT latitude, longitude, forecast_datetime, hours_ahead, data_block_id,
       round(sum(value), 4) / count(*) AS temperature, min(value) AS dewpoint,
       count(*) / 10.0 AS cloudcover_high, min(value) / 100.0 AS cloudcover_low,
       max(value) / 100.0 AS cloudcover_mid, round(sum(value), 4) / count(*) / 100.0 AS cloudcover_total,
       max(value) - min(value) AS "10_metre_u_wind_component",
       min(value) - round(sum(value), 4) / count(*) AS "10_metre_v_wind_component",
       max(value) AS direct_solar_radiation, round(sum(value), 4) AS surface_solar_radiation_downwards,
       min(value) / 10.0 AS snowfall, CAST(count(*) AS DOUBLE) AS total_precipitation,
       forecast_datetime - to_hours(hours_ahead) AS origin_datetime
FROM (SELECT {_LAT} AS latitude, {_LON} AS longitude, {_HOUR} AS forecast_datetime,
             CAST(hour(ts) + 24 * (event_id % 2) AS INTEGER) AS hours_ahead, {_BLOCK} AS data_block_id, value
      FROM events) e
GROUP BY latitude, longitude, forecast_datetime, hours_ahead, data_block_id""",
    # cleaned forecast: offshore stations removed, coordinates x10 integers
    "wf": """
SELECT * REPLACE (CAST(round(round(latitude, 3) * 10, 3) AS BIGINT) AS latitude,
                  CAST(round(round(longitude, 3) * 10, 3) AS BIGINT) AS longitude)
FROM wf_raw
WHERE (round(latitude, 3) <> 57.6 OR round(longitude, 3) <> 23.2)
  AND (round(latitude, 3) <> 57.6 OR round(longitude, 3) <> 24.2)""",
    "stn_raw": f"""
SELECT DISTINCT {_LAT} AS latitude, {_LON} AS longitude, CAST(user_id % 3 AS INTEGER) AS county FROM events""",
    "stn": """
SELECT CAST(round(round(latitude, 3) * 10, 3) AS BIGINT) AS latitude,
       CAST(round(round(longitude, 3) * 10, 3) AS BIGINT) AS longitude, county
FROM stn_raw WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND county IS NOT NULL""",
    "gas": f"""
SELECT CAST(ts AS DATE) AS forecast_date, {_BLOCK} AS data_block_id,
       min(value) AS lowest_price_per_mwh, max(value) AS highest_price_per_mwh,
       CAST(ts AS DATE) - 1 AS origin_date
FROM events WHERE event_type = 'purchase' GROUP BY 1, 2, 5""",
    "elec": f"""
SELECT {_BLOCK} AS data_block_id, round(sum(value), 4) / count(*) AS euros_per_mwh,
       {_HOUR} AS forecast_datetime, {_HOUR} - INTERVAL 1 DAY AS origin_datetime,
       CAST({_HOUR} - INTERVAL 1 DAY AS DATE) AS origin_date
FROM events WHERE event_type = 'view' GROUP BY 1, 3, 4, 5""",
    "daily": """
SELECT o_orderpriority AS unit, CAST(o_orderdate AS DATE) AS date,
       round(sum(o_totalprice), 2) AS target, count(*) AS n
FROM orders GROUP BY 1, 2""",
}

_DEPS = {"wf": ["wf_raw"], "stn": ["stn_raw"]}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` (which may start with its own ``WITH``-less CTE list via
    ``extra``) with the fixture CTEs it needs, in dependency order."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
