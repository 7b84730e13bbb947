"""Time spines and solar tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions.calendar import col
from ..functions.numeric import scaled_coord
from ..functions.solar import with_solar_position
from ..functions.tz import local_to_utc


def hour_spine(spark: SparkSession, start, end, name: str = "datetime") -> DataFrame:
    """Every hour in [start, end] as TIMESTAMP_NTZ.

    Generated with ``sequence`` over day-sized chunks so no single row expands
    to the whole range.
    """
    return _spine(spark, start, end, "hour", name)


def day_spine(spark: SparkSession, start, end, name: str = "date") -> DataFrame:
    """S7 daily."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                      F.expr("interval 1 day"))).alias(name))
    return days


def _bound(v):
    """A bound is a literal string or a Column (e.g. a scalar subquery from ``data_bounds``)."""
    return F.lit(v).cast("timestamp_ntz") if isinstance(v, str) else v


def data_bounds(df: DataFrame, ts: str):
    """G10 as scalar subqueries: (min, max) of ``ts``; evaluated by the executors,
    never collected."""
    b = df.select(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    return b.select("lo").scalar(), b.select("hi").scalar()


def _spine(spark, start, end, unit, name):
    s = _bound(start)
    e = _bound(end)
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(s), F.to_date(e),
                                                      F.expr("interval 1 day"))).alias("_d"))
    days = days.repartition("_d")           # one row gives the days; hours and what is derived from them spread
    return spine_from_days(days, s, e, name)


def spine_from_days(days: DataFrame, s, e, name: str = "datetime") -> DataFrame:
    """Expand a day column ``_d`` into its hours, keeping those in [s, e]."""
    hours = days.select(F.explode(F.sequence(F.col("_d").cast("timestamp_ntz"),
                                             F.col("_d").cast("timestamp_ntz") + F.expr("interval 23 hours"),
                                             F.expr("interval 1 hour"))).alias(name))
    return hours.filter((F.col(name) >= s) & (F.col(name) <= e))


def spine_between(bounds: DataFrame, lo: str, hi: str, name: str = "datetime",
                  keys=(), freq: str = "hour") -> DataFrame:
    """S7 from data bounds: hourly instants between per-row ``lo`` and ``hi``.

    ``bounds`` comes from an aggregate (G10), so the spine never passes through
    the driver. Two explodes (days, then hours) keep each generator output small.
    """
    days = bounds.select(*keys, lo, hi, F.explode(F.sequence(F.to_date(lo), F.to_date(hi),
                                                             F.expr("interval 1 day"))).alias("_d"))
    if freq == "day":
        return days.select(*keys, F.col("_d").alias(name))
    hours = days.select(*keys, lo, hi, F.explode(F.sequence(
        F.col("_d").cast("timestamp_ntz"), F.col("_d").cast("timestamp_ntz") + F.expr("interval 23 hours"),
        F.expr("interval 1 hour"))).alias(name))
    return hours.filter((F.col(name) >= F.col(lo)) & (F.col(name) <= F.col(hi))).select(*keys, name)


def solar_table(spark: SparkSession, start, end, site=schemas.SOLAR_SITE) -> DataFrame:
    """Hourly azimuth/elevation for one site; naive hours read in the site's zone.

    ``start`` and ``end``: strings, or scalar subqueries such as ``data_bounds`` of the table to be joined."""
    lat, lon, zone = site
    return solar_for_hours(hour_spine(spark, start, end), lat, lon, zone)


def solar_for_hours(hours: DataFrame, lat, lon, zone: str = schemas.SOLAR_SITE[2],
                    ts: str = "datetime") -> DataFrame:
    with_utc = hours.withColumn("_utc", local_to_utc(ts, zone))
    return with_solar_position(with_utc, "_utc", lat, lon).drop("_utc")


def rich_solar_table(locations: DataFrame, start, end,
                     zone: str = schemas.SOLAR_SITE[2], scale_keys: bool = False) -> DataFrame:
    """Every (location, hour) with its solar position, stacked long.

    ``locations`` has ``latitude``/``longitude``; the hours are generated per
    location row, so the work spreads over the location partitions.
    """
    s = _bound(start)
    e = _bound(end)
    locs = locations.select("latitude", "longitude").distinct()
    days = locs.select("latitude", "longitude",
                       F.explode(F.sequence(F.to_date(s), F.to_date(e), F.expr("interval 1 day"))).alias("_d"))
    hours = days.select("latitude", "longitude", F.explode(F.sequence(
        F.col("_d").cast("timestamp_ntz"), F.col("_d").cast("timestamp_ntz") + F.expr("interval 23 hours"),
        F.expr("interval 1 hour"))).alias("datetime")).filter((F.col("datetime") >= s) & (F.col("datetime") <= e))
    out = solar_for_hours(hours, "latitude", "longitude", zone)
    if scale_keys:
        out = out.withColumns({"latitude": scaled_coord("latitude"), "longitude": scaled_coord("longitude")})
    return out.select("datetime", "solar_elevation", "solar_azimuth", "latitude", "longitude")
