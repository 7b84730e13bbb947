"""Queries: calendar features and encodings."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions.encode import one_hot, segment_domain, segment_signature
from ..operators.quality import missing_instants
from ..sources.spine import spine_between
from .fixtures import load_panel
from .registry import query, rounded

SIGNATURES = [f"{c}-{b}-{p}" for c in range(3) for b in range(2) for p in range(2)]


def _fourier_sql(d: str) -> str:
    r = f"((dayofyear({d}) - 1) / dayofyear(make_date(year({d}), 12, 31)))"
    out = []
    for k in range(1, 7):
        w = repr(2 * math.pi * k)
        out.append(f"round(sin(CAST('{w}' AS DOUBLE) * {r}), 6) AS sin_{k}")
        out.append(f"round(cos(CAST('{w}' AS DOUBLE) * {r}), 6) AS cos_{k}")
    return ", ".join(out)


@query("f1_f2_f3_calendar_daily", f"""
WITH b AS (SELECT min(date) AS fs FROM daily)
SELECT unit, date, CAST(date - fs + 1 AS DOUBLE) AS trend, {_fourier_sql("date")},
       {", ".join(f"CAST((date - fs) % 7 = {k} AS INTEGER) AS s{k + 1}_7" for k in range(1, 7))}
FROM daily, b""", ("daily",))
def f1_f2_f3_calendar(spark, sf_dir):
    d = load_panel(spark, sf_dir).daily
    fs = d.select(F.min("date")).scalar()
    out = d.select("unit", "date", C.trend("date", fs).alias("trend"), *C.fourier_terms("date"),
                   *C.weekly_dummies("date", fs))
    return rounded(out, cols=C.fourier_names())


@query("f4_f5_f6_time_parts", """
SELECT row_id, CAST(isodow(prediction_datetime) AS INTEGER) AS weekday,
       CAST(hour(prediction_datetime) AS INTEGER) AS hour_of_day, CAST(prediction_datetime AS DATE) AS date,
       strftime(prediction_datetime, '%H:%M:%S') AS time_of_day,
       prediction_datetime - INTERVAL 2 DAY AS ts_2d_ago, prediction_datetime - INTERVAL 7 DAY AS ts_7d_ago,
       prediction_datetime - INTERVAL 1 HOUR AS ts_1h_ago
FROM tgt""", ("tgt",))
def f4_f5_f6(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    ts = "prediction_datetime"
    return t.select("row_id", C.weekday_iso(ts).alias("weekday"), C.hour_of_day(ts).alias("hour_of_day"),
                    C.date_of(ts).alias("date"), C.time_of(ts).alias("time_of_day"),
                    C.shift(ts, days=-2).alias("ts_2d_ago"), C.shift(ts, days=-7).alias("ts_7d_ago"),
                    C.shift(ts, hours=-1).alias("ts_1h_ago"))


@query("f7_hour_dummies", "SELECT row_id, " + ", ".join(
    f"CAST(hour(prediction_datetime) = {k} AS INTEGER) AS hour_{k:02d}" for k in range(24) if k != 10)
    + " FROM tgt", ("tgt",))
def f7_hour_dummies(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    return t.select("row_id", *C.hour_dummies("prediction_datetime"))


_SIG_SQL = "concat_ws('-', county, CAST(is_business AS INTEGER), product_type)"


@query("f8_f9_segment_one_hot", f"""
SELECT row_id, {_SIG_SQL} AS signature, """ + ", ".join(
    f"CAST({_SIG_SQL} = '{s}' AS INTEGER) AS seg_{s.replace('-', '_')}" for s in SIGNATURES) + " FROM tgt",
       ("tgt",))
def f8_one_hot(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.withColumn("signature", segment_signature())
    return t.select("row_id", "signature", *one_hot("signature", SIGNATURES, "seg"))


@query("f9_segment_domain", f"""
SELECT c.county, b.is_business, p.product_type,
       concat_ws('-', c.county, CAST(b.is_business AS INTEGER), p.product_type) AS signature
FROM (SELECT DISTINCT county FROM tgt) c, (SELECT DISTINCT is_business FROM tgt) b,
     (SELECT DISTINCT product_type FROM tgt) p""", ("tgt",))
def f9_domain(spark, sf_dir):
    return segment_domain(load_panel(spark, sf_dir).target)


@query("j10_calendar_in_place", f"""
WITH b AS (SELECT min(CAST(prediction_datetime AS DATE)) AS fs FROM tgt),
t AS (SELECT row_id, prediction_datetime, CAST(prediction_datetime AS DATE) AS date FROM tgt)
SELECT row_id, CAST(isodow(prediction_datetime) AS INTEGER) AS weekday,
       CAST(hour(prediction_datetime) AS INTEGER) AS hour_of_day, CAST(date - fs + 1 AS DOUBLE) AS trend,
       {_fourier_sql("date")}
FROM t, b""", ("tgt",))
def j10_calendar(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.select("row_id", "prediction_datetime",
                                                F.to_date("prediction_datetime").alias("date"))
    fs = t.select(F.min("date")).scalar()
    out = C.calendar_features(t, fit_start=fs).drop("prediction_datetime", "date")
    return rounded(out, cols=C.fourier_names())


@query("s7_q2_missing_days_per_unit", """
WITH b AS (SELECT unit, min(date) AS lo, max(date) AS hi FROM daily GROUP BY unit),
s AS (SELECT unit, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT s.unit, s.date FROM s ANTI JOIN daily d ON s.unit = d.unit AND s.date = d.date""", ("daily",))
def s7_missing_days(spark, sf_dir):
    d = load_panel(spark, sf_dir).daily
    bounds = d.groupBy("unit").agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    spine = spine_between(bounds, "_lo", "_hi", "date", ["unit"], freq="day")
    return spine.join(d.select("unit", "date"), ["unit", "date"], "left_anti")


@query("q2_missing_hours_electricity", """
WITH b AS (SELECT min(forecast_datetime) AS lo, max(forecast_datetime) AS hi FROM elec),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS forecast_datetime FROM b)
SELECT s.forecast_datetime FROM s ANTI JOIN elec e ON s.forecast_datetime = e.forecast_datetime""", ("elec",))
def q2_missing_hours(spark, sf_dir):
    return missing_instants(load_panel(spark, sf_dir).electricity_prices, "forecast_datetime")
