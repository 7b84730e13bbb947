import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import PANEL_SCHEMA, ts
from gridpanel.functions import calendar as C
from gridpanel.functions.encode import one_hot
from gridpanel.functions.tz import local_to_utc
from gridpanel.operators import enrich as E
from gridpanel.operators import normalise as N
from gridpanel.operators.lags import add_lag_inner, add_lags, shifted_history
from gridpanel.sources import tables as T


def test_missing_lag_hour_gives_null_not_previous_row(spark):
    rows = [(1, False, ts(h), float(h)) for h in range(201) if h != 50]
    df = spark.createDataFrame(rows, PANEL_SCHEMA)
    # with a row-offset lag the value would be hour 49's
    got = shifted_history(df, "target", (2,)).filter(F.col("target_2d_ago").isNotNull())
    assert got.filter(F.col("prediction_datetime") == ts(98)).count() == 0
    assert got.filter(F.col("prediction_datetime") == ts(99)).first()["target_2d_ago"] == 51.0
    out = add_lags(df, df, "target", (2,), "inference").filter(F.col("prediction_datetime") == ts(98)).first()
    assert out["target_2d_ago"] == 0.0
    train = add_lags(df, df, "target", (2, 7), "train")
    assert train.filter(F.col("prediction_datetime") == ts(98)).count() == 0
    assert train.filter(F.col("prediction_datetime") == ts(200)).first()["target_7d_ago"] == 200.0 - 168


def test_lag_inner_drops_rows_without_lag(spark):
    df = spark.createDataFrame([(1, False, ts(h), float(h)) for h in range(60)], PANEL_SCHEMA)
    out = add_lag_inner(df, df, "target", 2)
    assert out.count() == 12
    assert out.filter(F.col("target_2d_ago") != F.col("target") - 48).count() == 0


def test_zero_capacity_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 4.0)], "target double, installed_capacity double")
    out = N.normalise_by_capacity(df, "train").collect()
    assert out[0]["target"] is None and out[1]["target"] == 0.5
    assert N.normalise_by_capacity(df, "inference").collect()[0]["target"] == 1.0


def test_unit_max_unseen_unit(spark):
    fit = spark.createDataFrame([(1, 4.0), (1, 2.0)], "prediction_unit_id int, target double")
    mv = N.group_max(fit)
    new = spark.createDataFrame([(1, 2.0), (9, 3.0)], "prediction_unit_id int, target double")
    got = {r[0]: r[1] for r in N.apply_unit_max(new, mv).collect()}
    assert got == {1: 0.5, 9: 3.0}
    parity = {r[0]: r[1] for r in N.apply_unit_max(new, mv, fill_unseen=False).collect()}
    assert parity[9] is None
    back = N.invert_unit_max(N.apply_unit_max(new, mv), mv).filter("prediction_unit_id = 1").first()
    assert back["target"] == 2.0


def test_one_hot_unseen_level_all_zero(spark):
    df = spark.createDataFrame([("a",), ("z",)], "u string")
    out = df.select("u", *one_hot("u", ["a", "b"], "u")).orderBy("u").collect()
    assert (out[0]["u_a"], out[0]["u_b"]) == (1, 0)
    assert (out[1]["u_a"], out[1]["u_b"]) == (0, 0)


def test_nan_vs_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "k int, v double")
    assert sorted(r.k for r in T.drop_null_rows(df, ["v"]).collect()) == [1, 3]
    filled = {r.k: r.v for r in T.fill_numeric_nulls(df, 0, ["v"]).collect()}
    assert math.isnan(filled[1]) and filled[2] == 0.0
    nan_filled = {r.k: r.v for r in N.fill_nan(df, ["v"], 1.0).collect()}
    assert nan_filled[1] == 1.0 and nan_filled[2] is None


def test_fourier_leap_years(spark):
    df = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 2, 29),), (dt.date(2024, 12, 31),)], "d date")
    r = [x[0] for x in df.select(C.year_fraction("d")).collect()]
    assert r == pytest.approx([364 / 365, 59 / 366, 365 / 366])
    s1 = df.select(*C.fourier_terms("d", 1)).collect()
    assert s1[1]["sin_1"] == pytest.approx(math.sin(2 * math.pi * 59 / 366))


def test_weekday_monday_one(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 7, 23),)], "t timestamp_ntz")
    out = df.select(C.weekday_iso("t"), C.hour_of_day("t")).collect()
    assert [tuple(r) for r in out] == [(1, 5), (7, 23)]


def test_trend_and_weekly_dummies(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 10),), (dt.date(2024, 1, 4),)], "d date")
    out = df.select(C.trend("d", "2024-01-03").alias("tr"), *C.weekly_dummies("d", "2024-01-03")).collect()
    assert [r.tr for r in out] == [1.0, 8.0, 2.0]
    assert sum(out[0][1:]) == 0 and out[2]["s2_7"] == 1


def test_dst_warsaw(spark):
    df = spark.createDataFrame([(dt.datetime(2022, 3, 27, 2, 30),), (dt.datetime(2022, 10, 30, 2, 30),),
                                (dt.datetime(2022, 7, 1, 12, 0),)], "t timestamp_ntz")
    out = [r[0] for r in df.select(local_to_utc("t", "Europe/Warsaw")).collect()]
    assert out[0] == dt.datetime(2022, 3, 27, 1, 0)      # gap: shifted forward to 03:00 local
    assert out[1] == dt.datetime(2022, 10, 30, 0, 30)    # ambiguous: daylight-saving reading
    assert out[2] == dt.datetime(2022, 7, 1, 10, 0)


def test_offshore_pairs(spark):
    df = spark.createDataFrame([(57.6, 23.2), (57.6, 24.2), (57.6, 25.2), (58.5, 23.2)], "latitude double, longitude double")
    kept = sorted(tuple(r) for r in T.exclude_offshore(df).collect())
    assert kept == [(57.6, 25.2), (58.5, 23.2)]


def test_two_runs_latest(spark):
    fc = spark.createDataFrame([(576, 252, ts(30), 6, 1.0), (576, 252, ts(30), 30, 2.0)],
                               "latitude bigint, longitude bigint, forecast_datetime timestamp_ntz, hours_ahead int, temperature double")
    st = spark.createDataFrame([(576, 252, 1)], "latitude bigint, longitude bigint, county int")
    rows = spark.createDataFrame([(1, 1, ts(30))], "row_id int, county int, prediction_datetime timestamp_ntz")
    both = E.add_county_weather(rows, E.county_weather(st, fc, ["temperature"]))
    assert both.count() == 2
    one = E.add_county_weather(rows, E.county_weather(st, E.latest_run(fc), ["temperature"])).collect()
    assert len(one) == 1 and one[0]["temperature"] == 1.0


def test_station_first_per_county_with_override(spark):
    m = spark.createDataFrame([(58.5, 23.2, 1), (57.9, 23.2, 1), (58.2, 24.2, None), (58.8, 22.2, 2)],
                              "latitude double, longitude double, county int")
    out = {r.county: (r.latitude, r.longitude) for r in E.station_per_county(T.clean_station_map(m)).collect()}
    assert out == {1: (579, 232), 2: (588, 222)}
    ov = E.station_per_county(T.clean_station_map(m), overrides={(588, 222): 1})
    assert {r.county for r in ov.collect()} == {1}


def test_prices_fill_zero_and_rename(spark):
    feats = spark.createDataFrame([(1, ts(0)), (2, ts(30))], "row_id int, prediction_datetime timestamp_ntz")
    gas = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, 2.0)], "forecast_date date, lowest_price_per_mwh double, highest_price_per_mwh double")
    el = spark.createDataFrame([(ts(0), 5.0)], "forecast_datetime timestamp_ntz, euros_per_mwh double")
    out = {r.row_id: r for r in E.add_prices(feats, gas, el).collect()}
    assert (out[1].price_gas_low, out[1].price_electricity) == (1.0, 5.0)
    assert (out[2].price_gas_high, out[2].price_electricity) == (0.0, 0.0)


def test_solar_position_plausible(spark):
    from gridpanel.sources.spine import solar_for_hours
    hours = spark.createDataFrame([(dt.datetime(2022, 6, 21, 13, 20),), (dt.datetime(2022, 12, 21, 12, 20),),
                                   (dt.datetime(2022, 6, 21, 1, 0),)], "datetime timestamp_ntz")
    out = solar_for_hours(hours, 58.60, 25.01, "Europe/Tallinn").collect()
    assert out[0].solar_elevation == pytest.approx(90 - 58.60 + 23.44, abs=0.6)
    assert out[1].solar_elevation == pytest.approx(90 - 58.60 - 23.44, abs=0.6)
    assert out[0].solar_azimuth == pytest.approx(180, abs=3)
    assert out[2].solar_elevation < 0
