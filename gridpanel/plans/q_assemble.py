"""Queries: cleaning, assembly, lags."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.assemble import assemble_client, join_on_date_of, split_by_direction
from ..operators.lags import add_lag_inner, add_lags
from ..operators.normalise import normalise_by_capacity
from ..schemas import PANEL_KEY
from .fixtures import load_panel
from .registry import query, rounded

_LAG_OUT = ["row_id", "prediction_unit_id", "is_consumption", "prediction_datetime", "target",
            "target_2d_ago", "target_7d_ago"]


def capacity_normalised_lags(spark, sf_dir, mode: str):
    """Minimum slice: target J1 client -> F14 -> J3 (exact 2- and 7-day lags)."""
    p = load_panel(spark, sf_dir)
    a = normalise_by_capacity(assemble_client(p.target, p.client, "train"), "train")
    hist = a.select(*PANEL_KEY, "target")
    return rounded(add_lags(a, hist, "target", (2, 7), mode).select(*_LAG_OUT))


_LAG_SQL = """
WITH a AS (
  SELECT t.row_id, t.prediction_unit_id, t.is_consumption, t.prediction_datetime,
         t.target / nullif(c.installed_capacity, 0) AS target
  FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business
   AND t.product_type = c.product_type AND CAST(t.prediction_datetime AS DATE) = c.date)
SELECT a.row_id, a.prediction_unit_id, a.is_consumption, a.prediction_datetime,
       round(a.target, 6) AS target, round({fill2}, 6) AS target_2d_ago, round({fill7}, 6) AS target_7d_ago
FROM a
LEFT JOIN a h2 ON h2.prediction_unit_id = a.prediction_unit_id AND h2.is_consumption = a.is_consumption
 AND h2.prediction_datetime = a.prediction_datetime - INTERVAL 2 DAY
LEFT JOIN a h7 ON h7.prediction_unit_id = a.prediction_unit_id AND h7.is_consumption = a.is_consumption
 AND h7.prediction_datetime = a.prediction_datetime - INTERVAL 7 DAY
{where}"""


@query("j3_lag_2d_7d_inference",
       _LAG_SQL.format(fill2="coalesce(h2.target, 0)", fill7="coalesce(h7.target, 0)", where=""),
       ("tgt", "cli"))
def j3_lag_inference(spark, sf_dir):
    return capacity_normalised_lags(spark, sf_dir, "inference")


@query("j3_lag_2d_7d_train",
       _LAG_SQL.format(fill2="h2.target", fill7="h7.target",
                       where="WHERE h2.target IS NOT NULL AND h7.target IS NOT NULL AND a.target IS NOT NULL"),
       ("tgt", "cli"))
def j3_lag_train(spark, sf_dir):
    return capacity_normalised_lags(spark, sf_dir, "train")


@query("j4_lag_2d_inner", """
SELECT t.row_id, t.prediction_unit_id, t.prediction_datetime, t.target, h.target AS target_2d_ago
FROM tgt t JOIN tgt h ON h.prediction_unit_id = t.prediction_unit_id AND h.is_consumption = t.is_consumption
 AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY
WHERE NOT t.is_consumption""", ("tgt",))
def j4_lag_inner(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    prod, _ = split_by_direction(p.target)
    return add_lag_inner(prod, prod.select(*PANEL_KEY, "target"), "target", 2).select(
        "row_id", "prediction_unit_id", "prediction_datetime", "target", "target_2d_ago")


_ASSEMBLE_SQL = """
SELECT t.row_id, t.prediction_unit_id, t.county, t.is_business, t.product_type, t.is_consumption,
       t.prediction_datetime, t.data_block_id, t.target, t.date_when_predicting,
       CAST(t.prediction_datetime AS DATE) AS date, c.eic_count, c.installed_capacity
FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business
 AND t.product_type = c.product_type AND {day} = c.date"""


@query("j1_assemble_client_train", _ASSEMBLE_SQL.format(day="CAST(t.prediction_datetime AS DATE)"),
       ("tgt", "cli"))
def j1_assemble_train(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    return assemble_client(p.target, p.client, "train")


@query("j2_assemble_client_2d_earlier", _ASSEMBLE_SQL.format(day="t.date_when_predicting"),
       ("tgt", "cli"))
def j2_assemble_inference(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    return assemble_client(p.target, p.client, "inference")


@query("s2_clean_target", "SELECT * FROM tgt", ("tgt",))
def s2_clean_target(spark, sf_dir):
    return load_panel(spark, sf_dir).target


@query("s4_clean_electricity", "SELECT * FROM elec", ("elec",))
def s4_clean_electricity(spark, sf_dir):
    return load_panel(spark, sf_dir).electricity_prices


@query("p5_f11_clean_forecast", "SELECT * FROM wf", ("wf",))
def p5_clean_forecast(spark, sf_dir):
    return load_panel(spark, sf_dir).weather_forecast


@query("p6_split_production", """
SELECT row_id, prediction_unit_id, prediction_datetime, target FROM tgt WHERE NOT is_consumption""",
       ("tgt",))
def p6_split_production(spark, sf_dir):
    prod, _ = split_by_direction(load_panel(spark, sf_dir).target)
    return prod.select("row_id", "prediction_unit_id", "prediction_datetime", "target")


@query("j17_join_on_date_of_hour", """
SELECT t.row_id, t.prediction_datetime, g.lowest_price_per_mwh
FROM tgt t JOIN gas g ON CAST(t.prediction_datetime AS DATE) = g.forecast_date""", ("tgt", "gas"))
def j17_join_on_date(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    return join_on_date_of(p.target.select("row_id", "prediction_datetime"),
                           p.gas_prices.select("forecast_date", "lowest_price_per_mwh"),
                           "prediction_datetime", "forecast_date").drop("forecast_date")


@query("p1_p4_project_rename", """
SELECT row_id, prediction_unit_id AS unit, target * 2 AS target_x2,
       CAST(prediction_datetime AS DATE) AS date FROM tgt""", ("tgt",))
def p1_p4_project(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    return (t.withColumns({"target_x2": F.col("target") * 2, "date": F.to_date("prediction_datetime")})
            .withColumnsRenamed({"prediction_unit_id": "unit"})
            .drop("county", "is_business", "product_type", "is_consumption", "prediction_datetime",
                  "data_block_id", "target", "date_when_predicting", "no_such_column"))
