"""Queries: normalisation and group statistics."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import error_columns, forward, inverse
from ..operators import normalise as N
from ..operators.assemble import assemble_client
from ..operators.lags import add_lag_inner
from ..schemas import PANEL_KEY
from .fixtures import SPLIT, load_panel, split_block
from .registry import query, rounded

_ASM = """asm AS (SELECT t.*, CAST(t.prediction_datetime AS DATE) AS date, c.eic_count, c.installed_capacity
  FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business
   AND t.product_type = c.product_type AND CAST(t.prediction_datetime AS DATE) = c.date)"""


def _asm(spark, sf_dir):
    p = load_panel(spark, sf_dir)
    return assemble_client(p.target, p.client, "train")


@query("g1_max_per_unit", "SELECT prediction_unit_id, max(target) AS max_value FROM tgt GROUP BY 1", ("tgt",))
def g1_max_unit(spark, sf_dir):
    return N.group_max(load_panel(spark, sf_dir).target)


@query("g1_max_per_unit_direction", """
SELECT prediction_unit_id, is_consumption, max(target) AS max_value FROM tgt GROUP BY 1, 2""", ("tgt",))
def g1_max_unit_dir(spark, sf_dir):
    return N.group_max(load_panel(spark, sf_dir).target, ("prediction_unit_id", "is_consumption"))


@query("j11_group_max_joined", """
SELECT row_id, prediction_unit_id, is_consumption, target,
       max(target) OVER (PARTITION BY prediction_unit_id, is_consumption) AS max_target FROM tgt""", ("tgt",))
def j11_group_max(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.select("row_id", "prediction_unit_id", "is_consumption", "target")
    return N.with_group_stat(t, ("prediction_unit_id", "is_consumption"), "target", "max")


_F15 = """
WITH mv AS (SELECT prediction_unit_id, max(target) AS max_value FROM tgt WHERE data_block_id < {split} GROUP BY 1)
SELECT t.row_id, t.prediction_unit_id,
       round(t.target / nullif({m}, 0), 6) AS target
FROM tgt t LEFT JOIN mv m ON t.prediction_unit_id = m.prediction_unit_id WHERE t.data_block_id >= {split}"""


def _f15(spark, sf_dir, fill_unseen):
    t = load_panel(spark, sf_dir).target
    at = split_block(t)
    mv = N.group_max(t.filter(F.col("data_block_id") < at))
    s = t.filter(F.col("data_block_id") >= at).select("row_id", "prediction_unit_id", "target")
    return rounded(N.apply_unit_max(s, mv, fill_unseen=fill_unseen))


@query("f15_unit_max_normalise",
       _F15.format(split=SPLIT.format("tgt"), m="coalesce(CASE WHEN isnan(m.max_value) THEN 1.0 ELSE m.max_value END, 1.0)"), ("tgt",))
def f15_normalise(spark, sf_dir):
    return _f15(spark, sf_dir, True)


@query("f15_unit_max_normalise_parity",
       _F15.format(split=SPLIT.format("tgt"), m="CASE WHEN isnan(m.max_value) THEN 1.0 ELSE m.max_value END"), ("tgt",))
def f15_normalise_parity(spark, sf_dir):
    return _f15(spark, sf_dir, False)


@query("f15_unit_max_roundtrip", "SELECT row_id, round(target, 6) AS target FROM tgt", ("tgt",))
def f15_roundtrip(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.select("row_id", "prediction_unit_id", "target")
    mv = N.group_max(t)
    back = N.invert_unit_max(N.apply_unit_max(t, mv), mv)
    return rounded(back.select("row_id", "target"))


@query("f12_log_transforms", """
SELECT row_id, round(ln(1 + target), 6) AS target_log, round(exp(ln(1 + target)) - 1, 6) AS target_back FROM tgt""",
       ("tgt",))
def f12_log(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    return rounded(t.select("row_id", F.log1p("target").alias("target_log"),
                            F.expm1(F.log1p("target")).alias("target_back")))


@query("f13_f16_segment_double_log", """
SELECT row_id, round(target / nullif(segment_mean, 0), 6) AS ratio,
       round(ln(1 + ln(1 + target / nullif(segment_mean, 0))), 6) AS target_dlog
FROM (SELECT row_id, target, avg(target) OVER (PARTITION BY is_business, product_type) AS segment_mean FROM tgt) x""",
       ("tgt",))
def f13_double_log(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    out = N.segment_mean_double_log(t)
    return rounded(out.select("row_id", F.try_divide(F.col("target"), F.col("segment_mean")).alias("ratio"),
                              "target_dlog"))


@query("f14_p14_capacity_roundtrip", f"""
WITH {_ASM}
SELECT row_id, round(target / nullif(installed_capacity, 0), 6) AS target_norm,
       round(target / nullif(installed_capacity, 0) * installed_capacity, 6) AS prediction,
       round(target, 6) AS target_inference FROM asm""", ("tgt", "cli"))
def f14_capacity(spark, sf_dir):
    a = _asm(spark, sf_dir)
    # the inference form passes the target through: kept beside the normalised one
    kept = N.normalise_by_capacity(a, "inference").withColumn("target_inference", F.col("target"))
    train = N.normalise_by_capacity(kept, "train").withColumn("target_norm", F.col("target"))
    back = N.denormalise_by_capacity(train.withColumn("prediction", F.col("target_norm")))
    return rounded(back.select("row_id", "target_norm", "prediction", "target_inference"))


@query("f16_eic_normalise", f"""
WITH {_ASM}
SELECT row_id, round(target / nullif(eic_count, 0), 6) AS target FROM asm""", ("tgt", "cli"))
def f16_eic(spark, sf_dir):
    return rounded(N.normalise_by_eic(_asm(spark, sf_dir)).select("row_id", "target"))


@query("f17_j12_persistence_errors", """
SELECT t.row_id, h.target AS prediction, t.target AS target_true, h.target - t.target AS error,
       round((h.target - t.target) * (h.target - t.target), 6) AS sq_error,
       round((h.target - t.target) / nullif(t.target + 1, 0), 6) AS frac_error
FROM tgt t JOIN tgt h ON h.prediction_unit_id = t.prediction_unit_id AND h.is_consumption = t.is_consumption
 AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY""", ("tgt",))
def f17_errors(spark, sf_dir):
    t = load_panel(spark, sf_dir).target
    pred = add_lag_inner(t.select(*PANEL_KEY, "row_id"), t.select(*PANEL_KEY, "target"), "target", 2) \
        .select("row_id", F.col("target_2d_ago").alias("prediction"))
    truth = t.select("row_id", F.col("target").alias("target_true"))
    j = pred.join(truth, "row_id", "inner")
    out = j.select("row_id", "prediction", "target_true", *error_columns("prediction", "target_true"))
    return rounded(out, cols=["sq_error", "frac_error"])


@query("f21_in_place_transforms", f"""
WITH {_ASM}
SELECT row_id, round(ln(1 + target), 6) AS target, round(ln(1 + installed_capacity), 6) AS installed_capacity,
       round(exp(ln(1 + target)) - 1, 6) AS target_back FROM asm""", ("tgt", "cli"))
def f21_in_place(spark, sf_dir):
    a = _asm(spark, sf_dir).select("row_id", "target", "installed_capacity")
    fw = forward(a, ["target", "installed_capacity"]).withColumn("target_back", F.col("target"))
    return rounded(inverse(fw, ["target_back"]))


@query("g16_centre_by_unit", """
SELECT row_id, round(target - avg(target) OVER (PARTITION BY prediction_unit_id), 6) AS target_centred FROM tgt""",
       ("tgt",))
def g16_centre(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.select("row_id", "prediction_unit_id", "target")
    return rounded(N.centre_by_group(t, ["prediction_unit_id"], "target").select("row_id", "target_centred"))
