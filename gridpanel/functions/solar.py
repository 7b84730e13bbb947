"""Solar position as column expressions.

Uses the published NOAA solar-position equations (Meeus-based spreadsheet
form) on a UTC instant, with the refraction correction. Intermediate terms
are computed in successive projections: each is referenced several times,
so Catalyst keeps them as separate (codegen-fused) steps instead of
expanding one exponentially large expression tree.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

R, D = F.radians, F.degrees


def _lit(v):
    return F.lit(float(v)) if isinstance(v, (int, float)) else (F.col(v) if isinstance(v, str) else v)


def with_solar_position(df: DataFrame, utc_ts: str, lat, lon,
                        azimuth: str = "solar_azimuth", elevation: str = "solar_elevation") -> DataFrame:
    """Add azimuth and elevation (degrees) for the naive-UTC timestamp column ``utc_ts``."""
    c = F.col
    t = c(utc_ts)
    layers = [
        # epoch days from NTZ arithmetic only (no session time zone involved)
        {"_lat": _lit(lat), "_lon": _lit(lon),
         "_jc": (F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date"))
                 + (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)) / 86400.0
                 + 2440587.5 - 2451545.0) / 36525.0,
         "_mins": F.hour(t) * 60 + F.minute(t) + F.second(t) / 60.0},
        {"_l0": F.pmod(280.46646 + c("_jc") * (36000.76983 + c("_jc") * 0.0003032), F.lit(360.0)),
         "_m": 357.52911 + c("_jc") * (35999.05029 - 0.0001537 * c("_jc")),
         "_e": 0.016708634 - c("_jc") * (0.000042037 + 0.0000001267 * c("_jc")),
         "_om": 125.04 - 1934.136 * c("_jc")},
        {"_c": (F.sin(R(c("_m"))) * (1.914602 - c("_jc") * (0.004817 + 0.000014 * c("_jc")))
                + F.sin(R(2 * c("_m"))) * (0.019993 - 0.000101 * c("_jc"))
                + F.sin(R(3 * c("_m"))) * 0.000289),
         "_ob": (23 + (26 + (21.448 - c("_jc") * (46.815 + c("_jc") * (0.00059 - c("_jc") * 0.001813))) / 60) / 60)
                + 0.00256 * F.cos(R(c("_om")))},
        {"_app": (c("_l0") + c("_c")) - 0.00569 - 0.00478 * F.sin(R(c("_om"))),
         "_y": F.pow(F.tan(R(c("_ob") / 2)), 2)},
        {"_decl": F.asin(F.sin(R(c("_ob"))) * F.sin(R(c("_app")))),
         "_eqt": 4 * D(c("_y") * F.sin(2 * R(c("_l0"))) - 2 * c("_e") * F.sin(R(c("_m")))
                       + 4 * c("_e") * c("_y") * F.sin(R(c("_m"))) * F.cos(2 * R(c("_l0")))
                       - 0.5 * c("_y") * c("_y") * F.sin(4 * R(c("_l0")))
                       - 1.25 * c("_e") * c("_e") * F.sin(2 * R(c("_m"))))},
        {"_tst": F.pmod(c("_mins") + c("_eqt") + 4 * c("_lon"), F.lit(1440.0))},
        {"_ha": F.when(c("_tst") / 4 < 0, c("_tst") / 4 + 180).otherwise(c("_tst") / 4 - 180)},
        {"_zen": F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0),
                  F.sin(R(c("_lat"))) * F.sin(c("_decl"))
                  + F.cos(R(c("_lat"))) * F.cos(c("_decl")) * F.cos(R(c("_ha"))))))},
        {"_el": 90 - D(c("_zen")),
         "_azc": (F.sin(R(c("_lat"))) * F.cos(c("_zen")) - F.sin(c("_decl")))
                 / (F.cos(R(c("_lat"))) * F.sin(c("_zen")))},
        {"_te": F.tan(R(c("_el"))),
         "_azb": D(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c("_azc")))))},
        {azimuth: F.when(c("_ha") > 0, F.pmod(c("_azb") + 180, F.lit(360.0)))
                   .otherwise(F.pmod(540 - c("_azb"), F.lit(360.0))),
         elevation: c("_el") + (F.when(c("_el") > 85, 0.0)
                                .when(c("_el") > 5, 58.1 / c("_te") - 0.07 / F.pow(c("_te"), 3)
                                      + 0.000086 / F.pow(c("_te"), 5))
                                .when(c("_el") > -0.575, 1735 + c("_el") * (-518.2 + c("_el") * (
                                    103.4 + c("_el") * (-12.79 + c("_el") * 0.711))))
                                .otherwise(-20.772 / c("_te"))) / 3600.0},
    ]
    out = df
    helpers = []
    for layer in layers:
        out = out.withColumns(layer)
        helpers += [k for k in layer if k.startswith("_")]
    return out.drop(*helpers)
