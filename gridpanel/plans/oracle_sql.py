"""SQL text for oracle checks that need more than a fixture CTE."""
from __future__ import annotations

_HELPERS = ["_u", "_jc", "_mins", "_l0", "_m", "_e", "_om", "_c", "_ob", "_app", "_y", "_decl",
            "_eqt", "_tst", "_ha", "_zen", "_el", "_azc", "_te", "_azb"]


def solar_select(src: str, ts_local: str, lat: str, lon: str, zone: str = "Europe/Tallinn") -> str:
    """DuckDB SQL adding ``solar_azimuth``/``solar_elevation`` to relation ``src``,
    the same NOAA equations as ``functions.solar`` in layered projections."""
    layers = [
        f"timezone('UTC', timezone('{zone}', {ts_local})) AS _u",
        "((CAST(_u AS DATE) - DATE '1970-01-01') + (hour(_u) * 3600 + minute(_u) * 60 + second(_u)) / 86400.0 "
        "+ 2440587.5 - 2451545.0) / 36525.0 AS _jc, (hour(_u) * 60 + minute(_u) + second(_u) / 60.0) AS _mins",
        "(((280.46646 + _jc * (36000.76983 + _jc * 0.0003032)) % 360) + 360) % 360 AS _l0, "
        "357.52911 + _jc * (35999.05029 - 0.0001537 * _jc) AS _m, "
        "0.016708634 - _jc * (0.000042037 + 0.0000001267 * _jc) AS _e, 125.04 - 1934.136 * _jc AS _om",
        "sin(radians(_m)) * (1.914602 - _jc * (0.004817 + 0.000014 * _jc)) + sin(radians(2 * _m)) "
        "* (0.019993 - 0.000101 * _jc) + sin(radians(3 * _m)) * 0.000289 AS _c, "
        "(23 + (26 + (21.448 - _jc * (46.815 + _jc * (0.00059 - _jc * 0.001813))) / 60) / 60) "
        "+ 0.00256 * cos(radians(_om)) AS _ob",
        "(_l0 + _c) - 0.00569 - 0.00478 * sin(radians(_om)) AS _app, pow(tan(radians(_ob / 2)), 2) AS _y",
        "asin(sin(radians(_ob)) * sin(radians(_app))) AS _decl, "
        "4 * degrees(_y * sin(2 * radians(_l0)) - 2 * _e * sin(radians(_m)) "
        "+ 4 * _e * _y * sin(radians(_m)) * cos(2 * radians(_l0)) - 0.5 * _y * _y * sin(4 * radians(_l0)) "
        "- 1.25 * _e * _e * sin(2 * radians(_m))) AS _eqt",
        f"((((_mins + _eqt + 4 * {lon}) % 1440.0) + 1440.0) % 1440.0) AS _tst",
        "CASE WHEN _tst / 4 < 0 THEN _tst / 4 + 180 ELSE _tst / 4 - 180 END AS _ha",
        f"acos(greatest(-1.0, least(1.0, sin(radians({lat})) * sin(_decl) + cos(radians({lat})) * cos(_decl) "
        "* cos(radians(_ha))))) AS _zen",
        f"90 - degrees(_zen) AS _el, (sin(radians({lat})) * cos(_zen) - sin(_decl)) "
        f"/ (cos(radians({lat})) * sin(_zen)) AS _azc",
        "tan(radians(_el)) AS _te, degrees(acos(greatest(-1.0, least(1.0, _azc)))) AS _azb",
        "CASE WHEN _ha > 0 THEN (((_azb + 180) % 360) + 360) % 360 ELSE (((540 - _azb) % 360) + 360) % 360 END "
        "AS solar_azimuth, _el + (CASE WHEN _el > 85 THEN 0.0 WHEN _el > 5 THEN 58.1 / _te - 0.07 / pow(_te, 3) "
        "+ 0.000086 / pow(_te, 5) WHEN _el > -0.575 THEN 1735 + _el * (-518.2 + _el * (103.4 + _el * "
        "(-12.79 + _el * 0.711))) ELSE -20.772 / _te END) / 3600.0 AS solar_elevation",
    ]
    sql = f"SELECT * FROM {src}"
    for i, layer in enumerate(layers):
        sql = f"SELECT *, {layer} FROM ({sql}) _l{i}"
    return f"SELECT * EXCLUDE ({', '.join(_HELPERS)}) FROM ({sql}) _solar"
