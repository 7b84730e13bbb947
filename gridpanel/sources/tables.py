"""Loading and per-table cleaning.

One ``clean_<table>(df) -> df`` per input: a single projection with casts,
so Catalyst prunes and pushes filters through it to the scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.calendar import shift
from ..functions.numeric import scaled_coord

_LINE = "_line"


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """CSV scan with header and a declared schema (no inference)."""
    return (spark.read.schema(schemas.RAW_SCHEMAS[table]).option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def read_csv_checked(spark: SparkSession, path: str, table: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1/S3 with quarantine: ``(good, quarantined)``, together every line read.

    Lines are scanned as text fields first. ``quarantined`` holds ``line`` (as
    read), ``reasons`` and the fields as text, for lines with too few or too
    many fields (reason ``columns``) and for fields that are there but do not
    parse as their declared type (reason: the field's name). ``good`` has the
    declared types; an empty field is null, not malformed. Nothing is collected
    and no line is lost: write ``quarantined`` beside the table and look at it."""
    schema = schemas.RAW_SCHEMAS[table]
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_LINE, T.StringType())])
    lines = (spark.read.schema(text).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
             .option("columnPruning", False).option("enforceSchema", True).csv(path))
    fields = [f.name for f in schema.fields]

    def bad(f):
        parsed = F.col(f.name).try_cast(f.dataType)
        if isinstance(f.dataType, T.StringType):
            return F.lit(False)
        return F.col(f.name).isNotNull() & parsed.isNull()

    reasons = F.when(F.col(_LINE).isNotNull(), F.array(F.lit("columns"))).otherwise(
        F.array_compact(F.array(*[F.when(bad(f), F.lit(f.name)) for f in schema.fields])))
    checked = lines.withColumn("reasons", reasons)
    good = checked.filter(F.size("reasons") == 0).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
    as_read = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*fields)))
    return good, checked.filter(F.size("reasons") > 0).select(as_read.alias("line"), "reasons", *fields)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def drop_null_rows(df: DataFrame, cols=None, nan_as_null: bool = False) -> DataFrame:
    """Drop rows where any listed column is null.

    NaN is kept unless ``nan_as_null`` (``na.drop`` would treat NaN as null).
    """
    cols = cols or df.columns
    types = dict(df.dtypes)
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull()
        if nan_as_null and types[c] in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = ok if cond is None else cond & ok
    return df.filter(cond) if cond is not None else df


def fill_numeric_nulls(df: DataFrame, value=0, cols=None) -> DataFrame:
    """Numeric nulls -> value; NaN left alone (``na.fill`` would replace it)."""
    numeric = {"double", "float", "int", "bigint", "smallint", "tinyint"}
    cols = cols or [c for c, t in df.dtypes if t in numeric or t.startswith("decimal")]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(dict(df.dtypes)[c]))
                           for c in cols})


def exclude_offshore(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                     pairs=schemas.OFFSHORE_STATIONS) -> DataFrame:
    """P5: keep a row unless its (lat, lon) is one of the excluded pairs."""
    cond = None
    for a, b in pairs:
        keep = (F.col(lat) != F.lit(a)) | (F.col(lon) != F.lit(b))
        cond = keep if cond is None else cond & keep
    return df.filter(cond)


def clean_target(df: DataFrame, drop_missing: bool = True) -> DataFrame:
    """S2/S3 for train/test/revealed targets: typed keys, ``prediction_datetime``,
    ``date_when_predicting`` = date - 2 days. Rows with a missing value are dropped
    (pandas ``dropna`` semantics: null or NaN)."""
    casts = {"row_id": "bigint", "prediction_unit_id": "int", "county": "int",
             "is_business": "boolean", "product_type": "int", "is_consumption": "boolean",
             "data_block_id": "bigint"}
    out = df.withColumnsRenamed({"datetime": "prediction_datetime"}) \
        .withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns})
    out = out.withColumn("prediction_datetime", F.col("prediction_datetime").cast("timestamp_ntz"))
    if drop_missing:
        out = drop_null_rows(out, nan_as_null=True)
    return out.withColumn("date_when_predicting",
                          F.date_sub(F.to_date("prediction_datetime"), 2))


def clean_client(df: DataFrame) -> DataFrame:
    return df.withColumns({"county": F.col("county").cast("int"),
                           "is_business": F.col("is_business").cast("boolean"),
                           "product_type": F.col("product_type").cast("int"),
                           "date": F.to_date("date")})


def clean_weather_historical(df: DataFrame, filter_weather: bool = True) -> DataFrame:
    if filter_weather:
        df = exclude_offshore(df)
    return df.withColumns({"latitude": F.round("latitude", 3), "longitude": F.round("longitude", 3),
                           "datetime": F.col("datetime").cast("timestamp_ntz")})


def clean_weather_forecast(df: DataFrame, filter_weather: bool = True) -> DataFrame:
    """Round, drop offshore stations, then scale coordinates to integer keys."""
    df = df.withColumns({"latitude": F.round("latitude", 3), "longitude": F.round("longitude", 3)})
    if filter_weather:
        df = exclude_offshore(df)
    return df.withColumns({"latitude": scaled_coord("latitude"),
                           "longitude": scaled_coord("longitude")})


def clean_electricity(df: DataFrame) -> DataFrame:
    """Hourly price keyed by ``forecast_datetime``, plus ``origin_date``."""
    return (df.withColumns({"forecast_datetime": F.col("forecast_date").cast("timestamp_ntz"),
                            "origin_datetime": F.col("origin_date").cast("timestamp_ntz")})
            .drop("forecast_date", "origin_date")
            .withColumn("origin_date", F.to_date("origin_datetime")))


def clean_gas(df: DataFrame) -> DataFrame:
    return df.withColumns({"forecast_date": F.to_date("forecast_date"),
                           "origin_date": F.to_date("origin_date")})


def clean_solar(df: DataFrame) -> DataFrame:
    """Solar table; with coordinates present the offshore points are dropped and
    coordinates scaled like the forecast keys (D8)."""
    df = df.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    if "latitude" in df.columns and "longitude" in df.columns:
        df = exclude_offshore(df).withColumns({"latitude": scaled_coord("latitude"),
                                               "longitude": scaled_coord("longitude")})
    return df


def clean_station_map(df: DataFrame) -> DataFrame:
    """Station -> county map: rows with a null dropped, coordinates scaled (J8 keys)."""
    return (drop_null_rows(df.select("latitude", "longitude", F.col("county").cast("int")))
            .withColumns({"latitude": scaled_coord("latitude"),
                          "longitude": scaled_coord("longitude")}))


def clean_test(df: DataFrame) -> DataFrame:
    """Rows to predict: like the target table, without its value."""
    return clean_target(df, drop_missing=False)


CLEANERS = {"target": clean_target, "test": clean_test, "revealed_targets": clean_target, "client": clean_client,
            "weather_historical": clean_weather_historical, "weather_forecast": clean_weather_forecast,
            "electricity_prices": clean_electricity, "gas_prices": clean_gas, "solar": clean_solar,
            "station_to_county": clean_station_map, "sample_submission": lambda df: df}


def load_tables(raw: dict, assemble: bool = False) -> dict:
    """The tables of ``raw`` (name -> frame), each cleaned by its own rule.

    Revealed targets get the client facts of their own day. ``assemble`` adds
    ``train`` (facts of the same day) from ``target`` and ``scoring`` (facts
    known two days earlier) from ``test``, each also split by direction as
    ``<name>_production`` and ``<name>_consumption``. An unknown name is an error."""
    from ..operators.assemble import assemble_client, split_by_direction
    unknown = set(raw) - set(CLEANERS)
    if unknown:
        raise KeyError(f"no rule for {sorted(unknown)}")
    out = {name: CLEANERS[name](df) for name, df in raw.items()}
    if "client" in out:
        if "revealed_targets" in out:
            out["revealed_targets"] = assemble_client(out["revealed_targets"], out["client"], "train")
        if assemble:
            for name, source, mode in (("train", "target", "train"), ("scoring", "test", "inference")):
                if source in out:
                    out[name] = assemble_client(out[source], out["client"], mode)
                    out[f"{name}_production"], out[f"{name}_consumption"] = split_by_direction(out[name])
    return out


def lag_date(ts, days: int = 2):
    """Date known ``days`` before the hour's date (client facts at prediction time)."""
    return F.to_date(shift(ts, days=-days))
