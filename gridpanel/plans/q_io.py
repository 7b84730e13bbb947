"""Queries: scans, sinks and streams over data derived from the tables (S1, S3, S5, S6, T2, T3, T5), and P7, P9, P12, F20."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.numeric import flags_as_int
from ..operators.assemble import unit_slice
from ..operators.normalise import fill_nan
from ..schemas import PANEL_KEY
from ..session import ensure_checkpoint_dir
from ..sources import sinks
from ..sources.tables import clean_target, load_tables, read_csv, read_csv_checked
from ..streaming import blocks as S
from .backtest import with_reveal_block
from .fixtures import SPLIT, load_panel, raw_client, raw_target, split_block
from .registry import query, rounded


def _folder(spark, name: str) -> str:
    """A fresh folder where all executors can write and read."""
    master = spark.sparkContext.master or ""
    return f"{ensure_checkpoint_dir(spark, allow_local=master.startswith('local')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("s1_s3_csv_scan", """
SELECT row_id, prediction_unit_id, is_consumption, prediction_datetime, data_block_id, date_when_predicting, target FROM tgt""", ("tgt",))
def s1_csv(spark, sf_dir):
    """The raw target written as CSV text, scanned with its declared schema, strings parsed, cleaned."""
    path = _folder(spark, "csv")
    raw = raw_target(spark, sf_dir)
    raw.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).write.option("header", True).csv(path)
    return clean_target(read_csv(spark, path, "target")).select(
        "row_id", "prediction_unit_id", "is_consumption", "prediction_datetime", "data_block_id", "date_when_predicting", "target")


@query("s1_s3_quarantine", """
SELECT row_id, CASE WHEN row_id % 19 = 0 OR row_id % 23 = 0 THEN 'columns' ELSE
         concat_ws('+', CASE WHEN row_id % 17 = 0 THEN 'datetime' END, CASE WHEN row_id % 13 = 0 THEN 'target' END) END AS reasons,
       CASE WHEN row_id % 19 <> 0 AND row_id % 23 <> 0 AND row_id % 17 <> 0 AND row_id % 13 <> 0 AND row_id % 29 <> 0 THEN target END AS target
FROM tgt""", ("tgt",))
def s1_quarantine(spark, sf_dir):
    """The raw target as CSV text with short and long lines, bad dates and bad numbers: every line is good (reasons
    empty; an empty number is null) or quarantined."""
    path, raw = _folder(spark, "csv-lines"), raw_target(spark, sf_dir)
    n = F.col("row_id")
    when = F.when(n % 17 == 0, "2024-13-45 00:00:00").otherwise(F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    value = F.when(n % 13 == 0, "n/a").when(n % 29 == 0, "").otherwise(F.col("target").cast("string"))
    front = [c for c in raw.columns if c not in ("datetime", "data_block_id", "target")]
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in front], when, F.col("data_block_id").cast("string"),
                       F.when(n % 19 != 0, value))              # concat_ws leaves a null out: a short line
    raw.select(F.concat(line, F.when((n % 19 != 0) & (n % 23 == 0), ",more").otherwise("")).alias("value")).write.text(path)
    good, bad = read_csv_checked(spark, path, "target", header=False)
    return good.select("row_id", F.lit("").alias("reasons"), "target").unionAll(
        bad.select(F.split("line", ",")[0].cast("bigint"), F.array_join("reasons", "+"), F.lit(None).cast("double")))


@query("s2_load_and_assemble", """
SELECT t.row_id, t.is_consumption, t.target, c.eic_count, c.installed_capacity, 'train' AS part
FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type
  AND CAST(t.prediction_datetime AS DATE) = c.date
UNION ALL
SELECT t.row_id, t.is_consumption, NULL, c.eic_count, c.installed_capacity, 'scoring'
FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type
  AND t.date_when_predicting = c.date""", ("tgt", "cli"))
def s2_load(spark, sf_dir):
    """All tables by their rules, assembled and split by direction, in both modes."""
    raw = raw_target(spark, sf_dir)
    t = load_tables({"target": raw, "test": raw.drop("target"), "client": raw_client(spark, sf_dir)}, assemble=True)
    parts = [t[f"{name}_{side}"].select("row_id", "is_consumption", (F.col("target") if name == "train" else F.lit(None).cast("double")).alias("target"),
                                        "eic_count", "installed_capacity", F.lit(name).alias("part"))
             for name in ("train", "scoring") for side in ("production", "consumption")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@query("s5_s6_write_and_read_back", """
SELECT row_id, data_block_id, target, 'table' AS sink FROM tgt
UNION ALL SELECT row_id, NULL, target, 'submission' FROM tgt""", ("tgt",))
def s5_sinks(spark, sf_dir):
    """Partitioned table sink and a submission appended in two parts, both read back."""
    t = load_panel(spark, sf_dir).target.select("row_id", "data_block_id", "target")
    table, submission = _folder(spark, "table"), _folder(spark, "submission")
    sinks.write_table(t, table, partition_by="data_block_id")
    at = split_block(t)
    sinks.append_submission(t.filter(F.col("data_block_id") < at), submission)
    sinks.append_submission(t.filter(F.col("data_block_id") >= at), submission)
    stored = spark.read.parquet(table).select("row_id", F.col("data_block_id").cast("long").alias("data_block_id"), "target", F.lit("table").alias("sink"))
    sent = spark.read.schema("row_id long, target double").option("header", True).csv(submission)
    return stored.unionAll(sent.select("row_id", F.lit(None).cast("long"), "target", F.lit("submission")))


def _as_files(df, path: str) -> None:
    df.write.partitionBy("data_block_id").parquet(path)


@query("t2_block_stream", f"""
SELECT t.row_id, t.data_block_id, CASE WHEN h.data_block_id + 2 <= t.data_block_id THEN h.target ELSE 0.0 END AS prediction
FROM tgt t LEFT JOIN tgt h ON h.prediction_unit_id = t.prediction_unit_id AND h.is_consumption = t.is_consumption
  AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY
WHERE t.data_block_id >= {SPLIT.format('tgt')}""", ("tgt",))
def t2_stream(spark, sf_dir):
    """The block replay as a file stream, truth revealed two blocks later."""
    t = load_panel(spark, sf_dir).target
    rows, revealed, history, out = (_folder(spark, f"stream-{x}") for x in ("rows", "revealed", "history", "out"))
    columns = ["row_id", *PANEL_KEY, "data_block_id"]
    _as_files(t.filter(F.col("data_block_id") >= split_block(t)).select(*columns), rows)
    _as_files(with_reveal_block(t).select(*PANEL_KEY, "target", F.col("revealed_block").alias("data_block_id")), revealed)
    S.run_block_stream(spark, rows, revealed, t.select(*columns).schema, t.select(*PANEL_KEY, "target", "data_block_id").schema,
                       history, out, _folder(spark, "stream-checkpoint"), files_per_trigger=6)
    return spark.read.parquet(out).select("row_id", "data_block_id", "prediction")


@query("t3_stream_lag_join", """
SELECT t.row_id, h.target AS target_2d_ago FROM tgt t JOIN tgt h ON h.prediction_unit_id = t.prediction_unit_id
  AND h.is_consumption = t.is_consumption AND h.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY""", ("tgt",))
def t3_stream(spark, sf_dir):
    """Stream-stream join on the exact lagged hour; the matched rows (rows without a lag follow the watermark)."""
    t = load_panel(spark, sf_dir).target.select("row_id", *PANEL_KEY, "target")
    src, out = _folder(spark, "lag-rows"), _folder(spark, "lag-out")
    t.write.parquet(src)
    read = lambda: spark.readStream.schema(t.schema).parquet(src)                             # noqa: E731
    # an event time far behind any hour of the data: no row is late
    joined = S.stream_lag_join(read().drop("target"), read().drop("row_id"), 2, watermark="36500 days")
    q = (joined.select("row_id", "target_2d_ago").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", _folder(spark, "lag-checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("row_id long, target_2d_ago double").parquet(out).filter("target_2d_ago is not null")


@query("t5_stream_static", """
SELECT t.row_id, c.eic_count, c.installed_capacity FROM tgt t LEFT JOIN cli c ON t.county = c.county
  AND t.is_business = c.is_business AND t.product_type = c.product_type AND t.date_when_predicting = c.date""", ("tgt", "cli"))
def t5_stream(spark, sf_dir):
    """Streamed rows with the client facts of a static table."""
    p = load_panel(spark, sf_dir)
    keys = ["county", "is_business", "product_type", "date"]
    t = p.target.select("row_id", *keys[:3], F.col("date_when_predicting").alias("date"))
    src, out = _folder(spark, "static-rows"), _folder(spark, "static-out")
    t.write.parquet(src)
    joined = S.enrich_stream(spark.readStream.schema(t.schema).parquet(src), p.client.select(*keys, "eic_count", "installed_capacity"), keys)
    q = (joined.select("row_id", "eic_count", "installed_capacity").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", _folder(spark, "static-checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("row_id long, eic_count long, installed_capacity double").parquet(out)


@query("p7_drop_null_rows", """
SELECT row_id, prediction_datetime, target FROM tgt WHERE row_id % 7 <> 0 AND row_id % 11 <> 0""", ("tgt",))
def p7_drop_nulls(spark, sf_dir):
    """Every seventh target null, every eleventh NaN: both go."""
    holes = F.when(F.col("row_id") % 7 == 0, None).when(F.col("row_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("target"))
    return clean_target(raw_target(spark, sf_dir).withColumn("target", holes)).select("row_id", "prediction_datetime", "target")


@query("p9_nan_to_one", """
SELECT row_id, CASE WHEN row_id % 7 = 0 THEN NULL WHEN row_id % 11 = 0 THEN 1.0 ELSE target END AS target FROM tgt""", ("tgt",))
def p9_nan(spark, sf_dir):
    """NaN becomes 1.0, null stays null."""
    holes = F.when(F.col("row_id") % 7 == 0, None).when(F.col("row_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("target"))
    return fill_nan(load_panel(spark, sf_dir).target.select("row_id", holes.alias("target")), ["target"])


@query("p12_unit_slice", """
SELECT row_id, prediction_datetime, target FROM dtgt WHERE prediction_unit_id = (SELECT max(prediction_unit_id) FROM dtgt)""", ("dtgt",))
def p12_slice(spark, sf_dir):
    t = load_panel(spark, sf_dir).dense_target
    return unit_slice(t, t.select(F.max("prediction_unit_id")).scalar()).select("row_id", "prediction_datetime", "target")


@query("f20_flags_as_int", """
SELECT row_id, CAST(is_business AS INTEGER) AS is_business, CAST(is_consumption AS INTEGER) AS is_consumption FROM tgt""", ("tgt",))
def f20_flags(spark, sf_dir):
    t = load_panel(spark, sf_dir).target.select("row_id", "is_business", "is_consumption")
    return flags_as_int(t, ["is_business", "is_consumption"])
