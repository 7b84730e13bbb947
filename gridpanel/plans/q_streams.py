"""Queries: streams with bounded state and the clustered table sink."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.lags import add_lags_clustered
from ..operators.normalise import apply_unit_max, group_max
from ..schemas import PANEL_KEY, SEGMENT_KEY
from ..session import cut_lineage
from ..sources import sinks
from ..streaming import live as L
from . import backtest as B
from .fixtures import BLOCK_EPOCH, SPLIT, load_panel, split_block
from .q_history import _HN, _history_and_new
from .q_io import _folder
from .registry import query

PARTS = 6           # deliveries in which a replayed table arrives


def arrive(df: DataFrame, path: str, block: str = "data_block_id", parts: int = PARTS) -> int:
    """Write ``df`` as files that arrive in order of ``block``, in ``parts`` deliveries; the blocks that one spans.

    A stream that takes files in their order then sees no row further behind the newest one than that span."""
    held = cut_lineage(df)
    low, high = held.agg(F.min(block), F.max(block)).first()
    if low is None:
        held.write.mode("append").parquet(path)
        return 0
    span = (high - low) // parts + 1
    for start in range(low, high + 1, span):
        held.filter((F.col(block) >= start) & (F.col(block) < start + span)).write.mode("append").parquet(path)
    return span


def run(stream: DataFrame, spark, out: str) -> None:
    """A stream over everything there is, into Parquet files."""
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", _folder(spark, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def source(spark, path: str, schema) -> DataFrame:
    """The files of a folder as a stream of about ``PARTS`` micro-batches."""
    files = len(spark.read.schema(schema).parquet(path).inputFiles())
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max(1, files // PARTS)).parquet(path)


NOBODY = {"prediction_unit_id": -1, "is_consumption": False}      # the unit of closing rows


@query("t3_live_lags", """
SELECT t.row_id, CAST(d.days AS INTEGER) AS lag_days, h.target AS target_ago
FROM tgt t CROSS JOIN (VALUES (2), (7)) d(days) LEFT JOIN tgt h ON h.prediction_unit_id = t.prediction_unit_id
  AND h.is_consumption = t.is_consumption AND h.prediction_datetime = t.prediction_datetime - to_days(CAST(d.days AS INTEGER))""", ("tgt",))
def t3_live_lags(spark, sf_dir):
    """Every row with its lags of two and seven days, nulls too, from two streams under a real watermark."""
    t = load_panel(spark, sf_dir).target.select("row_id", *PANEL_KEY, "target", "data_block_id")
    rows, truth, out = (_folder(spark, f"live-{x}") for x in ("rows", "truth", "out"))
    asked, told = t.drop("target"), t.drop("row_id")
    span = arrive(asked, rows)
    arrive(told, truth)
    for df, path in ((asked, rows), (told, truth)):
        L.closing_row(df, "prediction_datetime", 30 + span, **NOBODY).write.mode("append").parquet(path)
    joined = L.stream_lags(source(spark, rows, asked.schema), source(spark, truth, told.schema), (2, 7), delay=f"{span} days")
    run(joined.select("row_id", "lag_days", "target_ago"), spark, out)
    return spark.read.schema("row_id long, lag_days int, target_ago double").parquet(out).filter("row_id is not null")


@query("t2_stateful_stream", f"""
SELECT t.row_id, t.data_block_id, CASE WHEN h2.data_block_id + 2 <= t.data_block_id THEN h2.target END AS target_2d_ago,
       CASE WHEN h7.data_block_id + 2 <= t.data_block_id THEN h7.target END AS target_7d_ago
FROM tgt t
LEFT JOIN tgt h2 ON h2.prediction_unit_id = t.prediction_unit_id AND h2.is_consumption = t.is_consumption
  AND h2.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY
LEFT JOIN tgt h7 ON h7.prediction_unit_id = t.prediction_unit_id AND h7.is_consumption = t.is_consumption
  AND h7.prediction_datetime = t.prediction_datetime - INTERVAL 7 DAY
WHERE t.data_block_id >= {SPLIT.format('tgt')}""", ("tgt",))
def t2_stateful(spark, sf_dir):
    """The block replay with the last week's hours in the state store; truth revealed two blocks later."""
    t = load_panel(spark, sf_dir).target
    epoch = F.unix_date(F.lit(BLOCK_EPOCH).cast("date")).cast("long")
    asked = t.filter(F.col("data_block_id") >= split_block(t)).select("row_id", *PANEL_KEY, (F.col("data_block_id") + epoch).alias("block"))
    told = B.with_reveal_block(t).select(*PANEL_KEY, "target", (F.col("revealed_block") + epoch).alias("block"))
    rows, truth, out = (_folder(spark, f"ring-{x}") for x in ("rows", "truth", "out"))
    span = arrive(told, truth, "block")
    span = max(span, arrive(asked, rows, "block"))
    for df, path in ((asked, rows), (told, truth)):
        last = L.closing_row(df.withColumn("_day", F.date_from_unix_date(F.col("block").cast("int")).cast("timestamp_ntz")), "_day", 30 + span, **NOBODY)
        last.withColumn("block", F.unix_date(F.to_date("_day")).cast("long")).drop("_day").write.mode("append").parquet(path)
    lagged = L.stream_block_lags(source(spark, rows, asked.schema), source(spark, truth, told.schema), (2, 7), f"{span} days",
                                 buckets=L.buckets_for(sum(spark.read.parquet(p).count() for p in (rows, truth))))
    with L.rocksdb_state(spark):
        run(lagged, spark, out)
    found = spark.read.schema(lagged.schema).parquet(out).filter("row_id is not null")
    return found.select("row_id", (F.col("block") - epoch).alias("data_block_id"), "target_2d_ago", "target_7d_ago")


# deliveries of the new rows: five blocks each; every row comes again with the next one
_NEW = f"data_block_id >= {SPLIT.format('tgt')} - 3"
_DELIVERED = f"""{_HN},
d AS (SELECT prediction_unit_id, is_consumption, prediction_datetime, target,
             (data_block_id - (SELECT min(data_block_id) FROM tgt WHERE {_NEW})) // 5 AS arrival
      FROM tgt WHERE {_NEW})"""


def _deliveries(spark, sf_dir):
    """History, and the new rows with the number of their delivery; every delivery repeats the one before it."""
    history, new = _history_and_new(spark, sf_dir)
    low = new.select(F.min("data_block_id")).scalar()
    first = new.select(*PANEL_KEY, "target", F.expr("data_block_id").alias("_b")).withColumn("arrival", F.floor((F.col("_b") - low) / 5)).drop("_b")
    return history.select(*PANEL_KEY, "target"), first.unionByName(first.withColumn("arrival", F.col("arrival") + 1))


@query("t1_stream_global_mark", f"""
WITH {_DELIVERED},
m AS (SELECT a.arrival, greatest((SELECT max(prediction_datetime) FROM h), max(d.prediction_datetime)) AS mark
      FROM (SELECT DISTINCT arrival FROM d) a LEFT JOIN d ON d.arrival < a.arrival GROUP BY 1)
SELECT * FROM h
UNION SELECT prediction_unit_id, is_consumption, prediction_datetime, target FROM d JOIN m USING (arrival) WHERE prediction_datetime > mark""",
       ("tgt",))
def t1_stream(spark, sf_dir):
    """History and what the stream adds under the global mark; replays and late units' rows bring nothing."""
    history, new = _deliveries(spark, sf_dir)
    src, out = _folder(spark, "deliveries"), _folder(spark, "history")
    arrive(new, src, "arrival")
    L.run_history_stream(source(spark, src, new.schema), history, out, _folder(spark, "checkpoint"))
    return history.distinct().unionByName(spark.read.schema(history.schema).parquet(f"{out}/rows").select(*history.columns))


@query("t1_stream_series_marks", f"""
WITH {_DELIVERED},
s AS (SELECT prediction_unit_id, is_consumption, max(prediction_datetime) AS mark FROM h GROUP BY 1, 2),
m AS (SELECT a.prediction_unit_id, a.is_consumption, a.arrival, greatest(max(s.mark), max(d.prediction_datetime)) AS mark
      FROM (SELECT DISTINCT prediction_unit_id, is_consumption, arrival FROM d) a
      LEFT JOIN d ON d.prediction_unit_id = a.prediction_unit_id AND d.is_consumption = a.is_consumption AND d.arrival < a.arrival
      LEFT JOIN s ON s.prediction_unit_id = a.prediction_unit_id AND s.is_consumption = a.is_consumption GROUP BY 1, 2, 3)
SELECT * FROM h
UNION SELECT d.prediction_unit_id, d.is_consumption, d.prediction_datetime, d.target FROM d
JOIN m USING (prediction_unit_id, is_consumption, arrival) WHERE m.mark IS NULL OR d.prediction_datetime > m.mark""", ("tgt",))
def t1_stream_series(spark, sf_dir):
    """The same deliveries, each series with its own mark in the state store."""
    history, new = _deliveries(spark, sf_dir)
    src, out = _folder(spark, "deliveries"), _folder(spark, "history")
    arrive(new, src, "arrival")
    with L.rocksdb_state(spark):
        run(L.stream_new_rows(source(spark, src, new.schema), history, buckets=L.buckets_for(spark.read.parquet(src).count())), spark, out)
    return history.distinct().unionByName(spark.read.schema(history.schema).parquet(out))


@query("t5_versioned_facts", """
SELECT t.row_id, v.eic_count, v.installed_capacity
FROM tgt t ASOF LEFT JOIN cli v ON v.county = t.county AND v.is_business = t.is_business AND v.product_type = t.product_type
  AND t.data_block_id - 2 >= v.data_block_id""", ("tgt", "cli"))
def t5_versioned(spark, sf_dir):
    """Streamed rows with the client facts of the latest version known two blocks before."""
    p = load_panel(spark, sf_dir)
    facts = p.client.select(*SEGMENT_KEY, "eic_count", "installed_capacity", F.col("data_block_id").alias("version_block"))
    rows = p.target.select("row_id", *SEGMENT_KEY, "data_block_id")
    src, versions, out = (_folder(spark, f"facts-{x}") for x in ("rows", "versions", "out"))
    arrive(rows, src)
    facts.write.partitionBy("version_block").parquet(versions)
    L.run_versioned_stream(source(spark, src, rows.schema), versions, facts.schema, SEGMENT_KEY, ["eic_count", "installed_capacity"], out,
                           _folder(spark, "checkpoint"))
    return spark.read.parquet(out).select("row_id", "eic_count", "installed_capacity")


BUCKETS = 8         # of the clustered copy; a few hundred MB each on a cluster


def _clustered(spark, df: DataFrame, value: str | None = None) -> DataFrame:
    return sinks.write_clustered(df, _folder(spark, "clustered"), PANEL_KEY, BUCKETS, value)


@query("s5_j3_clustered_history", """
WITH m AS (SELECT prediction_unit_id, is_consumption, max(target) AS top FROM tgt GROUP BY 1, 2),
n AS (SELECT t.row_id, prediction_unit_id, is_consumption, t.prediction_datetime, t.target / nullif(m.top, 0) AS target
      FROM tgt t JOIN m USING (prediction_unit_id, is_consumption))
SELECT t.row_id, coalesce(h2.target, 0) AS target_2d_ago, coalesce(h7.target, 0) AS target_7d_ago FROM n t
LEFT JOIN n h2 ON h2.prediction_unit_id = t.prediction_unit_id AND h2.is_consumption = t.is_consumption
  AND h2.prediction_datetime = t.prediction_datetime - INTERVAL 2 DAY
LEFT JOIN n h7 ON h7.prediction_unit_id = t.prediction_unit_id AND h7.is_consumption = t.is_consumption
  AND h7.prediction_datetime = t.prediction_datetime - INTERVAL 7 DAY""", ("tgt",))
def s5_j3_clustered(spark, sf_dir):
    """Lags read from a table clustered by unit, direction and hour: its side of the joins does not move."""
    t = load_panel(spark, sf_dir).target
    keys = PANEL_KEY[:2]
    norm = apply_unit_max(t, group_max(t, keys), keys)
    return add_lags_clustered(norm.select("row_id", *PANEL_KEY), _clustered(spark, norm.select(*PANEL_KEY, "target"), "target")) \
        .select("row_id", "target_2d_ago", "target_7d_ago")


@query("s5_t1_clustered_history", f"""
WITH {_HN}
SELECT * FROM h UNION SELECT * FROM n WHERE prediction_datetime > (SELECT max(prediction_datetime) FROM h)""", ("tgt",))
def s5_t1_clustered(spark, sf_dir):
    """The history update on a clustered table: only new rows move."""
    history, new = _history_and_new(spark, sf_dir)
    return B.extend_clustered_history(_clustered(spark, history.select(*PANEL_KEY, "target")), new)


@query("s5_j1_clustered_facts", """
SELECT t.row_id, c.eic_count, c.installed_capacity
FROM tgt t JOIN cli c ON t.county = c.county AND t.is_business = c.is_business AND t.product_type = c.product_type
  AND CAST(t.prediction_datetime AS DATE) = c.date""", ("tgt", "cli"))
def s5_j1_clustered(spark, sf_dir):
    """Rows and client facts both clustered by segment and date: the join moves neither."""
    p = load_panel(spark, sf_dir)
    keys = [*SEGMENT_KEY, "date"]
    rows = p.target.select("row_id", *SEGMENT_KEY, F.to_date("prediction_datetime").alias("date"))
    left = sinks.write_clustered(rows, _folder(spark, "clustered-rows"), keys, BUCKETS)
    right = sinks.write_clustered(p.client.select(*keys, "eic_count", "installed_capacity"), _folder(spark, "clustered-facts"), keys, BUCKETS)
    return left.join(right.hint("merge"), keys).select("row_id", "eic_count", "installed_capacity")


@query("s6_submission_blocks", """
SELECT row_id, target, CAST(data_block_id AS INTEGER) AS block FROM tgt WHERE data_block_id IN (SELECT DISTINCT data_block_id FROM tgt
  ORDER BY data_block_id LIMIT 3)""", ("tgt",))
def s6_blocks(spark, sf_dir):
    """The first three blocks sent as a submission, the second one twice: each row is there once."""
    t = load_panel(spark, sf_dir).target
    blocks = [r[0] for r in t.select("data_block_id").distinct().orderBy("data_block_id").limit(3).collect()]
    path = _folder(spark, "submission")
    for b in [*blocks, *blocks[1:2]]:
        sinks.write_submission_block(t.filter(F.col("data_block_id") == b), path, b)
    return sinks.read_submission(spark, path)
