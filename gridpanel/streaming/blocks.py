"""Structured Streaming forms of history, block replay and live lags.

- ``run_block_stream``: file-source micro-batches of block rows; ``foreachBatch``
  stores newly revealed truth and the scores of each epoch in folders of that
  epoch, which a repeated batch overwrites.
- ``stream_lag_join``: stream-stream left outer join on the exact lagged hour,
  with watermarks on both sides (T3).
- ``enrich_stream``: stream-static joins (T5).
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.backtest import visible_lags
from ..schemas import PANEL_KEY
from ..sources.tables import fill_numeric_nulls


def block_source(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def _epochs(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The epochs written under ``path`` (up to ``before``), or None if there are none."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException:
        return None
    return found if before is None else found.filter(F.col("epoch") < before)


def _mark(spark: SparkSession, path: str, epoch: int) -> int | None:
    """The last block whose truth earlier epochs stored: one row that the epoch before left, or None."""
    found = _epochs(spark, path)
    if found is None:
        return None
    return found.filter(F.col("epoch") == epoch - 1).agg(F.max("known")).first()[0]


def score_batch(batch: DataFrame, epoch: int, revealed: DataFrame, history_path: str, out_path: str, days=(2,), score=None,
                key=PANEL_KEY, value: str = "target", late_blocks: int = 7) -> None:
    """One micro-batch of the block replay (T1 + T2).

    Truth revealed up to the batch's last block and not stored by an earlier
    epoch, also if it arrives up to ``late_blocks`` after its block, becomes ``history_path/epoch=N``, by day; the batch is scored from
    the stored days its lags fall on, a row seeing only truth revealed by its
    own block; the result becomes ``out_path/epoch=N``. Both folders are
    overwritten, so a batch that runs again after a failure leaves its rows
    once. Blocks of one file, blocks over several files and blocks without
    test rows come out alike, as visibility goes by block and not by batch."""
    spark = batch.sparkSession
    *ids, ts = key
    span = batch.agg(F.max("data_block_id").alias("last"), F.min(F.to_date(ts)).alias("a"), F.max(F.to_date(ts)).alias("b")).first()
    marks = f"{history_path.rstrip('/')}-marks"
    known = _mark(spark, marks, epoch) if epoch else None
    newest = max((b for b in (span["last"], known) if b is not None), default=None)
    # an empty batch passes the mark on
    spark.range(1).select(F.lit(newest).cast("long").alias("known")).write.mode("overwrite").parquet(f"{marks}/epoch={epoch}")
    if span["last"] is None:
        return
    block = F.col("data_block_id")
    fresh = revealed.filter(block <= span["last"])
    if known is not None:
        fresh = fresh.filter(block > known - late_blocks)
        held = _epochs(spark, history_path, epoch)
        if held is not None:
            # what those blocks brought before; only they are read
            seen = held.filter(F.col("revealed_block") > known - late_blocks)
            same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in key] + [block == F.col("_s_block")]
            fresh = fresh.join(seen.select(*[F.col(c).alias(f"_s_{c}") for c in key], F.col("revealed_block").alias("_s_block")), same, "left_anti")
    (fresh.select(*key, value, block.alias("revealed_block"), F.to_date(ts).alias("day"))
     .write.mode("overwrite").partitionBy("day").parquet(f"{history_path.rstrip('/')}/epoch={epoch}"))
    history = _epochs(spark, history_path, epoch + 1)
    needed = None
    for d in days:
        near = (F.col("day") >= F.date_sub(F.lit(span["a"]), d)) & (F.col("day") <= F.date_sub(F.lit(span["b"]), d))
        needed = near if needed is None else needed | near
    lagged = visible_lags(batch, history.filter(needed), days, value, key)
    scored = score(fill_numeric_nulls(lagged)) if score else lagged.withColumn("prediction", F.col(f"{value}_{days[0]}d_ago"))
    out = fill_numeric_nulls(scored.select("row_id", "data_block_id", "prediction"), cols=["prediction"])
    out.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}")


def run_block_stream(spark: SparkSession, rows_dir: str, revealed_dir: str, rows_schema, revealed_schema,
                     history_path: str, out_path: str, checkpoint: str, days=(2,), score=None,
                     files_per_trigger: int = 1) -> None:
    """T2 streaming: blocks arrive as files; each micro-batch is scored by ``score_batch``.

    ``revealed_dir`` holds truth by the block that reveals it, best partitioned
    by ``data_block_id``. ``score`` maps a frame with lag columns to one with
    ``prediction`` (a fitted model's ``predict``); without it, the first lag is
    the prediction."""

    def per_batch(batch: DataFrame, epoch: int) -> None:
        revealed = spark.read.schema(revealed_schema).parquet(revealed_dir)
        score_batch(batch, epoch, revealed, history_path, out_path, days, score)

    q = (block_source(spark, rows_dir, rows_schema, files_per_trigger).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_lag_join(rows: DataFrame, truth: DataFrame, days: int = 2, value: str = "target",
                    watermark: str = "3 days") -> DataFrame:
    """Each streamed row with the value ``days`` earlier from a truth stream;
    left outer join, so rows without a lag are emitted with null once the
    watermark passes."""
    *ids, ts = PANEL_KEY
    # watermarks need TIMESTAMP event time; both sides convert the same way, so
    # exact-hour equality is preserved
    r = rows.withColumn("_et", F.col(ts).cast("timestamp")).withWatermark("_et", watermark).alias("r")
    h = (truth.select(*[F.col(c).alias(f"h_{c}") for c in ids],
                      (F.col(ts) + F.make_dt_interval(F.lit(days))).cast("timestamp").alias("_het"),
                      F.col(value).alias(f"{value}_{days}d_ago"))
         .withWatermark("_het", watermark))
    cond = [F.col(f"r.{c}") == F.col(f"h_{c}") for c in ids] + [F.col("r._et") == F.col("_het")]
    j = r.join(h, cond, "leftOuter")
    return j.select("r.*", f"{value}_{days}d_ago").drop("_et")


def enrich_stream(rows: DataFrame, static: DataFrame, keys, how: str = "left") -> DataFrame:
    """T5: stream-static join (static side read once per micro-batch plan)."""
    return rows.join(static, list(keys), how)
