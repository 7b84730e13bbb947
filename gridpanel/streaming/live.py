"""Streams whose state stays bounded: live lags (T3), truth history (T1), block scoring from stored hours (T2),
facts in versions (T5).

All event times are hours or blocks of the data. A watermark ``delay`` says how
far behind the newest row a row may still arrive; state older than that plus
the lag is dropped. ``closing_row`` is a last row far ahead: it moves the
watermark past everything, so that rows still waiting are given out.
"""
from __future__ import annotations

from contextlib import contextmanager
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.calendar import epoch_micros
from ..schemas import PANEL_KEY
from ..session import cut_lineage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _instant(ts: str):
    """An event time of an hour without a zone: its place on the UTC line, whatever the session's zone. A cast would
    move hours around clock changes, and seven days would not always be 168 hours."""
    return F.timestamp_micros(epoch_micros(ts))


@contextmanager
def rocksdb_state(spark: SparkSession):
    """State stores of the queries started inside are RocksDB ones, as arbitrary state needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def closing_row(df: DataFrame, ts: str, days: int, **values) -> DataFrame:
    """One row like ``df``'s, ``days`` after its last ``ts``, other columns null but for ``values``; none for an empty ``df``.

    Columns that a join compares need a value that no other row has: a filter
    for nulls runs before the row is seen by the watermark."""
    cell = lambda f: F.col("_t") if f.name == ts else F.lit(values.get(f.name)).cast(f.dataType)              # noqa: E731
    return (df.agg((F.max(ts) + F.make_dt_interval(F.lit(days))).alias("_t")).filter("_t is not null")
            .select(*[cell(f).alias(f.name) for f in df.schema.fields]))


# ---------------------------------------------------------------- T3
def stream_lags(rows: DataFrame, truth: DataFrame, days=(2, 7), value: str = "target", delay: str = "1 day") -> DataFrame:
    """Each streamed row, once per lag, with the value of the truth stream exactly that many days earlier.

    Result: the columns of ``rows``, ``lag_days`` and ``<value>_ago``, null
    where truth has no such hour; null rows come out once the watermark has
    passed the hour they wait for. Both sides meet on unit, direction and the
    wanted hour, so a hot unit spreads over its hours. The time range of the
    condition bounds the state: a row leaves when the watermark passes the
    earliest hour it can still meet (``min(days)`` behind it), a truth hour
    ``max(days)`` after itself; it is held once for all lags. Truth is to hold
    an hour once; rows later than ``delay`` are dropped, on either side."""
    *ids, ts = PANEL_KEY
    near, far = min(days), max(days)
    wanted = (rows.withColumn("_et", _instant(ts)).withWatermark("_et", delay)
              .withColumn("lag_days", F.explode(F.array(*[F.lit(d) for d in days])))
              .withColumn("_want", F.col(ts) - F.make_dt_interval(F.col("lag_days"))))
    known = (truth.select(*[F.col(c).alias(f"_h_{c}") for c in PANEL_KEY], F.col(value).alias(f"{value}_ago"),
                          _instant(ts).alias("_het")).withWatermark("_het", delay))
    same = [F.col(c) == F.col(f"_h_{c}") for c in ids] + [F.col("_want") == F.col(f"_h_{ts}")]
    within = F.expr(f"_het >= _et - interval {far} days AND _het <= _et - interval {near} days")
    joined = wanted.join(known, [*same, within], "left_outer")
    return joined.select(*rows.columns, "lag_days", f"{value}_ago")


def _series(ids):
    """A key that is never null: one null in a batch would turn whole numbers into floats in the processor, and so
    change it."""
    return F.to_json(F.struct(*ids), {"ignoreNullFields": "false"})


BUCKET_ROWS = 20_000        # rows of a stream for which there is a bucket


def buckets_for(rows: int) -> int:
    """Buckets of series for a stream of so many rows. A checkpoint goes with the number it was started with."""
    return max(32, -(-rows // BUCKET_ROWS))


def _bucket(buckets: int, *of):
    """The state's grouping key. Processors are called once a key and batch, and talk to the state store by messages:
    with a key for every series that takes hours, with one for some thousand rows it does not count."""
    return F.pmod(F.xxhash64(*of), F.lit(buckets)).cast("int")


# ---------------------------------------------------------------- T1
_NEVER = -(1 << 63)


def _advance(state, arrivals):
    """Marks of the arrivals of a batch: what was held before each, and the state afterwards.

    ``state`` is (last arrival, mark before it, newest hour held), ``arrivals``
    (arrival, newest hour in this batch) in order. More of the last arrival
    meets the mark from before it; an older arrival that comes late meets the
    newest hour held."""
    last, before, newest = state
    marks = {}
    for arrival, top in arrivals:
        if last is None or arrival > last:
            last, before = arrival, newest
        marks[arrival] = before if arrival == last else newest
        newest = max(newest, top)
    return marks, (last, before, newest)


class _SeriesMark(StatefulProcessor):
    """Of each series of a bucket: its last arrival, the latest hour held before that, and the latest hour held."""

    def __init__(self, ts, arrival, columns):
        self.ts, self.arrival, self.columns = ts, arrival, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getMapState("marks", "series string", "last long, before long, newest long")

    def handleInputRows(self, key, rows, timerValues):
        got = pd.concat(list(rows), ignore_index=True)
        held = {series: tuple(state) for (series,), state in self.marks.iterator()}
        tops = got.groupby(["series", self.arrival])[self.ts].max().sort_index()
        marks = {}
        for series, arrivals in groupby(tops.items(), key=lambda item: item[0][0]):
            old = held.get(series, (None, _NEVER, _NEVER))
            found, state = _advance(old, [(int(a), int(t)) for (_, a), t in arrivals])
            if state != old:
                self.marks.updateValue((series,), state)
            marks.update({(series, a): m for a, m in found.items()})
        limit = np.array([marks[k] for k in zip(got["series"], got[self.arrival])], dtype="int64")
        yield got[got[self.ts].to_numpy() > limit].drop_duplicates()[self.columns]

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for series, micros in zip(initialState["series"], initialState["micros"]):
            self.marks.updateValue((series,), (None, _NEVER, int(micros)))

    def close(self) -> None:
        pass


def _once(new: DataFrame, columns, arrival: str) -> DataFrame:
    """Rows repeated within an arrival once, whatever files hold them. Event time is the arrival (0 or more; a day each),
    so no hour is late, and what was seen is forgotten two arrivals later."""
    seen = new.filter(F.col(arrival).isNotNull()).withColumn(arrival, F.col(arrival).cast("long"))
    return (seen.select(*columns, arrival, F.timestamp_seconds((F.col(arrival) + 10_000) * 86400).alias("_et")).withWatermark("_et", "2 days")
            .dropDuplicatesWithinWatermark([*columns, arrival]))


def stream_new_rows(new: DataFrame, history: DataFrame | None = None, value: str = "target", arrival: str = "arrival",
                    buckets: int = 256) -> DataFrame:
    """T1 with a mark per series, as state: the rows of each arrival that are strictly newer than the latest hour their
    series held before it, without repeats.

    ``arrival`` numbers the deliveries (say, the block that reveals); they come
    in order, each in any number of files and micro-batches. ``history`` (a
    static frame) gives the first marks; rows of a series without one are all
    kept. Rows without an hour are left out; null ids are a series of their own.
    The state is three numbers per series; ``buckets`` of series are processed
    together (``buckets_for``). Needs ``rocksdb_state``."""
    *ids, ts = PANEL_KEY
    columns = [*PANEL_KEY, value]
    start = None
    if history is not None:
        start = cut_lineage(history.filter(F.col(ts).isNotNull()).groupBy(_series(ids).alias("series"))
                            .agg(F.max(epoch_micros(ts)).alias("micros")).withColumn("bucket", _bucket(buckets, "series"))).groupBy("bucket")
    # the processor sees hours as microseconds, which no zone moves; it sees no names that begin with an underscore
    seen = (_once(new.filter(F.col(ts).isNotNull()), columns, arrival)
            .select(*ids, epoch_micros(ts).alias(ts), value, arrival, _series(ids).alias("series"))
            .withColumn("bucket", _bucket(buckets, "series")))
    kept = seen.groupBy("bucket").transformWithStateInPandas(_SeriesMark(ts, arrival, columns), seen.select(*columns).schema, "append", "None", start)
    return kept.withColumn(ts, F.timestamp_add("MICROSECOND", F.col(ts), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))


def run_history_stream(new: DataFrame, history: DataFrame, path: str, checkpoint: str, value: str = "target",
                       arrival: str = "arrival") -> None:
    """T1 with the global mark on a stream: ``path/rows/epoch=N`` receives what epoch N adds to ``history``.

    Rows repeated within an arrival go by ``dropDuplicatesWithinWatermark``; then a row counts
    only if it is newer than the latest hour held before its arrival (see
    ``stream_new_rows``). The state between epochs is one row
    (``path/marks/epoch=N``), so an epoch reads no history, and an epoch that
    runs again finds the same state and overwrites its own rows. The driver
    sees one row per arrival of a batch."""
    ts, columns = PANEL_KEY[-1], [*PANEL_KEY, value]
    marks_at, rows_at = f"{path.rstrip('/')}/marks", f"{path.rstrip('/')}/rows"
    micros = epoch_micros
    state_schema = "last long, before long, newest long"

    def per_batch(batch: DataFrame, epoch: int) -> None:
        own = batch.sparkSession
        if epoch == 0:
            top = history.select(F.max(micros(ts))).first()[0]
            state = (None, _NEVER, _NEVER if top is None else top)
        else:
            state = tuple(own.read.schema(state_schema).parquet(f"{marks_at}/epoch={epoch - 1}").first())
        batch.persist()
        try:
            tops = batch.groupBy(arrival).agg(F.max(micros(ts)).alias("top")).orderBy(arrival).collect()
            marks, state = _advance(state, [(r[arrival], r["top"]) for r in tops])
            limits = own.createDataFrame(list(marks.items()), f"{arrival} long, _mark long")           # a row per arrival
            fresh = batch.join(F.broadcast(limits), arrival).filter(micros(ts) > F.col("_mark")).select(*columns)
            fresh.write.mode("overwrite").parquet(f"{rows_at}/epoch={epoch}")
        finally:
            batch.unpersist()
        own.createDataFrame([state], state_schema).coalesce(1).write.mode("overwrite").parquet(f"{marks_at}/epoch={epoch}")

    seen = _once(new, columns, arrival)
    q = seen.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


# ---------------------------------------------------------------- T2
TRUTH, ROW, NOTHING = 0, 1, 2          # what a row of the block stream is; nothing: it only moves the watermark


HOURS, WAITING = ["series", "hour", "block", "value"], ["series", "row_id", "hour", "block"]
_KINDS = {"series": "string", "hour": "long", "block": "long", "row_id": "long", "value": "double"}


def _chunk(state, key: int, columns) -> pd.DataFrame | None:
    """The rows that a map state holds under a key, as columns."""
    held = state.getValue((int(key),))
    return None if held is None else pd.DataFrame(dict(zip(columns, held)))


def _hold(state, key: int, columns, rows: pd.DataFrame) -> None:
    if len(rows):
        state.updateValue((int(key),), tuple(rows[c].tolist() for c in columns))
    elif state.containsKey((int(key),)):
        state.removeKey((int(key),))


def _first_told(hours: pd.DataFrame) -> pd.DataFrame:
    """An hour counts as it was first revealed."""
    return hours.sort_values(["series", "hour", "block", "value"]).drop_duplicates(["series", "hour"])


class _BlockScorer(StatefulProcessor):
    """Hours of truth by day, and rows that wait by block, of a bucket of series."""

    def __init__(self, days, columns):
        self.days, self.columns = days, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = lambda columns: ", ".join(f"{c} array<{_KINDS[c]}>" for c in columns)                        # noqa: E731
        self.hours = handle.getMapState("hours", "day long", lists(HOURS))
        self.waiting = handle.getMapState("waiting", "block long", lists(WAITING))

    def _times(self, blocks, days) -> list[int]:
        """When waiting rows can be answered, and when the oldest day is of no more use."""
        return [_block_millis(b) for b in blocks] + ([_block_millis(min(days) + max(self.days) + 2)] if days else [])

    def _wake(self, times, instead: bool) -> None:
        """One timer, the earliest needed; ``instead`` of those there are, or along with them."""
        now = list(self.handle.listTimers())
        wanted = min([*times, *([] if instead else now)], default=None)
        for t in now:
            if t != wanted:
                self.handle.deleteTimer(t)
        if wanted is not None and wanted not in now:
            self.handle.registerTimer(wanted)

    def handleInputRows(self, key, rows, timerValues):
        got = pd.concat(list(rows), ignore_index=True)
        truth, asked = got[got["kind"] == TRUTH], got[got["kind"] == ROW]
        days, blocks = truth["hour"] // 24, asked["block"]
        for day, part in truth.groupby(days):
            _hold(self.hours, day, HOURS, _first_told(pd.concat([_chunk(self.hours, day, HOURS), part[HOURS]])))
        for block, part in asked.groupby(blocks):
            _hold(self.waiting, block, WAITING, pd.concat([_chunk(self.waiting, block, WAITING), part[WAITING]]))
        self._wake(self._times(blocks.unique().tolist(), days.unique().tolist()), instead=False)
        yield pd.DataFrame(columns=self.columns)

    def _told(self, asked: pd.DataFrame, days_ago: int, held: set) -> pd.Series:
        """For each row the value of its series so many days before, if its own block knows it."""
        wanted = pd.DataFrame({"series": asked["series"], "hour": asked["hour"] - 24 * days_ago})
        known = [_chunk(self.hours, d, HOURS) for d in (wanted["hour"] // 24).unique() if d in held]
        if not known:
            return pd.Series(np.nan, index=asked.index)
        seen = wanted.merge(pd.concat(known), on=["series", "hour"], how="left").set_index(asked.index)      # an hour is held once
        return seen["value"].where(seen["block"] <= asked["block"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        held, blocks = {d for (d,) in self.hours.keys()}, {b for (b,) in self.waiting.keys()}
        ready = {b for b in blocks if _block_millis(b) <= passed}
        if ready:
            asked = pd.concat([_chunk(self.waiting, b, WAITING) for b in sorted(ready)], ignore_index=True)
            lags = {name: self._told(asked, d, held) for name, d in zip(self.columns[2:], self.days)}
            yield asked[["row_id", "block"]].assign(**lags)[self.columns]
            for b in ready:
                self.waiting.removeKey((b,))
        # the ring: hours that a row of a block still to come may ask for
        oldest = passed // 3_600_000 - 24 * (max(self.days) + 1)
        for day in sorted(held):
            if 24 * day < oldest:
                rest = _chunk(self.hours, day, HOURS)
                rest = rest[rest["hour"] >= oldest]
                _hold(self.hours, day, HOURS, rest)
                if not len(rest):
                    held.remove(day)
        self._wake(self._times(blocks - ready, held), instead=True)

    def close(self) -> None:
        pass


DAY_MILLIS = 86_400_000


def _block_millis(block: int) -> int:
    """A block is a day since the epoch; it is complete when the watermark passes its end."""
    return (int(block) + 1) * DAY_MILLIS - 1


def stream_block_lags(rows: DataFrame, truth: DataFrame, days=(2, 7), delay: str = "1 day", parts: int = 4,
                      value: str = "target", buckets: int = 256) -> DataFrame:
    """T2 on one stream with state: ``(row_id, block, <value>_<d>d_ago ..)`` of each row, as known in its own block.

    ``rows`` has ``row_id``, the panel key and ``block``; ``truth`` has the key,
    ``value`` and ``block``, the one that reveals it. Blocks are days since
    1970-01-01, rows ask for hours of their block's day or later. Event time is
    the block, not the hour: a row waits in state
    until the watermark has passed its block, so whatever that block reveals
    counts, in whichever file or batch it arrives. Then its lags are read from
    the stored hours, of which the last ``max(days) + 1`` days before the
    watermark stay. Rows without an id only move the watermark; truth without
    a value or key is left out, and rows without an hour have no lags. A series is held in ``parts`` by the hour of the day (lags
    are whole days), so a hot one spreads; ``buckets`` of such parts are processed together (``buckets_for``). Needs ``rocksdb_state``."""
    *ids, ts = PANEL_KEY
    hour = F.timestamp_diff("HOUR", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))
    block = F.col("block").cast("long")
    common = [F.coalesce(hour, F.lit(0)).alias("hour"), block.alias("block"), F.timestamp_seconds(block * 86400).alias("_et"),
              _series(ids).alias("series")]
    # a watermark on each side: the stream goes by the side that is further behind; numbers are never null (see _series)
    asked = rows.select(*common, F.when(F.col("row_id").isNull(), NOTHING).otherwise(ROW).alias("kind"),
                        F.coalesce(F.col("row_id").cast("long"), F.lit(0)).alias("row_id"), F.lit(0.0).alias("value")).withWatermark("_et", delay)
    useless = F.col(value).isNull() | F.col(ts).isNull() | F.greatest(*[F.col(c).isNull() for c in ids])
    told = truth.select(*common, F.when(useless, NOTHING).otherwise(TRUTH).alias("kind"), F.lit(0).cast("long").alias("row_id"),
                        F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value")).withWatermark("_et", delay)
    stream = asked.unionByName(told).withColumn("bucket", _bucket(buckets, "series", F.pmod(F.col("hour"), F.lit(parts))))
    names = ["row_id", "block", *[f"{value}_{d}d_ago" for d in days]]
    schema = ", ".join(["row_id long", "block long", *[f"{n} double" for n in names[2:]]])
    return stream.groupBy("bucket").transformWithStateInPandas(_BlockScorer(tuple(days), names), schema, "append", "EventTime")


# ---------------------------------------------------------------- T5
def enrich_versioned(batch: DataFrame, versions: DataFrame, keys, facts, block: str = "data_block_id",
                     version: str = "version_block", delay_blocks: int = 2) -> DataFrame:
    """T5 with facts in versions: each row gets, of its key, the facts of the latest version stamped with a block at
    least ``delay_blocks`` before its own (null if there is none).

    Rows are first reduced to their distinct (key, block) pairs, so a hot key
    meets its versions once per block of the batch. A version stamped twice
    counts with its larger facts."""
    keys = list(keys)
    wanted = batch.select(*keys, block).distinct()
    known = versions.select(*[F.col(k).alias(f"_v_{k}") for k in keys], F.col(version).alias("_version"), F.struct(*facts).alias("_facts"))
    same = [F.col(k) == F.col(f"_v_{k}") for k in keys] + [F.col("_version") <= F.col(block) - delay_blocks]
    latest = (wanted.join(known, same).groupBy(*keys, block).agg(F.max(F.struct("_version", "_facts")).alias("_latest"))
              .select(*keys, block, "_latest._facts.*"))
    return batch.join(latest, [*keys, block], "left")


def run_versioned_stream(rows: DataFrame, versions_path: str, versions_schema, keys, facts, out_path: str, checkpoint: str,
                         delay_blocks: int = 2, block: str = "data_block_id") -> None:
    """T5: ``enrich_versioned`` per micro-batch into ``out_path/epoch=N``.

    The versions (folders ``version_block=N`` under ``versions_path``) are listed
    anew for every batch, and only those old enough for its newest block are read."""

    def per_batch(batch: DataFrame, epoch: int) -> None:
        own = batch.sparkSession
        last = batch.agg(F.max(block)).first()[0]
        if last is None:
            return
        versions = own.read.schema(versions_schema).parquet(versions_path).filter(F.col("version_block") <= last - delay_blocks)
        (enrich_versioned(batch, versions, keys, facts, block, delay_blocks=delay_blocks)
         .write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}"))

    q = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
