import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from gridpanel.operators.lags import add_lags
from gridpanel.plans import backtest as B
from gridpanel.plans import q_streams as Q
from gridpanel.schemas import PANEL_KEY
from gridpanel.sources import sinks
from gridpanel.streaming import live as L

from conftest import ts

SCHEMA = "prediction_unit_id int, is_consumption boolean, prediction_datetime timestamp_ntz, target double, row_id long, data_block_id long"


def panel(spark, days=40, units=3, seed=1):
    """Hours with gaps; block = day."""
    rng = random.Random(seed)
    rows, n = [], 0
    for u in range(units):
        for side in (False, True):
            for d in range(days):
                for h in range(0, 24, 5):
                    if rng.random() < 0.8:
                        n += 1
                        rows.append((u, side, ts(24 * d + h), rng.random(), n, d))
    return spark.createDataFrame(rows, SCHEMA)


def finish(stream, out, ckpt):
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def feed(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def deliver(df, path, parts, block="data_block_id"):
    return Q.arrive(df.coalesce(1), path, block, parts)


# ------------------------------------------------------------------ T3
def test_live_lags_give_every_row_and_state_shrinks(spark, tmpdir_path):
    t = panel(spark).cache()
    asked, told = t.drop("target"), t.select(*PANEL_KEY, "target", "data_block_id")
    rows, truth, out = (os.path.join(tmpdir_path, x) for x in ("rows", "truth", "out"))
    span = deliver(asked, rows, 8)
    deliver(told, truth, 8)
    for df, path in ((asked, rows), (told, truth)):
        L.closing_row(df, "prediction_datetime", 30, **Q.NOBODY).coalesce(1).write.mode("append").parquet(path)
    q = finish(L.stream_lags(feed(spark, rows, asked.schema), feed(spark, truth, told.schema), (2, 7), delay=f"{span} days"), out, os.path.join(tmpdir_path, "c"))
    got = {(r.row_id, r.lag_days): r.target_ago for r in spark.read.parquet(out).filter("row_id is not null").collect()}
    exact = {(r.prediction_unit_id, r.is_consumption, r.prediction_datetime): r.target for r in t.collect()}
    want = {(r.row_id, d): exact.get((r.prediction_unit_id, r.is_consumption, r.prediction_datetime - dt.timedelta(days=d)))
            for r in t.collect() for d in (2, 7)}
    assert got == want and None in want.values()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(held) < 1.2 * t.count() and held[-1] <= 3           # all rows and lags would be three times the table
    t.unpersist()


def test_late_truth_is_met_within_the_delay(spark, tmpdir_path):
    """Truth two days behind the rows, as when it is revealed late: no lag is lost."""
    t = panel(spark, days=20).cache()
    rows, truth, out = (os.path.join(tmpdir_path, x) for x in ("rows", "truth", "out"))
    late = t.select(*PANEL_KEY, "target", (F.col("data_block_id") + 2).alias("data_block_id"))
    span = max(deliver(t.drop("target"), rows, 5), deliver(late, truth, 5))
    for df, path in ((t.drop("target"), rows), (late, truth)):
        L.closing_row(df, "prediction_datetime", 40, **Q.NOBODY).coalesce(1).write.mode("append").parquet(path)
    finish(L.stream_lags(feed(spark, rows, t.drop("target").schema), feed(spark, truth, late.schema), (2,), delay=f"{span + 2} days"), out, os.path.join(tmpdir_path, "c"))
    got = spark.read.parquet(out).filter("row_id is not null")
    matched = t.alias("a").join(t.alias("b"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in PANEL_KEY[:2]]
                                + [F.col("a.prediction_datetime") == F.col("b.prediction_datetime") + F.expr("interval 2 days")]).count()
    assert got.count() == t.count() and got.filter("target_ago is not null").count() == matched
    t.unpersist()


# ------------------------------------------------------------------ T2
@pytest.fixture
def block_feed(spark, tmpdir_path):
    t = panel(spark, days=24).cache()
    asked = t.filter("data_block_id >= 12").select("row_id", *PANEL_KEY, (F.col("data_block_id") + 19723).alias("block"))
    told = t.select(*PANEL_KEY, "target", (F.col("data_block_id") + 19725).alias("block"))
    # an hour that is revealed again, otherwise, later: the first counts
    told = told.unionByName(told.filter("prediction_unit_id = 0").withColumns({"target": F.col("target") + 1, "block": F.col("block") + 1}))
    want = {r.row_id: (r.target_2d_ago, r.target_7d_ago) for r in B.visible_lags(
        t.filter("data_block_id >= 12"), told.withColumnRenamed("block", "revealed_block").withColumn("revealed_block", F.col("revealed_block") - 19723)).collect()}
    rows, truth = os.path.join(tmpdir_path, "rows"), os.path.join(tmpdir_path, "truth")

    def closing(df):
        day = F.date_from_unix_date(F.col("block").cast("int")).cast("timestamp_ntz")
        return L.closing_row(df.withColumn("_day", day), "_day", 60, **Q.NOBODY).withColumn("block", F.unix_date(F.to_date("_day")).cast("long")).drop("_day")
    yield asked, told, rows, truth, closing, want
    t.unpersist()


def lag_rows(spark, out):
    return [(r.row_id, (r.target_2d_ago, r.target_7d_ago)) for r in spark.read.parquet(out).filter("row_id is not null").collect()]


def test_block_lags_from_state_equal_the_batch_and_survive_a_restart(spark, tmpdir_path, block_feed):
    asked, told, rows, truth, closing, want = block_feed
    out, ckpt = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ckpt")
    stream = lambda: L.stream_block_lags(feed(spark, rows, asked.schema, 2), feed(spark, truth, told.schema, 2), (2, 7), "4 days")      # noqa: E731
    first = "block < {}".format(19723 + 18)
    with L.rocksdb_state(spark):
        deliver(told.filter(first), truth, 4, "block")
        deliver(asked.filter(first), rows, 2, "block")
        finish(stream(), out, ckpt)
        before = lag_rows(spark, out)
        assert 0 < len(before) < len(want)                      # rows whose block may still be told something wait
        deliver(told.filter(f"NOT {first}"), truth, 3, "block")
        deliver(asked.filter(f"NOT {first}"), rows, 3, "block")
        for df, path in ((asked, rows), (told, truth)):
            closing(df).coalesce(1).write.mode("append").parquet(path)
        q = finish(stream(), out, ckpt)                         # goes on where the first run stopped
    got = lag_rows(spark, out)
    assert len(got) == len(want) and dict(got) == want
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert held[-1] < max(held)


def test_rows_wait_for_truth_of_their_own_block_in_later_files(spark, tmpdir_path, block_feed):
    """Rows first, the truth that their blocks reveal in a later micro-batch: visibility goes by block, not by batch."""
    asked, told, rows, truth, closing, want = block_feed
    with L.rocksdb_state(spark):
        asked.coalesce(1).write.parquet(rows)
        deliver(told, truth, 6, "block")
        for df, path in ((asked, rows), (told, truth)):
            closing(df).coalesce(1).write.mode("append").parquet(path)
        finish(L.stream_block_lags(feed(spark, rows, asked.schema), feed(spark, truth, told.schema), (2, 7), "30 days"), os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "c"))
    assert dict(lag_rows(spark, os.path.join(tmpdir_path, "out"))) == want


# ------------------------------------------------------------------ T1
@pytest.fixture
def deliveries(spark):
    """History, and three deliveries: overlapping ones, repeats, rows older than the mark, units without history."""
    t = panel(spark, days=20).select(*PANEL_KEY, "target", "data_block_id").cache()
    history = t.filter("data_block_id < 8 - prediction_unit_id * 2 AND prediction_unit_id < 2").drop("data_block_id")
    parts = [t.filter("data_block_id BETWEEN 5 AND 11"), t.filter("data_block_id BETWEEN 9 AND 15"), t.filter("data_block_id BETWEEN 3 AND 19")]
    parts = [p.drop("data_block_id").union(p.drop("data_block_id").limit(20)) for p in parts]
    yield history, parts
    t.unpersist()


def replay(history, parts, per_series):
    held = history
    for p in parts:
        held = B.update_history(held, p, per_series_mark=per_series)
    return sorted(tuple(r) for r in held.collect())


def write_deliveries(parts, path, files):
    for i, p in enumerate(parts):
        p.withColumn("arrival", F.lit(i).cast("long")).repartition(files).write.mode("append").parquet(path)


@pytest.mark.parametrize("files,per_trigger", [(1, 1), (3, 1), (3, 2), (2, 100)])
def test_global_mark_on_a_stream(spark, tmpdir_path, deliveries, files, per_trigger):
    history, parts = deliveries
    src, out = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "out")
    write_deliveries(parts, src, files)
    schema = spark.read.parquet(src).schema
    L.run_history_stream(feed(spark, src, schema, per_trigger), history, out, os.path.join(tmpdir_path, "c"))
    added = spark.read.parquet(f"{out}/rows").select(*history.columns)
    assert sorted(tuple(r) for r in history.unionByName(added).collect()) == replay(history, parts, False)


@pytest.mark.parametrize("files,per_trigger", [(1, 1), (3, 2), (2, 100)])
def test_series_marks_in_state(spark, tmpdir_path, deliveries, files, per_trigger):
    history, parts = deliveries
    src, out, ckpt = (os.path.join(tmpdir_path, x) for x in ("src", "out", "c"))
    with L.rocksdb_state(spark):
        for upto in (2, 3):                                     # a restart before the last delivery
            write_deliveries(parts[:2], src, files) if upto == 2 else \
                parts[2].withColumn("arrival", F.lit(2).cast("long")).repartition(files).write.mode("append").parquet(src)
            q = finish(L.stream_new_rows(feed(spark, src, spark.read.parquet(src).schema, per_trigger), history), out, ckpt)
    got = spark.read.parquet(out)
    assert sorted(tuple(r) for r in history.unionByName(got).collect()) == replay(history, parts, True)
    marks = [p for s in q.recentProgress[-1]["stateOperators"] if "transformWithState" in s["operatorName"] for p in [s["numRowsTotal"]]]
    assert marks == [6]                                         # one mark per series


def test_marks_of_arrivals():
    marks, state = L._advance((None, L._NEVER, 10), [(0, 15), (1, 12), (2, 30)])
    assert marks == {0: 10, 1: 15, 2: 15} and state == (2, 15, 30)
    assert L._advance(state, [(2, 40), (3, 5)]) == ({2: 15, 3: 40}, (3, 40, 40))
    assert L._advance(state, [(1, 50)])[0] == {1: 30}            # an old delivery that comes late meets the newest hour


# ------------------------------------------------------------------ T5
def test_facts_change_between_batches(spark, tmpdir_path):
    """Each block is scored by the version known two blocks before, also if later versions are there already."""
    rows, versions, out, ckpt = (os.path.join(tmpdir_path, x) for x in ("rows", "versions", "out", "c"))
    facts = "k int, v double, version_block long"
    write = lambda data: spark.createDataFrame(data, facts).write.mode("append").partitionBy("version_block").parquet(versions)      # noqa: E731
    asked = "row_id long, k int, data_block_id long"
    batch = lambda data: spark.createDataFrame(data, asked).coalesce(1).write.mode("append").parquet(rows)                            # noqa: E731
    run = lambda: L.run_versioned_stream(feed(spark, rows, spark.createDataFrame([], asked).schema), versions,                       # noqa: E731
                                         spark.createDataFrame([], facts).schema, ["k"], ["v"], out, ckpt)
    write([(1, 10.0, 0), (2, 20.0, 0), (1, 11.0, 3)])
    batch([(1, 1, 1), (2, 1, 2), (3, 1, 4), (4, 2, 4), (5, 3, 4), (6, 1, 5)])
    run()
    write([(2, 21.0, 5), (1, 12.0, 6), (1, 12.5, 6)])
    batch([(7, 1, 5), (8, 1, 8), (9, 2, 7), (10, None, 9), (8, 1, 8)])
    run()
    got = sorted((r.row_id, r.v) for r in spark.read.parquet(out).collect())
    assert got == [(1, None), (2, 10.0), (3, 10.0), (4, 20.0), (5, None), (6, 11.0), (7, 11.0), (8, 12.5), (8, 12.5), (9, 21.0), (10, None)]


# ------------------------------------------------------------------ S5, S6
def moved_tables(df):
    """Names of clustered tables that go through an exchange before their first join or grouping, and all that the plan reads."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))                       # noqa: E731
    moved, read, above = set(), set(), []
    for line in lines:
        while above and above[-1][0] >= depth(line):
            above.pop()
        above.append((depth(line), line))
        if "clustered_" in line and "Scan" in line:
            name = "clustered_" + line.split("clustered_")[1][:32]
            read.add(name)
            for _, text in reversed(above):
                if "Exchange hashpartitioning" in text:
                    moved.add(name)
                if "Join" in text or "Aggregate" in text and "partial_" not in text and "Exchange" not in text:
                    break
    return moved, read


def test_clustered_history_is_read_without_an_exchange(spark, tmpdir_path):
    from gridpanel.operators.lags import add_lags_clustered
    t = panel(spark).select("row_id", *PANEL_KEY, "target")
    twice = t.unionByName(t.filter("row_id % 5 = 0").withColumn("target", F.col("target") - 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        history = sinks.write_clustered(twice, os.path.join(tmpdir_path, "h"), PANEL_KEY, 4, "target")
        got = add_lags_clustered(t.select("row_id", *PANEL_KEY), history)
        moved, read = moved_tables(got)
        assert len(read) == 1 and not moved
        assert moved_tables(history.groupBy("target").count())[0] == read       # a grouping by something else does move it
        want = add_lags(t.select("row_id", *PANEL_KEY), twice)
        rows = lambda d: sorted(tuple(r) for r in d.select("row_id", "target_2d_ago", "target_7d_ago").collect())                    # noqa: E731
        assert rows(got) == rows(want)
        assert rows(add_lags_clustered(t.select("row_id", *PANEL_KEY), history, mode="train")) == rows(add_lags(t.select("row_id", *PANEL_KEY), twice, mode="train"))
        again = sinks.open_clustered(spark, os.path.join(tmpdir_path, "h"), history.schema, PANEL_KEY, 4)
        assert rows(add_lags_clustered(t.select("row_id", *PANEL_KEY), again)) == rows(want) and not moved_tables(add_lags_clustered(t, again))[0]
        held = sinks.write_clustered(twice.select(*PANEL_KEY, "target"), os.path.join(tmpdir_path, "t1"), PANEL_KEY, 4)
        new = panel(spark, days=45).select(*PANEL_KEY, "target")
        grown = B.extend_clustered_history(held, new)
        assert not moved_tables(grown)[0]
        assert sorted(tuple(r) for r in grown.collect()) == sorted(tuple(r) for r in B.update_history(twice, new).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


def test_submission_block_sent_twice(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "row_id long, target double")
    path = os.path.join(tmpdir_path, "sub")
    for block in (3, 4, 3):
        sinks.write_submission_block(df, path, block)
    assert sorted((r.row_id, r.target, r.block) for r in sinks.read_submission(spark, path).collect()) == \
        [(1, 2.0, 3), (1, 2.0, 4), (2, None, 3), (2, None, 4)]


# ------------------------------------------------------------------ many series
def test_marks_of_many_series_take_few_calls(spark, tmpdir_path, monkeypatch):
    """A processor is called for a bucket of series: 3,000 series, one of them without a unit, in a few calls."""
    new = (spark.range(3000).select(F.when(F.col("id") > 0, F.col("id")).cast("int").alias("prediction_unit_id"), F.lit(True).alias("is_consumption"),
                                    F.lit(ts(5)).cast("timestamp_ntz").alias("prediction_datetime"), F.col("id").cast("double").alias("target"),
                                    F.lit(0).cast("long").alias("arrival")))
    new = new.unionByName(new.withColumns({"prediction_datetime": F.lit(ts(9)).cast("timestamp_ntz"), "arrival": F.lit(1).cast("long")}))
    history = new.filter("arrival = 0 AND target < 1000").drop("arrival")
    src, out, log = (os.path.join(tmpdir_path, x) for x in ("src", "out", "log"))
    os.makedirs(log)
    plain = L._SeriesMark.handleInputRows

    class Counted(L._SeriesMark):
        def handleInputRows(self, key, rows, timerValues):
            import uuid
            open(os.path.join(log, uuid.uuid4().hex), "w").close()
            return plain(self, key, rows, timerValues)
    monkeypatch.setattr(L, "_SeriesMark", Counted)
    new.coalesce(1).write.parquet(src)
    with L.rocksdb_state(spark):
        finish(L.stream_new_rows(feed(spark, src, new.schema, 100), history), out, os.path.join(tmpdir_path, "c"))
    got = sorted((r.prediction_unit_id or 0, r.prediction_datetime, r.target) for r in spark.read.parquet(out).collect())
    assert got == sorted([(i, ts(5), float(i)) for i in range(1000, 3000)] + [(i, ts(9), float(i)) for i in range(3000)])
    assert 0 < len(os.listdir(log)) <= 256


def test_block_lags_of_many_series_take_few_calls(spark, tmpdir_path, monkeypatch):
    """2,000 series in a few buckets: as many calls as buckets and batches, not as series and their parts."""
    told = (spark.range(2000).select(F.when(F.col("id") > 0, F.col("id")).cast("int").alias("prediction_unit_id"), F.lit(False).alias("is_consumption"),
                                     F.lit(ts(24 * 10 + 5)).cast("timestamp_ntz").alias("prediction_datetime"), F.col("id").cast("double").alias("target"),
                                     F.lit(19725 + 10).cast("long").alias("block")))
    asked = told.select(F.col("target").cast("long").alias("row_id"), *PANEL_KEY[:2], (F.col("prediction_datetime") + F.expr("interval 2 days")).alias("prediction_datetime"),
                        (F.lit(19725 + 10) - F.when(F.col("target") % 3 == 0, 1).otherwise(0)).cast("long").alias("block"))
    rows, truth, out, log = (os.path.join(tmpdir_path, x) for x in ("rows", "truth", "out", "log"))
    os.makedirs(log)
    plain = L._BlockScorer.handleInputRows

    class Counted(L._BlockScorer):
        def handleInputRows(self, key, rows, timerValues):
            import uuid
            open(os.path.join(log, uuid.uuid4().hex), "w").close()
            return plain(self, key, rows, timerValues)
    monkeypatch.setattr(L, "_BlockScorer", Counted)
    for df, path in ((asked, rows), (told, truth)):
        df.coalesce(1).write.parquet(path)
        day = F.date_from_unix_date(F.col("block").cast("int")).cast("timestamp_ntz")
        last = L.closing_row(df.withColumn("_day", day), "_day", 60, **Q.NOBODY).withColumn("block", F.unix_date(F.to_date("_day")).cast("long")).drop("_day")
        last.write.mode("append").parquet(path)
    with L.rocksdb_state(spark):
        finish(L.stream_block_lags(feed(spark, rows, asked.schema, 9), feed(spark, truth, told.schema, 9), (2, 7), "4 days"), out, os.path.join(tmpdir_path, "c"))
    # a value counts for rows of the block that reveals it or later; without a unit there is no truth
    assert sorted(lag_rows(spark, out)) == [(i, (float(i) if i % 3 else None, None)) for i in range(2000)]
    assert 0 < len(os.listdir(log)) <= 2 * 256
