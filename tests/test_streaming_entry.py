import os

from pyspark.sql import functions as F

from gridpanel.plans import backtest as B
from gridpanel.schemas import PANEL_KEY
from gridpanel.sources.sinks import append_submission, write_table
from gridpanel.streaming import blocks as S

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert {"target_2d_ago", "target_7d_ago", "row_id"} <= set(df.columns)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_block_stream_equals_batch_backtest(spark, tmpdir_path):
    from gridpanel.plans.fixtures import load_panel
    t = load_panel(spark, SF).target.filter("data_block_id BETWEEN 0 AND 8")
    rows_dir = os.path.join(tmpdir_path, "rows")
    rev_dir = os.path.join(tmpdir_path, "revealed")
    # blocks 6, 7, 8 arrive as three files; truth of block b is revealed in block b + 2
    for b in (6, 7, 8):
        t.filter(F.col("data_block_id") == b).drop("target").coalesce(1).write.mode("append").parquet(rows_dir)
    t.filter("data_block_id <= 6").withColumn("data_block_id", F.col("data_block_id") + 2) \
        .write.parquet(rev_dir)
    rows_schema = spark.read.parquet(rows_dir).schema
    rev_schema = spark.read.parquet(rev_dir).schema
    out = os.path.join(tmpdir_path, "out")
    S.run_block_stream(spark, rows_dir, rev_dir, rows_schema, rev_schema, os.path.join(tmpdir_path, "hist"), out,
                       os.path.join(tmpdir_path, "ckpt"))
    streamed = {r.row_id: r.prediction for r in spark.read.parquet(out).collect()}
    batch = {r.row_id: r.prediction for r in
             B.persistence_backtest(t.filter("data_block_id >= 6"), t, 2).collect()}
    assert streamed == batch and len(streamed) > 0


def test_repeated_batch_and_blocks_in_one_file(spark, tmpdir_path):
    """A batch that runs again leaves its rows once; blocks that share a batch see no later truth; blocks
    without rows still reveal theirs."""
    from gridpanel.plans.fixtures import load_panel
    t = load_panel(spark, SF).target.filter("data_block_id BETWEEN 0 AND 12").cache()
    revealed = B.with_reveal_block(t).select(*PANEL_KEY, "target", F.col("revealed_block").alias("data_block_id"))
    hist, out = os.path.join(tmpdir_path, "hist"), os.path.join(tmpdir_path, "out")
    batches = ["data_block_id IN (4, 5, 6)", "data_block_id IN (8, 9)", "data_block_id IN (11, 7)"]       # 10 has no rows, 7 is late
    for epoch, cond in enumerate(batches):
        for _ in range(2):
            S.score_batch(t.filter(cond), epoch, revealed, hist, out)
    got = [(r.row_id, r.prediction) for r in spark.read.parquet(out).collect()]
    rows = t.filter("data_block_id IN (4, 5, 6, 7, 8, 9, 11)")
    assert sorted(got) == sorted((r.row_id, r.prediction) for r in B.persistence_backtest(rows, t).collect())
    stored = spark.read.parquet(hist)
    assert stored.count() == revealed.filter("data_block_id <= 11").count()


def test_truth_that_comes_late_is_stored_once(spark, tmpdir_path):
    """Truth of a block already passed, delivered with a later batch, is stored then; nothing is stored twice."""
    from gridpanel.plans.fixtures import load_panel
    t = load_panel(spark, SF).target.filter("data_block_id BETWEEN 0 AND 12").cache()
    revealed = B.with_reveal_block(t).select(*PANEL_KEY, "target", F.col("revealed_block").alias("data_block_id")).cache()
    late = (F.col("prediction_unit_id") % 3 == 0) & (F.col("data_block_id") <= 6)
    hist, out = os.path.join(tmpdir_path, "hist"), os.path.join(tmpdir_path, "out")
    S.score_batch(t.filter("data_block_id IN (4, 5, 6)"), 0, revealed.filter(~late), hist, out)
    S.score_batch(t.filter("data_block_id = 8"), 1, revealed, hist, out)
    S.score_batch(t.filter("data_block_id = 9"), 2, revealed, hist, out)
    stored = [tuple(r) for r in spark.read.parquet(hist).select(*PANEL_KEY, "target", "revealed_block").collect()]
    assert sorted(stored) == sorted(tuple(r) for r in revealed.filter("data_block_id <= 9").collect())
    got = {r.row_id: r.prediction for r in spark.read.parquet(out).filter("data_block_id >= 8").collect()}
    assert got == {r.row_id: r.prediction for r in B.persistence_backtest(t.filter("data_block_id IN (8, 9)"), t).collect()}


def test_stream_scores_with_a_fitted_model(spark, tmpdir_path):
    from gridpanel.operators.models import fit_grouped_ols
    from gridpanel.plans.fixtures import load_panel
    t = load_panel(spark, SF).target
    revealed = B.with_reveal_block(t).select(*PANEL_KEY, "target", F.col("revealed_block").alias("data_block_id"))
    train = B.visible_lags(t.filter("data_block_id < 20"), B.with_reveal_block(t), (2, 7)).na.fill(0.0)
    model = fit_grouped_ols(train, ["target_2d_ago", "target_7d_ago"], "target")
    test = t.filter("data_block_id >= 20")
    out = os.path.join(tmpdir_path, "out")
    S.score_batch(test.drop("target"), 0, revealed, os.path.join(tmpdir_path, "hist"), out, (2, 7), model.predict)
    batch = model.predict(B.visible_lags(test, B.with_reveal_block(t), (2, 7)).na.fill(0.0, ["target_2d_ago", "target_7d_ago"]))
    expect = {r.row_id: round(r.prediction, 9) for r in batch.collect()}
    assert {r.row_id: round(r.prediction, 9) for r in spark.read.parquet(out).collect()} == expect and expect


def test_stream_lag_join(spark, tmpdir_path):
    from gridpanel.plans.fixtures import load_panel
    t = load_panel(spark, SF).target.select(*PANEL_KEY, "target")
    src = os.path.join(tmpdir_path, "src")
    t.write.parquet(src)
    rows = spark.readStream.schema(t.schema).parquet(src)
    truth = spark.readStream.schema(t.schema).parquet(src)
    joined = S.stream_lag_join(rows, truth, 2)
    q = joined.writeStream.format("memory").queryName("lagged").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    from gridpanel.operators.lags import add_lag_inner
    expect = {tuple(r) for r in add_lag_inner(t, t, "target", 2).select(*PANEL_KEY, "target_2d_ago").collect()}
    got = [tuple(r) for r in spark.sql("SELECT prediction_unit_id, is_consumption, prediction_datetime, target_2d_ago FROM lagged").collect()]
    assert {r for r in got if r[3] is not None} == expect and len(got) == len(set(got))
    # rows without a lag come with null once the watermark (three days behind the last hour) has passed them
    nulls = {r[:3] for r in got if r[3] is None}
    last = max(r[2] for r in got)
    without = {tuple(r) for r in t.select(*PANEL_KEY).collect()} - {r[:3] for r in expect}
    import datetime as dt
    assert nulls and nulls <= without
    assert {r for r in without if r[2] < last - dt.timedelta(days=4)} <= nulls


def test_sinks_roundtrip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 2.0, 0), (2, 3.0, 1)], "row_id int, target double, data_block_id int")
    p = os.path.join(tmpdir_path, "tbl")
    write_table(df, p, partition_by="data_block_id")
    assert spark.read.parquet(p).count() == 2
    s = os.path.join(tmpdir_path, "sub")
    append_submission(df.filter("data_block_id = 0"), s)
    append_submission(df.filter("data_block_id = 1"), s)
    assert spark.read.option("header", True).csv(s).count() == 2


def test_csv_scan_with_declared_schema(spark, tmpdir_path):
    from gridpanel.sources.tables import clean_target, read_csv
    p = os.path.join(tmpdir_path, "train.csv")
    with open(p, "w") as f:
        f.write("row_id,prediction_unit_id,county,is_business,product_type,is_consumption,datetime,data_block_id,target\n")
        f.write("1,0,0,False,1,False,2021-09-01 00:00:00,0,0.713\n")
        f.write("2,0,0,False,1,True,2021-09-01 00:00:00,0,\n")
    df = clean_target(read_csv(spark, p, "target"))
    rows = df.collect()
    assert len(rows) == 1 and rows[0].target == 0.713
    assert str(rows[0].date_when_predicting) == "2021-08-30"
    assert dict(df.dtypes)["prediction_datetime"] == "timestamp_ntz"


def test_flags_and_unit_slice(spark):
    from gridpanel.functions.numeric import flags_as_int
    from gridpanel.operators.assemble import unit_slice
    df = spark.createDataFrame([(1, True), (2, False)], "prediction_unit_id int, is_business boolean")
    assert [r.is_business for r in flags_as_int(df, ["is_business"]).orderBy("prediction_unit_id").collect()] == [1, 0]
    assert unit_slice(df, 2).count() == 1


def test_stream_static_enrichment(spark, tmpdir_path):
    from gridpanel.plans.fixtures import load_panel
    t = load_panel(spark, SF).target.select("row_id", "county", "prediction_datetime")
    src = os.path.join(tmpdir_path, "rows")
    t.write.parquet(src)
    static = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "county int, name string")
    s = S.enrich_stream(spark.readStream.schema(t.schema).parquet(src), static, ["county"])
    q = s.writeStream.format("memory").queryName("enriched").start()
    q.processAllAvailable()
    q.stop()
    assert spark.sql("SELECT count(*) FROM enriched WHERE name IS NOT NULL").first()[0] == t.count()
