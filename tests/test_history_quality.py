import datetime as dt

from pyspark.sql import functions as F

from conftest import PANEL_SCHEMA, ts
from gridpanel.operators import quality as Q
from gridpanel.operators.fill import fill_missing_hours, last_known
from gridpanel.plans import backtest as B


def test_duplicate_history_row_kept_once(spark):
    h = spark.createDataFrame([(1, False, ts(0), 1.0)], PANEL_SCHEMA)
    new = spark.createDataFrame([(1, False, ts(1), 2.0), (1, False, ts(1), 2.0)], PANEL_SCHEMA)
    out = B.update_history(h, new)
    assert out.count() == 2
    assert B.update_history(out, new).count() == 2      # replaying a block is idempotent


def test_late_slow_unit(spark):
    h = spark.createDataFrame([(1, False, ts(10), 1.0), (2, False, ts(5), 1.0)], PANEL_SCHEMA)
    new = spark.createDataFrame([(2, False, ts(7), 3.0), (1, False, ts(11), 4.0)], PANEL_SCHEMA)
    glob = B.update_history(h, new)
    assert glob.filter("prediction_unit_id = 2").count() == 1          # dropped: older than global mark
    per = B.update_history(h, new, per_series_mark=True)
    assert per.filter("prediction_unit_id = 2").count() == 2


def test_gap_fill_repeats_previous_row(spark):
    rows = [(ts(h), float(h), h % 3) for h in range(10) if h not in (4, 5)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v double, w int")
    out = {r.t: r for r in fill_missing_hours(df, [], "t", ["v", "w"]).collect()}
    assert len(out) == 10
    assert out[ts(4)].v == 3.0 and out[ts(5)].v == 3.0 and out[ts(5)].w == 0 and out[ts(5)].filled
    assert not out[ts(6)].filled
    missing = [r.t for r in Q.missing_instants(df, "t").collect()]
    assert sorted(missing) == [ts(4), ts(5)]


def test_last_known_across_days(spark):
    rows = [(ts(h), float(h) if h in (2, 70) else None) for h in range(0, 80)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v double")
    out = {r.t: r.v_last for r in last_known(df, [], "t", "v").collect()}
    assert out[ts(1)] is None and out[ts(2)] == 2.0 and out[ts(50)] == 2.0 and out[ts(79)] == 70.0
    back = {r.t: r.v_next for r in last_known(df, [], "t", "v", direction="backward").collect()}
    assert back[ts(3)] == 70.0 and back[ts(0)] == 2.0 and back[ts(75)] is None


def test_key_checks(spark):
    df = spark.createDataFrame([(1, ts(0)), (1, ts(0)), (2, ts(1))], "k int, t timestamp_ntz")
    assert [tuple(r) for r in Q.duplicate_keys(df, ["k", "t"]).collect()] == [(1, ts(0), 2)]
    nulls = Q.null_counts(spark.createDataFrame([(1, None), (None, 2.0)], "a int, b double")).first()
    assert (nulls.a, nulls.b) == (1, 1)
    freq = Q.frequency_mode(spark.createDataFrame([(ts(h),) for h in (0, 1, 2, 3, 5, 30, 31)], "t timestamp_ntz"), "t")
    assert freq.first().step_seconds == 3600


def test_submission_fills_missing_with_zero(spark):
    template = spark.createDataFrame([(1, 0, 9.0), (2, 0, 9.0), (3, 0, 9.0)], "row_id int, data_block_id int, target double")
    p1 = spark.createDataFrame([(1, 5.0)], "row_id int, prediction double")
    p2 = spark.createDataFrame([(3, 7.0)], "row_id int, prediction double")
    out = {r.row_id: r.target for r in B.complete_submission(template, [p1, p2]).collect()}
    assert out == {1: 5.0, 2: 0.0, 3: 7.0}


def test_backtest_visibility(spark):
    truth = spark.createDataFrame([(1, False, dt.datetime(2024, 1, 1, 5), 10, 4.0)],
                                  "prediction_unit_id int, is_consumption boolean, prediction_datetime timestamp_ntz, data_block_id int, target double")
    test = spark.createDataFrame([(7, 1, False, dt.datetime(2024, 1, 3, 5), 12), (8, 1, False, dt.datetime(2024, 1, 3, 5), 11)],
                                 "row_id int, prediction_unit_id int, is_consumption boolean, prediction_datetime timestamp_ntz, data_block_id int")
    out = {r.row_id: r.prediction for r in B.persistence_backtest(test, truth, 2).collect()}
    assert out == {7: 4.0, 8: 0.0}       # block 11 cannot see a value revealed in block 12
