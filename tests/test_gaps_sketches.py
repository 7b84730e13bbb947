"""Gap intervals, missing members, merged sketches, walk-forward fits, quarantined lines."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import ts
from gridpanel.operators import models as M
from gridpanel.operators import profiles as P
from gridpanel.operators import quality as Q
from gridpanel.sources.tables import read_csv, read_csv_checked


def series(spark, hours):
    rows = [(k, ts(h)) for k, hs in hours.items() for h in hs]
    return spark.createDataFrame(rows, "k int, t timestamp_ntz")


@pytest.mark.parametrize("seed", [1, 2])
def test_gap_intervals_are_the_missing_hours(spark, seed):
    rng = random.Random(seed)
    hours = {k: sorted(rng.choices(range(24 * 12), k=rng.choice([1, 2, 30, 200]))) for k in range(8)}
    hours[20] = [0, 23, 24, 47, 72, 240, 240]
    df = series(spark, hours).union(spark.sql("select 3, cast(null as timestamp_ntz)")).repartition(3)
    gaps = Q.gap_intervals(df, "t", ["k"])
    got = sorted((r.k, r.t) for r in Q.expand_gaps(gaps, "t", ["k"]).collect())
    assert got == sorted((k, ts(h)) for k, hs in hours.items() for h in set(range(min(hs), max(hs))) - set(hs))
    found = gaps.collect()
    assert all(r.n_missing == (r.last_missing - r.first_missing) // dt.timedelta(hours=1) + 1 for r in found)
    held = {(k, ts(h)) for k, hs in hours.items() for h in hs}        # intervals are as long as can be
    one = dt.timedelta(hours=1)
    assert all((r.k, r.first_missing - one) in held and (r.k, r.last_missing + one) in held for r in found)


def test_gap_intervals_without_keys_and_of_nothing(spark):
    df = series(spark, {1: [0, 5], 2: [3, 30]})
    assert [(r.first_missing, r.n_missing) for r in Q.gap_intervals(df, "t").orderBy("first_missing").collect()] == [(ts(1), 2), (ts(4), 1), (ts(6), 24)]
    assert Q.gap_intervals(df.limit(0), "t", ["k"]).count() == 0
    assert Q.gap_intervals(series(spark, {1: [7]}), "t", ["k"]).count() == 0


def test_missing_members(spark):
    rng = random.Random(3)
    rows = [(g, m, m % 3) for g in range(30) for m in range(40) if rng.random() < 0.8] + [(7, None, 1), (99, None, 0), (None, 5, 2), (None, 6, 0)]
    df = spark.createDataFrame(rows, "g int, m int, m2 int").repartition(5)
    members = {(m, n) for _, m, n in rows if m is not None}
    want = {(g, m, n) for g in {r[0] for r in rows} for m, n in members} - {(g, m, n) for g, m, n in rows}
    got = [tuple(r) for r in Q.missing_members(df, ["m", "m2"], ["g"]).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert Q.missing_members(df.limit(0), ["m", "m2"], ["g"]).count() == 0
    assert Q.missing_members(df.filter("m is null"), ["m", "m2"], ["g"]).count() == 0      # no member seen: none is missing


def test_missing_members_over_several_words(spark):
    n = 2 * Q.WORD_BITS + 10
    df = spark.range(n).select((F.col("id") % 2).alias("g"), F.col("id").alias("m")).union(spark.range(n).select(F.lit(5), "id")) \
        .union(spark.sql("select 9, 0"))
    got = Q.missing_members(df, ["m"], ["g"])
    assert {r.g: r["count"] for r in got.groupBy("g").count().collect()} == {0: n // 2, 1: n // 2, 9: n - 1}
    assert got.filter("g < 2 AND m % 2 = g").count() == 0


def test_numbered_rows_have_no_gaps(spark):
    df, n = Q.numbered_rows(spark.range(1000).repartition(7).filter("id % 3 > 0"))
    assert n == 666 and sorted(r["_id"] for r in df.collect()) == list(range(1, 667))


def test_merged_sketches_stay_within_the_bound(spark):
    rng = np.random.default_rng(4)
    n = 60_000
    values = np.exp(rng.normal(size=n) * 2)
    values[: n // 3] = 1.5                                               # one value a third of all
    rows = [(int(i % 2), ts(int(h)), float(v)) for i, (h, v) in enumerate(zip(rng.integers(0, 24 * 9, n), values))]
    rows += [(2, ts(0), None), (3, ts(0), float("nan")), (4, ts(1), 7.0), (4, ts(30), 9.0)]
    df = spark.createDataFrame(rows, "k int, prediction_datetime timestamp_ntz, target double").repartition(6)
    days = P.daily_sketches(df, ["k"])
    assert days.filter("k < 2").count() == 18
    got = P.merged_quantiles(days, ["k"], quantiles=(0.1, 0.5, 0.99))
    per = {r.k: r for r in got.collect()}
    assert per[0].target_n == n // 2 and per[2].target_n == 0 and per[2].target_q is None and per[3].target_n == 0
    assert per[4].target_n == 2 and per[4].target_q[1] in (7.0, 9.0)
    for i, q in enumerate((0.1, 0.5, 0.99)):
        errors = P.rank_errors(df, got.withColumn("e", F.col("target_q")[i]), ["k"], "target", "e", q).filter("k < 2").collect()
        assert len(errors) == 2 and all(r.rank_error <= P.RANK_ERROR for r in errors)
    wrong = got.withColumn("e", F.col("target_q")[2])
    assert all(r.rank_error > 0.4 for r in P.rank_errors(df, wrong, ["k"], "target", "e", 0.5).filter("k < 2").collect())


def test_walk_forward_equals_refitting(spark):
    rng = np.random.default_rng(5)
    rows = [(int(g), int(b), float(x), float(z), float(2 * x - z + g + rng.normal()))
            for g in range(3) for b in range(10) if (g, b) != (1, 4) for x, z in rng.normal(size=(int(rng.integers(1, 6)), 2))]
    df = spark.createDataFrame(rows, "g int, b long, x double, z double, y double").repartition(4)
    asked = df.select("g", "b").union(spark.createDataFrame([(1, 4), (0, 15), (7, 3)], "g int, b long"))      # blocks without truth
    fits = M.walk_forward_ols(M.block_grams(df, ["x", "z"], "y", ["g"], "b"), asked, ["x", "z"], ["g"], "b")
    got = {(r.g, r.b): r for r in fits.collect()}
    want = {}
    for g, b in {(r[0], r[1]) for r in rows} | {(1, 4), (0, 15), (7, 3)}:
        seen = [r for r in rows if r[0] == g and r[1] <= b - 2]
        if seen:
            a = np.array([[1, x, z] for *_, x, z, _ in seen])
            want[g, b] = (len(seen), np.linalg.lstsq(a, np.array([r[4] for r in seen]), rcond=1e-10)[0])
    assert set(got) == set(want)
    for key, (n, coef) in want.items():
        assert got[key].n == n
        assert np.allclose(got[key].coef, coef, atol=1e-6)
    scored = M.walk_forward_predict(df, fits, ["x", "z"], ["g"], "b").collect()
    assert len(scored) == sum((r[0], r[1]) in want for r in rows)
    assert all(abs(r.prediction - float(want[r.g, r.b][1] @ [1, r.x, r.z])) < 1e-6 for r in scored)


HEADER = "row_id,prediction_unit_id,county,is_business,product_type,is_consumption,datetime,data_block_id,target"
LINES = ["1,0,0,False,1,False,2021-09-01 00:00:00,0,0.5", "2,0,0,False,1,True,2021-09-01 00:00:00,0,", "x,0,0,False,1,True,2021-09-01 00:00:00,0,1",
         "4,0,0,maybe,1,True,2021-02-30 00:00:00,0,1.5", "5,0,0,False,1,True,2021-09-01 00:00:00,0", "6,0,0,False,1,True,2021-09-01 00:00:00,0,1,2",
         "7,0,0,False,1,True,2021-09-01 00:00:00,0,1e3", "8,0,0,False,1,True,2021-09-01 00:00:00,0,1;5", "9,99999999999,0,False,1,True,2021-09-01 00:00:00,0,1"]


def test_quarantine_loses_no_line(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    good, bad = read_csv_checked(spark, str(tmp_path), "target")
    assert good.schema == read_csv(spark, str(tmp_path), "target").schema
    assert [(r.row_id, r.target) for r in good.orderBy("row_id").collect()] == [(1, 0.5), (2, None), (7, 1000.0)]
    found = {r.line.split(",")[0]: list(r.reasons) for r in bad.collect()}
    assert found == {"x": ["row_id"], "4": ["is_business", "datetime"], "5": ["columns"], "6": ["columns"], "8": ["target"], "9": ["prediction_unit_id"]}
    assert {r.line for r in bad.collect()} == {LINES[i] for i in (2, 3, 4, 5, 7, 8)}
    assert good.count() + bad.count() == len(LINES)
    assert good.select("row_id").count() == 3 and bad.select("line").count() == 6       # also with few columns asked for
