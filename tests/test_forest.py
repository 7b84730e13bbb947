import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpanel.operators import forest as B
from gridpanel.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x, z, k = rng.normal(size=600).round(2), rng.random(600), rng.integers(0, 5, 600)
    y = np.where(x > 0, 3.0, -1.0) + 2 * z * (k > 2) + rng.normal(size=600) / 10
    data = [(i, float(a), float(b), float(c), float(d)) for i, (a, b, c, d) in enumerate(zip(x, z, k, y))]
    return spark.createDataFrame(data, "id long, x double, z double, k double, y double").repartition(3, "id").cache()


def test_a_tree_is_the_one_that_spark_grows(spark, rows):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor
    at = VectorAssembler(inputCols=["x", "z", "k"], outputCol="f").transform(rows)
    model = DecisionTreeRegressor(featuresCol="f", labelCol="y", maxDepth=6, maxBins=32).fit(at)
    want = {r.id: r.prediction for r in model.transform(at).collect()}
    got = rows.orderBy("id").collect()
    x, y = np.array([[r.x, r.z, r.k] for r in got]), np.array([r.y for r in got])
    codes = B.binned(x, [B.thresholds(x[:, j], 31) for j in range(3)])
    tree = B.grow(codes, y, np.ones(len(y)), 6)
    assert np.allclose(B.value_of(codes, tree), [want[r.id] for r in got], atol=1e-9)


def test_a_grown_tree_parts_what_its_bins_part():
    codes = np.array([[0, 0], [0, 1], [1, 0], [1, 0], [2, 1]], dtype="uint8")
    tree = B.grow(codes, np.array([5.0, 7.0, 1.0, 3.0, -4.0]), np.array([1.0, 2.0, 1.0, 3.0, 1.0]), 30)
    assert np.allclose(B.value_of(codes, tree), [5, 7, 2.5, 2.5, -4])       # rows of one bin meet in their weighted mean
    assert np.allclose(B.value_of(codes, B.grow(codes, np.full(5, 0.1), np.ones(5), 30)), 0.1)


def test_a_capped_forest_takes_a_few_jobs_however_deep(spark, rows):
    """Spark's forest passes over all rows for every level and group of nodes."""
    sc = spark.sparkContext
    sc.setJobGroup("capped-forest", "fit")
    try:
        model = M.fit_forest(rows, ["x", "z", "k"], "y", num_trees=40, max_samples=200)
        jobs = len(sc.statusTracker().getJobIdsForGroup("capped-forest"))
    finally:
        sc.setJobGroup("", "")
    assert 0 < jobs <= 8 and len(model.trees) == 40
    again = M.fit_forest(rows, ["x", "z", "k"], "y", num_trees=40, max_samples=200)
    scored = model.predict(rows)
    assert scored.columns == [*rows.columns, "prediction"]
    got, same = ({r.id: r.prediction for r in m.predict(rows).collect()} for m in (model, again))
    assert got == same and len(got) == 600
    error, spread = scored.agg(F.avg((F.col("y") - F.col("prediction")) ** 2), F.var_pop("y")).first()
    assert error < 0.05 * spread


def test_rows_without_a_value_or_feature(spark, rows):
    """Rows without a label or with a missing feature are not fitted on; a missing feature is scored as larger than all."""
    odd = rows.withColumn("y", F.when(F.col("id") % 7 != 0, F.col("y"))).withColumn("x", F.when(F.col("id") % 5 != 0, F.col("x")))
    model = M.fit_forest(odd, ["x", "z", "k"], "y", num_trees=10, max_samples=10_000)
    a, b = (model.predict(rows.withColumn("x", v)).orderBy("id").select("prediction").collect() for v in (F.lit(None).cast("double"), F.lit(1e9)))
    assert a == b and all(np.isfinite(r.prediction) for r in a)
