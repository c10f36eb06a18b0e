"""Boosted trees from sums of weights: the trees of Spark's learner, shared passes, and no cached rows."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from tallyforge.ml import trees as T
from tallyforge.ml import tune as Tu
from tallyforge.ml.boosting import AdaBoostClassifier, fit_together
from tallyforge.workspace import keep


def table(spark, n, classes=2, seed=1):
    """Dense and sparse vectors, equal values, a constant feature."""
    g = np.random.default_rng(seed)
    x = np.stack([g.normal(size=n).round(3), g.integers(0, 50, n) / 50, (g.random(n) < 0.3) * 1.0, g.integers(0, 7, n) * (g.random(n) < 0.5), np.zeros(n)], 1)
    s = x[:, 0] + 2 * x[:, 1] * x[:, 2] + 0.3 * x[:, 3] + g.normal(size=n) * 0.5
    y = np.digitize(s, np.quantile(s, np.arange(1, classes) / classes))
    rows = [(i, Vectors.dense(x[i]) if i % 2 else Vectors.sparse(5, {j: float(v) for j, v in enumerate(x[i]) if v}), float(y[i])) for i in range(n)]
    return keep(spark.createDataFrame(rows, ["id", "features", "label"]).repartition(3), "boost-test")


def text(model):
    return [re.sub(r"^.*\n", "", t.toDebugString) for t in model.trees]


@pytest.fixture
def no_row_is_cached(monkeypatch):
    monkeypatch.setattr(DataFrame, "persist", lambda *_: pytest.fail("rows are cached"))
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda *_: pytest.fail("Spark's learner caches all rows"))


def test_fits_cache_no_rows_and_share_their_passes(spark, monkeypatch, no_row_is_cached):
    df, passes = table(spark, 400), []
    real = T._pass
    monkeypatch.setattr(T, "_pass", lambda *a: passes.append(1) or real(*a))
    models = fit_together([AdaBoostClassifier(rounds=3), AdaBoostClassifier(rounds=2, maxDepth=2, algorithm="SAMME")], df)
    assert [len(m.trees) for m in models] == [3, 2] and len(passes) == 4
    boost = AdaBoostClassifier(rounds=2, maxDepth=2)
    passes.clear()
    grid = [{boost.algorithm: a, boost.learningRate: r} for a in ("SAMME", "SAMME.R") for r in (0.1, 1.0)]
    Tu.grid_search(boost, grid, BinaryClassificationEvaluator(), df, "id", folds=2, refit=False)
    assert len(passes) == 2 * 4


@pytest.mark.parametrize("n, classes, params", [
    (600, 2, {"rounds": 5, "maxDepth": 3, "checkpointInterval": 2}), (600, 3, {"rounds": 3, "maxDepth": 4, "algorithm": "SAMME", "learningRate": 0.1}),
    (25_000, 2, {"rounds": 3}), (25_000, 3, {"rounds": 2, "maxDepth": 4})])
def test_trees_are_those_of_sparks_learner(spark, n, classes, params):
    df, boost = table(spark, n, classes), AdaBoostClassifier(**params)
    got, want = boost.fit(df), boost._fit_wide(df)
    assert text(got) == text(want) and got.alphas == pytest.approx(want.alphas)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())
    found = got.transform(df).select("id", F.col("prediction").alias("p")).join(want.transform(df), "id")
    assert found.filter("p <> prediction").count() == 0


def test_stored_trees_and_rows_that_are_no_stored_table(spark, tmp_path):
    df = table(spark, 300)
    local = spark.createDataFrame(df.collect(), df.schema)
    model = AdaBoostClassifier(rounds=2, maxDepth=2).fit(local)
    model.write().save(str(tmp_path / "boost"))
    again = type(model).load(str(tmp_path / "boost"))
    assert text(again) == text(model) and again.transform(df).orderBy("id").collect() == model.transform(df).orderBy("id").collect()


def test_rows_a_tree_cannot_learn_from(spark):
    bad = spark.createDataFrame([(Vectors.dense(float("nan")), 1.0), (Vectors.dense(1.0), 0.0)], ["features", "label"])
    with pytest.raises(Exception, match="NaN"):
        AdaBoostClassifier(rounds=1).fit(bad)
    with pytest.raises(Exception):
        AdaBoostClassifier(rounds=1).fit(bad.withColumn("label", F.lit(None).cast("double")))
    separable = spark.createDataFrame([(Vectors.dense(float(i)), float(i > 5)) for i in range(10)], ["features", "label"])
    model = AdaBoostClassifier(rounds=5).fit(separable)
    assert model.alphas == [1.0]
