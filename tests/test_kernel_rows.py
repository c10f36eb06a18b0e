"""Kernel SVM on rows that stand for several equal rows: the model of the rows one by one."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.catalog import models
from tallyforge.ml import evaluate as Ev
from tallyforge.ml.kernel import KernelSVM, RandomFourierFeatures, kernel_svm, scale_gamma


@pytest.fixture(scope="module")
def kinds(spark):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(300, 2))
    made = [(Vectors.dense(p), float(p[0] * p[1] > 0), int(n)) for p, n in zip(points, rng.integers(1, 40, 300) ** 2 // 40 + 1)]
    return spark.createDataFrame(made, ["features", "label", "n"])


def test_weighted_rows_give_the_model_of_single_rows(kinds):
    single = kinds.withColumn("one", F.explode(F.expr("sequence(1L, n)")))
    gamma = scale_gamma(kinds, weight="n")
    assert gamma == pytest.approx(scale_gamma(single), rel=1e-9)
    want = kernel_svm(single.count(), gamma, dimensions=32, max_iter=20).fit(single).stages[1]
    got = KernelSVM(weightCol="n", dimensions=32, maxIter=20).fit(kinds).linear
    assert np.allclose(got.coefficients.toArray(), want.coefficients.toArray(), rtol=1e-4, atol=1e-4)
    assert got.intercept == pytest.approx(want.intercept, rel=1e-4, abs=1e-4)


def test_weighted_scores_are_those_of_single_rows(spark):
    rows = spark.createDataFrame([(1.0, 1.0, 3), (1.0, 0.0, 2), (0.0, 0.0, 5), (0.0, 1.0, 1), (None, 1.0, 4)], "label double, prediction double, n int")
    single = rows.withColumn("one", F.explode(F.expr("sequence(1, n)")))
    assert Ev.binary_scores(rows, weight="n").first() == Ev.binary_scores(single).first()
    assert Ev.binary_scores(rows.filter("false"), weight="n").first() == Ev.binary_scores(rows.filter("false")).first()


def test_dense_and_sparse_vectors_of_one_block(spark):
    kinds = [Vectors.dense(0.5, 0.0, -0.2), Vectors.sparse(3, {0: 0.5, 2: -0.2}), Vectors.sparse(3, {}), Vectors.dense(0.0, 0.0, 0.0)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(kinds * 200)], ["i", "features"]).coalesce(1)
    z = [r.fourier.toArray() for r in RandomFourierFeatures(gamma=0.7, dimensions=16, seed=1).transform(df).orderBy("i").collect()]
    assert np.allclose(z[0], z[1]) and np.allclose(z[2], z[3]) and not np.allclose(z[0], z[2])
    assert np.allclose(z, z[:4] * 200)


def test_fit_rows_do_not_grow_with_copies_of_people(spark, tmp_path):
    rng = np.random.default_rng(8)
    lines = [(int(i), int(i % 3), float(rng.integers(1, 50)), float(rng.integers(1, 125) * 1000), 0.06 if i % 4 else 0.0, 0.02 * (i % 3), "ANR"[i % 3], "FO"[i % 2])
             for i in range(400)]
    names = "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    table = spark.createDataFrame(lines, names)
    for copies in (1, 30):
        copied = table.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn("l_orderkey", F.expr("l_orderkey + 1000 * k")).drop("k")
        copied.write.parquet(str(tmp_path / str(copies) / "lineitem.parquet"))
    train, test, _ = models.alike_census_parts(spark, str(tmp_path / "30"))
    assert train.count() <= 400 and test.count() <= 400
    assert train.agg(F.sum("n")).first()[0] + test.agg(F.sum("n")).first()[0] == 30 * 400
    plain_train, plain_test, _ = models.census_parts(spark, str(tmp_path / "30"))
    plain = kernel_svm(plain_train.count(), scale_gamma(plain_train), dimensions=64, max_iter=20).fit(plain_train)
    want = Ev.binary_scores(plain.transform(plain_test)).first()
    got = models.kernel_svm_scores(spark, str(tmp_path / "30")).first()
    assert tuple(got)[1:] == pytest.approx(tuple(want))
