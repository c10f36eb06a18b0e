import numpy as np
import pytest
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.ml import models as Mo
from tallyforge.ml import textmodel as Tm
from tallyforge.ml import tune as Tu
from tallyforge.ml.kernel import KernelSVM, KernelSVMModel
from tallyforge.operators import profile as P
from tallyforge.plans.messages import message_grid, message_model

WORDS = ["water", "pipe", "street", "fire", "house", "food", "road", "rain"]


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(120):
        words = [WORDS[j] for j in rng.integers(0, 8, 5)]
        data.append((i, " ".join(words), int("water" in words), int("fire" in words)))
    return spark.createDataFrame(data, "id bigint, message string, water int, fire int").coalesce(2).persist()


@pytest.fixture(scope="module")
def circles(spark):
    rng = np.random.default_rng(3)
    xy = rng.uniform(-1, 1, (600, 2))
    data = [(i, Vectors.dense(float(x), float(y)) if i % 2 else Vectors.sparse(2, {0: float(x), 1: float(y)}), float(x * x + y * y < 0.5), float(x > 0))
            for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(data, ["id", "features", "label", "right"]).coalesce(2).persist()


def plain_search(estimator, grid, evaluator, rows, folds=3):
    """Every setting fitted as a whole in every fold."""
    marked = rows.withColumn("_fold", Tu.fold_of("id", folds)).persist()
    scores = [[evaluator.evaluate(estimator.fit(marked.filter(F.col("_fold") != f).drop("_fold"), s).transform(
        marked.filter(F.col("_fold") == f).drop("_fold"))) for f in range(folds)] for s in grid]
    return [sum(s) / folds for s in scores]


def test_shared_stages_run_once_and_scores_are_those_of_the_plain_search(spark, texts, monkeypatch):
    base = LogisticRegression(maxIter=5)
    pipeline = message_model(base, ["water", "fire"])
    grid = message_grid(pipeline, {base.regParam: [0.0, 0.5]}, max_features=(6,))
    assert len(grid) == 8 and len(message_grid(pipeline, {base.regParam: [0.0, 0.5]})) == 16
    runs = {"terms": 0, "vectors": 0, "models": 0}

    def counted(cls, method, name):
        real = getattr(cls, method)

        def run(self, *args):
            runs[name] += 1
            return real(self, *args)

        monkeypatch.setattr(cls, method, run)

    counted(Tm.MessageTerms, "_transform", "terms")
    counted(Tm.TermVectors, "_fit", "vectors")
    counted(Mo.PerLabelClassifier, "_fit", "models")
    evaluator = Mo.AllLabelsRight(["water", "fire"])
    _, table, best = Tu.grid_search(pipeline, grid, evaluator, texts, "id", folds=2)
    # two n-grams for all folds; 2 x 2 vocabularies and 8 models a fold; and the refit
    assert runs == {"terms": 2 + 1, "vectors": 4 * 2 + 1, "models": 8 * 2 + 1}
    some = [0, 5]
    scores = [r.mean_score for r in table.orderBy("setting").collect()]
    assert [scores[g] for g in some] == pytest.approx(plain_search(pipeline, [grid[g] for g in some], evaluator, texts, 2))
    assert best == grid[max(range(8), key=lambda g: scores[g])]


class Shift(Transformer):
    def _transform(self, dataset):
        return dataset.withColumn("moved", F.col("id") + 1)


def test_a_search_without_a_pipeline_and_equal_settings(spark, circles):
    bayes = NaiveBayes(modelType="gaussian")
    grid = [{bayes.smoothing: 0.1}, {bayes.smoothing: 0.1}, {bayes.smoothing: 1.0}]
    evaluator = BinaryClassificationEvaluator()
    _, table, best = Tu.grid_search(bayes, grid, evaluator, circles, "id", folds=2)
    scores = [r.mean_score for r in table.orderBy("setting").collect()]
    assert scores[0] == scores[1] and scores[2:] == pytest.approx(plain_search(bayes, grid[2:], evaluator, circles, 2))
    assert best == grid[0]
    assert Tu.grid_search(Pipeline(stages=[Shift(), bayes]), grid, evaluator, circles, "id", folds=2)[2] == best


def share_right(rows, label="label", prediction="prediction"):
    return rows.agg(F.avg((F.col(label) == F.col(prediction)).cast("double"))).first()[0]


def test_kernel_svm_on_circles_stored_and_by_label(spark, circles, tmp_path):
    kernel = KernelSVM(gamma=2.0, c=10.0, dimensions=64, maxIter=15)
    model = kernel.fit(circles)
    scored = model.transform(circles)
    assert share_right(scored) > 0.95 > 0.75 > share_right(LinearSVC(maxIter=20).fit(circles).transform(circles))
    assert set(scored.columns) == {*circles.columns, "rawPrediction", "prediction"}
    model.write().save(str(tmp_path / "kernel"))
    again = KernelSVMModel.load(str(tmp_path / "kernel"))
    assert again.transform(circles).orderBy("id").collect() == scored.orderBy("id").collect()
    labels = ["label", "right"]
    both = Mo.PerLabelClassifier(kernel, labels).fit(circles).transform(circles)
    assert min(share_right(both, c, f"prediction_{c}") for c in labels) > 0.95
    grid = [{kernel.gamma: g, kernel.c: c} for g, c in [(0.001, 1.0), (2.0, 10.0)]]
    _, _, best = Tu.grid_search(Mo.PerLabelClassifier(kernel, labels), grid, Mo.AllLabelsRight(labels), circles, "id", folds=2)
    assert best[kernel.gamma] == 2.0


def test_correlations_of_many_columns_by_group(spark):
    rng = np.random.default_rng(1)
    n, d = 300, 200
    x = rng.normal(size=(n, d)) + rng.normal(size=(n, 1)) + 1e6 * rng.integers(0, 3, d)
    x[:, 7], x[:, 8] = 0.1, np.where(np.arange(n) % 2 == 0, 0.3, x[:, 8])
    holes = rng.random((n, d)) < 0.1
    rows = [(int(i % 2) if i % 10 else None, *[None if h else float(v) for v, h in zip(x[i], holes[i])]) for i in range(n)]
    df = spark.createDataFrame(rows, "part int, " + ", ".join(f"c{i} double" for i in range(d))).repartition(5)
    found = P.correlations(df, [f"c{i}" for i in range(d)], by="part")
    got = {(r.part, r.a, r.b): r.r for r in found.collect()}
    assert len(got) == 3 * d * (d + 1) // 2
    part = np.array([-1 if r[0] is None else r[0] for r in rows])
    for key in (None, 0, 1):
        of = part == (-1 if key is None else key)
        for i in (0, 3, 7, 8, 150):
            for j in (3, 7, 8, 150, 199):
                if i <= j:
                    both = of & ~holes[:, i] & ~holes[:, j]
                    a, b = x[both, i], x[both, j]
                    want = None if np.ptp(a) == 0 or np.ptp(b) == 0 else np.corrcoef(a, b)[0, 1]
                    assert got[key, f"c{i}", f"c{j}"] == (want if want is None else pytest.approx(want, abs=1e-7)), (key, i, j)
    assert P.correlations(df.filter("false"), ["c0", "c1"]).collect() == []
