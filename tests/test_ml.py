import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.ml import evaluate as Ev
from tallyforge.ml import models as Mo
from tallyforge.ml import neighbours as N
from tallyforge.ml import prep as Pr
from tallyforge.ml import selection as Se
from tallyforge.ml import textmodel as Tm
from tallyforge.ml import tune as Tu
from tallyforge.ml.boosting import AdaBoostClassifier, AdaBoostModel
from tallyforge.ml.kernel import RandomFourierFeatures, kernel_svm, scale_gamma
from tallyforge.plans.messages import message_model
from tallyforge.sources.models import load_model, save_model
from tallyforge.streaming.scoring import score_stream


@pytest.fixture(scope="module")
def ring(spark):
    """Inside or outside a circle: no line separates it, trees and kernels do."""
    rng = np.random.default_rng(3)
    xy = rng.uniform(-1, 1, (600, 2))
    data = [(i, Vectors.dense(float(x), float(y)), float(x * x + y * y < 0.5)) for i, (x, y) in enumerate(xy)]
    return spark.createDataFrame(data, ["id", "features", "label"]).persist()


@pytest.fixture(scope="module")
def parts(ring):
    return Pr.split_by_key(ring, "id", 80, 1)


def score(model, test):
    return Ev.binary_scores(model.transform(test)).first()


def test_split_is_disjoint_complete_and_stable(ring):
    train, test = Pr.split_by_key(ring.repartition(7), "id", 80, 5)
    again, _ = Pr.split_by_key(ring, "id", 80, 5)
    ids = {r.id for r in train.collect()}
    assert ids == {r.id for r in again.collect()}
    assert ids | {r.id for r in test.collect()} == set(range(600)) and train.count() + test.count() == 600
    assert 420 < len(ids) < 540


def test_scaling(spark):
    df = spark.createDataFrame([(1, 0.0, 5.0), (2, 5.0, 5.0), (3, 10.0, None)], "id int, a double, k double")
    assert rows(Pr.min_max_scale(df, ["a", "k"])) == [(1, 0.0, 0.0), (2, 0.5, 0.0), (3, 1.0, None)]
    train, test = Pr.standardize(df.filter("id < 3"), [df.filter("id = 3")], ["a"])
    assert [r.a for r in train.orderBy("id").collect()] == [-1.0, 1.0] and test.first().a == 3.0


def test_components(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(200, 2))
    data = np.hstack([base, base @ rng.normal(size=(2, 3))])
    df = spark.createDataFrame([(Vectors.dense(x.tolist()),) for x in data], ["features"])
    model, shares = Pr.fit_components(df, 0.999)
    assert len(shares) == 2 and shares == sorted(shares, reverse=True)
    assert model.transform(df).first().pcaFeatures.size == 2
    with pytest.raises(ValueError):
        Pr.fit_components(df, 0.999, max_k=1)


@pytest.mark.parametrize("algorithm", ["SAMME", "SAMME.R"])
def test_boosting_beats_its_stump_and_the_baseline(parts, algorithm):
    train, test = parts
    one = score(AdaBoostClassifier(rounds=1, algorithm=algorithm).fit(train), test)
    many = score(AdaBoostClassifier(rounds=25, algorithm=algorithm, checkpointInterval=5).fit(train), test)
    assert many.accuracy > 0.85 and many.accuracy > one.accuracy
    assert many.f_beta > Ev.naive_baseline(test, "label").first().f_beta


def test_boosting_weights_follow_the_formula(spark):
    # One stump on x <= 1.5 errs on one of four rows: error 1/4, part ln 3.
    df = spark.createDataFrame([(Vectors.dense(float(x)), y) for x, y in [(0, 0.0), (1, 0.0), (2, 1.0), (3, 0.0)]], ["features", "label"])
    model = AdaBoostClassifier(rounds=1, algorithm="SAMME").fit(df)
    assert model.alphas == [pytest.approx(math.log(3))]


def test_boosting_stops_when_perfect_and_is_saved(spark, tmp_path):
    df = spark.createDataFrame([(Vectors.dense(float(x), 0.0), float(x > 4)) for x in range(10)], ["features", "label"])
    model = AdaBoostClassifier(rounds=20).fit(df)
    assert len(model.trees) == 1 and model.featureImportances.toArray().tolist() == [1.0, 0.0]
    path = save_model(model, str(tmp_path / "m"))
    again = load_model(path, AdaBoostModel)
    assert again.transform(df).filter("prediction <> label").count() == 0
    assert again.getOrDefault("rounds") == 20


def test_models_of_all_labels_and_boosting_are_stored_in_pipelines(spark, ring, tmp_path):
    from pyspark.ml import Pipeline

    rows_ = ring.select("id", "features", "label", (1 - F.col("label")).alias("other"))
    for i, base in enumerate((LogisticRegression(), AdaBoostClassifier(rounds=3))):
        model = Pipeline(stages=[Mo.PerLabelClassifier(base, ["label", "other"])]).fit(rows_)
        again = load_model(save_model(model, str(tmp_path / f"per-label-{i}")))
        names = ["id", "prediction_label", "prediction_other"]
        assert rows(again.transform(rows_).select(names)) == rows(model.transform(rows_).select(names))


def test_samples_do_not_depend_on_partitions(spark):
    from tallyforge.operators.clean import sample_rows

    df = spark.range(3000).select("id", (F.col("id") % 3).cast("double").alias("label"))
    taken = [rows(Pr.stratified_sample(df.repartition(n), "label", {0.0: 0.8, 1.0: 0.2}, key=["id"])) for n in (4, 7, 13)]
    assert taken[0] == taken[1] == taken[2] and {r[1] for r in taken[0]} == {0.0, 1.0}
    assert rows(sample_rows(df.repartition(4), 0.1)) == rows(sample_rows(df.repartition(9), 0.1))


def test_kernel_svm_learns_the_circle(parts):
    train, test = parts
    gamma = scale_gamma(train)
    both = np.array([r.features.toArray() for r in train.collect()])
    assert gamma == pytest.approx(1 / (2 * both.var()), rel=1e-9)
    model = kernel_svm(train.count(), gamma=gamma, c=10.0, dimensions=128).fit(train)
    assert score(model, test).accuracy > 0.9


def test_fourier_features_approach_the_kernel(spark):
    dense = [Vectors.dense(0.5, 0.0, -0.2), Vectors.dense(0.1, 0.4, 0.0)]
    sparse = [Vectors.sparse(3, {0: 0.5, 2: -0.2}), Vectors.sparse(3, {0: 0.1, 1: 0.4})]
    z = []
    for kind in (dense, sparse):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(kind)], ["i", "features"])
        out = RandomFourierFeatures(gamma=0.7, dimensions=4096, seed=1).transform(df).orderBy("i").collect()
        z.append([r.fourier.toArray() for r in out])
    assert np.allclose(z[0], z[1])
    distance = ((dense[0].toArray() - dense[1].toArray()) ** 2).sum()
    assert z[0][0] @ z[0][1] == pytest.approx(math.exp(-0.7 * distance), abs=0.05)


def test_neighbours_equal_brute_force_in_small_blocks(spark):
    rng = np.random.default_rng(5)
    points = rng.integers(0, 6, (150, 3)).astype(float)  # many ties
    df = spark.createDataFrame([(i, p.tolist(), int(i % 3)) for i, p in enumerate(points)], "id bigint, vector array<double>, label int")
    got = N.nearest(df, df, 4, label="label", block=40, leave_out_self=True)
    expected = []
    for i, p in enumerate(points):
        d = np.sqrt(((points - p) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((np.arange(150), d)) if j != i][:4]
        expected += [(i, j, r) for r, j in enumerate(order, 1)]
    assert [(r.query_id, r.neighbour_id, r["rank"]) for r in got.orderBy("query_id", "rank").collect()] == expected
    votes = spark.createDataFrame([(1, 2), (1, 2), (1, 0), (2, 1), (2, 0)], "query_id int, label int")
    assert rows(N.vote(votes)) == [(1, 2), (2, 0)]


def test_metrics_with_an_unused_class(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 3 + [(1.0, 0.0)] + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 4 + [(2.0, 0.0)], "label double, prediction double")
    got = {r["class"]: r for r in Ev.class_metrics(df).collect()}
    assert (got[1.0].precision, got[1.0].recall, got[1.0].support) == (0.6, 0.75, 4)
    assert got[1.0].f05 == pytest.approx(1.25 * 0.6 * 0.75 / (0.25 * 0.6 + 0.75))
    assert (got[2.0].precision, got[2.0].recall, got[2.0].f1) == (0.0, 0.0, 0.0)
    assert got[0.0].accuracy == pytest.approx(7 / 11)


def test_label_report_with_a_label_never_predicted(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), ("b", 1, 0), ("b", 0, 0)], "label_name string, y int, p int")
    got = {(r.label_name, r["class"]): r for r in Ev.label_report(df).collect()}
    assert (got["b", 1].precision, got["b", 1].f1, got["a", 1].precision) == (0.0, 0.0, 0.5)
    assert tuple(Ev.average_scores(df).first()) == (0.5, pytest.approx(1 / 3))


def test_named_models_and_unknown_name(parts):
    train, test = parts
    _, predictions, metrics = Mo.train_and_evaluate(train, test, "RandomForestClassifier")
    assert predictions.count() == test.count() and metrics.first().area_under_pr > 0.9
    with pytest.raises(ValueError, match="unknown classifier"):
        Mo.classifier("SomethingElse")


def test_linear_model_and_cutoffs(spark):
    random.seed(1)
    data = [(i, float(i % 7), float(i % 3), 1.0 if i == 0 else 0.0, 2.0 * (i % 7) - (i % 3) + 1) for i in range(100)]
    df = spark.createDataFrame(data, "id int, a double, b double, rare double, y double")
    train, test = Pr.split_by_key(df, "id", 70)
    test_r2, train_r2, model = Mo.train_linear(train, test, ["a", "b"], "y")
    assert (test_r2, train_r2) == (pytest.approx(1.0), pytest.approx(1.0))
    assert [r.est_int for r in Mo.coefficient_table(spark, model, ["a", "b"]).collect()] == ["a", "b"]
    scores, best, (_, kept) = Mo.best_cutoff(train, test, ["a", "b", "rare"], "y", [5, 200, 10_000])
    assert [(r.cutoff, r.n_features) for r in scores.collect()] == [(5.0, 2), (200.0, 1)]
    assert best == 5.0 and kept == ["a", "b"]


def test_grid_search_and_learning_curve(parts):
    train, test = parts
    forest = RandomForestClassifier(seed=1, numTrees=5)
    grid = [{forest.maxDepth: 1}, {forest.maxDepth: 5}]
    model, table, best = Tu.grid_search(forest, grid, BinaryClassificationEvaluator(), train, "id")
    assert best == grid[1] and table.count() == 2 and score(model, test).accuracy > 0.85
    curve = Tu.learning_curve({"forest": forest}, train, test, "id", permille=(100, 1000), head=30).collect()
    assert [r.sample_permille for r in curve] == [100, 1000] and curve[1].acc_test > 0.8


def test_importances_and_selection(spark, ring):
    wide = ring.withColumn("features", F.udf(lambda v: Vectors.dense([0.0, *v.toArray().tolist()]), ring.schema["features"].dataType)("features"))
    model = RandomForestClassifier(seed=1).fit(wide)
    assert sum(model.featureImportances.toArray()) == pytest.approx(1.0)
    top = Ev.importances(spark, model, ["constant", "x", "y"], 2).orderBy("rank").collect()
    assert {r.feature for r in top} == {"x", "y"} and top[1].cumulative == pytest.approx(1.0)
    both = Se.compare_with_top_features(RandomForestClassifier(seed=1), model, wide, wide, 2).collect()
    assert [r.features_used for r in both] == ["all", "top2"]


TEXTS = [(i, ("water pipe broken street" if i % 2 else "fire house burning") + f" w{i % 5}", i % 2, int(i % 4 == 0)) for i in range(60)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id bigint, message string, water int, rare int")


def test_vector_tf_idf_equals_long_form(spark, texts):
    from tallyforge.functions.text import content_words
    from tallyforge.operators.textfeatures import tf_idf
    fitted = Tm.tf_idf_pipeline().fit(texts)
    words = {r.term_id: r.term for r in fitted.stages[1].index.collect()}
    vectors = {r.id: {words[i]: v for i, v in zip(r.features.indices, r.features.values)} for r in fitted.transform(texts).collect()}
    for r in tf_idf(texts, "id", content_words("message")).collect():
        assert vectors[r.id][r.term] == pytest.approx(r.weight)


def test_per_label_models_grid_and_stream(spark, texts, tmp_path):
    labels = ["water", "rare"]
    pipeline = message_model(LogisticRegression(maxIter=10), labels)
    scored = pipeline.fit(texts).transform(texts)
    assert Mo.AllLabelsRight(["water"]).evaluate(scored) == 1.0
    assert "rawPrediction" not in scored.columns
    terms, counts = pipeline.getStages()[:2]
    _, table, _ = Tu.grid_search(pipeline, [{terms.ngrams: 1, counts.vocabSize: 2}, {terms.ngrams: 2, counts.vocabSize: 500}],
                                 Mo.AllLabelsRight(["water"]), texts, "id", parallelism=2)
    assert [r.setting for r in table.orderBy("setting").collect()] == [0, 1]

    from pyspark.ml import Pipeline
    model = Pipeline(stages=[*Tm.tf_idf_stages(), LogisticRegression(labelCol="water")]).fit(texts)
    path = save_model(model, str(tmp_path / "model"))
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    texts.select("id", "message").repartition(3).write.parquet(source)
    query = score_stream(spark, load_model(path), source, texts.select("id", "message").schema, sink, str(tmp_path / "cp"), ["id"], files_per_batch=1)
    query.awaitTermination()
    got = spark.read.parquet(sink)
    assert got.count() == 60 and got.select("batch").distinct().count() == 3
    assert got.join(texts, "id").filter("prediction <> water").count() == 0
    spark.createDataFrame([(99, "fire house")], "id bigint, message string").write.mode("append").parquet(source)
    score_stream(spark, model, source, texts.select("id", "message").schema, sink, str(tmp_path / "cp"), ["id"]).awaitTermination()
    assert spark.read.parquet(sink).count() == 61
    assert array_to_vector is not None
