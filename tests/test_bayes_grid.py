from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.catalog import models as M
from tallyforge.functions.text import tally
from tallyforge.ml import bayesgrid as B
from tallyforge.ml import models as Mo
from tallyforge.ml import neighbours as N
from tallyforge.ml import prep as Pr
from tallyforge.ml import selection as Se
from tallyforge.ml import tune as Tu
from tallyforge.ml.bayesgrid import bayes_grid
from tallyforge.operators import textfeatures as T
from tallyforge.plans.messages import message_grid, message_model

LABELS = ["water", "fire", "never"]


def rows(spark, n=150):
    """Texts with rare and very common words, some without words, some equal; one id comes twice, one is null; a label with one class."""
    rng = np.random.default_rng(8)
    data = []
    for i in range(n):
        words = [f"word{int(x)}" for x in rng.zipf(1.4, 6) % 40] + (["street"] if i % 9 else [])
        text = "" if i % 31 == 0 else " ".join(words)
        data.append((None if i == 7 else i // 2 if i < 6 else i, text, int("word2" in words), int(len(set(words)) > 4), 0))
    return spark.createDataFrame(data, "id bigint, message string, water int, fire int, never int").coalesce(2).persist()


def test_scores_are_those_of_the_general_search_and_no_model_is_fitted_for_them(spark, monkeypatch):
    base, table = NaiveBayes(), rows(spark)
    pipeline = message_model(base, LABELS, parallelism=1)
    grid = message_grid(pipeline, {base.smoothing: (0.1, 1.0)}, max_df=(0.7, 1.0), max_features=(None, 12))[::3]
    want = Tu.grid_search(pipeline, grid, Mo.AllLabelsRight(LABELS), table, "id", folds=3, parallelism=4)[1].orderBy("setting").collect()
    monkeypatch.setattr(Mo.PerLabelClassifier, "_fit", lambda *_: pytest.fail("a model for each setting, fold and label"))
    got = bayes_grid(pipeline, grid, table, "id", folds=3).orderBy("setting").collect()
    assert [r[:2] for r in got] == [r[:2] for r in want] and len({r.mean_score for r in want}) > 2
    assert [r.mean_score for r in got] == pytest.approx([r.mean_score for r in want], abs=1e-12)


def test_labels_without_a_value_are_an_error(spark):
    base = NaiveBayes()
    pipeline = message_model(base, ["water"])
    table = spark.createDataFrame([(i, "a house", None if i == 3 else i % 2) for i in range(20)], "id bigint, message string, water int")
    with pytest.raises(ValueError, match="null"):
        bayes_grid(pipeline, [{base.smoothing: 1.0}], table, "id", folds=2)


def test_tally_counts_inside_the_row(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (None,), (["x"],)], "t array<string>")
    got = [r[0] and [tuple(p) for p in r[0]] for r in df.select(tally("t")).collect()]
    assert got == [[("a", 1), ("b", 2)], None, None, [("x", 1)]]


def test_documents_are_spread_by_their_number(spark):
    df = spark.range(3 * T.DOCUMENTS_A_TASK + 1)
    assert T.placed_by(df, "id").rdd.getNumPartitions() == 4


def test_blocks_of_an_index_grow_with_the_base_up_to_a_limit(spark):
    assert [N._block_size(n, 64) for n in (10, 40_000, 100_000, 10**7)] == [4096, 5000, 12_500, 32_768]
    assert N._block_size(10**7, 1000) == 4096
    base = spark.range(40_000).select("id", F.array(F.rand(1), F.rand(2)).alias("vector"))
    assert N.build_index(base).block == 5000


def test_label_models_read_as_many_parts_as_cores(spark, monkeypatch):
    seen = []
    real = Mo.PerLabelClassifier._fit_rows
    monkeypatch.setattr(Mo.PerLabelClassifier, "_fit_rows", lambda self, r, f: seen.append(r.rdd.getNumPartitions()) or real(self, r, f))
    table = spark.createDataFrame([(Vectors.dense(float(i % 3), 1.0), i % 2) for i in range(60)], ["features", "a"])
    Mo.PerLabelClassifier(NaiveBayes(), ["a"]).fit(table.repartition(50))
    assert seen == [spark.sparkContext.defaultParallelism]


def test_scaled_features_do_not_read_their_source_again(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def costly(x):
        calls.add(1)
        return float(x)

    scaled, _ = Pr.scale_features(spark.range(20).select("id", costly("id").alias("x"), (F.col("id") % 2).alias("churn")), key="id")
    Pr.fit_components(scaled)
    assert scaled.count() == 20 and calls.value == 20


def test_a_fitted_ranking_is_scored_and_a_grid_may_go_without_a_last_fit(spark, monkeypatch):
    table = spark.createDataFrame([(i, Vectors.dense(float(i % 7), float(i % 2)), float(i % 2)) for i in range(80)], ["id", "features", "label"])
    forest = RandomForestClassifier(seed=1, numTrees=3)
    model, fits = forest.fit(table), []
    want = Se.compare_with_top_features(forest, model, table, table, 1).collect()
    real = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, rows: fits.append(1) or real(self, rows))
    assert Se.compare_with_top_features(forest, model, table, table, 1, fitted=True).collect() == want and len(fits) == 1
    fits.clear()
    found = Tu.grid_search(forest, [{forest.maxDepth: 1}, {forest.maxDepth: 2}], BinaryClassificationEvaluator(), table, "id", folds=2, refit=False)
    assert found[0] is None and len(fits) == 4


def test_pairs_are_worked_off_in_lots_and_give_the_same_scores(spark, monkeypatch):
    base, table = NaiveBayes(), rows(spark)
    pipeline = message_model(base, LABELS, parallelism=1)
    grid = message_grid(pipeline, {base.smoothing: (0.1,)}, ngrams=(1,), max_df=(0.7,), max_features=(12,))
    want = bayes_grid(pipeline, grid, table, "id", folds=3).orderBy("setting").collect()
    monkeypatch.setattr(B, "PAIRS_AT_ONCE", 350)
    held, most, real = [], [], B.kept

    @contextmanager
    def kept(df, label, *by):
        with real(df, label, *by) as out:
            held.append(label)
            most.append(held.count("placed"))
            yield out
            held.remove(label)

    monkeypatch.setattr(B, "kept", kept)
    got = bayes_grid(pipeline, grid, table, "id", folds=3).orderBy("setting").collect()
    assert [r.mean_score for r in got] == pytest.approx([r.mean_score for r in want], abs=1e-12)
    assert max(most) == 1 and len(most) > 9 and not held


def test_message_grid_fits_all_labels(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(M, "bayes_grid", lambda pipeline, grid, train, *_, **__: seen.append((pipeline.getStages()[-1].labels, train.columns)))
    M.message_grid(spark, "/root/testdata/sf0.001")
    assert seen == [(M.LABELS, ["id", "message", *M.LABELS])]
