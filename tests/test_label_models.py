"""Gaussian naive Bayes of all labels, links of predicted labels, and the exact area under precision over recall."""

import math
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyforge.ml import evaluate as Ev
from tallyforge.ml import score as Sc
from tallyforge.ml.bayes import GaussianLabels, GaussianLabelsModel, label_statistics
from tallyforge.sources.models import load_model, save_model
from tallyforge.streaming.scoring import link_stream

LABELS = ["a", "b", "three", "same", "absent"]


@pytest.fixture(scope="module")
def data(spark):
    r = random.Random(4)
    out = []
    for i in range(400):
        a, three = i % 2, i % 3
        out.append((i, r.gauss(3 * a, 1), None if i % 50 == 0 else r.gauss(three * 4, 1), 7.0, a, None if i % 10 == 0 else int(i < 30), three, 1, None))
    return spark.createDataFrame(out, "id bigint, x double, `y y` double, flat double, a int, b int, three int, same int, absent int").repartition(5)


FEATURES = ["x", "y y", "flat"]


def test_statistics_are_those_of_each_class(data):
    found = {(r.label_name, r["class"]): r for r in label_statistics(data, FEATURES, LABELS).collect()}
    assert found[(None, None)].n == 400 and found[("b", 1)].n == 27 and ("absent", None) not in found
    xs = [r.x for r in data.filter("a = 1").collect()]
    mean = sum(xs) / len(xs)
    assert found[("a", 1)].means[0] == pytest.approx(mean)
    assert found[("a", 1)].variances[0] == pytest.approx(sum((x - mean) ** 2 for x in xs) / len(xs))


def test_fit_is_one_aggregate_whatever_the_labels(spark, data):
    plan = label_statistics(data, FEATURES, LABELS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Generate explode") == 1


def test_predictions_of_hard_columns_and_storage(spark, data, tmp_path):
    model = GaussianLabels(FEATURES, LABELS).fit(data)
    again = load_model(save_model(model, str(tmp_path / "bayes")), GaussianLabelsModel)
    first, second = ([tuple(r) for r in m.transform(data).orderBy("id").collect()] for m in (model, again))
    assert first == second
    scored = model.transform(data)
    assert scored.filter("prediction_a <> a").count() < 60
    assert scored.filter("prediction_three <> three AND `y y` IS NOT NULL").count() < 40
    assert scored.filter("prediction_a IS NULL").count() == scored.filter("`y y` IS NULL").count() == 8
    assert rows(scored.select("prediction_same", "score_same", "prediction_absent").distinct()) == [(1.0, None, None)]
    assert all(math.isfinite(r.score_three) for r in scored.filter("`y y` IS NOT NULL").collect())
    tie = spark.createDataFrame([(0.0, 0), (0.0, 1)], "x double, a int")
    assert GaussianLabels(["x"], ["a"]).fit(tie).transform(tie).filter("prediction_a = 0").count() == 2
    assert GaussianLabels(["x"], ["a"]).fit(tie.limit(0)).transform(tie).filter("prediction_a IS NULL").count() == 2


def test_links_in_batch_and_stream_and_a_batch_run_twice(spark, data, tmp_path):
    labels, links = ["a", "b"], Sc.advice_links(spark, {"a": "link of a"})
    model = GaussianLabels(["x"], labels).fit(data)
    batch = rows(Sc.links_of_predicted_labels(model, data, "id", labels, links))
    assert {b[1:] for b in batch} <= {("a", "link of a"), ("b", None)} and len(batch) > 100
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    data.select("id", "x").repartition(3).write.parquet(source)
    for progress in ("one", "two"):  # the second run starts anew, as after a lost checkpoint, and replaces the same batches
        link_stream(spark, model, source, data.select("id", "x").schema, sink, str(tmp_path / progress), "id", labels, links).awaitTermination()
    found = spark.read.schema("id bigint, label_name string, link string, batch int").parquet(sink)
    assert rows(found.select("id", "label_name", "link")) == batch


def plain_area(pairs):
    area, tp, seen, before, every = 0.0, 0, 0, None, sum(y for y, _ in pairs)
    for s in sorted({s for _, s in pairs}, reverse=True):
        hits = sum(y for y, t in pairs if t == s)
        tp, seen = tp + hits, seen + sum(1 for _, t in pairs if t == s)
        precision = tp / seen
        area += hits / every * (precision + (precision if before is None else before)) / 2
        before = precision
    return area


@pytest.mark.parametrize("values", [5, 10**6])
def test_area_is_exact(spark, values):
    r = random.Random(values)
    pairs = [(int(r.random() < 0.3), float(r.randrange(values))) for _ in range(3000)] + [(1, 2.0)] * 1500
    df = spark.createDataFrame([*pairs, (None, 1.0), (1, None)], "y int, s double").repartition(6)
    assert Ev.precision_recall_area(df, "y", "s").first().area == pytest.approx(plain_area(pairs), abs=1e-12)


def test_area_without_rows_of_class_one(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0)], "y int, s double")
    assert Ev.precision_recall_area(df, "y", "s").first().area is None
    assert Ev.precision_recall_area(df.limit(0), "y", "s").first().area is None
    assert Ev.precision_recall_area(df.withColumn("y", F.lit(1)), "y", "s").first().area == 1.0
