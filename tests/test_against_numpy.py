"""Fitted results against plain numpy on small tables, and keys that hold a third of all rows."""

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyforge.ml import prep as Pr
from tallyforge.ml.boosting import AdaBoostClassifier
from tallyforge.ml.evaluate import area_under_pr
from tallyforge.ml.models import classifier
from tallyforge.operators import behavior as B
from tallyforge.operators import choices as Ch
from tallyforge.operators import clean as C


def frame(spark, x, y):
    return spark.createDataFrame([(Vectors.dense(a.tolist()), float(b)) for a, b in zip(x, y)], ["features", "label"])


def gini_stump(x, y, w):
    """Best weighted stump by Gini impurity: (feature, threshold, class probabilities left, right)."""
    best = None
    for j in range(x.shape[1]):
        cuts = np.unique(x[:, j])
        for cut in (cuts[1:] + cuts[:-1]) / 2:
            left = x[:, j] <= cut
            impurity, sides = 0.0, []
            for side in (left, ~left):
                p = np.array([w[side & (y == k)].sum() for k in (0, 1)])
                impurity += p.sum() * (1 - ((p / p.sum()) ** 2).sum())
                sides.append(p / p.sum())
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, j, cut, *sides)
    return best[1:]


@pytest.fixture(scope="module")
def stepped():
    rng = np.random.default_rng(11)
    x = rng.integers(0, 12, (300, 3)).astype(float)
    y = ((x[:, 0] + x[:, 1] * 0.7 + rng.normal(0, 1.5, 300)) > 10).astype(float)
    return x, y


def test_samme_follows_its_rounds(spark, stepped):
    x, y = stepped
    model = AdaBoostClassifier(rounds=6, algorithm="SAMME", learningRate=0.5).fit(frame(spark, x, y))
    w, votes, alphas = np.ones(300), np.zeros(300), []
    for _ in range(6):
        j, cut, left, right = gini_stump(x, y, w)
        predicted = np.where(x[:, j] <= cut, left.argmax(), right.argmax())
        error = w[predicted != y].sum() / w.sum()
        alpha = 0.5 * np.log((1 - error) / error)
        alphas.append(alpha)
        votes += alpha * np.where(predicted == 1, 1, -1)
        w = w * np.exp(alpha * (predicted != y))
    assert model.alphas == pytest.approx(alphas)
    got = [r.prediction for r in model.transform(frame(spark, x, y)).collect()]
    assert got == [float(v > 0) for v in votes]


def test_samme_r_follows_its_rounds(spark, stepped):
    x, y = stepped
    model = AdaBoostClassifier(rounds=5, algorithm="SAMME.R").fit(frame(spark, x, y))
    w, score = np.ones(300), np.zeros((300, 2))
    for _ in range(5):
        j, cut, left, right = gini_stump(x, y, w)
        logs = np.log(np.maximum(np.where((x[:, j] <= cut)[:, None], left, right), np.finfo(float).eps))
        score += logs - logs.mean(axis=1, keepdims=True)
        coding = np.where(y[:, None] == np.arange(2), 1.0, -1.0)
        w = w * np.exp(-0.5 * (coding * logs).sum(axis=1))
    raw = np.array([r.rawPrediction.toArray() for r in model.transform(frame(spark, x, y)).collect()])
    assert raw == pytest.approx(score / 5)


def test_components_and_correlation(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 4))
    df = frame(spark, x, np.zeros(120))
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    _, shares = Pr.fit_components(df, 0.9)
    assert shares == pytest.approx((values / values.sum())[:len(shares)])
    assert sum(shares) >= 0.9 > sum(shares[:-1])
    r = np.corrcoef(x.T)
    got = {(c.a, c.b): c.r for c in Pr.vector_correlations(df, list("abcd")).collect()}
    assert got["a", "d"] == pytest.approx(r[0, 3]) and len(got) == 10


def test_gaussian_naive_bayes(spark, stepped):
    x, y = stepped
    model = classifier("GaussianNB").fit(frame(spark, x, y))
    logs = []
    for k in (0, 1):
        part = x[y == k]
        mean, var = part.mean(axis=0), part.var(axis=0) + 1e-9 * x.var(axis=0).max()
        logs.append(np.log(len(part) / len(x)) - 0.5 * (np.log(2 * np.pi * var) + (x - mean) ** 2 / var).sum(axis=1))
    got = [r.prediction for r in model.transform(frame(spark, x, y)).collect()]
    assert got == [float(v) for v in np.argmax(logs, axis=0)]


def test_area_under_pr(spark):
    df = spark.createDataFrame([(Vectors.dense(-s, s), y) for s, y in [(0.9, 1.0), (0.8, 0.0), (0.7, 1.0), (0.1, 0.0)]], ["rawPrediction", "label"])
    # precision-recall points (0, 1), (.5, 1), (.5, .5), (1, 2/3), (1, .5), joined by straight lines
    assert area_under_pr(df) == pytest.approx(0.5 + 0.5 * (0.5 + 2 / 3) / 2)


def test_sample_by_class(spark):
    df = spark.range(4000).select("id", (F.col("id") % 4 == 0).cast("double").alias("label"))
    got = {r.label: r["count"] for r in Pr.stratified_sample(df, "label", {0.0: 0.8, 1.0: 0.8}).groupBy("label").count().collect()}
    assert got[0.0] == pytest.approx(2400, rel=0.06) and got[1.0] == pytest.approx(800, rel=0.1)
    both = df.filter("id < 10")
    assert rows(Pr.all_but(both, both.filter("id % 2 = 0")).select("id")) == [(1,), (3,), (5,), (7,), (9,)]


def test_a_user_with_a_third_of_all_events(spark):
    n = 9000
    log = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("bigint").alias("userId"), (F.col("id") % 11).alias("sessionId"),
        F.col("id").alias("itemInSession"), F.when(F.col("id") == 3, "Cancellation Confirmation").otherwise("NextSong").alias("page"),
        (F.col("id") * 1000).alias("ts"), F.lit(0).cast("bigint").alias("registration"), F.lit(1.0).alias("length"),
        F.lit("free").alias("level"), F.lit("2018-10-01").cast("date").alias("monthStart"), F.lit(1).alias("month"), F.lit(1).alias("date"),
    ).repartition(6)
    labelled = B.label_churn(log)
    assert labelled.count() == n and labelled.filter("churn = 1").count() == n // 3
    hot = B.user_features(log, ["NextSong"], {"level": ["free"]}).filter("userId = 0").first()
    assert (hot.levelfree, hot.NextSongPageMonth, hot.churn, hot.avgSessionsMonth) == (3000, 2999.0, 1, 11.0)
    freq = B.churn_frequency(log, B.churned_users(log), ["page"])
    assert rows(freq.select("value", "churn", "n")) == [("Cancellation Confirmation", 1, 1), ("NextSong", 0, 6000), ("NextSong", 1, 2999)]


def test_a_choice_and_a_text_with_a_third_of_all_rows(spark):
    df = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot;hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("message")).repartition(6)
    counts = Ch.choice_counts(df, "message")
    assert counts.count() == 4001 and counts.filter("choice = 'hot'").first().n == 4000
    assert C.first_per_key(df, "message", ["id"]).count() == 4001
