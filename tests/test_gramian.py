"""Least squares from moments against numpy, with collinear and constant columns and far means."""

import numpy as np
import pytest

from tallyforge.ml import gramian as G
from tallyforge.ml import models as Mo


@pytest.fixture(scope="module")
def parts(spark):
    g = np.random.default_rng(8)
    x = g.normal(size=(900, 4)) * [1, 50, 0.01, 1] + [0, 1e6, 3, 5]
    x = np.column_stack([x, x[:, 0] * 2 - x[:, 2], np.full(900, 7.0)])  # the fifth is made of others, the sixth is constant
    y = 3 + x[:, 0] * 2 - x[:, 1] * 0.1 + g.normal(size=900)
    names = ["a", "b b", "c", "d", "e", "f"]
    frame = lambda z, t: spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(z, t)] + [(None, *[1.0] * 6)],
                                               ", ".join(f"`{c}` double" for c in [*names, "y"])).repartition(3)
    return frame(x[:600], y[:600]), frame(x[600:], y[600:]), names, x, y


def plain(x, y, used):
    z = np.column_stack([np.ones(len(x)), x[:, used]])
    return np.linalg.lstsq(z, y, rcond=None)[0]


def score(b, x, y, used):
    rest = y - np.column_stack([np.ones(len(x)), x[:, used]]) @ b
    return 1 - (rest**2).sum() / ((y - y.mean())**2).sum()


def test_fit_and_scores(parts):
    train, test, names, x, y = parts
    test_r2, train_r2, fit = Mo.train_linear(train, test, names[:4], "y")
    want = plain(x[:600], y[:600], [0, 1, 2, 3])
    assert np.allclose(fit.coefficients, want[1:], rtol=1e-6) and fit.intercept == pytest.approx(want[0], rel=1e-6)
    assert train_r2 == pytest.approx(score(want, x[:600], y[:600], [0, 1, 2, 3]), abs=1e-8)
    assert test_r2 == pytest.approx(score(want, x[600:], y[600:], [0, 1, 2, 3]), abs=1e-8)
    predicted = test.dropna().select(fit.prediction().alias("p"), "y").toPandas()
    assert 1 - ((predicted.p - predicted.y)**2).sum() / ((predicted.y - predicted.y.mean())**2).sum() == pytest.approx(test_r2, abs=1e-8)


def test_explained_columns_get_no_weight(parts):
    train, test, names, x, y = parts
    _, train_r2, fit = Mo.train_linear(train, test, names, "y")
    assert fit.coefficients[4] == fit.coefficients[5] == 0.0
    assert train_r2 == pytest.approx(score(plain(x[:600], y[:600], [0, 1, 2, 3]), x[:600], y[:600], [0, 1, 2, 3]), abs=1e-8)


def test_all_cutoffs_from_one_pass(spark, parts):
    train, test, names, x, y = parts
    totals = x.sum(0)
    ends = sorted(totals.tolist())
    cutoffs = [(a + b) / 2 for a, b in zip(ends, ends[1:])]
    jobs = []
    for some in ([-1e18], [-1e18, *cutoffs]):
        spark.sparkContext.setJobGroup(f"sweep {len(some)}", "sweep")
        table, best, (fit, kept) = Mo.best_cutoff(train, test, names, "y", some)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sweep {len(some)}")))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] and table.count() == 1 + len(cutoffs)
    for r in table.collect():
        used = [i for i in range(6) if totals[i] > r.cutoff]
        assert r.n_features == len(used)
        b = plain(x[:600], y[:600], used)
        assert r.train_r2 == pytest.approx(score(b, x[:600], y[:600], used), abs=1e-7)
        assert r.test_r2 == pytest.approx(score(b, x[600:], y[600:], used), abs=1e-6)
    assert best == max(table.collect(), key=lambda r: r.test_r2).cutoff and fit.columns == kept


def test_empty_and_tiny_parts(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    test_r2, train_r2, fit = Mo.train_linear(df, df.limit(0), ["x"], "y")
    assert np.isnan(test_r2) and np.isnan(train_r2) and fit.intercept == 2.0 and fit.coefficients[0] == 0.0
    assert [m.n for m in G.moments([df, df.limit(0)], ["x", "y"])] == [1, 0]
