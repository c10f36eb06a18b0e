"""Hard negatives against brute force, on made-up rows with copies, ties, zero and large vectors."""

import math
import random

import numpy as np
import pytest

pytest.importorskip("tallyforge.llm")

from pyspark.sql import functions as F  # noqa: E402

from tallyforge.llm import hard_negatives, whole  # noqa: E402

SCHEMA = "vec_id long, embedding array<double>, label int, row string, grp string, score string, v string"


def made_up(seed=2, n=400, large=()):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = centres[r.randrange(5)]
        rows.append((i, [x + r.gauss(0, 0.4) for x in c], r.randrange(4)))
    rows += [(n + i, rows[7][1], 1) for i in range(40)] + [(n + 40 + i, rows[7][1], 2) for i in range(40)]
    rows += [(1000, [0.0] * 6, 1), (1010, [], 2), (1020, [1.0, 2.0], 3), (1030, None, 1), (1040, [1.0, None], 1), (1050, [math.nan], 2),
             (1060, [math.inf, 1.0], 1), (1070, rows[3][1], None), (None, rows[4][1], 1), rows[50], rows[50], (1080, [-3.0] * 6, 9)]
    return rows + list(large)


def brute(rows, positives=5, negatives=3, scale=256, low=50, high=95, step=10):
    good = {(i, lab, tuple(math.floor(x * scale) for x in v)) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    product = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, lab, q in good:
        if i % step:
            continue
        scored = sorted((-product(q, v), j, l2) for j, l2, v in good if j != i)
        best = [(-s, j) for s, j, l2 in scored if l2 == lab][:positives]
        for p, pid in best:
            fits = [(-s, j) for s, j, l2 in scored if l2 != lab and low * p <= -100 * s <= high * p][:negatives]
            out += [(i, pid, r + 1, j, p, s) for r, (s, j) in enumerate(fits)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], lab, "row", "grp", "score", "v") for i, v, lab in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("settings", [{}, {"block_rows": 16, "anchor_rows": 7, "first": 1}, {"references": 3, "rings": 2, "label_groups": 2, "block_rows": 60}])
def test_rows_are_those_of_all_pairs(spark, settings):
    rows = made_up()
    found = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, **settings)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_large_components_are_exact(spark):
    large = [(2000, [1e7, 1.0, 0, 0, 0, 0], 0), (2010, [1e7, 2.0, 0, 0, 0, 0], 0), (2020, [9e6, 2.0, 0, 0, 0, 0], 1), (2030, [-1e7, 0, 0, 0, 0, 3.0], 1)]
    rows = made_up(5, 60, large)
    found = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0, block_rows=32)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_scores_beyond_a_long_are_held(spark):
    a = np.array([[1e18, 0.0], [3.0, 4.0]])
    assert whole.products(a, a).tolist() == [[whole.MOST, 3 * 10**18], [3 * 10**18, 25]]
    assert whole.products(a, -a)[0, 0] == whole.LEAST
    huge = [(i * 10, [1e300 * (1 + i % 2), -1e-300], i % 2) for i in range(6)]
    found = hard_negatives.hard_negatives(frame(spark, huge), F.col("vec_id") % 10 == 0).collect()
    assert all(r["positive_score"] == whole.MOST for r in found)


def test_empty_and_single_rows(spark):
    for rows in ([], [(0, [1.0], 1)], [(1, [0.0], 1), (2, [0.0], 1)], [(0, [0.0], 1), (1, [0.0], 1), (2, [0.0], 2)]):
        found = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
        assert sorted(map(tuple, found)) == brute(rows)


def test_bounds_hold_for_random_vectors():
    g = np.random.default_rng(1)
    d = g.normal(size=(5, 8))
    d /= np.sqrt((d**2).sum(1))[:, None]
    a, b = np.floor(g.normal(size=(60, 8)) * 50), np.floor(g.normal(size=(80, 8)) * 90)
    b[:20] = a[:20] * 2
    b[20:40] = -a[:20]
    ta, tb = hard_negatives.angles_to(a, d), hard_negatives.angles_to(b, d)
    na, nb = whole.lengths(a)[:, None], whole.lengths(b)[None, :]
    least, greatest = hard_negatives.score_bounds((ta[:, None], ta[:, None]), (na, na), (tb[None], tb[None]), (nb, nb))
    score = whole.products(a, b)
    assert (least <= score).all() and (score <= greatest).all()
    ranges = hard_negatives.score_bounds((ta[:, None], ta[:, None]), (na, na), (tb.min(0)[None, None], tb.max(0)[None, None]), (nb.min(), nb.max()))
    assert (ranges[0] <= score).all() and (score <= ranges[1]).all()


def test_far_blocks_are_not_sent(spark):
    """Two far clusters: with windows set, blocks of the other cluster meet no anchor."""
    g = np.random.default_rng(6)
    rows = [(i, [float(x) for x in ([1.0, 0.0] if i % 2 else [0.0, 1.0]) + g.normal(0, 0.01, 2)], i % 3) for i in range(600)]
    found = hard_negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, block_rows=20)
    assert sorted(map(tuple, found.collect())) == brute(rows, step=50)
