"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

P(grade <= k | x) = sigmoid(threshold_k - w.x): one weight vector for all thresholds, which are kept in order. Features are the
words, and beginnings of words, that tell most about the label (G statistic), each with 1 + log(count). The fit uses at
most ``max_labelled`` labelled documents, the same of each label as far as there are, chosen by a hash of their id, and the
thresholds are moved to the labels' shares in the table; scoring reads every text whole.

Where labels say only toxic or not, grades are made of them: 0 for clean documents; toxic ones get 1, or 2 if they hold at
least as many marked words (words of which nine in ten labelled documents are toxic) as the median toxic document with any.

Defined cases: a null or empty text has no words and is not rejected unless most labelled documents are toxic; null labels and
labels without a document are left out, several labels of a document count as the largest; without labels, or with labels of one
grade only, the expected severity is 0 (or that grade) everywhere; repeated rows are scored each; other columns are kept.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import new_name, shares, text_of

WORD = r"\w+"


def text_features(text: str, wanted=None) -> Counter:
    """Counts of words and of the beginnings (four and five letters, marked) of longer ones; of the wanted ones if given."""
    counts: Counter = Counter()
    for word, n in Counter(re.findall(WORD, text.lower())).items():
        for feature in (word, *(f"{word[:k]}~" for k in (4, 5) if len(word) > k)):
            if wanted is None or feature in wanted:
                counts[feature] += n
    return counts


class OrdinalModel(NamedTuple):
    weights: dict[str, float]
    thresholds: list[float]

    def severity(self, text: str) -> tuple[float, float]:
        """Expected grade, and the probability of a grade above 0."""
        weights, counts = self.weights, text_features(text, self.weights)
        score = math.fsum(weights[w] * (1 + math.log(n)) for w, n in sorted(counts.items()))
        above = [1 / (1 + math.exp(min(700, t - score))) for t in self.thresholds]
        return sum(above), above[0] if above else 0.0


def fit_ordinal(rows: list[tuple[int, Sequence[int], Sequence[float]]], features: int, grades: int, steps: int = 400,
                penalty: float = 1e-5, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the penalised likelihood of (grade, indices, values), by Adam steps."""
    y = np.array([r[0] for r in rows])
    lengths = np.array([len(r[1]) for r in rows])
    row = np.repeat(np.arange(len(rows)), lengths)
    col = np.concatenate([np.asarray(r[1], np.int64) for r in rows]) if lengths.sum() else np.empty(0, np.int64)
    val = np.concatenate([np.asarray(r[2], float) for r in rows]) if lengths.sum() else np.empty(0)
    share = np.cumsum(np.bincount(y, minlength=grades))[:-1] / len(y)
    start = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    # thresholds are the first one and the logarithms of the steps between them, so that they stay in order
    p = np.concatenate([np.zeros(features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    def thresholds(p):
        return p[features] + np.concatenate([[0], np.cumsum(np.exp(p[features + 1:]))])

    for step in range(1, steps + 1):
        t = np.concatenate([[-np.inf], thresholds(p), [np.inf]])
        s = np.bincount(row, val * p[col], len(rows))
        high, low = sigmoid(t[y + 1] - s), sigmoid(t[y] - s)
        mass = np.maximum(high - low, 1e-9)
        up, down = high * (1 - high) / mass, low * (1 - low) / mass
        per_threshold = np.bincount(y + 1, up, grades + 1)[1:-1] - np.bincount(y, down, grades + 1)[1:-1]
        g = np.empty_like(p)
        g[:features] = np.bincount(col, val * (down - up)[row], features) / len(y) - penalty * p[:features]
        g[features:] = np.concatenate([[per_threshold.sum()], np.cumsum(per_threshold[::-1])[::-1][1:] * np.exp(p[features + 1:])]) / len(y)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:features], thresholds(p)


def in_order(sample: pa.Table) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """The rows (label, marks, at, value) in the order of their values, which are not negative; the lists are views of Arrow buffers."""
    columns = []
    for name in ("at", "value"):
        lists = [chunk for chunk in sample.column(name).chunks if len(chunk)]
        columns.append([row for chunk in lists for row in np.split(chunk.flatten().to_numpy(), np.cumsum(chunk.value_lengths().to_numpy())[:-1])])
    rows = list(zip(sample.column("label").to_pylist(), sample.column("marks").to_pylist(), *columns))
    # the bytes of such numbers, the highest first, sort as the numbers do
    rows.sort(key=lambda r: (r[0], r[1], r[2].astype(">i4").tobytes(), r[3].astype(">f8").tobytes()))
    return rows


def labelled_documents(documents: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str,
                       max_labelled: int) -> tuple[DataFrame, dict[int, int], dict[int, int]]:
    """doc_id, text, label of at most ``max_labelled`` labelled documents, of each label the first ones by a hash of the id.

    Also how many documents have each label, and how many of them are taken.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_of(text_column).alias("text"))
    known = (labels.filter(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
             .groupBy(F.col(id_column).cast("long").alias("doc_id")).agg(F.max(F.col(label_column).cast("int")).alias("label"))
             .join(rows.select("doc_id"), "doc_id", "left_semi"))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row a grade
    taken = shares(totals, max_labelled)
    chosen = [known.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(taken[y]) for y in sorted(totals)]
    if not chosen:
        chosen = [known.limit(0)]
    return rows.join(F.broadcast(reduce(DataFrame.union, chosen)), "doc_id"), totals, taken  # max_labelled rows of two numbers


def fit(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
        max_labelled: int = 20000, features: int = 1024, least_gain: float = 20.0) -> OrdinalModel:
    """The model. Labels of more than two grades are taken as they are, from 0 upwards.

    Features are words with a G statistic of twice ``least_gain`` or more, so chance finds no place among them.
    """
    rows, known, taken = labelled_documents(documents, labels, id_column, text_column, label_column, max_labelled)

    def distinct_words(batches):
        for batch in batches:
            words, label = [], []
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = text_features(text)
                words.extend(own)
                label.extend([min(y, 1)] * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(label, pa.int32())], names=["word", "label"])

    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row a grade
    if len(totals) < 2:
        return OrdinalModel({}, [-50.0] * max(totals, default=0))
    n, pos = sum(totals.values()), sum(c for y, c in totals.items() if y)
    a, df = F.col("a").cast("double"), F.col("df").cast("double")
    term = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    g = (term(a, df * pos / n) + term(df - a, df * (n - pos) / n)
         + term(pos - a, (n - df) * pos / n) + term((n - df) - (pos - a), (n - df) * (n - pos) / n))
    best = (rows.mapInArrow(distinct_words, "word string, label int").groupBy("word")
            .agg(F.count("*").alias("df"), F.sum("label").alias("a")).filter("df >= 5")
            .select("word", "a", "df", F.round(g, 6).alias("g")).filter(F.col("g") >= least_gain).orderBy(F.desc("g"), "word").limit(features).collect())
    vocabulary = {r["word"]: i for i, r in enumerate(best)}
    marked = {r["word"] for r in best if r["a"] >= 0.9 * r["df"]}

    def counted(batches):
        for batch in batches:
            out = {"label": batch.column(2), "marks": [], "at": [], "value": []}
            for text in batch.column(1).to_pylist():
                items = sorted(text_features(text, vocabulary).items())
                out["marks"].append(sum(c for w, c in items if w in marked))
                out["at"].append([vocabulary[w] for w, _ in items])
                out["value"].append([1 + math.log(c) for _, c in items])
            yield pa.RecordBatch.from_arrays(
                [out["label"], pa.array(out["marks"], pa.int64()), pa.array(out["at"], pa.list_(pa.int32())),
                 pa.array(out["value"], pa.list_(pa.float64()))], names=list(out))

    # at most max_labelled rows of at most `features` numbers come to the driver
    sample = in_order(rows.mapInArrow(counted, "label int, marks long, at array<int>, value array<double>").toArrow())
    if len(totals) == 2 and set(totals) == {0, 1}:
        some = sorted(m for y, m, _, _ in sample if y and m)
        middle = some[len(some) // 2] if some else math.inf
        sample = [(2 if y and m >= middle else y, m, i, v) for y, m, i, v in sample]
    grades = max(y for y, *_ in sample) + 1
    weights, thresholds = fit_ordinal([(y, i, v) for y, _, i, v in sample], len(vocabulary), grades)
    def shift(k: int) -> float:
        """What the sample's shares of the labels above and up to k add to the log odds of a grade above k."""
        sides = [[y for y in known if y > k], [y for y in known if y <= k]]
        above, below = (math.log(sum(taken[y] for y in ys) / sum(known[y] for y in ys)) if all(sides) else 0.0 for ys in sides)
        return above - below

    moved = [float(t) + shift(min(k, max(known) - 1)) for k, t in enumerate(thresholds)]
    return OrdinalModel({w: float(weights[i]) for w, i in vocabulary.items()}, np.maximum.accumulate(moved).tolist())


def score(documents: DataFrame, model: OrdinalModel, text_column: str = "text", reject_at: float = 0.5,
          names: tuple[str, str, str] = ("expected_severity", "p_toxic", "rejected")) -> DataFrame:
    """The rows with the expected severity, the probability of a grade above 0, and whether that is ``reject_at`` or more.

    The three columns have these ``names``; own columns of such a name are replaced, so take others to keep them. Only the texts go
    through Python, and two numbers a text come back; all other columns stay where they are.
    """
    @F.arrow_udf("struct<severity:double,p:double>")
    def judged(texts: pa.Array) -> pa.Array:
        found = [model.severity(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([e for e, _ in found], pa.float64()), pa.array([p for _, p in found], pa.float64())], names=["severity", "p"])

    at = new_name("judged")
    columns = [F.col(f"`{c}`") for c in documents.columns if c not in names]
    rows = documents.select(*columns, judged(text_of(text_column)).alias(at))
    severity, p = F.col(at)["severity"], F.col(at)["p"]
    return rows.select(*columns, F.round(severity, 6).alias(names[0]), F.round(p, 6).alias(names[1]), (p >= reject_at).alias(names[2]))
