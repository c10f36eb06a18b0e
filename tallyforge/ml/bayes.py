"""Gaussian naive Bayes for any number of labels from one aggregate."""

from __future__ import annotations

import math

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.profile import _q

#: Share of the greatest variance of a feature over all rows that is added to each variance, so that none is 0.
SMOOTHING = 1e-9


def label_statistics(df: DataFrame, features: list[str], labels: list[str]) -> DataFrame:
    """(label_name, class, n, means, variances): of each class of each label, and a row with a null label over all rows.

    One aggregate whose partial results merge: a row meets each of its labels once, before any shuffle, and what is shuffled is a row a
    label, class and task. Null labels and null features are left out of what they belong to.
    """
    each = [F.struct(F.lit(c).alias("label_name"), _q(c).cast("int").alias("class")) for c in labels]
    every = F.struct(F.lit(None).cast("string").alias("label_name"), F.lit(None).cast("int").alias("class"))
    long = df.select(*[_q(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.explode(F.array(every, *each)).alias("of"))
    long = long.filter("of.label_name IS NULL OR of.class IS NOT NULL")
    xs = [F.col(f"x{i}") for i in range(len(features))]
    return long.groupBy(F.col("of.label_name").alias("label_name"), F.col("of.class").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.array(*map(F.avg, xs)).alias("means"), F.array(*map(F.var_pop, xs)).alias("variances"))


class GaussianLabels(Estimator):
    """Fits all labels over the same numeric columns in one pass."""

    def __init__(self, features: list[str], labels: list[str]):
        super().__init__()
        self.features, self.labels = features, labels

    def _fit(self, dataset: DataFrame) -> "GaussianLabelsModel":
        found = label_statistics(dataset, self.features, self.labels).collect()  # classes of all labels
        whole = next((r for r in found if r["label_name"] is None), None)
        extra = SMOOTHING * max([v or 0.0 for v in whole["variances"]] if whole else [0.0])
        classes: dict[str, list] = {c: [] for c in self.labels}
        for r in sorted((r for r in found if r["label_name"] is not None), key=lambda r: (r["label_name"], r["class"])):
            classes[r["label_name"]].append((r["class"], r["n"], list(r["means"]), [None if v is None else v + extra for v in r["variances"]]))
        return GaussianLabelsModel(self.features, self.labels, classes)


class GaussianLabelsModel(Model, MLReadable, MLWritable):
    """Adds ``prediction_<label>`` and ``score_<label>`` as plain expressions, so also to a stream.

    A score is the logarithm of the chance of the highest class over that of the best other one; it is null where a feature is null or the
    training rows had one class only, which is then predicted. Labels without training rows are predicted null. Of equally likely classes the lowest wins.
    """

    def __init__(self, features: list[str], labels: list[str], classes: dict[str, list]):
        super().__init__()
        self.features, self.labels, self.classes = features, labels, classes

    def copy(self, extra=None):
        that = super().copy(extra)
        that.features, that.labels, that.classes = self.features, self.labels, self.classes
        return that

    def likelihoods(self, label: str) -> list[tuple[int, Column]]:
        """Logarithm of share times density of each class, lowest class first."""
        total, out = sum(c[1] for c in self.classes[label]), []
        for cls, n, means, variances in self.classes[label]:
            value = F.lit(math.log(n / total))
            for name, m, v in zip(self.features, means, variances):
                if m is not None and v:  # a feature that is the same in all rows says nothing
                    value = value - 0.5 * math.log(2 * math.pi * v) - (_q(name).cast("double") - m) ** 2 / (2 * v)
            out.append((cls, value))
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns = {}
        for label in self.labels:
            parts = self.likelihoods(label)
            known = [F.col(f"`{c}`").isNotNull() for c in self.features]
            whole = known[0] if known else F.lit(True)
            for k in known[1:]:
                whole = whole & k
            if len(parts) < 2:
                columns[f"prediction_{label}"] = F.lit(float(parts[0][0]) if parts else None).cast("double")
                columns[f"score_{label}"] = F.lit(None).cast("double")
                continue
            best = F.array_max(F.array(*[F.struct(v.alias("v"), F.lit(-c).alias("c")) for c, v in parts]))
            others = F.greatest(*[v for _, v in parts[:-1]]) if len(parts) > 2 else parts[0][1]
            columns[f"prediction_{label}"] = F.when(whole, (-best["c"]).cast("double"))
            columns[f"score_{label}"] = F.when(whole, parts[-1][1] - others)
        return dataset.withColumns(columns)

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: GaussianLabelsModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"features": m.features, "labels": m.labels, "classes": m.classes})


class _Reader(MLReader):
    def load(self, path: str) -> GaussianLabelsModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = GaussianLabelsModel(meta["features"], meta["labels"], meta["classes"])
        model._resetUid(meta["uid"])
        return model
