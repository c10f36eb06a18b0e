"""AdaBoost (SAMME and SAMME.R; Zhu et al. 2009) as a Spark ML estimator over decision trees."""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from ..workspace import cut_lineage, stored
from . import trees as T

EPS = float(np.finfo(float).eps)
#: Longest vectors that are handed over as numbers, and classes that a tree may have.
WIDEST, MOST_CLASSES = 512, 100


class _BoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol):
    rounds = Param(Params._dummy(), "rounds", "largest number of trees", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "shrinks each tree's part", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", TypeConverters.toInt)
    algorithm = Param(Params._dummy(), "algorithm", "SAMME or SAMME.R", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the trees", TypeConverters.toInt)
    checkpointInterval = Param(Params._dummy(), "checkpointInterval", "rounds between checkpoints", TypeConverters.toInt)


class AdaBoostClassifier(Estimator, _BoostParams):
    """Each round fits a weighted tree and raises the weight of the rows it gets wrong.

    A row's weight follows from the trees so far and is written beside it every ``checkpointInterval`` rounds, so that no rows are
    cached: executors hold a batch of rows and the sums of the open nodes (see ``trees``).
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", rounds=50, learningRate=1.0,
                 maxDepth=1, algorithm="SAMME.R", seed=42, checkpointInterval=10):
        super().__init__()
        self._setDefault(rounds=50, learningRate=1.0, maxDepth=1, algorithm="SAMME.R", seed=42, checkpointInterval=10)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "AdaBoostModel":
        return fit_together([self], dataset)[0]

    def fit_together(self, estimators: list["AdaBoostClassifier"], dataset: DataFrame) -> list["AdaBoostModel"]:
        return fit_together(estimators, dataset)

    def _learner(self) -> DecisionTreeClassifier:
        return DecisionTreeClassifier(maxDepth=self.getOrDefault(self.maxDepth), weightCol="w", seed=self.getOrDefault(self.seed))

    def _rows(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(F.col(self.getFeaturesCol()).alias("features"), F.col(self.getLabelCol()).cast("double").alias("label"))

    def _fit_wide(self, dataset: DataFrame) -> "AdaBoostModel":
        """With Spark's own learner, for vectors too long to be handed over as rows of numbers."""
        rate, algorithm = self.getOrDefault(self.learningRate), self.getOrDefault(self.algorithm)
        rows = self._rows(dataset).withColumn("w", F.lit(1.0)).persist(StorageLevel.MEMORY_AND_DISK)
        n, top = rows.agg(F.count(F.lit(1)), F.max("label")).first()
        classes = int(top) + 1 if top else 2
        learner = self._learner()
        trees, alphas, done = [], [], rows  # done: what the rows are read from
        for turn in range(1, self.getOrDefault(self.rounds) + 1):
            tree = learner.fit(rows)
            # The tree is applied once to each row: the new weights follow from what is cached here.
            wrong, margin = F.col("wrong"), F.col("margin")
            scored = tree.transform(rows).select(
                "features", "label", "w", (F.col("prediction") != F.col("label")).cast("double").alias("wrong"),
                (_margin(classes) if algorithm == "SAMME.R" else F.lit(0.0)).alias("margin")).persist(StorageLevel.MEMORY_AND_DISK)
            lost, total = scored.agg(F.sum(F.col("w") * wrong), F.sum("w")).first()
            error = lost / total
            done.unpersist()
            done = scored
            if error <= 0:
                trees, alphas = trees + [tree], alphas + [1.0]
                break
            if algorithm == "SAMME":
                if error >= 1 - 1 / classes:
                    break
                alpha = rate * (math.log((1 - error) / error) + math.log(classes - 1))
                factor = F.exp(alpha * wrong)
            else:
                alpha = 1.0
                factor = F.exp(-rate * (classes - 1) / classes * margin)
            trees, alphas = trees + [tree], alphas + [alpha]
            rows = scored.select("features", "label", (F.col("w") * factor * (n / total)).alias("w"))
            if turn % self.getOrDefault(self.checkpointInterval) == 0:
                rows = cut_lineage(rows)
        done.unpersist()
        return self._model(trees, alphas, classes)

    def _model(self, trees: list, alphas: list[float], classes: int) -> "AdaBoostModel":
        if not trees:
            raise ValueError("the first tree is no better than chance")
        return self._copyValues(AdaBoostModel(trees, alphas, classes))


class _Fit:
    """One boosted model while its trees grow. ``past``: the steps that are not in the stored weights; ``due``: weights are to be stored."""

    def __init__(self, estimator: AdaBoostClassifier, place: int, rows: T.Rows, sample: tuple, n: int, classes: int):
        self.estimator, self.place, self.rows, self.n, self.classes = estimator, place, rows, n, classes
        self.past, self.due, self.model = [], False, None
        self.x, self.y, self.share = sample
        self.w, self.whole = np.ones(len(self.x)), float(n)  # weights of the sample, and of all rows
        self.turns = self.run()
        self.request = next(self.turns)

    def answer(self, sums: dict) -> None:
        try:
            self.request = self.turns.send(sums)
        except StopIteration:
            self.request = None

    def run(self):
        e, spark, classes = self.estimator, self.rows.spark, self.classes
        rate, algorithm, learner = e.getOrDefault(e.learningRate), e.getOrDefault(e.algorithm), e._learner()
        trees, alphas = [], []
        for turn in range(1, e.getOrDefault(e.rounds) + 1):
            bins = min(T.BINS, self.n)
            edges = [T._edges(self.x[:, f], self.w, bins, self.share * self.whole) for f in range(self.rows.width)]
            root = T.prune((yield from T.grow(self.place, self.past, edges, classes, e.getOrDefault(e.maxDepth))))
            nodes = T.listed(root)
            sums = np.array([np.zeros(classes) if node.children else node.plain for node in nodes])  # of the leaves
            hit = np.eye(classes)[[node.prediction for node in nodes]]
            lost, total = (sums * (1 - hit)).sum(), sums.sum()
            error = lost / total
            tree = T.spark_model(spark, learner, root, self.rows.width, classes)
            if error <= 0:
                trees, alphas = trees + [tree], alphas + [1.0]
                break
            if algorithm == "SAMME":
                if error >= 1 - 1 / classes:
                    break
                alpha = rate * (math.log((1 - error) / error) + math.log(classes - 1))
                factor = np.exp(alpha * (1 - hit))
            else:
                alpha = 1.0
                stats = np.array([node.stats for node in nodes])
                logs = np.log(np.maximum(stats / np.maximum(stats.sum(1), EPS)[:, None], EPS))
                margin = logs - (logs.sum(1)[:, None] - logs) / (classes - 1)
                factor = np.exp(-rate * (classes - 1) / classes * margin)
            trees, alphas = trees + [tree], alphas + [alpha]
            step = T.Step(T.arrays(nodes), factor, self.n / total)
            self.w, self.whole = T.weigh([step], self.x, self.y, self.w), (sums * factor).sum() * step.scale
            self.past = [*self.past, step]
            self.due = turn % e.getOrDefault(e.checkpointInterval) == 0
        self.model = e._model(trees, alphas, classes)


def fit_together(estimators: list[AdaBoostClassifier], dataset: DataFrame) -> list["AdaBoostModel"]:
    """The models of all estimators, which read the same columns of the same rows: they share every pass over them."""
    for e in estimators:
        if e.getOrDefault(e.algorithm) not in ("SAMME", "SAMME.R"):
            raise ValueError(f"algorithm must be SAMME or SAMME.R, not {e.getOrDefault(e.algorithm)!r}")
    if len({(e.getFeaturesCol(), e.getLabelCol()) for e in estimators}) > 1:
        return [m for e in estimators for m in fit_together([e], dataset)]
    one = estimators[0]
    with stored(one._rows(dataset), "boost-rows") as rows:
        label = F.col("label")
        plain = (label >= 0) & (label == F.floor(label)) & F.col("features").isNotNull()
        first = rows.select("features").first()
        width = len(first.features) if first and first.features is not None else 0
        if not 0 < width <= WIDEST or _has_kinds(rows):
            return [e._fit_wide(dataset) for e in estimators]
        n, top, good = rows.agg(F.count(F.lit(1)), F.max("label"), F.count_if(plain)).first()
        if good < n or not top or top >= MOST_CLASSES:  # what Spark's learner makes of them
            return [e._fit_wide(dataset) for e in estimators]
        read = T.Rows(rows, width, len(estimators))
        samples = {}
        for seed in {e.getOrDefault(e.seed) for e in estimators}:
            samples[seed] = read.sample(n, seed)
        try:
            fits = [_Fit(e, i, read, samples[e.getOrDefault(e.seed)], n, int(top) + 1) for i, e in enumerate(estimators)]
            while waiting := [f for f in fits if f.request]:
                if any(f.due for f in waiting):
                    read.store([f.past for f in fits])
                    for f in fits:
                        f.past.clear()  # also those of the request that waits
                        f.due = False
                for f, sums in zip(waiting, read.sums([f.request for f in waiting])):
                    f.answer(sums)
        finally:
            read.close()
        return [f.model for f in fits]


def _has_kinds(rows: DataFrame) -> bool:
    """Features that are marked as categories."""
    return bool({"nominal", "binary"} & set(rows.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})))


def _log_probability():
    return F.transform(vector_to_array("probability"), lambda p: F.log(F.greatest(p, F.lit(EPS))))


def _margin(classes: int):
    """Log probability of the true class minus the mean of the others'."""
    logs = _log_probability()
    true = F.element_at(logs, F.col("label").cast("int") + 1)
    return true - (F.aggregate(logs, F.lit(0.0), lambda a, x: a + x) - true) / (classes - 1)


class AdaBoostModel(Model, _BoostParams, MLWritable, MLReadable):
    def __init__(self, trees=None, alphas=None, classes=2):
        super().__init__()
        self._setDefault(rounds=50, learningRate=1.0, maxDepth=1, algorithm="SAMME.R", seed=42, checkpointInterval=10)
        self.trees, self.alphas, self.classes = trees or [], alphas or [], classes

    def copy(self, extra=None):
        that = super().copy(extra)
        that.trees, that.alphas, that.classes = self.trees, self.alphas, self.classes
        return that

    @property
    def featureImportances(self) -> DenseVector:
        """Tree importances weighted by the trees' parts; they sum to 1."""
        total = sum(a * t.featureImportances.toArray() for t, a in zip(self.trees, self.alphas)) / sum(self.alphas)
        return DenseVector(total / total.sum() if total.sum() else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        soft = self.getOrDefault(self.algorithm) == "SAMME.R"
        scored, votes = dataset, [F.lit(0.0)] * self.classes
        columns = []
        for i, (tree, alpha) in enumerate(zip(self.trees, self.alphas)):
            name = f"_tree{i}"
            columns.append(name)
            tree = tree.copy()
            tree.setFeaturesCol(self.getFeaturesCol())
            tree._set(rawPredictionCol="", probabilityCol=name if soft else "", predictionCol="" if soft else name)
            scored = tree.transform(scored)
            if soft:
                p = vector_to_array(F.col(name))
                logs = [F.log(F.greatest(F.get(p, F.lit(k)), F.lit(EPS))) for k in range(self.classes)]
                mean = sum(logs, F.lit(0.0)) / self.classes
                part = [(self.classes - 1) * (x - mean) for x in logs]
            else:
                part = [F.when(F.col(name) == k, alpha).otherwise(0.0) for k in range(self.classes)]
            votes = [v + p for v, p in zip(votes, part)]
        raw = F.array(*[v / sum(self.alphas) for v in votes])
        scored = scored.withColumn("_votes", raw).drop(*columns)
        return scored.withColumns({
            self.getPredictionCol(): (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double"),
            self.getRawPredictionCol(): array_to_vector(F.col("_votes")),
        }).drop("_votes")

    def write(self):
        return _BoostWriter(self)

    @classmethod
    def read(cls):
        return _BoostReader()


class _BoostWriter(MLWriter):
    def __init__(self, model: AdaBoostModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        params = {p.name: m.getOrDefault(p) for p in m.params if m.isDefined(p)}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, {"alphas": m.alphas, "classes": m.classes, "own": params})
        for i, tree in enumerate(m.trees):
            tree.write().overwrite().save(f"{path}/trees/{i}")


class _BoostReader(MLReader):
    def load(self, path: str) -> AdaBoostModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees = [DecisionTreeClassificationModel.load(f"{path}/trees/{i}") for i in range(len(meta["alphas"]))]
        model = AdaBoostModel(trees, meta["alphas"], meta["classes"])
        model._resetUid(meta["uid"])
        return model._set(**meta["own"])
