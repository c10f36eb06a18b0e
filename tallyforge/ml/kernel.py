"""RBF-kernel classifier: random Fourier features (Rahimi and Recht 2007) and a linear SVM."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.classification import LinearSVC, LinearSVCModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol, HasRawPredictionCol, HasWeightCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, functions as F

MAX_PROJECTION = 64_000_000  # doubles: the random matrix every Python worker holds
ROWS_AT_ONCE = 256


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """sqrt(2/D) cos(xW + b) with W ~ N(0, 2 gamma): inner products approach exp(-gamma |x-y|^2)."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    dimensions = Param(Params._dummy(), "dimensions", "number of random features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the random matrix", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="fourier", gamma=1.0, dimensions=256, seed=42):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="fourier", gamma=1.0, dimensions=256, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        project = _projector(*(self.getOrDefault(p) for p in (self.gamma, self.dimensions, self.seed)))
        return dataset.withColumn(
            self.getOutputCol(), array_to_vector(project(F.unwrap_udt(F.col(self.getInputCol()))))
        )


def _projector(gamma: float, dimensions: int, seed: int):
    made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def matrix(size: int):
        if size * dimensions > MAX_PROJECTION:
            raise ValueError(f"{size} x {dimensions} is too wide for one worker: use a smaller vocabulary")
        if size not in made:
            rng = np.random.default_rng(seed)
            made[size] = (
                rng.normal(0.0, np.sqrt(2 * gamma), (size, dimensions)), rng.uniform(0, 2 * np.pi, dimensions)
            )
        return made[size]

    @F.arrow_udf("array<double>")
    def project(v: pa.Array) -> pa.Array:
        out = [project_block(v.slice(i, ROWS_AT_ONCE), matrix, dimensions) for i in range(0, len(v), ROWS_AT_ONCE)]
        flat = np.concatenate(out).ravel() if out else np.zeros(0)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dimensions), pa.int32()), pa.array(flat))

    return project


def project_block(part: pa.StructArray, matrix, dimensions: int) -> np.ndarray:
    """One product for all rows of a block, over the columns that any of them has; vectors of one block are of one size."""
    if part.field("values").null_count:
        raise ValueError("a row has no vector")
    dense = part.field("type").to_numpy(zero_copy_only=False) == 1
    lengths = part.field("values").value_lengths().to_numpy()
    values, row = part.field("values").flatten().to_numpy(), np.repeat(np.arange(len(part)), lengths)
    places = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    places[~dense[row]] = part.field("indices").flatten().to_numpy()  # dense rows have none
    weights, shift = matrix(int(lengths[0]) if dense[0] else part.field("size")[0].as_py())
    used, at = np.unique(places, return_inverse=True)
    block = np.zeros((len(part), len(used)))
    block[row, at] = values
    return np.sqrt(2.0 / dimensions) * np.cos(block @ weights[used] + shift)


def scale_gamma(df: DataFrame, features: str = "features", weight: str | None = None) -> float:
    """1 / (number of features * variance of all entries); a row counts ``weight`` times."""
    if weight:
        s, n = df.select(Summarizer.metrics("mean", "normL2").summary(F.col(features), F.col(weight).cast("double")), F.sum(weight)).first()
        mean, squares = s.mean.toArray(), s.normL2.toArray() ** 2 / n
    else:
        mean, var = df.select(Summarizer.metrics("mean", "variance").summary(F.col(features)).alias("s")).select(
            "s.mean", "s.variance").first()
        n = df.count()
        mean = mean.toArray()
        squares = var.toArray() * (n - 1) / n + mean**2
    total = squares.mean() - mean.mean() ** 2
    return float(1.0 / (len(mean) * total)) if total > 0 else 1.0


def kernel_svm(
    n_rows: int, gamma: float, c: float = 1.0, dimensions: int = 256, seed: int = 42,
    features: str = "features", label: str = "label", max_iter: int = 100,
) -> Pipeline:
    """The margin weight ``c`` of a kernel SVM is a regularisation of 1 / (c n) in the linear one."""
    return Pipeline(stages=[
        RandomFourierFeatures(inputCol=features, outputCol="fourier", gamma=gamma, dimensions=dimensions, seed=seed),
        LinearSVC(featuresCol="fourier", labelCol=label, regParam=1.0 / (c * n_rows), maxIter=max_iter),
    ])


class _KernelParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol):
    gamma = Param(Params._dummy(), "gamma", "kernel width; 0 for 1 / (number of features * variance of all entries)", TypeConverters.toFloat)
    c = Param(Params._dummy(), "c", "weight of the margin's violations", TypeConverters.toFloat)
    dimensions = Param(Params._dummy(), "dimensions", "number of random features", TypeConverters.toInt)
    maxIter = Param(Params._dummy(), "maxIter", "largest number of iterations", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the random matrix", TypeConverters.toInt)

    def _set_defaults(self):
        self._setDefault(gamma=0.0, c=1.0, dimensions=256, maxIter=100, seed=42)


class KernelSVM(Estimator, _KernelParams, HasWeightCol, DefaultParamsReadable, DefaultParamsWritable):
    """RBF-kernel classifier of two classes: random Fourier features and a linear SVM on them.

    It takes the features as they are, so it may be the base of one model a label or a stage of a grid over ``gamma`` and ``c``.
    Rows without a label are left out of the fit. With ``weightCol``, a row stands for as many equal rows, and the fit keeps one
    row of each kind: the model is that of the rows one by one, see ``_as_single_rows``.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", weightCol=None, gamma=0.0, c=1.0, dimensions=256, maxIter=100, seed=42):
        super().__init__()
        self._set_defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "KernelSVMModel":
        features, label = self.getFeaturesCol(), self.getLabelCol()
        weight = self.getWeightCol() if self.isDefined(self.weightCol) else None
        columns = [F.col(f"`{features}`").alias("features"), F.col(f"`{label}`").cast("double").alias("label")]
        rows = dataset.select(*columns, *([F.col(f"`{weight}`").cast("double").alias("weight")] if weight else [])).filter("label IS NOT NULL")
        gamma = self.getOrDefault(self.gamma) or scale_gamma(rows, weight="weight" if weight else None)
        fourier = RandomFourierFeatures(gamma=gamma, dimensions=self.getOrDefault(self.dimensions), seed=self.getOrDefault(self.seed))
        mapped = fourier.transform(rows).drop("features")
        if weight:
            mapped, n = _as_single_rows(mapped)
        else:
            n = rows.count()
        linear = LinearSVC(featuresCol="fourier", regParam=1.0 / (self.getOrDefault(self.c) * max(1, n)), maxIter=self.getOrDefault(self.maxIter))
        return self._copyValues(KernelSVMModel((linear.setWeightCol("weight") if weight else linear).fit(mapped), gamma))


def _as_single_rows(rows: DataFrame) -> tuple[DataFrame, float]:
    """(label, weight, fourier) rows that the linear fit takes as ``weight`` single rows each, and the sum of their weights.

    The fit scales each feature by its deviation, whose divisor is W - (sum of squared weights) / W, with W the sum of the weights; single
    rows have n - 1. Two rows at the mean, one of each label, make up the difference: they leave mean and squares as they are, and
    their pulls on the plane cancel for as long as the mean is within the margin. Beyond it they draw the intercept with half their
    weight, which is about (sum of squared weights) / W in W.
    """
    n, squares = rows.agg(F.sum("weight"), F.sum(F.col("weight") ** 2)).first()
    n, over = n or 0.0, max(0.0, (squares or 0.0) - (n or 0.0))
    if not over:
        return rows, n
    more = 2 * over / (n + 1 + np.sqrt((n + 1) ** 2 + 2 * over))  # then W - squares / W is n - 1
    mean = rows.select(Summarizer.mean(F.col("fourier"), F.col("weight"))).first()[0]
    both = rows.sparkSession.createDataFrame([(y, float(more) / 2, mean) for y in (0.0, 1.0)], ["label", "weight", "fourier"])
    return rows.select("label", "weight", "fourier").union(both.coalesce(1)), float(n + more)


class KernelSVMModel(Model, _KernelParams, MLReadable, MLWritable):
    """The linear model over the random features. They follow from ``fitted_gamma``, ``dimensions`` and ``seed``, which are stored."""

    def __init__(self, linear: LinearSVCModel, fitted_gamma: float):
        super().__init__()
        self._set_defaults()
        self.linear, self.fitted_gamma = linear, fitted_gamma

    def copy(self, extra=None):
        that = super().copy(extra)
        that.linear, that.fitted_gamma = self.linear, self.fitted_gamma
        return that

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fourier = RandomFourierFeatures(
            inputCol=self.getFeaturesCol(), outputCol="_fourier", gamma=self.fitted_gamma,
            dimensions=self.getOrDefault(self.dimensions), seed=self.getOrDefault(self.seed))
        linear = self.linear.copy()
        linear.setFeaturesCol("_fourier").setPredictionCol(self.getPredictionCol()).setRawPredictionCol(self.getRawPredictionCol())
        return linear.transform(fourier.transform(dataset)).drop("_fourier")

    def write(self):
        return _KernelWriter(self)

    @classmethod
    def read(cls):
        return _KernelReader()


class _KernelWriter(MLWriter):
    def __init__(self, model: KernelSVMModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, {"fitted_gamma": self.model.fitted_gamma})
        self.model.linear.write().save(f"{path}/linear")


class _KernelReader(MLReader):
    def load(self, path: str) -> KernelSVMModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = KernelSVMModel(LinearSVCModel.load(f"{path}/linear"), meta["fitted_gamma"])
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
