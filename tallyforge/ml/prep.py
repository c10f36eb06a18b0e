"""Model preparation: scaling, splits, correlation, principal components."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, MinMaxScaler, VectorAssembler, VectorSlicer
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import in_share
from ..operators.profile import _q, beside
from ..workspace import keep


def vector_scaler(columns: list[str], out: str = "features") -> Pipeline:
    """Assembles the columns and scales each to [0, 1]."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="feature_vec"),
        MinMaxScaler(inputCol="feature_vec", outputCol=out),
    ])


def scale_features(df: DataFrame, label: str = "churn", key: str = "userId") -> tuple[DataFrame, PipelineModel]:
    """All columns but key and label as one scaled vector, with a double ``label``. The rows are written once: the fit, those of later
    steps and the result read them, and what made them is not done again."""
    df = keep(df, "features")
    columns = [c for c in df.columns if c not in (key, label)]
    model = vector_scaler(columns).fit(df)
    return model.transform(df.withColumn("label", _q(label).cast("double"))), model


def min_max_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed columns scaled to [0, 1]; a constant column gives 0. The range is a scalar subquery."""
    ranges = df.agg(F.struct(*[
        F.struct(F.min(_q(c)).cast("double").alias("lo"), F.max(_q(c)).cast("double").alias("hi")).alias(c) for c in columns
    ]))
    s = F.col("_ranges")
    return beside(df, "_ranges", ranges).withColumns({
        c: F.when(s[c]["hi"] == s[c]["lo"], F.when(_q(c).isNotNull(), 0.0))
        .otherwise((_q(c) - s[c]["lo"]) / (s[c]["hi"] - s[c]["lo"]))
        for c in columns
    }).drop("_ranges")


def standardize(train: DataFrame, others: list[DataFrame], columns: list[str]) -> list[DataFrame]:
    """Zero mean and unit population deviation, measured on ``train`` and applied to all tables."""
    scales = train.agg(F.struct(*[
        F.struct(F.avg(_q(c)).alias("mean"), F.stddev_pop(_q(c)).alias("std")).alias(c) for c in columns
    ]))
    s = F.col("_scales")
    return [
        beside(t, "_scales", scales).withColumns({
            c: (_q(c) - s[c]["mean"]) / F.when(s[c]["std"] == 0, 1.0).otherwise(s[c]["std"]) for c in columns
        }).drop("_scales")
        for t in [train, *others]
    ]


# -- splits ------------------------------------------------------------------------------------


def in_train(key: str, percent: int = 80, seed: int = 42, method: str = "hash") -> Column:
    """True for the training rows. The key alone decides, so the split is the same in every
    job, after a lost executor, and for all rows of one key. ``plain`` uses key mod 100."""
    if method == "plain":
        return F.pmod(_q(key), F.lit(100)) < percent
    return F.pmod(F.xxhash64(_q(key), F.lit(seed)), F.lit(100)) < percent


def split_by_key(
    df: DataFrame, key: str, percent: int = 80, seed: int = 42, method: str = "hash"
) -> tuple[DataFrame, DataFrame]:
    picked = in_train(key, percent, seed, method)
    return df.filter(picked), df.filter(~picked)


def stratified_sample(df: DataFrame, label: str, fractions: dict, seed: int = 123, key: list[str] | None = None) -> DataFrame:
    """A share of each class (none of a class without one). The key (all columns by default) decides, not the partitioning."""
    share = F.lit(0.0)
    for value, fraction in fractions.items():
        share = F.when(_q(label) == value, float(fraction)).otherwise(share)
    return df.filter(in_share(share, seed, *[_q(c) for c in key or df.columns]))


def all_but(df: DataFrame, part: DataFrame) -> DataFrame:
    """Distinct rows of ``df`` that are not in ``part``."""
    return df.subtract(part)


# -- correlation and components ----------------------------------------------------------------


def vector_correlations(df: DataFrame, names: list[str], features: str = "features") -> DataFrame:
    """(a, b, r) for a <= b of a vector column: one Gramian pass, d x d numbers to the driver."""
    matrix = Correlation.corr(df, features, "pearson").first()[0].toArray()
    rows = [
        (a, b, None if math.isnan(matrix[i, j]) else float(matrix[i, j])) for i, a in enumerate(names) for j, b in enumerate(names) if i <= j
    ]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def fit_components(
    df: DataFrame, share: float = 0.95, max_k: int | None = None, features: str = "features", out: str = "pcaFeatures"
) -> tuple[PipelineModel, list[float]]:
    """(model, shares): the fewest components that explain ``share`` of the variance.

    One fit at the largest k gives all shares; the vector is then cut, not fitted again.
    """
    size = max_k or _vector_size(df, features)
    model = PCA(k=size, inputCol=features, outputCol="allComponents").fit(df)
    explained = [float(x) for x in model.explainedVariance]
    reached = [k for k, total in enumerate(accumulate(explained), 1) if total >= share - 1e-12]
    if not reached:
        raise ValueError(f"{size} components explain {sum(explained):.4f}, less than {share}")
    cut = VectorSlicer(inputCol="allComponents", outputCol=out, indices=list(range(reached[0])))
    return PipelineModel(stages=[model, cut]), explained[:reached[0]]


def _vector_size(df: DataFrame, features: str) -> int:
    return df.select(features).first()[0].size
