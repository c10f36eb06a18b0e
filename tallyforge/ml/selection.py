"""Feature selection by importance."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame

from .evaluate import binary_scores


def top_indices(model: Model, top: int = 5) -> list[int]:
    values = model.featureImportances.toArray()
    return sorted(range(len(values)), key=lambda i: (-values[i], i))[:top]


def compare_with_top_features(
    estimator: Estimator, ranking: Model, train: DataFrame, test: DataFrame, top: int = 5, fitted: bool = False,
) -> DataFrame:
    """(features_used, accuracy, f_beta) of one model on all features and on the ``top`` ones.

    With ``fitted`` the ranking is the estimator's own fit of ``train``: it is scored as it is and not fitted once more.
    """
    features = estimator.getFeaturesCol()
    reduced = Pipeline(stages=[
        VectorSlicer(inputCol=features, outputCol="_top", indices=top_indices(ranking, top)),
        estimator.copy({estimator.featuresCol: "_top"}),
    ])
    rows = []
    for name, e in (("all", estimator), (f"top{top}", reduced)):
        model = ranking if fitted and e is estimator else e.fit(train)
        s = binary_scores(model.transform(test)).first()
        rows.append((name, s.accuracy, s.f_beta))
    return train.sparkSession.createDataFrame(rows, "features_used string, accuracy double, f_beta double")
