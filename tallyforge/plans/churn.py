"""Churn pipeline: raw clicks to features, split, models."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from ..ml.models import train_and_evaluate
from ..ml.prep import fit_components, in_train, vector_scaler
from ..operators.behavior import user_features
from ..operators.clean import clean_clicks

MODELS = ["LogisticRegression", "GBTClassifier", "RandomForestClassifier"]


def churn_features(raw: DataFrame, **kwargs) -> DataFrame:
    return user_features(clean_clicks(raw), **kwargs)


def churn_scores(features: DataFrame, models: list[str] = MODELS, pca_share: float | None = None, percent: int = 80, seed: int = 123) -> DataFrame:
    """Class metrics of each model on held-out users; scaler and components see training users only."""
    columns = [c for c in features.columns if c not in ("userId", "churn")]
    picked = in_train("userId", percent, seed)
    rows = features.na.fill(0.0).withColumn("label", F.col("churn").cast("double")).persist(StorageLevel.MEMORY_AND_DISK)
    scaled = vector_scaler(columns).fit(rows.filter(picked)).transform(rows).select("userId", "label", "features")
    used = "features"
    if pca_share:
        model, _ = fit_components(scaled.filter(picked), pca_share)
        scaled, used = model.transform(scaled), "pcaFeatures"
    scaled = scaled.persist(StorageLevel.MEMORY_AND_DISK)
    results, schema = [], None
    try:
        for name in models:
            _, _, metrics = train_and_evaluate(scaled.filter(picked), scaled.filter(~picked), name, features=used)
            named = metrics.select(F.lit(name).alias("model"), "*")
            results += named.collect()  # one row a class
            schema = named.schema
    finally:
        scaled.unpersist()
        rows.unpersist()
    return features.sparkSession.createDataFrame(results, schema)
