"""Scoring new rows with a stored model, and advice links for predicted labels."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as fixed
from ..operators.profile import _q


def score(model: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(rows).select(*[_q(c) for c in keep], "prediction")


def advice_links(spark: SparkSession, links: dict[str, str] = fixed.ADVICE_LINKS) -> DataFrame:
    return spark.createDataFrame(list(links.items()), "label_name string, link string")


def with_advice(predicted: DataFrame, links: DataFrame) -> DataFrame:
    """Adds the link of each predicted label, matched by name; labels without one keep a null."""
    return predicted.join(links, "label_name", "left")


def predicted_labels(scored: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """(key, label_name, prediction) from the ``prediction_<label>`` columns."""
    return scored.select(_q(key), F.inline(F.array(*[
        F.struct(F.lit(c).alias("label_name"), _q(f"prediction_{c}").cast("int").alias("prediction")) for c in labels
    ])))


def links_of_predicted_labels(model, rows: DataFrame, key: str, labels: list[str], links: DataFrame) -> DataFrame:
    """(key, label_name, link): the labels a model predicts for each row, and only these, with their links by name.

    ``rows`` may be a stream when the model's transform is made of expressions: the links are then the static side of the join.
    """
    predicted = predicted_labels(model.transform(rows), key, labels).filter(F.col("prediction") == 1)
    return with_advice(predicted.select(_q(key), "label_name"), links).select(_q(key), "label_name", "link")
