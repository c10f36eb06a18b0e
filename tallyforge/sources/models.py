"""Fitted models on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model, path: str) -> str:
    """Store a fitted model, replacing an earlier one at ``path``."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str, kind=PipelineModel):
    return kind.load(path)
