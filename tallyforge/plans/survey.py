"""Survey pipeline: modelling table, split, linear model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import exprs as E
from ..ml.prep import split_by_key
from ..operators.choices import multi_hot
from ..operators.clean import drop_empty_columns, drop_incomplete, drop_text_columns, fill_means
from ..schemas import numeric_columns


def with_flags(survey: DataFrame) -> DataFrame:
    return survey.withColumns({"HigherEd": E.higher_ed("EdLevel"), "JobSatisfied": E.job_satisfied("JobSat")})


def modelling_table(
    survey: DataFrame, response: str, key: str, categories: bool = False, columns: list[str] | None = None, cutoff: float = 0.2
) -> DataFrame:
    """Rows with a response, no empty column, categories as dummies or dropped, gaps filled with means."""
    rows = drop_empty_columns(drop_incomplete(survey, [response]))
    if columns:
        rows = rows.select(key, *[c for c in columns if c in rows.columns], response)
    rows = multi_hot(rows, cutoff) if categories else drop_text_columns(rows)
    return fill_means(rows, [c for c in numeric_columns(rows) if c not in (key, response)])


def modelling_split(survey: DataFrame, response: str, key: str, percent: int = 70, seed: int = 42, **kwargs):
    """(table, train, test)."""
    table = modelling_table(survey, response, key, **kwargs)
    return table, *split_by_key(table, key, percent, seed)
