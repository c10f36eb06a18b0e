"""Category encodings."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, functions as F

from ..schemas import text_columns
from .profile import _q

MAX_COLUMNS = 2000


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """0, 1, ... by the sorted order of the class values."""
    model = StringIndexer(inputCol=column, outputCol=out, stringOrderType="alphabetAsc").fit(df)
    return model.transform(df).withColumn(out, _q(out).cast("int"))


def one_hot(df: DataFrame, columns: list[str] | None = None, values: dict[str, list[str]] | None = None) -> DataFrame:
    """One 0/1 column for every value of every text column, none left out; a null is all 0.

    Values can be given; otherwise one distinct pass finds them, and more than
    ``MAX_COLUMNS`` of them is an error that points to ``one_hot_vector``.
    """
    columns = columns or text_columns(df)
    if values is None:
        found = (
            df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), _q(c).alias("value")) for c in columns])))
            .filter("value is not null").distinct().limit(MAX_COLUMNS + 1).collect()
        )
        if len(found) > MAX_COLUMNS:
            raise ValueError("too many values for one column each: use one_hot_vector")
        values = {c: sorted(r.value for r in found if r.field == c) for c in columns}
    return df.select(
        *[_q(c) for c in df.columns if c not in columns],
        *[F.coalesce((_q(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for c in columns for v in values[c]],
    )


def one_hot_vector(columns: list[str]) -> Pipeline:
    """The same as sparse vectors, ``<column>_vec``, for columns with many values."""
    index = StringIndexer(
        inputCols=columns, outputCols=[f"{c}_idx" for c in columns],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    )
    encode = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns], dropLast=False
    )
    return Pipeline(stages=[index, encode])
