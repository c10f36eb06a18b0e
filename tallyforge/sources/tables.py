"""Stored tables: replace, load and split into text, labels and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import DICTIONARY
from .files import read_table_csv


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` over whatever ``path`` holds and return the stored table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_labelled(
    table: DataFrame, text: str = "message", not_labels: list[str] | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """(text column, label columns, label names); labels are told by name, not by position."""
    if not_labels is None:
        not_labels = ["id", "message", "original", "genre"]
    names = [c for c in table.columns if c not in not_labels]
    return table.select("id", text), table.select("id", *names), names


def join_on_id(messages: DataFrame, categories: DataFrame, key: str = "id") -> DataFrame:
    """Messages with their packed labels, matched on the common id."""
    return messages.join(categories, key, "inner")


def repeated_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once; empty when ``key`` is unique."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return read_table_csv(spark, path, DICTIONARY)


def column_description(dictionary: DataFrame, column: str) -> DataFrame:
    return dictionary.filter(F.col("Column") == column).select("Column", "QuestionText")


def describe_columns(names: DataFrame, dictionary: DataFrame, name_col: str) -> DataFrame:
    """Question text beside each listed column name; unknown columns keep a null text."""
    return names.join(dictionary, names[name_col] == dictionary["Column"], "left").drop("Column")


def shared_columns(one: DataFrame, other: DataFrame) -> DataFrame:
    """Column names that both data dictionaries list."""
    return one.select("Column").intersect(other.select("Column"))


def dictionary_of(df: DataFrame) -> DataFrame:
    """A data dictionary of ``df``'s own columns."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, DICTIONARY)
