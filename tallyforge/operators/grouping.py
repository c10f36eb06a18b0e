"""Class profiles, group means, value counts and column shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exprs import has_word
from .profile import _q, unpivoted


def class_profile(df: DataFrame, column: str, high: str, low: str) -> DataFrame:
    """One row: records, records of each class, percent of the high class."""
    return df.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(_q(column) == high).alias("n_greater_50k"),
        F.count_if(_q(column) == low).alias("n_at_most_50k"),
    ).withColumn("greater_percent", F.try_divide(F.col("n_greater_50k") * 100, F.col("n_records")))


def mean_by_dimensions(df: DataFrame, value: str, group: str, dimensions: list[str]) -> DataFrame:
    """(group, dimension, level, mean) for many dimensions in one scan and one shuffle."""
    cells = unpivoted(df, [group, value], dimensions, "dimension", "level", "string")
    return cells.groupBy(_q(group), "dimension", "level").agg(F.avg(_q(value)).alias("mean_value"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(_q(column)).agg(F.count(F.lit(1)).alias("n"))


def label_counts_with_word(
    df: DataFrame, word: str, label: str, text: str = "message", ignore_case: bool = True
) -> DataFrame:
    """(label value, n) among the messages that contain a word."""
    return value_counts(df.filter(has_word(_q(text), word, ignore_case)), label)


def group_means(df: DataFrame, value: str, by: list[str], where: Column | None = None) -> DataFrame:
    """Mean of ``value`` by one or more columns, optionally among the rows of a predicate."""
    rows = df if where is None else df.filter(where)
    known = None
    for c in by:
        known = _q(c).isNotNull() if known is None else known & _q(c).isNotNull()
    return rows.filter(known).groupBy(*[_q(c) for c in by]).agg(F.avg(_q(value)).alias("mean_value"))


def compare_group_means(later: DataFrame, earlier: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Two years' group means side by side with their difference (inner)."""
    a, b = names
    return (
        later.withColumnRenamed("mean_value", a)
        .join(earlier.withColumnRenamed("mean_value", b), by)
        .withColumn("Diff_Vals", _q(a) - _q(b))
    )


def column_totals(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, total, share): sum and mean of each column, in one pass."""
    stats = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.sum(_q(c)).cast("double").alias("total"), F.avg(_q(c)).alias("share"))
        for c in columns
    ])
    return df.agg(stats.alias("s")).select(F.inline("s"))


def drop_rare_columns(df: DataFrame, columns: list[str], min_share: float) -> DataFrame:
    """Without the listed columns whose mean is below ``min_share``."""
    means = df.agg(*[F.avg(_q(c)).alias(c) for c in columns]).first()
    rare = {c for c in columns if means[c] is not None and means[c] < min_share}
    return df.select([_q(c) for c in df.columns if c not in rare])
