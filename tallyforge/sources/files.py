"""Readers for event logs and delimited files, with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..fixed_values import NULL_TOKENS
from ..schemas import CLICKS


def read_event_log(spark: SparkSession, path: str, schema: T.StructType = CLICKS) -> DataFrame:
    """JSON-lines log, one event a line. A declared schema saves the inference pass."""
    return spark.read.schema(schema).json(path)


def read_table_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | T.StructType,
    types: dict[str, str] | None = None,
    null_tokens: list[str] = NULL_TOKENS,
    multi_line: bool = False,
) -> DataFrame:
    """CSV with header, quoted cells (which may span lines) and missing-value tokens.

    Everything is read as text, tokens become null, and only then are columns cast, so a
    stray word in a numeric column gives null instead of failing the job. Files
    are split; where cells span lines pass ``multi_line=True``, which reads each file in one task.
    """
    if isinstance(columns, T.StructType):
        types = {f.name: f.dataType.simpleString() for f in columns.fields if f.dataType != T.StringType()}
        columns = columns.names
    text = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    raw = (
        spark.read.schema(text)
        .option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
        .csv(path)
    )
    return typed(null_out(raw, null_tokens), types or {})


def null_out(df: DataFrame, tokens: list[str] = NULL_TOKENS) -> DataFrame:
    """Listed tokens become null in every text column."""
    return df.select([
        F.when(~F.col(f"`{f.name}`").isin(tokens), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select([
        F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns
    ])
