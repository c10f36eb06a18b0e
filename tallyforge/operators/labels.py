"""Packed message labels (``name-0;name-1;...``) to 0/1 columns, and label clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import exprs as E
from .clean import first_per_key
from .profile import _q

SEPARATOR = ";"


def label_names(df: DataFrame, packed: str = "categories", key: str = "id") -> DataFrame:
    """(position, label_name) as listed in the first row by ``key``."""
    cells = df.agg(F.min_by(_q(packed), _q(key)).alias("cell"))
    return cells.select(F.posexplode(F.split("cell", SEPARATOR)).alias("position", "c")).select(
        "position", E.packed_name("c").alias("label_name")
    )


def label_cells(df: DataFrame, packed: str = "categories", key: str = "id") -> DataFrame:
    """Long form: (key, label_name, label)."""
    return df.select(_q(key), F.explode(F.split(_q(packed), SEPARATOR)).alias("c")).select(
        _q(key), E.packed_name("c").alias("label_name"), E.packed_value("c").alias("label")
    )


def split_labels(df: DataFrame, names: list[str] | None = None, packed: str = "categories", key: str = "id") -> DataFrame:
    """One int column a label instead of the packed column. Without ``names`` they are those of the first row."""
    if names is None:
        names = [r.label_name for r in label_names(df, packed, key).orderBy("position").collect()]
    cells = F.split(_q(packed), SEPARATOR)
    return df.select(
        *[_q(c) for c in df.columns if c != packed],
        *[E.packed_value(F.get(cells, F.lit(i))).alias(name) for i, name in enumerate(names)],
    )


def label_sum(names: list[str]) -> Column:
    return sum((F.coalesce(_q(n), F.lit(0)) for n in names), F.lit(0))


def drop_unlabelled(df: DataFrame, names: list[str]) -> DataFrame:
    """Rows with at least one label."""
    return df.filter(label_sum(names) != 0)


def drop_rare_labels(df: DataFrame, names: list[str]) -> DataFrame:
    """Without the label columns whose total is 0 or 1; one summing pass decides."""
    totals = df.agg(*[F.sum(_q(n)).alias(n) for n in names]).first()
    return df.drop(*[n for n in names if totals[n] in (None, 0, 1)])


def clean_messages(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Label columns, no missing text, one row for each text (the first by id)."""
    return first_per_key(split_labels(df, names).filter(F.col("message").isNotNull()), "message", ["id"])
