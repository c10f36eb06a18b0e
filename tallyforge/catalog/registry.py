"""Registered queries: name -> (callable, oracle SQL or None, survey operators it covers)."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: str


QUERIES: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Registers the function under its own name."""
    def add(fn):
        if fn.__name__ in QUERIES:
            raise ValueError(f"two queries named {fn.__name__}")
        QUERIES[fn.__name__] = Query(fn, sql, covers)
        return fn
    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles rounded as in the oracle; a sum's last bits depend on its order."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})
