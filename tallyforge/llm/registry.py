"""Registered queries of this subpackage: name -> (callable, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class LlmQuery(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


LLM_QUERIES: dict[str, LlmQuery] = {}


def llm_query(sql: str | None = None):
    def add(fn):
        LLM_QUERIES[fn.__name__] = LlmQuery(fn, sql)
        return fn
    return add
