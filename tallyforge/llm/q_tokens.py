"""Queries of the run and byte-level token operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, periodic
from .common import table
from .registry import llm_query


@llm_query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, every tenth with planted periods: number of runs, the strongest one, digests of all runs and of the rest."""
    return periodic.run_digests(periodic.periodic_runs(periodic.with_planted_periods(table(spark, sf_dir, "documents"))))


@llm_query()
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by the many-language ranks and decoded again: number of tokens, digests of ids and of decoded bytes."""
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), byte_bpe.load_vocabulary())
