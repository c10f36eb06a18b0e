"""Helpers the operators share: input tables, scratch tables in the shared folder, row identity."""

from __future__ import annotations

import contextlib
import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..workspace import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def new_name(stem: str) -> str:
    """A column or table name that no input has."""
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def shares(totals: dict, most: int) -> dict:
    """How many rows of each kind are taken, ``most`` in all: the same of each, what rare kinds lack goes to the others; one at least."""
    taken, left = {}, most
    for i, kind in enumerate(sorted(totals, key=lambda k: (totals[k], k))):
        taken[kind] = min(totals[kind], max(1, left // (len(totals) - i)))
        left -= taken[kind]
    return taken


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session that holds for what runs within, and is then as it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


class Scratch:
    """Tables written once under ``spark.checkpoint.dir``, read back from there, dropped when they are no longer needed."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes the rows; what follows reads them and does not repeat the work, also after a lost executor.

        Spark drops the shuffle files of the write when it has ended: only the table is read again.
        """
        with setting(self.spark, CLEANUP, "true"):
            df.write.mode("error").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def per_worker(kind: str, key: str, make):
    """A value made once in each Python worker and kept for its later tasks, until the kind's next key takes its place."""
    kept = sys.modules.setdefault("tallyforge_worker_values", types.ModuleType("tallyforge_worker_values")).__dict__
    if kept.get(kind, (None,))[0] != key:
        kept[kind] = (key, make())
    return kept[kind][1]
