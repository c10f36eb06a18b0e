"""Shared scratch space: checkpoints and hand-over tables that outlive an executor."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tallyforge-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/tallyforge/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result is read from shared storage, not recomputed."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def keep(df: DataFrame, label: str) -> DataFrame:
    """The rows written once under the shared folder and read back: later steps and lost executors read them, nothing is repeated."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame, label: str, by: str | None = None) -> Iterator[DataFrame]:
    """As ``keep``, for as long as the block runs: the table is removed when it ends. Values of a column ``by`` are read apart."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _read_only(plan) -> bool:
    """Whether a plan only filters and selects from stored files."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    return plan.nodeName() in ("Project", "Filter", "LogicalRelation") and (bool(children) or plan.nodeName() == "LogicalRelation") and all(map(_read_only, children))


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Rows to be read again and again: as they are if they only select from stored files, else as ``kept``."""
    if _read_only(df._jdf.queryExecution().optimizedPlan()):
        yield df
    else:
        with kept(df, label) as rows:
            yield rows


def sweep(spark: SparkSession) -> None:
    """What was shuffled for tables that are written and no longer in use is removed now, not at the driver's next collection."""
    gc.collect()
    spark._jvm.System.gc()
