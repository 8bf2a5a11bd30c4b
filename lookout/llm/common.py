"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.session import checkpoint_root, materialize, ship_library

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20

__all__ = ["checkpoint_root", "documents", "id_text", "materialize", "pages",
           "parts_for", "prepare", "uniform01"]


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers and the checkpoint
    folder known. Every operator that runs Python calls it.

    Texts reach Python ``BATCH_ROWS`` and about ``BATCH_BYTES`` at a time, where the
    session still has Spark's defaults (10,000 and 64 MB): whole texts can be
    long, and a worker's memory holds a few batches."""
    checkpoint_root(spark)
    ship_library(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) == f"{64 << 20}b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty; all else dropped,
    so further columns of the input can never clash with an operator's."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def parts_for(amount: int, per_part: int) -> int:
    """Number of partitions for ``amount`` of work, ``per_part`` in each."""
    return max(1, math.ceil((amount or 0) / per_part))


def uniform01(*cols: Column) -> Column:
    """A repeatable uniform number in (0, 1) for each row's ``cols``."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
