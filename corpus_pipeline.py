"""Corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; all but the last return the columns of ``docs``. Stages
are written as Parquet and read again before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.llm import minhash_dedup, packing, pii, quality
from lookout.llm.common import documents, materialize
from lookout.llm.queries import CAPACITY, tokenizer
from lookout.session import Scratch, discard


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance-resampling classifier keeps."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id.
    Repeated rows of one id are one document; rows without an id stay."""
    with Scratch() as temp:
        gone = minhash_dedup.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
        gone = temp.keep(materialize(gone, "dropped-ids"))
    left = docs.join(gone, F.col("doc_id").cast("long") == F.col("gone"), "left_anti")
    return minhash_dedup.one_row_per_id(left)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by its kind."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and place in sequences."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), lower=False, end_id=0, capacity=CAPACITY,
                                  with_ids=True)


STAGES = [("quality", quality_stage), ("dedup", dedup_stage), ("pii", pii_stage), ("packing", packing_stage)]

# learned weights, near-copy links and tokenizer ids have no SQL form; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = documents(spark, sf_dir)
    before = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
            if before is not None:
                discard(before)                # the stage after it is written
            before = docs
    return docs
