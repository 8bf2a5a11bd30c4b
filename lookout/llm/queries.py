"""Registered queries of the numbered operators, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.llm import (bpe_automaton, chat, imatch, minhash_dedup, packing, pii, quality, repair, secrets,
                         token_store, urls, vafile, vptree)
from lookout.llm.common import documents, pages

# folder of the public vocabulary files; set LOOKOUT_TOKENIZERS to use another copy
TOKENIZERS = os.environ.get("LOOKOUT_TOKENIZERS", "")
CAPACITY = 2048
URL_RULES: list[urls.Rule] = [("block", "net", "/"), ("allow", "example.net", "/en/"),
                              ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def tokenizer(name: str) -> str:
    """Path of a vocabulary file on driver and workers."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir), threshold=85)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_store.write_store(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"), lower=True, end_id=1)
    return token_store.read_store(spark, folder)


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir), whole=True)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vptree.clean(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return vptree.nearest(vectors, F.col("vec_id") % 20 == 0, 20, factor=1.0)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), lower=False, end_id=0,
                                  capacity=CAPACITY)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.encode_decode(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(pages(spark, sf_dir), URL_RULES)


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (op1_minhash_dedup, op2_token_store, op3_imatch, op4_secrets, op5_quality,
                                   op6_nearest, op7_packing, op8_bpe, op9_pii, op10_urls, op11_chat, op12_repair,
                                   op13_clusters)}

# The method's own output (near-copy links, ids of a vocabulary, mined rules, fitted
# weights, ...) of the others has no SQL form; tests/llm holds them against brute force.
ORACLE: dict[str, str] = {"op11_chat": chat.oracle(), "op12_repair": repair.oracle(), "op13_clusters": vafile.oracle()}
