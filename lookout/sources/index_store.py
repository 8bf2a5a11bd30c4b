"""The persisted index (S6): term-ordered posting blocks, bitmaps and a directory.

A document is numbered by its place in the input (``doc_no``, see
:func:`lookout.operators.corpus.forward_index`); ``2^BLOCK_BITS`` numbers make a
block, ``2^BUCKET_BITS`` a bucket, which is what one of Spark's bitmaps covers.

``blocks``
    one row per (term, block): number of postings, greatest weight, and the
    postings themselves, ``entries``. Ranged on (term, block) into shards, one
    folder and file each, so a term of any frequency spans as many shards as it needs
    and a row never holds more than a block.
``bitmaps``
    one row per (term, bucket) that at least ``DENSE`` documents share. A term in all
    documents costs one bitmap a bucket; of sparser ones the blocks are enough.
``directory``
    one row per (term, shard): where a term's postings are, with its statistics.

A search looks its terms up in the directory first. The (term, shard) pairs it gets
are a small written table; joined to ``blocks`` they prune the scan to the
shards that hold the terms (dynamic partition pruning), and the terms' range
prunes row groups inside them.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, label, materialize, partitions_for, shuffles_go, written_bytes

BLOCK_BITS = 3
BUCKET_BITS = 15
DENSE = 1024
SHARD_BYTES = 16 << 20       # of postings as written; sorting them takes some ten times as much memory
POSTING_BYTES = 16           # of a posting as written, about

ENTRY = "array<struct<at:int,doc_id:bigint,tf:bigint,weight:double>>"
BLOCKS = f"term string, block bigint, n bigint, max_weight double, entries {ENTRY}, shard int"
BITMAPS = "term string, bucket bigint, n bigint, bitmap binary, shard int"
DIRECTORY = "term string, shard int, n bigint, max_weight double, df bigint, cf bigint, idf double"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")


class PostingStore:
    """A persisted index: written by :meth:`write`, opened again with its path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(os.path.join(self.path, name))

    @property
    def blocks(self) -> DataFrame:
        return self._table("blocks", BLOCKS)

    @property
    def bitmaps(self) -> DataFrame:
        return self._table("bitmaps", BITMAPS)

    @property
    def directory(self) -> DataFrame:
        return self._table("directory", DIRECTORY)

    # ------------------------------------------------------------- write --

    @classmethod
    def write(cls, postings: DataFrame, stats: DataFrame, path: str | None = None, shards: int | None = None,
              dense: int = DENSE) -> "PostingStore":
        """:meth:`_write`, leaving no shuffle files behind."""
        with shuffles_go(postings.sparkSession):
            return cls._write(postings, stats, path, shards, dense)

    @classmethod
    def _write(cls, postings: DataFrame, stats: DataFrame, path: str | None = None, shards: int | None = None,
              dense: int = DENSE) -> "PostingStore":
        """Write ``postings`` (``doc_no, doc_id, term, tf, weight``; a null weight means that the
        term isn't in the ranked vocabulary) with the terms' ``stats`` (``term, df, cf, idf``).
        ``postings`` are evaluated twice, as their term boundaries are sampled first: a written table, or
        one scan of such. Those of unknown size need ``shards``. With a column ``shard`` (see :func:`term_places`) they
        are dealt by it instead, and evaluated once."""
        spark = postings.sparkSession
        path = path or scratch_path(spark, "index")
        store = cls(spark, path)
        n = shards or partitions_for(spark, written_bytes(postings), SHARD_BYTES)
        block = F.shiftright("doc_no", BLOCK_BITS)               # made after the shuffle: it isn't sent along
        entry = F.struct(F.col("doc_no").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("at"),
                         "doc_id", "tf", "weight")
        aggregates = (F.count(F.lit(1)).alias("n"), F.max("weight").alias("max_weight"), F.sort_array(F.collect_list(entry)).alias("entries"))
        if "shard" in postings.columns:
            dealt = postings.select(label(spark, n, F.col("shard")).alias("shard"), "term", "doc_no", "doc_id", "tf", "weight").repartition(n, "shard")
            blocks = dealt.groupBy("shard", "term", block.alias("block")).agg(*aggregates)
        else:
            postings = postings.select("term", "doc_no", "doc_id", "tf", "weight")
            blocks = postings.repartitionByRange(n, F.col("term"), block).withColumn("block", block).groupBy("term", "block").agg(*aggregates)
        blocks.withColumn("shard", F.spark_partition_id()).sortWithinPartitions("term", "block") \
            .write.option("compression", "zstd").partitionBy("shard").parquet(os.path.join(path, "blocks"))

        places = store.blocks.groupBy("term", "shard").agg(F.sum("n").alias("n"), F.max("max_weight").alias("max_weight"))
        places.join(stats.select("term", "df", "cf", "idf"), "term") \
            .select("term", "shard", "n", "max_weight", "df", "cf", "idf") \
            .repartitionByRange(partitions_for(spark, written_bytes(stats), SHARD_BYTES), "term").sortWithinPartitions("term") \
            .write.parquet(os.path.join(path, "directory"))

        bucket = F.shiftright("block", BUCKET_BITS - BLOCK_BITS).alias("bucket")
        crowded = store.blocks.select("term", bucket, "shard", "n").groupBy("term", "bucket") \
            .agg(F.sum("n").alias("n"), F.min("shard").alias("home")).where(F.col("n") >= dense)
        crowded = materialize(crowded, "crowded")
        bits = store.blocks.select("term", "block", bucket, F.explode("entries.at").alias("at")) \
            .join(crowded, ["term", "bucket"])
        bits.groupBy("home", "term", "bucket", "n").agg(F.bitmap_construct_agg(bucket_position("block", "at")).alias("bitmap")) \
            .select("term", "bucket", "n", "bitmap", F.col("home").alias("shard")).repartition("shard") \
            .sortWithinPartitions("shard", "term", "bucket").write.partitionBy("shard").parquet(os.path.join(path, "bitmaps"))
        return store

    # -------------------------------------------------------------- read --

    def locate(self, query_terms: DataFrame) -> DataFrame:
        """Where each term of a batch is: the columns of ``query_terms`` and of the directory, one row per
        (query, term, shard). Terms that the index doesn't hold drop out. Written once: its size is known, as is
        that of the terms, so a batch of usual size is broadcast and the directory isn't shuffled."""
        return materialize(materialize(query_terms, "query-terms").join(self.directory, "term"), "located")

    def prune(self, table: DataFrame, located: DataFrame) -> DataFrame:
        """Rows of ``table`` (blocks or bitmaps) of the located terms. The pairs are few, so the planner
        broadcasts them and hands their shards to the scan as a partition filter."""
        pairs = located.where("n > 0").select("shard", "term").distinct()
        return table.join(pairs, ["shard", "term"], "left_semi")

    def postings(self) -> DataFrame:
        """All postings as rows: ``term, doc_id, tf, weight``."""
        return self.blocks.select("term", F.inline("entries")).select("term", "doc_id", "tf", "weight")

    def lookup(self, terms: DataFrame) -> DataFrame:
        """Postings of the terms of a batch (column ``term``): ``term, doc_id, tf, weight``."""
        located = self.locate(terms.select("term").distinct())
        return self.prune(self.blocks, located).select("term", F.inline("entries")).select("term", "doc_id", "tf", "weight")


def term_places(stats: DataFrame, rows: int, shards: int) -> DataFrame:
    """``term, idf, first, span``, written: where the postings of each term go, from ``stats`` (``term, df, idf``): all
    ``rows`` of them in term order make ``shards`` of about equal size, and a term's lie in ``span`` shards from ``first``
    on. A term of any frequency thus has as many as it needs, and no posting is sampled."""
    spark = stats.sparkSession
    ranged = materialize(stats.select("term", "df", "idf").repartitionByRange(partitions_for(spark, written_bytes(stats), SHARD_BYTES), "term")
                         .sortWithinPartitions("term").withColumn("_mono", F.monotonically_increasing_id()), "ranged-terms") \
        .withColumn("_part", F.shiftright("_mono", 33))
    order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)      # over one row per range partition
    sums = ranged.groupBy("_part").agg(F.sum("df").alias("n")).select("_part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("offset"))
    before = F.col("offset") + F.coalesce(F.sum("df").over(Window.partitionBy("_part").orderBy("_mono").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shard = lambda at: F.floor(at.cast("double") * shards / max(1, rows)).cast("int")           # noqa: E731
    placed = ranged.join(F.broadcast(sums), "_part").withColumn("_at", before) \
        .select("term", "idf", F.least(shard(F.col("_at")), F.lit(shards - 1)).alias("first"),
                F.least(shard(F.col("_at") + F.col("df") - 1), F.lit(shards - 1)).alias("last"))
    return materialize(placed.select("term", "idf", "first", (F.col("last") - F.col("first") + 1).alias("span")), "term-places")


def shard_of(block: Column) -> Column:
    """The shard of a posting, from its term's place and its block."""
    return F.col("first") + F.pmod(F.xxhash64(block), F.col("span")).cast("int")


def bucket_position(block: str, at: str):
    """The bit of a bucket's bitmap that stands for document ``at`` of ``block``."""
    in_bucket = F.col(block).bitwiseAND(F.lit((1 << (BUCKET_BITS - BLOCK_BITS)) - 1))
    return F.shiftleft(in_bucket, BLOCK_BITS) + F.col(at)


def has_bit(bitmap: Column, position: Column) -> Column:
    """True where the bitmap holds the bit (byte ``position / 8``, lowest bit first)."""
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, position.bitwiseAND(F.lit(7)).cast("int")) == 1
