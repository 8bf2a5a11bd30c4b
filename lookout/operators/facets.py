"""Many search requests at once over a stored field index.

A :class:`FacetIndex` is built once from a place table and written:

* ``store``, a :class:`~lookout.sources.index_store.PostingStore` whose terms are ``field:word``;
* ``facets``, one row per (facet, value, bucket of places) with a bitmap of the places
  that have the value: price bands, regions, cards, facilities (lists in lower case);
* ``places``, the columns that results show.

Requests are rows: ``request_id, name, city, cuisine string, price_low, price_high string,
regions, cards, facilities array<string>``. A request's conditions become rows too. Values
that one condition allows are united, conditions are intersected, all on bitmaps per
(request, bucket); only then are words looked up, in the shards that hold them, and
only places that pass are scored. No step groups by word or facet value alone.

Null or empty texts and lists ask for nothing; a null price bound is the end of the
scale, an unknown band lets no place pass; places whose band is unknown pass no
request, as in :func:`~lookout.operators.search.filter_price`.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import materialize
from ..sources.index_store import BLOCK_BITS, BUCKET_BITS, PostingStore, bucket_position, has_bit, scratch_path
from .search import PRICE_BANDS, price_ordinal, top_k

SHOWN = ("name", "address", "city", "cuisine", "price_range", "region", "website")
# which cleaner a field and a request's text for it go through (T9 or T10)
FIELDS = {"name": T.clean_field, "city": T.clean_basic, "cuisine": T.clean_field}


def _field_words(rows: DataFrame, *keys: str) -> DataFrame:
    """``(keys, term, mult)``: the cleaned words of each field, as ``field:word``, counted inside the row."""
    def marked(field: str, clean) -> Column:
        return F.transform(T.words(clean(F.col(field))), lambda w: F.concat(F.lit(field + ":"), w))

    words = F.flatten(F.array(*[marked(f, clean) for f, clean in FIELDS.items()]))
    listed = rows.select(*keys, words.alias("_w"))
    counted = F.transform(F.array_distinct("_w"), lambda w: F.struct(
        w.alias("term"), F.size(F.filter("_w", lambda x: x == w)).cast("bigint").alias("mult")))
    return listed.select(*keys, F.inline(counted))


def _facet_values(row: str = "") -> Column:
    """The facets of a place as an array of ``(facet, value)``."""
    def each(facet: str, values: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.transform(F.array_distinct(F.coalesce(values, none)),
                           lambda v: F.struct(F.lit(facet).alias("facet"), v.alias("value")))
    return F.filter(F.concat(
        each("price", F.array(price_ordinal(F.col("price_range")).cast("string"))), each("region", F.array("region")),
        each("card", F.transform("cards", lambda v: F.lower(v))),
        each("facility", F.transform("facilities", lambda v: F.lower(v)))), lambda x: x["value"].isNotNull())


def conditions(requests: DataFrame) -> DataFrame:
    """``(request_id, n_conditions, condition, facet, value)``: a place passes a condition by any of
    its values, and a request by all conditions."""
    scale = F.array(*[F.lit(b) for b in PRICE_BANDS])
    low = F.array_position(scale, F.coalesce("price_low", F.lit(PRICE_BANDS[0])))
    high = F.array_position(scale, F.coalesce("price_high", F.lit(PRICE_BANDS[-1])))
    bands = F.when((low > 0) & (high >= low), F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    none = F.array().cast("array<string>")

    def condition(name: Column, facet: str, values: Column) -> Column:
        return F.struct(name.alias("condition"), F.lit(facet).alias("facet"), values.alias("values"))

    def every(col: str, facet: str) -> Column:
        wanted = F.array_distinct(F.transform(F.coalesce(col, none), lambda v: F.lower(v)))
        return F.transform(wanted, lambda v: condition(F.concat(F.lit(facet + ":"), v), facet, F.array(v)))

    regions = F.coalesce("regions", none)
    either = F.array(condition(F.lit("price"), "price", F.transform(bands, lambda b: b.cast("string"))))
    place = F.when(F.size(regions) > 0, F.array(condition(F.lit("region"), "region", F.array_distinct(regions)))) \
        .otherwise(F.slice(either, 1, 0))
    listed = requests.select("request_id", F.concat(either, place, every("cards", "card"), every("facilities", "facility")).alias("c"))
    return listed.select("request_id", F.size("c").alias("n_conditions"), F.inline("c")) \
        .select("request_id", "n_conditions", "condition", "facet", F.explode("values").alias("value"))


class FacetIndex:
    """The stored field index and facet bitmaps of a place table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.store = PostingStore(spark, os.path.join(path, "words"))

    @property
    def facets(self) -> DataFrame:
        return self.spark.read.schema("facet string, value string, bucket bigint, bitmap binary").parquet(os.path.join(self.path, "facets"))

    @property
    def places(self) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, "places"))

    @classmethod
    def write(cls, places: DataFrame, path: str | None = None, shards: int | None = None) -> "FacetIndex":
        """Write the index of ``places``: ``doc_id``, the searched fields, ``price_range``, ``region``, ``cards``,
        ``facilities`` and, if they are there, the other columns that results show."""
        spark = places.sparkSession
        path = path or scratch_path(spark, "facet-index")
        index = cls(spark, path)
        shown = [F.col(c) if c in places.columns else F.lit(None).cast("string").alias(c) for c in SHOWN]
        places.select(F.monotonically_increasing_id().alias("doc_no"), "doc_id", *shown, "cards", "facilities") \
            .write.parquet(os.path.join(path, "places"))
        words = materialize(_field_words(index.places, "doc_no", "doc_id")
                            .select("doc_no", "doc_id", "term", F.col("mult").alias("tf"), F.lit(1.0).alias("weight")), "field-words")
        stats = words.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"), F.lit(1.0).alias("idf"))
        PostingStore.write(words, materialize(stats, "field-stats"), os.path.join(path, "words"), shards)
        block, at = F.shiftright("doc_no", BLOCK_BITS).alias("block"), F.col("doc_no").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("at")
        index.places.select(block, at, F.shiftright("doc_no", BUCKET_BITS).alias("bucket"), F.inline(_facet_values())) \
            .groupBy("facet", "value", "bucket").agg(F.bitmap_construct_agg(bucket_position("block", "at")).alias("bitmap")) \
            .write.parquet(os.path.join(path, "facets"))
        return index

    def field_index(self) -> DataFrame:
        """V9: ``(field, term, doc_id)`` without duplicates."""
        return self.store.postings().select(F.substring_index("term", ":", 1).alias("field"),
                                            F.expr("substring(term, locate(':', term) + 1)").alias("term"), "doc_id")

    def allowed(self, requests: DataFrame) -> DataFrame:
        """``(request_id, bucket, bitmap)``: the places that pass all of a request's conditions."""
        asked = materialize(conditions(requests), "conditions")
        return self.facets.join(asked, ["facet", "value"]).groupBy("request_id", "n_conditions", "condition", "bucket") \
            .agg(F.bitmap_or_agg("bitmap").alias("bitmap")).groupBy("request_id", "n_conditions", "bucket") \
            .agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("n")) \
            .where((F.col("n") == F.col("n_conditions")) & (F.bitmap_count("bitmap") > 0)).select("request_id", "bucket", "bitmap")

    def _hits(self, requests: DataFrame) -> DataFrame:
        """Postings of the requests' words: ``request_id, mult, block, bucket, at, doc_id``."""
        located = self.store.locate(_field_words(requests, "request_id").withColumnRenamed("request_id", "query_id"))
        bucket = F.shiftright("block", BUCKET_BITS - BLOCK_BITS).alias("bucket")
        return self.store.blocks.select("shard", "term", "block", bucket, "entries.at", "entries.doc_id") \
            .join(located.where("n > 0").select("shard", "term", F.col("query_id").alias("request_id"), "mult"), ["shard", "term"])

    def match_scores(self, requests: DataFrame) -> DataFrame:
        """``(request_id, doc_id, score)``, +1 per (field, request word) hit, a repeated word again."""
        return self._hits(requests).select("request_id", "mult", F.inline(F.arrays_zip("at", "doc_id"))) \
            .groupBy("request_id", "doc_id").agg(F.sum("mult").alias("score"))

    def search(self, requests: DataFrame, top_n: int = 10) -> DataFrame:
        """The best ``top_n`` places of each request that pass its conditions and share a word with it:
        ``request_id, rank, doc_id, score`` and the shown columns."""
        hits = self._hits(requests).join(self.allowed(requests), ["request_id", "bucket"]) \
            .select("request_id", "mult", "block", "bitmap", F.inline(F.arrays_zip("at", "doc_id"))) \
            .where(has_bit(F.col("bitmap"), bucket_position("block", "at")))
        best = top_k(hits.groupBy("request_id", "doc_id").agg(F.sum("mult").alias("score")), top_n, "request_id")
        return best.join(self.places.select("doc_id", *SHOWN), "doc_id") \
            .select("request_id", "rank", "doc_id", F.col("score").cast("bigint").alias("score"), *SHOWN)
