import os

from lookout.operators import corpus as C
from lookout.operators.extract import extract_places
from lookout.sources import index_store as IS
from lookout.streaming.ingest import stream_places, stream_postings

SF = "/root/testdata/sf0.001"


def _land(spark, df, folder, parts):
    # the crawl delivers the data as several files over time
    df.repartition(parts).write.mode("overwrite").parquet(folder)


def test_stream_postings_equal_batch(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    src, sink = IS.scratch_path(spark, "docs-in"), IS.scratch_path(spark, "postings-out")
    _land(spark, docs, src, 4)
    q = stream_postings(spark, src, sink, name="test_postings", available_now=True,
                        max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    want = sorted(tuple(r) for r in C.term_counts(docs).collect())
    assert got == want


def test_stream_places_equal_batch(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    src, sink = IS.scratch_path(spark, "pages-in"), IS.scratch_path(spark, "places-out")
    _land(spark, pages, src, 3)
    q = stream_places(spark, src, sink, name="test_places", available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    want = sorted(tuple(r) for r in extract_places(pages).collect())
    assert got == want and len(got) == pages.count()
