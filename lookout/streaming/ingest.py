"""Incremental ingest with Structured Streaming.

Pages arrive over time (a crawl writes them batch by batch). The same
extraction job and the same in-row term counting used in batch run on each
micro-batch: both are stateless per row, so the streams need no state store
and append exactly once to Parquet sinks; progress lives in a checkpoint
under the shared checkpoint folder, so a restarted or re-scheduled query
resumes where it stopped.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import corpus as C
from ..operators import extract as EX
from ..session import checkpoint_root

PAGE_SCHEMA = "page_id bigint, url string, html string"
DOCUMENT_SCHEMA = "doc_id bigint, text string"


def _start(df: DataFrame, sink: str, name: str, available_now: bool) -> StreamingQuery:
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", sink)
              .option("checkpointLocation",
                      os.path.join(checkpoint_root(df.sparkSession), "streams", name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.queryName(name).start()


def stream_places(spark: SparkSession, pages_dir: str, sink: str, name: str = "places",
                  available_now: bool = False, max_files_per_trigger: int = 64) -> StreamingQuery:
    """Parquet files of ``(page_id, url, html)`` landing in ``pages_dir`` ->
    typed place records appended to ``sink``."""
    pages = (spark.readStream.schema(PAGE_SCHEMA)
             .option("maxFilesPerTrigger", max_files_per_trigger).parquet(pages_dir))
    places = EX.extract_places(pages)
    return _start(places, sink, name, available_now)


def stream_postings(spark: SparkSession, docs_dir: str, sink: str, name: str = "postings",
                    available_now: bool = False, max_files_per_trigger: int = 64) -> StreamingQuery:
    """Parquet files of ``(doc_id, text)`` -> ``(doc_id, term, tf)`` rows
    appended to ``sink``. Counting is inside each document row, so a
    micro-batch shuffles nothing."""
    docs = (spark.readStream.schema(DOCUMENT_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(docs_dir))
    toks = docs.select("doc_id", F.array_sort(C.T.normalized_tokens(F.col("text"))).alias("_s"))
    return _start(C.run_counts(toks, "_s"), sink, name, available_now)
