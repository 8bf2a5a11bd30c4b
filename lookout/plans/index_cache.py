"""Built indexes are reused across queries over the same corpus.

Building the postings, the idf model or the stem dictionary is the
expensive, write-once part of every search; queries only read the tables
it wrote to the checkpoint folder. Entries are keyed by the Spark
application, the input files' length and modification time (through the
Hadoop file system API, so any cluster file system works) and the build
parameters, so a changed input builds a fresh index."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import SparkSession

_CACHE: dict = {}


def file_signature(spark: SparkSession, path: str) -> tuple:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    statuses = fs.listStatus(p) if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]
    return tuple(sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in statuses))


def cached(spark: SparkSession, kind: str, inputs: list[str], params: tuple,
           build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, kind,
           tuple(file_signature(spark, p) for p in inputs), params)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def clear() -> None:
    _CACHE.clear()
