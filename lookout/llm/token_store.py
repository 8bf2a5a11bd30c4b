"""Token-id store: documents as token ids, each compressed on its own with a
shared zstandard dictionary, in blocks with an offset index.

The dictionary is trained on the serialised id arrays of a bounded sample of
documents (``SAMPLE_DOCS`` documents with the smallest hash of id and text, at
most ``SAMPLE_BYTES`` of each). Layout below the store's folder, all written by
Spark, so any store that Spark writes to will do:

* ``dictionary``: one row, ``dict_hash`` and the dictionary's bytes;
* ``blocks``: rows in ascending ``doc_id`` order. A block holds the frames of
  about ``BLOCK_BYTES`` of documents in ``payload`` and their index
  (``doc_ids``, ``offsets``, ``lengths``, ``n_tokens``), so one short document is
  read by pruning on ``first_doc``/``last_doc``, slicing the payload and
  decompressing one frame with the dictionary named by ``dict_hash``.

Defined results: null text is empty (only the end id); rows with null
``doc_id`` come first; rows of equal ``doc_id`` keep one frame each, ordered by
their frames' hash, and many of them span shards; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lookout.llm.common import checkpoint_root, id_text, materialize, parts_for, prepare
from lookout.llm.tokens import id_encoder, slices

SAMPLE_DOCS = 1000
SAMPLE_BYTES = 16_384
DICT_BYTES = 65_536
BLOCK_BYTES = 256 << 10
SHARD_BYTES = 32 << 20
# A reader holds one row group of blocks, so these are small; payloads are compressed already.
BLOCK_FILES = {"compression": "uncompressed", "parquet.block.size": str(4 << 20),
               "parquet.block.size.row.check.min": "4", "parquet.page.size.row.check.min": "1"}
LEVEL = 3

FRAMES = "doc_id long, n_tokens int, frame binary"
BLOCKS = ("shard int, block int, first_doc long, last_doc long, doc_ids array<long>, offsets array<int>,"
          " lengths array<int>, n_tokens array<int>, total long, dict_hash string, payload binary")
READ = "shard int, block int, doc_id long, local_start long, n_tokens long, ids_crc32 long, place int"


def narrow(ids: bytes) -> bytes:
    """Serialised ids: unsigned 16 bits where all fit, after a width byte."""
    wide = np.frombuffer(ids, "<u4")
    if len(wide) and wide.max() > 0xFFFF:
        return b"\x04" + ids
    return b"\x02" + wide.astype("<u2").tobytes()


def widen(data: bytes) -> np.ndarray:
    """The id array (unsigned 32 bits) of serialised ids."""
    return np.frombuffer(data, "<u2" if data[:1] == b"\x02" else "<u4", offset=1).astype("<u4")


def _ids(texts: list[str], path: str, lower: bool, end: int) -> list[bytes]:
    tail = array("I", [end]).tobytes()
    return [ids + tail for ids in id_encoder(path, lower).encode(texts)]


def _train(docs: DataFrame, path: str, lower: bool, end: int) -> bytes:
    import zstandard

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            data = [narrow(x)[:SAMPLE_BYTES] for x in _ids(texts, path, lower, end)]
            yield pa.RecordBatch.from_pydict({"data": pa.array(data, pa.binary())})

    # the smallest hashes first, eight bytes a row; then the texts that have them, repeated rows once
    hashed = docs.select(F.xxhash64("doc_id", "text").alias("_o"), F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    least = [r[0] for r in hashed.select("_o").orderBy("_o").limit(SAMPLE_DOCS).collect()]
    sample = hashed.where(F.col("_o").isin(least)).groupBy("_o").agg(F.first("text").alias("text")).select("text")
    samples = sorted(bytes(r.data) for r in sample.mapInArrow(serialise, "data binary").collect())
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:          # too few samples to train on: a raw-content dictionary
        return b"".join(samples)[:DICT_BYTES]


def write_store(docs: DataFrame, tokenizer: str, lower: bool, end_id: int,
                folder: str | None = None) -> str:
    """Tokenise ``docs`` (``doc_id``, ``text``) and write the store; returns
    its folder. ``tokenizer`` is the path of a vocabulary file."""
    spark = docs.sparkSession
    prepare(spark)
    folder = folder or os.path.join(checkpoint_root(spark), f"token-store-{uuid.uuid4().hex}")
    docs = id_text(docs)
    dictionary = _train(docs, tokenizer, lower, end_id)
    dict_hash = hashlib.sha256(dictionary).hexdigest()[:16]
    spark.createDataFrame([(dict_hash, dictionary)], "dict_hash string, bytes binary") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        zdict = zstandard.ZstdCompressionDict(shared.value)
        zdict.precompute_compress(level=LEVEL)
        z = zstandard.ZstdCompressor(dict_data=zdict, level=LEVEL)
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for lo, hi in slices(texts):
                out = _ids(texts[lo:hi], tokenizer, lower, end_id)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(lo, hi - lo),
                    "n_tokens": pa.array([len(x) // 4 for x in out], pa.int32()),
                    "frame": pa.array([z.compress(narrow(x)) for x in out], pa.binary())})

    frames = materialize(docs.mapInArrow(compress, FRAMES), "token-frames")
    size = frames.agg(F.sum(F.length("frame"))).first()[0]
    n = parts_for(size, SHARD_BYTES)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, rows, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            lengths = [len(f) for _, _, f in rows]
            offsets = np.cumsum([0, *lengths[:-1]]).astype("int32").tolist()
            docs_, counts = [d for d, _, _ in rows], [c for _, c, _ in rows]
            known = [d for d in docs_ if d is not None]
            one = {"shard": [shard], "block": [number], "first_doc": [min(known, default=None)],
                   "last_doc": [max(known, default=None)], "doc_ids": [docs_], "offsets": [offsets],
                   "lengths": [lengths], "n_tokens": [counts], "total": [sum(counts)],
                   "dict_hash": [dict_hash], "payload": [b"".join(f for _, _, f in rows)]}
            return pa.RecordBatch.from_pydict(one, schema=pa.schema([
                ("shard", pa.int32()), ("block", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int32())),
                ("lengths", pa.list_(pa.int32())), ("n_tokens", pa.list_(pa.int32())), ("total", pa.int64()),
                ("dict_hash", pa.string()), ("payload", pa.binary())]))

        for b in batches:
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                rows.append(row)
                size += len(row[2])
                if size >= BLOCK_BYTES:
                    yield flush()
                    number, rows, size = number + 1, [], 0
        if rows:
            yield flush()

    by = [F.col("doc_id").asc_nulls_first(), F.xxhash64("frame")]
    ordered = frames.repartitionByRange(n, *by).sortWithinPartitions(*by, "frame")
    ordered.mapInArrow(block, BLOCKS).write.options(**BLOCK_FILES).parquet(f"{folder}/blocks")
    return folder


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: ``doc_id``, ``start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32``, from the decompressed ids."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(
        {r.dict_hash: bytes(r.bytes) for r in spark.read.parquet(f"{folder}/dictionary").collect()})

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):               # one block's payload at a time
                row, = b.slice(i, 1).to_pylist()
                z = _decompressor(row["dict_hash"], shared.value)
                data = memoryview(row["payload"])
                ids = [widen(z.decompress(data[o:o + n])) for o, n in zip(row["offsets"], row["lengths"])]
                counts = np.array([len(x) for x in ids], "int64")
                k = len(ids)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * k, pa.int32()), "block": pa.array([row["block"]] * k, pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "local_start": pa.array(np.cumsum(counts) - counts, pa.int64()), "n_tokens": pa.array(counts),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                    "place": pa.array(range(k), pa.int32())})

    blocks = spark.read.parquet(f"{folder}/blocks")
    # running totals: within a shard by its own window, over shards on one row each
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.select("shard", "block", "total")
    shards = heads.groupBy("shard").agg(F.sum("total").alias("shard_total")) \
        .select("shard", F.coalesce(F.sum("shard_total").over(over), F.lit(0)).alias("shard_start"))
    starts = heads.select("shard", "block", F.coalesce(F.sum("total").over(within), F.lit(0)).alias("block_start")) \
        .join(shards, "shard")
    rows = blocks.select("shard", "block", "doc_ids", "offsets", "lengths", "dict_hash", "payload") \
        .mapInArrow(decode, READ)
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("shard_start") + F.col("block_start") + F.col("local_start")).alias("start"),
        "n_tokens", "ids_crc32")


def _decompressor(dict_hash: str, dictionaries: dict[str, bytes], _made: dict = {}):
    import zstandard
    if dict_hash not in _made:
        _made[dict_hash] = zstandard.ZstdDecompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionaries[dict_hash]))
    return _made[dict_hash]


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of every stored row of one document: the block statistics prune
    the scan, and only that document's frames are decompressed."""
    dictionaries = {r.dict_hash: bytes(r.bytes) for r in spark.read.parquet(f"{folder}/dictionary").collect()}
    found = spark.read.parquet(f"{folder}/blocks") \
        .where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id)) \
        .select("dict_hash", "payload", F.posexplode("doc_ids").alias("i", "d"), "offsets", "lengths") \
        .where(F.col("d") == doc_id) \
        .select("dict_hash", F.expr("substring(payload, offsets[i] + 1, lengths[i])").alias("frame")).collect()
    return [widen(_decompressor(r.dict_hash, dictionaries).decompress(bytes(r.frame))).tolist() for r in found]
