"""Bounded-space online best-fit packing of documents into token sequences.

A document longer than ``capacity`` is cut into full pieces after a first
piece that may be shorter; a full piece is a sequence by itself. All other
pieces go through an online best-fit packer with a fixed number of open bins:
the open bins are lists keyed by free space and one integer bitset tells which
free spaces occur, so the best bin is one shift and one lowest-bit test. When
all ``open_bins`` are open and a piece fits none, the fullest bin closes.

Packing runs per partition on piece lengths alone (a few bytes per piece). Where the ids
are wanted, pieces carry them in 16 bits while they are stored and shuffled, if all
fit, and in 32 bits in the result.
The number of packing partitions comes from the token total, with at least
``PART_SEQUENCES`` sequences of tokens each, and every partition's pieces
arrive longest first, so what bins are left partly filled at a partition's end
is a vanishing share.

Defined results: null text is an empty document (one end id); rows with equal
``doc_id`` and repeated rows are packed one by one; rows with null ``doc_id``
too; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import id_text, materialize, parts_for, prepare
from lookout.llm.token_store import narrow, widen
from lookout.llm.tokens import id_encoder, slices

OPEN_BINS = 8192
PART_SEQUENCES = 16_384

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class BestFit:
    """Online best fit over at most ``open_bins`` open bins of ``capacity``."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _push(self, space: int, bin_: int) -> None:
        self.by_space[space].append(bin_)
        self.bits |= 1 << space

    def _pop(self, space: int) -> int:
        bin_ = self.by_space[space].pop()
        if not self.by_space[space]:
            self.bits &= ~(1 << space)
        return bin_

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to ``capacity`` tokens."""
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bin_ = self._pop(space)
        else:
            if self.open >= self.open_bins:
                self._pop((self.bits & -self.bits).bit_length() - 1)      # the fullest closes
                self.open -= 1
            bin_, space = self.made, self.capacity
            self.made += 1
            self.open += 1
        if space > length:
            self._push(space - length, bin_)
        else:
            self.open -= 1                                                # full
        return bin_, self.capacity - space


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of serialised 32-bit ids."""
    n = len(ids) // 4
    first = n if n <= capacity else n % capacity or capacity
    edges = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
    return [(a, b - a, zlib.crc32(ids[4 * a:4 * b])) for a, b in zip(edges, edges[1:])]


def pieces(docs: DataFrame, tokenizer: str, lower: bool, end_id: int, capacity: int,
           with_ids: bool = False) -> DataFrame:
    """The pieces of all documents; ``with_ids`` adds the token ids, narrowed."""
    tail = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = id_encoder(tokenizer, lower)
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            for lo, hi in slices(texts):
                rows, parts = [], []
                for doc, data in zip(ids[lo:hi], encoder.encode(texts[lo:hi])):
                    data += tail
                    for k, (start, length, crc) in enumerate(cut(data, capacity)):
                        rows.append((doc, k, start, length, crc))
                        if with_ids:
                            parts.append(narrow(data[4 * start:4 * (start + length)]))
                doc, k, start, length, crc = zip(*rows)
                cols = {"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(k, pa.int32()),
                        "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())}
                if with_ids:
                    cols["ids"] = pa.array(parts, pa.binary())
                yield pa.RecordBatch.from_pydict(cols)

    return id_text(docs).mapInArrow(run, PIECES + (", ids binary" if with_ids else ""))


def pack(table: DataFrame, capacity: int, open_bins: int = OPEN_BINS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with ``doc_id``, ``piece``
    and ``length`` of 1 to ``capacity``. Narrowed ``ids`` are widened. ``table`` must be stored data: its total
    is taken first, then the pieces are dealt by hash and packed."""
    total = table.agg(F.sum("length")).first()[0]
    n = parts_for(total, capacity * PART_SEQUENCES)
    names = table.columns
    schema = table.schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        for b in batches:
            placed = [packer.place(x) for x in b.column("length").to_pylist()]
            if "ids" in names:
                wide = [widen(x).tobytes() for x in b.column("ids").to_pylist()]
                b = b.set_column(names.index("ids"), "ids", pa.array(wide, pa.binary()))
            yield b.append_column("sequence_id", pa.array([base + k for k, _ in placed], pa.int64())) \
                .append_column("offset", pa.array([o for _, o in placed], pa.int64()))

    dealt = table.repartition(n, "doc_id", "piece", "start", "ids_crc32") \
        .sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32")
    return dealt.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, lower: bool, end_id: int, capacity: int,
                   open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    prepare(spark)
    name = "packing-pieces"
    return pack(materialize(pieces(docs, tokenizer, lower, end_id, capacity, with_ids), name), capacity, open_bins)
