"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (one and two words) are counted:
the raw model over all documents, the target model over labelled good ones. A
document's importance weight is the ratio of its likelihoods under the two,
taken as if every document had ``LENGTH`` n-grams, so long and short documents
compare. The cut between documents that fit the target and the rest is fitted on
held-out labelled rows; ``k`` is the number of documents above it, and ``k``
documents are sampled by Gumbel top-k: the ``k`` largest log weights after
standard Gumbel noise, which is sampling without replacement by weight.

The fit uses at most ``SAMPLE`` labelled rows (the smallest hashes of ``doc_id``), a
fifth of them held out; the raw model covers all documents. What reaches the
driver are the model's ``BUCKETS`` counts and the held-out scores, whatever the
input's size.

Defined results: null text is empty and, like any text without words, has weight
0 before noise; rows of equal ``doc_id`` and text share their noise, so they are
kept or dropped together; null labels are no labels; without labelled rows of
both sorts every document is kept; an empty table gives no rows; ``keep`` returns
the rows it keeps with all their columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import materialize, prepare, uniform01
from lookout.llm.tokens import slices

BUCKETS = 1 << 16
LENGTH = 200
SAMPLE = 20_000
PRIOR = 4.0             # occurrences by which a bucket's ratio is drawn to one
GOOD_KEPT = 0.995       # share of held-out good documents that the cut keeps at least


def ngram_buckets(texts: list[str], buckets: int) -> list[np.ndarray]:
    """Each text's n-gram buckets, with repeats."""
    split = [t.lower().split() for t in texts]
    flat = [w for ws in split for w in ws]
    if not flat:
        return [np.empty(0, "int64")] * len(texts)
    h = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
    one = (h >> np.uint64(20)) % np.uint64(buckets)
    two = ((h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) >> np.uint64(20)) % np.uint64(buckets)
    out, at = [], 0
    for ws in split:
        n = len(ws)
        out.append(np.concatenate([one[at:at + n], two[at:at + max(0, n - 1)]]).astype("int64"))
        at += n
    return out


def weights(texts: list[str], ratio: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Log importance weight of each text, for ``length`` n-grams."""
    grams = ngram_buckets(texts, len(ratio))
    return np.array([ratio[g].mean() * length if len(g) else 0.0 for g in grams])


def _prepared(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       uniform01(F.col("doc_id").cast("long"), text, F.lit(7)).alias("u"))


def _labelled(labels: DataFrame, sample: int) -> DataFrame:
    """A bounded sample of labelled ids, with ``good`` and ``fold``."""
    rows = labels.where("doc_id is not null and quality is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") == 1).alias("good"))
    order = F.xxhash64("doc_id", F.lit(3))
    return rows.withColumn("o", order).orderBy("o", "doc_id").limit(sample) \
        .select("doc_id", "good", (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(5)) == 0).alias("held"))


class Model:
    """Log ratio of every bucket, the cut of log weights, and the bound that a
    perturbed log weight must reach."""

    def __init__(self, ratio: np.ndarray, cut: float, bound: float, length: int):
        self.ratio, self.cut, self.bound, self.length = ratio, cut, bound, length


def _count(docs: DataFrame, labelled: DataFrame, buckets: int) -> np.ndarray:
    """Counts [raw, target] of every bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), "int64")
        for b in batches:
            texts = b.column("text").to_pylist()
            target = [g is True and not h for g, h in zip(b.column("good").to_pylist(), b.column("held").to_pylist())]
            for lo, hi in slices(texts):
                grams = ngram_buckets(texts[lo:hi], buckets)
                counts[0] += np.bincount(np.concatenate(grams), minlength=buckets)
                mine = [g for g, t in zip(grams, target[lo:hi]) if t]
                if mine:
                    counts[1] += np.bincount(np.concatenate(mine), minlength=buckets)
        at = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "raw": pa.array(counts[0, at]),
                                          "target": pa.array(counts[1, at])})

    # at most SAMPLE rows of ids and flags
    rows = docs.join(F.broadcast(labelled), "doc_id", "left").select("text", "good", "held") \
        .mapInArrow(run, "bucket int, raw long, target long") \
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    out = np.zeros((2, buckets))
    for r in rows:
        out[:, r.bucket] = r.raw, r.target
    return out


def log_ratio(raw: np.ndarray, target: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Log ratio of the two models, buckets with little evidence near zero."""
    if not target.sum() or not raw.sum():
        return np.zeros(len(raw))
    expected = raw / raw.sum() * target.sum()
    return np.log((target + prior) / (expected + prior))


def best_cut(scores: np.ndarray, good: np.ndarray, good_kept: float = GOOD_KEPT) -> float:
    """The cut that rejects most bad rows among those keeping at least the
    given share of good ones; between two scores."""
    if not good.any() or good.all():
        return -np.inf
    order = np.unique(scores)
    lost = np.searchsorted(np.sort(scores[good]), order) / good.sum()
    caught = np.searchsorted(np.sort(scores[~good]), order) / (~good).sum()
    worth = np.where(lost <= 1 - good_kept, caught - 4 * lost, -1)
    i = int(worth.argmax())
    return float(order[i] if i == 0 else (order[i] + order[i - 1]) / 2)


def kth_largest(scores: DataFrame, col: str, k: int) -> float:
    """The ``k``-th largest value of a stored column: histograms narrow the
    range, so the driver gets a few thousand counts however many rows."""
    lo, hi, n = scores.agg(F.min(col), F.max(col), F.count(col)).first()
    if k <= 0 or not n:
        return float("inf")
    if k >= n:
        return float("-inf")
    above = 0
    while True:
        inside = scores.where((F.col(col) >= lo) & (F.col(col) <= hi))
        width = (hi - lo) / 1024
        if width <= max(abs(lo), abs(hi)) * 1e-14:
            return lo
        bins = inside.groupBy(F.least(F.floor((F.col(col) - lo) / width), F.lit(1023)).alias("b")) \
            .agg(F.count(F.lit(1)).alias("c"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()
        for r in sorted(bins, key=lambda r: -r.b):
            if above + r.c >= k:
                lo, hi = r.lo, r.hi
                break
            above += r.c
        if lo == hi:
            return lo


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, length: int = LENGTH,
        sample: int = SAMPLE) -> tuple[Model, DataFrame]:
    """The model and the stored scores (``doc_id``, ``log_weight``, ``perturbed``,
    ``good``, ``held``) of all documents."""
    spark = docs.sparkSession
    prepare(spark)
    rows = _prepared(docs)
    labelled = materialize(_labelled(labels, sample), "quality-labels")
    raw, target = _count(rows, labelled, buckets)
    ratio = log_ratio(raw, target)
    shared = spark.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = _batch_weights(b.column("text").to_pylist(), shared.value, length)
            noise = -np.log(-np.log(b.column("u").to_numpy(zero_copy_only=False)))
            yield b.select(["doc_id"]).append_column("log_weight", pa.array(w)) \
                .append_column("perturbed", pa.array(w + noise))

    scored = rows.mapInArrow(run, "doc_id long, log_weight double, perturbed double")
    scores = materialize(scored.join(F.broadcast(labelled), "doc_id", "left"), "quality-scores")
    held = scores.where("held").select("log_weight", "good").collect()       # a fifth of the sample at most
    cut = best_cut(np.array([r.log_weight for r in held]), np.array([r.good for r in held], bool))
    k = scores.where(F.col("log_weight") >= cut).count()
    return Model(ratio, cut, kth_largest(scores, "perturbed", k), length), scores


def _batch_weights(texts: list[str], ratio: np.ndarray, length: int) -> np.ndarray:
    return np.concatenate([np.empty(0), *(weights(texts[lo:hi], ratio, length) for lo, hi in slices(texts))])


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document ``log_weight``, ``perturbed`` and ``kept``."""
    model, scores = fit(docs, labels, **options)
    return scores.select("doc_id", "log_weight", "perturbed", (F.col("perturbed") >= model.bound).alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The sampled documents, all their columns unchanged."""
    model, _ = fit(docs, labels, **options)
    ratio, bound, length = docs.sparkSession.sparkContext.broadcast(model.ratio), model.bound, model.length
    kept, u = docs.columns, "u"
    while u in kept:
        u += "_"
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            noise = -np.log(-np.log(b.column(u).to_numpy(zero_copy_only=False)))
            yield b.select(kept).filter(pa.array(_batch_weights(texts, ratio.value, length) + noise >= bound))

    return docs.withColumn(u, uniform01(F.col("doc_id").cast("long"), text, F.lit(7))).mapInArrow(run, docs.schema)
