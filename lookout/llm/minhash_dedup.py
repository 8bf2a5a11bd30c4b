"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of ``m`` partial keys are computed per text, each partial
key from ``rows`` minhashes. The ``m * m`` table keys are all pairs of one key from
either collection, so a text needs ``2 * m * rows`` minhashes where plain banding
of as many tables needs ``2 * rows * m * m``. With the defaults (8 and 2) a pair of
similarity 0.85 shares a key but for 7 cases in 100,000, one of 0.9 but for 2 in
a million.

Every candidate is confirmed on the full shingle sets, without forming all
pairs of a bucket:

1. texts of equal shingle sets become one class;
2. a candidate whose share of shingles found in no other candidate already rules
   the threshold out against anything is dropped (an exact bound);
3. in each bucket all members are compared with one centre, the member with the
   smallest such share, and the links give components;
4. in buckets that still hold several components, the pairs across components
   that the bound allows are compared, each in the first bucket it shares. Here
   the bound is taken per hash class of shingles (two sets share at most the
   smaller count in each class), which tells apart copies of one text that were
   changed in different places.

Links are found within a component only as far as they are needed to connect it;
no link between two components is left out among candidates.

Defined results: null or word-less text has no shingles and no links; rows of
equal text (or of one ``doc_id``) are linked; rows with null ``doc_id`` stay alone,
with null ``component_id`` and kept; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import id_text, materialize, prepare
from lookout.session import Scratch
from lookout.llm.tokens import slices

WORDS = 5
THRESHOLD = 80          # per cent
KEYS = 8                # partial keys in each of the two collections
ROWS = 2                # minhashes in a partial key
CLASSES = 64            # hash classes of shingles in the bound on what two sets share

_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
SIGNATURE = "doc_id long, n_shingles long, h1 long, h2 long, a array<long>, b array<long>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * _Q
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes: of ``words``
    words, or of the whole sequence where it is shorter."""
    split = [t.encode("utf-8", "replace").lower().split() for t in texts]
    flat = [w for ws in split for w in ws]
    if not flat:
        return [np.empty(0, "uint64")] * len(texts)
    h = pd.util.hash_array(np.array(flat, dtype=object), categorize=False)
    rolled = h[:max(0, len(h) - words + 1)]
    for i in range(1, words):
        rolled = rolled * _P + h[i:len(rolled) + i]
    rolled = _mix(rolled)
    out, at = [], 0
    for ws in split:
        n = len(ws)
        if n >= words:
            out.append(np.unique(rolled[at:at + n - words + 1]))
        elif n:
            one = np.array([n], "uint64")
            for x in h[at:at + n]:
                one = one * _Q + x
            out.append(_mix(one))
        else:
            out.append(np.empty(0, "uint64"))
        at += n
    return out


def signatures(sets: list[np.ndarray], keys: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For non-empty sets: two 64-bit set hashes and the ``2 * keys`` partial keys."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    h1 = _mix(np.add.reduceat(_mix(flat * _P), starts))
    h2 = _mix(np.add.reduceat(_mix(flat ^ _Q), starts) ^ np.array([len(s) for s in sets], "uint64"))
    factors = np.random.default_rng(17).integers(1, 1 << 63, 2 * keys * rows, dtype="uint64") * np.uint64(2) + np.uint64(1)
    partial = np.empty((len(sets), 2 * keys), "uint64")
    for k in range(2 * keys):
        key = np.full(len(sets), k + 1, "uint64")
        for f in factors[k * rows:(k + 1) * rows]:
            low = np.minimum.reduceat(flat * f, starts)
            key = _mix(key * _P + low)
        partial[:, k] = key
    return h1, h2, partial


def _signature_rows(words: int, keys: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for lo, hi in slices(texts):
                sets = shingle_sets(texts[lo:hi], words)
                n = np.array([len(s) for s in sets], "int64")
                h = np.zeros((2, len(sets)), "uint64")
                partial: list = [None] * len(sets)
                full = np.flatnonzero(n)
                if len(full):
                    h[0, full], h[1, full], p = signatures([sets[i] for i in full], keys, rows)
                    for i, row in zip(full, p.view("int64")):
                        partial[i] = row
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids.slice(lo, hi - lo), "n_shingles": pa.array(n),
                    "h1": pa.array(h[0].view("int64")), "h2": pa.array(h[1].view("int64")),
                    "a": pa.array([None if x is None else x[:keys] for x in partial], kind),
                    "b": pa.array([None if x is None else x[keys:] for x in partial], kind)})
    return run


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for lo, hi in slices(texts):
                sets = [s.view("int64") for s in shingle_sets(texts[lo:hi], words)]
                yield pa.RecordBatch.from_pydict({
                    "id": ids.slice(lo, hi - lo), "n": pa.array([len(s) for s in sets], pa.int64()),
                    "shingles": pa.array(sets, pa.list_(pa.int64())),
                    "classes": pa.array([np.bincount(s & (CLASSES - 1), minlength=CLASSES) for s in sets],
                                        pa.list_(pa.int32()))})
    return run


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (``x``, ``y``): ``id`` and ``component``
    (its smallest id), for ids that have an edge. Each round links every larger
    neighbour of a node, then every smaller one, to the node's smallest
    neighbour; a round is written to the shared folder, so none is run twice."""
    one = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    e = materialize(one.where("x != y").distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())

    before = state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        large = materialize(large, "large-star")
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x != y") \
            .unionByName(low.select("x", F.col("m").alias("y"))).distinct()
        e = materialize(small, "small-star")
        now = state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("x").alias("id"), F.col("y").alias("component")) \
        .unionByName(e.select(F.col("y").alias("id"), F.col("y").alias("component"))).distinct()


def _may_reach(n1: str, u1: str, n2: str, u2: str, threshold: int) -> Column:
    """Whether sets of ``n`` shingles with ``u`` found nowhere else can be as
    similar as the threshold: what they share is at most the smaller rest."""
    shared = F.least(F.col(n1) - F.col(u1), F.col(n2) - F.col(u2))
    return 100 * shared >= threshold * (F.col(n1) + F.col(n2) - shared)


def _links(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (``x``, ``y``) whose full sets reach the threshold."""
    shared = F.size(F.array_intersect("sx", "sy"))
    return pairs.join(sets.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col("shingles").alias("sx")), "x") \
        .join(sets.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col("shingles").alias("sy")), "y") \
        .select("x", "y", "nx", "ny", shared.alias("shared")) \
        .where(100 * F.col("shared") >= threshold * (F.col("nx") + F.col("ny") - F.col("shared"))) \
        .select("x", "y")


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD,
                    keys: int = KEYS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): ``n_shingles``, ``component_id`` (the
    smallest ``doc_id`` linked with it, over any number of links) and ``kept``."""
    spark = docs.sparkSession
    prepare(spark)
    docs = id_text(docs)
    with Scratch() as temp:
        signed = temp.keep(materialize(docs.mapInArrow(_signature_rows(words, keys, rows), SIGNATURE), "signatures"))
        named = signed.where("doc_id is not null and n_shingles > 0")

        # one class for each shingle set; its smallest doc_id stands for it
        classes = materialize(named.groupBy("h1", "h2").agg(F.min("doc_id").alias("id")), "classes")
        heads = named.join(classes.withColumnRenamed("id", "doc_id"), ["h1", "h2", "doc_id"], "left_semi")
        tables = heads.select(F.col("doc_id").alias("id"), "a", "b", F.posexplode("a").alias("i", "ka")) \
            .select("id", "i", "ka", F.posexplode("b").alias("j", "kb")) \
            .select("id", F.col("i").cast("byte").alias("i"), F.col("j").cast("byte").alias("j"),
                    F.xxhash64("i", "ka", "j", "kb").alias("key"))
        shared_keys = materialize(tables.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                                  .where("lo < hi").select("key"), "shared-keys")
        bucketed = materialize(tables.join(shared_keys, "key", "left_semi"), "bucketed")

        # full sets of the candidates, and how many of their shingles no other has
        some = bucketed.select(F.col("id").alias("doc_id")).distinct()
        sets = materialize(docs.join(some, "doc_id", "left_semi").mapInArrow(
            _set_rows(words), "id long, n long, shingles array<long>, classes array<int>"), "shingle-sets")
        alone = sets.select("id", F.explode("shingles").alias("s")).groupBy("s") \
            .agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("id")).where("c = 1") \
            .groupBy("id", F.col("s").bitwiseAND(F.lit(CLASSES - 1).cast("long")).cast("int").alias("class")) \
            .agg(F.count(F.lit(1)).cast("int").alias("c")) \
            .groupBy("id").agg(F.sum("c").alias("u"), F.map_from_entries(F.collect_list(F.struct("class", "c"))).alias("own"))
        common = F.expr("transform(classes, (c, k) -> if(own is null, c, c - coalesce(try_element_at(own, k), 0)))")
        sizes = materialize(sets.select("id", "n", "classes").join(alone, "id", "left")
                            .select("id", "n", F.coalesce("u", F.lit(0)).alias("u"), common.alias("common"))
                            .where(100 * (F.col("n") - F.col("u")) >= threshold * F.col("n")), "set-sizes")
        members = materialize(bucketed.join(sizes.select("id", "n", "u"), "id"), "bucket-members")

        # every member against its bucket's centre
        centres = materialize(members.groupBy("key").agg(F.min(F.struct(
            (F.col("u") / F.col("n")).alias("r"), "id", "n", "u")).alias("c"))
            .select("key", F.col("c.id").alias("y"), F.col("c.n").alias("ny"), F.col("c.u").alias("uy")), "centres")
        star = members.join(centres, "key").where("id != y").where(_may_reach("n", "u", "ny", "uy", threshold)) \
            .select(F.col("id").alias("x"), "y").distinct()
        linked = materialize(_links(star, sets, threshold), "star-links")

        # pairs across components that still share a bucket
        found = components(linked)
        of = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        of = materialize(of, "bucket-components")
        mixed = materialize(of.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                            .where("lo < hi").select("key"), "mixed-keys")
        partial = heads.select(F.col("doc_id").alias("id"), "a", "b").dropDuplicates(["id"])
        common = sizes.select("id", "common").dropDuplicates(["id"])
        left = materialize(of.join(mixed, "key", "left_semi").join(partial, "id").join(common, "id"), "mixed-members")
        x = left.select("key", "i", "j", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("u").alias("ux"),
                        F.col("component").alias("cx"), F.col("a").alias("ax"), F.col("b").alias("bx"), F.col("common").alias("hx"))
        y = left.select("key", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("u").alias("uy"),
                        F.col("component").alias("cy"), F.col("a").alias("ay"), F.col("b").alias("by"), F.col("common").alias("hy"))
        first = F.expr("array_position(zip_with(ax, ay, (p, q) -> p = q), true) = i + 1 and "
                       "array_position(zip_with(bx, by, (p, q) -> p = q), true) = j + 1")
        most = "aggregate(zip_with(hx, hy, (p, q) -> least(p, q)), 0, (s, v) -> s + v)"
        by_class_ok = F.expr(f"{100 + threshold} * {most} >= {threshold} * (nx + ny)")
        across = x.join(y, (x["key"] == y["key"]) & (F.col("cx") < F.col("cy"))
                        & _may_reach("nx", "ux", "ny", "uy", threshold) & first & by_class_ok)
        across = materialize(across.select("x", "y").distinct(), "across-pairs")
        all_links = linked.unionByName(_links(across, sets, threshold))
        final = materialize(components(all_links), "components")

        by_class = classes.join(final, "id", "left") \
            .select("h1", "h2", F.coalesce("component", "id").alias("component_id"))
        by_class = temp.keep(materialize(by_class, "class-components"))
    rows_ = signed.drop("a", "b").join(by_class, ["h1", "h2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows_.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), component)) \
        .select("doc_id", "n_shingles", "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_row_per_id(docs: DataFrame) -> DataFrame:
    """``docs`` with one row for each ``doc_id`` (of several, the first in the order
    of their hashes); rows without an id stay. Ids that occur once, as nearly
    all do, are not shuffled with their texts again."""
    repeated = materialize(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("again"))
                           .agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("again"), "repeated-ids")
    if not repeated.take(1):
        return docs
    several = docs.join(repeated, docs["doc_id"] == F.col("again"), "left_semi").dropDuplicates(["doc_id"])
    return docs.join(repeated, docs["doc_id"] == F.col("again"), "left_anti").unionByName(several)
