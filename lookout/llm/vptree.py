"""Nearest neighbours by vantage-point trees, one per shard.

Inner product is made a metric first: with ``M`` the largest norm, every vector
gets one more component ``sqrt(M^2 - |x|^2)`` and queries get 0, so the distance
grows as the inner product falls. Vectors are dealt to shards by hash; a task
builds the tree of its shard and searches it with one block of queries. A
subtree is skipped when its triangle-inequality bound, multiplied by ``factor``,
is beyond the query's worst neighbour so far. Factor one is exact search, ties included; a
larger one skips more. Distances come from matrix products, so rows at about the k-th
distance are compared by their inner products and ids, as the result is. The neighbours found in all shards are merged per query,
scored again on the original vectors in double precision.

Shards and query blocks have fixed sizes (``SHARD`` and ``BLOCK`` rows), so memory in
a task is bounded at any input. Of equal vectors, only the ``k + 1`` smallest ids
can be among anyone's ``k`` nearest; the rest is left out before the search, which
changes no result and bounds a group of copies.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows without an id; of
rows with one id and different vectors the smallest is taken; with fewer
candidates all are returned; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookout.llm.common import materialize, parts_for, prepare

FACTOR = 1.1
SHARD = 16_384
BLOCK = 4_096
LEAF = 256
FOUND = "query_id long, vec_id long, score double"


class Tree:
    """A vantage-point tree over the rows of ``x``."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x = x
        self.leaf = leaf
        self.root = self._build(np.arange(len(x)), np.random.default_rng(11))

    def _build(self, rows: np.ndarray, rng) -> tuple | np.ndarray:
        if len(rows) <= self.leaf:
            return rows
        point = self.x[rows[rng.integers(len(rows))]]
        d = distances(point[None], self.x[rows])[0]
        mid = float(np.median(d))
        near = d <= mid
        if near.all():
            near = d < mid
            if not near.any():
                return rows                        # all at one distance: nothing to split
        inside, outside = rows[near], rows[~near]
        return (point, float(d[near].max()), float(d[~near].min()), float(d[~near].max()),
                self._build(inside, rng), self._build(outside, rng))

    def search(self, queries: np.ndarray, k: int, factor: float, order) -> np.ndarray:
        """Rows of the ``k`` nearest found for each query, -1 where fewer. Among rows whose distances are
        within ``tie`` of the k-th, ``order(query, rows)`` decides: it sorts rows, the nearest first."""
        best = np.full((len(queries), k), np.inf)
        found = np.full((len(queries), k), -1)
        tie = 1e-7 * (1.0 + float(np.abs(self.x).max(initial=0.0)) * np.sqrt(self.x.shape[1]))
        self._visit(self.root, np.arange(len(queries)), queries, best, found, factor, tie, order)
        return found

    def _visit(self, node, at: np.ndarray, q: np.ndarray, best: np.ndarray, found: np.ndarray, factor: float,
               tie: float, order) -> None:
        if not len(at):
            return
        if isinstance(node, np.ndarray):
            k = best.shape[1]
            for part in np.array_split(node, -(-len(node) // 4096)):
                d = np.concatenate([best[at], distances(q[at], self.x[part])], axis=1)
                ids = np.concatenate([found[at], np.broadcast_to(part, (len(at), len(part)))], axis=1)
                keep = np.argpartition(d, k - 1, axis=1)[:, :k]
                kth = np.take_along_axis(d, keep, 1).max(axis=1)
                tied = np.flatnonzero((np.isfinite(d) & (d <= kth[:, None] + tie)).sum(axis=1) > k)
                for i in tied:                     # more rows than places at about this distance
                    near = np.flatnonzero(d[i] <= kth[i] + tie)
                    keep[i] = near[order(at[i], ids[i, near])[:k]]
                best[at] = np.take_along_axis(d, keep, 1)
                found[at] = np.take_along_axis(ids, keep, 1)
            return
        point, edge, low, high, inside, outside = node
        d = distances(q[at], point[None])[:, 0]
        to_inside, to_outside = np.maximum(d - edge, 0), np.maximum(np.maximum(low - d, d - high), 0)
        first = to_inside <= to_outside
        for side, bound, mine in ((inside, to_inside, first), (outside, to_outside, ~first),
                                  (outside, to_outside, first), (inside, to_inside, ~first)):
            open_ = mine & (bound * factor <= best[at].max(axis=1) + tie)
            self._visit(side, at[open_], q, best, found, factor, tie, order)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` from all rows of ``b``."""
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(d, 0))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, summed in the same order for equal rows."""
    return (a * b).sum(axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (``vec_id``, ``v`` of doubles) that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")) \
        .where("vec_id is not null and v is not null and size(v) > 0").where(finite) \
        .where(F.exists("v", lambda x: x != 0))
    rows = materialize(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (usual.n if usual else 0))


def nearest(rows: DataFrame, is_query, k: int, factor: float = FACTOR, shard: int = SHARD,
            block: int = BLOCK) -> DataFrame:
    """For every cleaned row (``vec_id``, ``v``) that meets ``is_query``, its ``k`` nearest
    other rows: ``query_id``, ``rank``, ``vec_id``, ``score``."""
    spark = rows.sparkSession
    prepare(spark)
    copies = Window.partitionBy("v").orderBy("vec_id")
    few = materialize(rows.withColumn("c", F.row_number().over(copies)).where(F.col("c") <= k + 1)
                      .select("vec_id", "v"), "candidates")
    queries = materialize(rows.where(is_query), "queries")
    n, m = few.count(), queries.count()
    shards, blocks = parts_for(n, shard), parts_for(m, block)
    norm = few.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0] or 0.0

    # one cell for each (shard, query block); a row goes to all cells of its shard or block
    cell = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    own = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    placed = few.select("vec_id", "v", F.lit(False).alias("q"), cell.alias("s"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b")) \
        .unionByName(queries.select("vec_id", "v", F.lit(True).alias("q"),
                                    F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s"), own.alias("b")))
    def run(key: tuple, table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        empty = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]).empty_table()
        mine = t.column("q").to_numpy()
        ids, v = t.column("vec_id").to_numpy(), _matrix(t.column("v").combine_chunks())
        if mine.all() or not mine.any():
            return empty
        x, xid, q, qid = v[~mine], ids[~mine], v[mine], ids[mine]
        extra = np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0))
        tree = Tree(np.hstack([x, extra[:, None]]))

        def order(i: int, rows_: np.ndarray) -> np.ndarray:
            return np.lexsort((xid[rows_], -inner(q[i][None], x[rows_])))

        found = tree.search(np.hstack([q, np.zeros((len(q), 1))]), k + 1, factor, order)     # one may be the query itself
        at, col = np.nonzero(found >= 0)
        to = found[at, col]
        other = xid[to] != qid[at]
        at, to = at[other], to[other]
        return pa.table({"query_id": qid[at], "vec_id": xid[to], "score": inner(q[at], x[to])})

    hits = placed.groupBy("s", "b").applyInArrow(run, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
