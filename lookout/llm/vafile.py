"""Centroid clustering over a vector-approximation file.

Every kept vector is written once beside its approximation: ``BITS`` = 6 bits for each
component, the cell of that dimension's grid it falls in. For each centroid,
lookup tables give the least and greatest squared distance that a cell adds, so
64 lookups bound a vector's distance from below and above. A centroid whose upper
bound is below all others' lower bounds is the nearest. Where intervals overlap, a
table per pair of centroids bounds the difference of the two distances, which is
tighter, as a component's place in its cell counts once. Only where that interval
holds zero too, the full vector is fetched (a join on its key) and measured exactly:
about a third of vectors without any cluster structure.

A round reads approximations alone, under the old and the new centroids. A vector
surely in one cluster under both changes no sum; the rest is fetched, and the
clusters' exact sums and counts take the difference. So no assignment is stored,
and a round depends only on the written file and on the centroids (8 x 64
integers): a lost executor costs its tasks. The grids come from all vectors' mean
and deviation, with the outermost cells reaching the least and greatest component;
they decide speed only, as all results are exact integers.

Defined results: vectors that are null, of another length than 64, or hold null or
non-finite components take no part; nor do those with a component beyond
``LARGEST`` = 2^26 after scaling, whose squared distances could pass a long; rows
without ``vec_id`` are clustered but start no centroid; repeated rows count each, and
of equal ids the vector that is less in order starts first; with fewer than 8
vectors there are fewer centroids; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.llm.common import materialize, prepare
from lookout.session import discard

SCALE = 1024
LARGEST = 1 << 26
BITS = 6
SPREAD = 3.0                      # inner cells cover mean +- SPREAD deviations
TOTALS = "cluster int, pos int, total long, n long"


def matrix(column: pa.Array, width: int, dtype=np.int64) -> np.ndarray:
    """An array column of equally long lists without nulls as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype, copy=False).reshape(-1, width)


def integers(vectors: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """Kept vectors (``vec_id``, ``v`` of ``dim`` integers)."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) <= LARGEST))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")) \
        .where((F.size("v") == dim) & sound)
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("int")))


class Grid:
    """Cell edges of each dimension: inner edges (dim, cells - 1), and the least and
    greatest component of all vectors."""

    def __init__(self, edges: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.edges = edges
        # the integers of cell b lie in [lower[:, b], upper[:, b]]
        self.lower = np.hstack([low[:, None], edges])
        self.upper = np.hstack([edges - 1, high[:, None]])

    def cells(self, v: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, v[:, d], side="right") for d, e in enumerate(self.edges)], 1).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance that each cell adds: (centroid, dim, cell)."""
        c = centroids[:, :, None]
        below, above = self.lower[None] - c, c - self.upper[None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        return least, np.maximum(np.abs(below), np.abs(above)) ** 2


def fit_grid(rows: DataFrame, dim: int, bits: int = BITS) -> tuple[Grid | None, int]:
    """The grid over all rows of ``v`` and their number; no grid without rows."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q = 0, np.zeros(dim), np.zeros(dim)
        low, high = np.full(dim, LARGEST), np.full(dim, -LARGEST - 1)
        for b in batches:
            if b.num_rows:
                v = matrix(b.column(0), dim)
                n, s, q = n + len(v), s + v.sum(0), q + (v.astype(float) ** 2).sum(0)
                low, high = np.minimum(low, v.min(0)), np.maximum(high, v.max(0))
        if n:
            yield pa.RecordBatch.from_pydict({"pos": np.arange(dim, dtype=np.int32), "n": np.full(dim, n), "s": s, "q": q,
                                              "low": low, "high": high})

    found = rows.select("v").mapInArrow(part, "pos int, n long, s double, q double, low long, high long") \
        .groupBy("pos").agg(*[F.sum(c).alias(c) for c in "nsq"], F.min("low").alias("low"), F.max("high").alias("high")) \
        .orderBy("pos").collect()                  # one row per dimension
    if not found:
        return None, 0
    n, s, q, low, high = (np.array([r[c] for r in found]) for c in ("n", "s", "q", "low", "high"))
    mean = s / n
    deviation = np.sqrt(np.maximum(q / n - mean * mean, 0))
    steps = np.linspace(-SPREAD, SPREAD, (1 << bits) - 1)
    edges = np.rint(mean[:, None] + deviation[:, None] * steps).astype(np.int64)
    return Grid(np.clip(edges, low[:, None], high[:, None] + 1), low, high), int(n[0])


def pack(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of ``bits`` bits side by side, a row of bytes for each vector."""
    of_cell = np.unpackbits(cells[:, :, None], axis=2)[:, :, 8 - bits:]
    return np.packbits(of_cell.reshape(len(cells), cells.shape[1] * bits), axis=1)


def unpack(data: np.ndarray, dim: int, bits: int = BITS) -> np.ndarray:
    of_cell = np.unpackbits(data, axis=1, count=dim * bits).reshape(len(data), dim, bits)
    wide = np.zeros((len(data), dim, 8), np.uint8)
    wide[:, :, 8 - bits:] = of_cell
    return np.packbits(wide, axis=2)[:, :, 0]


def write_file(rows: DataFrame, grid: Grid) -> DataFrame:
    """The written file: ``key`` (one per row), ``vec_id``, ``cells``, ``v``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            packed = pack(grid.cells(matrix(b.column(1), len(grid.edges))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([p.tobytes() for p in packed], pa.binary()), b.column(1)], ["vec_id", "cells", "v"])

    approximated = rows.select("vec_id", "v").mapInArrow(run, "vec_id long, cells binary, v array<int>")
    return materialize(approximated.withColumn("key", F.monotonically_increasing_id()), "va-file")


class Measure:
    """Bounds and exact distances of vectors from one set of centroids."""

    def __init__(self, grid: Grid, centroids: np.ndarray):
        self.centroids = centroids
        self.least, self.greatest = grid.tables(centroids)
        # how much nearer a centroid is than another at least, for each cell: the difference of
        # the two squares is linear in the component, so its extremes are at the cell's ends
        ends = np.stack([grid.lower, grid.upper])[None] - centroids[:, None, :, None]
        self.gain = [[(ends[b] ** 2 - ends[a] ** 2).min(0) for b in range(len(centroids))] for a in range(len(centroids))]

    def sure(self, cells: np.ndarray) -> np.ndarray:
        """The nearest centroid where bounds decide it, else -1."""
        at, row = np.arange(cells.shape[1]), np.arange(len(cells))
        low = np.stack([t[at, cells].sum(1) for t in self.least], 1)
        high = np.stack([t[at, cells].sum(1) for t in self.greatest], 1)
        best = (low + high).argmin(1)
        # of equally near centroids the smaller number is taken, so it must be farther to be beaten
        smaller = np.arange(low.shape[1])[None] < best[:, None]
        limit = high[row, best][:, None]
        beaten = np.where(smaller, low > limit, low >= limit)
        beaten[row, best] = True
        for a in range(low.shape[1]):
            for b in range(low.shape[1]):
                rest = np.flatnonzero((best == a) & ~beaten[:, b])
                gain = self.gain[a][b][at, cells[rest]].sum(1)
                beaten[rest, b] = gain > 0 if b < a else gain >= 0
        return np.where(beaten.all(1), best, -1)

    def exact(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest centroid, squared distance) of full vectors."""
        d = np.stack([((v - c) ** 2).sum(1) for c in self.centroids], 1)
        best = d.argmin(1)
        return best, d[np.arange(len(v)), best]

    def assign(self, cells: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The nearest centroid: by bounds, and by full vectors where intervals overlap."""
        out = self.sure(cells)
        open_ = out < 0
        out[open_] = self.exact(v[open_])[0]
        return out


def cells_of(column: pa.Array, dim: int) -> np.ndarray:
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return unpack(data.reshape(len(column), -1), dim)


def _totals(rows: DataFrame, dim: int, k: int, change: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and counts by cluster of what ``change(batch)`` yields: (vectors, cluster, sign).
    Each task sends ``k`` sums; the driver gets ``k`` times ``dim`` numbers."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in batches:
            if b.num_rows:
                for v, cluster, sign in change(b):
                    for c in range(k):
                        mine = v[cluster == c]
                        total[c] += sign * mine.sum(0)
                        n[c] += sign * len(mine)
        yield pa.RecordBatch.from_pydict({"cluster": np.repeat(np.arange(k, dtype=np.int32), dim),
                                          "pos": np.tile(np.arange(dim, dtype=np.int32), k),
                                          "total": total.ravel(), "n": np.repeat(n, dim)})

    found = rows.mapInArrow(part, TOTALS).groupBy("cluster", "pos").agg(F.sum("total").alias("t"), F.sum("n").alias("n")).collect()
    total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
    for r in found:
        total[r.cluster, r.pos], n[r.cluster] = r.t, r.n
    return total, n


def fetch(file: DataFrame, keys: DataFrame) -> DataFrame:
    """Full vectors of the written ``keys``; the planner knows their size."""
    return file.select("key", "cells", "v").join(keys, "key")


def first_centroids(rows: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest."""
    code = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    start = rows.where("vec_id is not null").select("v", code.alias("code")).orderBy("code", "v").limit(k).collect()
    return np.array([r.v for r in start], np.int64)


def moved(old: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each non-empty centroid's exact floor of sum / count."""
    return np.where(n[:, None] > 0, total // np.maximum(n, 1)[:, None], old)


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, prefix: str = "3:",
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Lloyd's rounds with exact integers. Returns per kept vector ``vec_id``, ``cluster``,
    ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``."""
    spark = vectors.sparkSession
    prepare(spark)
    out = "vec_id long, cluster int, distance long"
    rows = integers(vectors, dim, id_col, vector_col)
    grid, _ = fit_grid(rows, dim)
    start = first_centroids(rows, k, prefix)
    if grid is None or not len(start):
        more = "cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"{out}, {more}")
    file = write_file(rows, grid)
    k = len(start)

    now = Measure(grid, start)

    def all_of(b: pa.RecordBatch, m=now):
        v = matrix(b.column(1), dim)
        yield v, m.assign(cells_of(b.column(0), dim), v), 1

    total, n = _totals(file.select("cells", "v"), dim, k, all_of)
    for _ in range(rounds - 1):
        old, now = now, Measure(grid, moved(now.centroids, total, n))
        if (old.centroids == now.centroids).all():
            break                                  # nothing can change any more

        def unsure(batches: Iterator[pa.RecordBatch], a=old, b=now) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells = cells_of(batch.column(1), dim)
                first, second = a.sure(cells), b.sure(cells)
                yield batch.select(["key"]).filter(pa.array((first < 0) | (second < 0) | (first != second)))

        def change(batch: pa.RecordBatch, a=old, b=now):
            cells, v = cells_of(batch.column(0), dim), matrix(batch.column(1), dim)
            first, second = a.assign(cells, v), b.assign(cells, v)
            differ = first != second
            yield v[differ], first[differ], -1
            yield v[differ], second[differ], 1

        keys = materialize(file.select("key", "cells").mapInArrow(unsure, "key long"), "va-open")
        more, n_more = _totals(fetch(file, keys).select("cells", "v"), dim, k, change)
        discard(keys)
        total, n = total + more, n + n_more
    last = Measure(grid, moved(now.centroids, total, n))

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = matrix(b.column(2), dim)
            best = last.assign(cells_of(b.column(1), dim), v)
            d = ((v - last.centroids[best]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(best, pa.int32()), pa.array(d, pa.int64())],
                                             ["vec_id", "cluster", "distance"])

    placed = materialize(file.select("vec_id", "cells", "v").mapInArrow(final, out), "clusters")
    sums = {r.cluster: r.s for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    codes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in last.centroids.tolist()]
    of = F.create_map(*[x for c in sums for x in (F.lit(c), F.struct(F.lit(sums[c]).cast("long").alias("s"),
                                                                     F.lit(codes[c]).alias("code")))])
    mine = F.element_at(of, F.col("cluster"))
    return placed.select("vec_id", "cluster", "distance", mine["s"].alias("cluster_inertia"),
                         F.lit(sum(sums.values())).cast("long").alias("inertia"), mine["code"].alias("centroid_sha256"))


def oracle(k: int = 8, rounds: int = 10, dim: int = 64, prefix: str = "3:") -> str:
    """DuckDB SQL for :func:`cluster` over the table ``embeddings``, each round two steps."""
    steps = [f"""
kept as materialized (
  select row_number() over () as key, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v
  from embeddings where len(embedding) = {dim} and list_count(embedding) = {dim}
   and len(list_filter(embedding, lambda x: not isfinite(x) or abs({SCALE} * x::double) > {LARGEST})) = 0),
c0 as materialized (
  select row_number() over (order by sha256('{prefix}' || vec_id), v) - 1 as cluster, v
  from kept where vec_id is not null qualify cluster < {k})"""]
    square = "list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    for r in range(rounds + 1):
        steps.append(f"""
a{r} as materialized (
  select key, arg_min(cluster, (d, cluster)) as cluster, min(d) as d
  from (select e.key, c.cluster, {square}::bigint as d from kept e, c{r} c) group by key)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} as materialized (
  select c.cluster, coalesce(m.v, c.v) as v
  from c{r} c left join (
    select cluster, list(x order by pos) as v from (
      select cluster, pos, ((s - ((s % n) + n) % n) // n)::bigint as x
      from (select cluster, pos, sum(x)::hugeint as s, count(*)::hugeint as n
            from (select a.cluster, unnest(e.v) as x, generate_subscripts(e.v, 1) as pos from a{r} a join kept e using (key))
            group by cluster, pos)) group by cluster) m using (cluster))""")
    return f"""with {','.join(steps)}
select e.vec_id, a.cluster::integer as cluster, a.d as distance,
       sum(a.d) over (partition by a.cluster)::bigint as cluster_inertia, sum(a.d) over ()::bigint as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{rounds} a join kept e using (key) join c{rounds} c using (cluster)
"""
