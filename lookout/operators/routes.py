"""Monotone route feasibility.

Per test case: points sorted by (x, y), walked from (0, 0) moving only
right (R) or up (U). Feasible iff no point lies left of or below its
predecessor; the path is R x dx then U x dy per step, which is the
lexicographically smallest shortest path. All cases run in one job.

A case may hold a large share of all points, so no task gets a case as a whole.
Points are range-partitioned on (case, x, y) -- boundaries come from a sample, so a
huge case is cut into several balanced partitions -- and each partition's piece of
a case is folded to a summary: first point, last point, whether its steps are
feasible, their length and moves. Summaries of neighbouring pieces merge
associatively: the step from one's last to the next's first point joins them. What is
gathered per case is one summary per partition, and the answer's own path string.
:func:`route_summary` leaves the moves out, for cases whose path is too long for a row.

Repeated points add no step, so they are made distinct first (combined in the map
tasks); points with a null coordinate are no points.

:func:`route_steps` returns the steps as rows. There the predecessor of a
partition's first row is the last row of the previous non-empty partition when that
row belongs to the same case; that boundary table has one row per range partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, partitions_for, written_bytes

LOCAL_BITS = 33


def _step() -> list[Column]:
    """``ok`` and ``moves`` of the step from ``(_px, _py)`` to ``(x, y)``."""
    return [((F.col("x") >= F.col("_px")) & (F.col("y") >= F.col("_py"))).alias("ok"),
            F.concat(F.repeat(F.lit("R"), F.greatest(F.col("x") - F.col("_px"), F.lit(0))),
                     F.repeat(F.lit("U"), F.greatest(F.col("y") - F.col("_py"), F.lit(0)))).alias("moves")]


def route_steps(points: DataFrame, case_col: str = "case_id", x: str = "x", y: str = "y",
                partitions: int | None = None) -> DataFrame:
    """``(case_id, x, y, ok, moves)`` per point, with its walking order
    ``seq`` (increasing within a case)."""
    spark = points.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (points.select(F.col(case_col).alias("case_id"), F.col(x).alias("x"), F.col(y).alias("y"))
              .repartitionByRange(n, "case_id", "x", "y")
              .sortWithinPartitions("case_id", "x", "y")
              .select("case_id", "x", "y", F.monotonically_increasing_id().alias("seq")))
    ranged = materialize(ranged, "route-order").withColumn(
        "_part", F.shiftright("seq", LOCAL_BITS))

    # Last row of every range partition (one row per partition).
    last = (ranged.groupBy("_part")
            .agg(F.max_by(F.struct("case_id", "x", "y"), "seq").alias("_last")))
    # The previous non-empty partition's last row, for each partition.
    w_parts = Window.orderBy("_part")
    bridge = last.select("_part", F.lag("_last").over(w_parts).alias("_prev_last"))

    w = Window.partitionBy("_part").orderBy("seq")
    local_prev = F.lag(F.struct("case_id", "x", "y")).over(w)
    with_prev = (ranged.withColumn("_prev", local_prev)
                 .join(F.broadcast(bridge), "_part", "left"))
    prev = F.coalesce(F.col("_prev"), F.col("_prev_last"))
    same_case = prev.isNotNull() & (prev["case_id"] == F.col("case_id"))
    px = F.when(same_case, prev["x"]).otherwise(F.lit(0))
    py = F.when(same_case, prev["y"]).otherwise(F.lit(0))
    return (with_prev.select("case_id", "x", "y", "seq", px.alias("_px"), py.alias("_py"))
            .select("case_id", "x", "y", "seq", *_step()))


def _move(to: Column, of: Column, moves: bool) -> Column:
    """The step from point ``of`` to ``to``: feasible, its length, its moves ('' unless asked for)."""
    dx, dy = to["x"] - of["x"], to["y"] - of["y"]
    path = F.concat(F.repeat(F.lit("R"), F.greatest(dx, F.lit(0)).cast("int")),
                    F.repeat(F.lit("U"), F.greatest(dy, F.lit(0)).cast("int"))) if moves else F.lit("")
    return F.struct(((dx >= 0) & (dy >= 0)).alias("ok"), (dx + dy).cast("bigint").alias("length"), path.alias("moves"))


def route_pieces(points: DataFrame, case_col: str = "case_id", x: str = "x", y: str = "y",
                 partitions: int | None = None, moves: bool = True) -> DataFrame:
    """One summary per (case, range partition): ``case_id, piece, n, first, last, ok, length, moves``;
    ``piece`` ascends along the case."""
    spark = points.sparkSession
    pts = points.select(F.col(case_col).alias("case_id"), F.col(x).alias("x"), F.col(y).alias("y")) \
        .where("x is not null and y is not null").distinct()
    pts = materialize(pts, "route-points")
    n = partitions or partitions_for(spark, written_bytes(pts))
    listed = pts.repartitionByRange(n, "case_id", "x", "y").withColumn("piece", F.spark_partition_id()) \
        .groupBy("case_id", "piece").agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("points"))
    steps = F.transform(F.sequence(F.lit(2), F.size("points")),
                        lambda i: _move(F.element_at("points", i), F.element_at("points", i - 1), moves))
    steps = F.when(F.size("points") > 1, steps).otherwise(F.array().cast("array<struct<ok:boolean,length:bigint,moves:string>>"))
    stepped = listed.select("case_id", "piece", F.size("points").cast("bigint").alias("n"), F.element_at("points", 1).alias("first"),
                            F.element_at("points", -1).alias("last"), steps.alias("steps"))
    return stepped.select("case_id", "piece", "n", "first", "last", F.forall("steps", lambda s: s["ok"]).alias("ok"),
                          F.aggregate("steps", F.lit(0).cast("bigint"), lambda a, s: a + s["length"]).alias("length"),
                          F.array_join(F.transform("steps", lambda s: s["moves"]), "").alias("moves"))


def _merged(pieces: DataFrame, case_col: str, moves: bool) -> DataFrame:
    """Pieces of each case in order, with the step that leads to each: the case and ``p``."""
    listed = pieces.groupBy("case_id").agg(F.sort_array(F.collect_list(
        F.struct("piece", "n", "first", "last", "ok", "length", "moves"))).alias("p"))
    origin = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"))
    led = F.transform("p", lambda s, i: F.struct(
        s.alias("own"), _move(s["first"], F.when(i == 0, origin).otherwise(F.get("p", i - 1)["last"]), moves).alias("to")))
    return listed.select(F.col("case_id").alias(case_col), led.alias("p"))


def _answer() -> Column:
    return F.forall("p", lambda s: s["own"]["ok"] & s["to"]["ok"])


def monotone_route(points: DataFrame, case_col: str = "case_id", x: str = "x", y: str = "y",
                   partitions: int | None = None) -> DataFrame:
    """``(case_id, answer, path)``: ``YES`` with the path, or ``NO`` with a
    null path. The moves of an infeasible piece are dropped before they are gathered."""
    pieces = route_pieces(points, case_col, x, y, partitions).withColumn("moves", F.when(F.col("ok"), F.col("moves")))
    merged = _merged(pieces, case_col, True).withColumn("yes", _answer())
    path = F.array_join(F.transform("p", lambda s: F.concat(s["to"]["moves"], s["own"]["moves"])), "")
    return merged.select(case_col, F.when(F.col("yes"), "YES").otherwise("NO").alias("answer"),
                         F.when(F.col("yes"), path).alias("path"))


def route_summary(points: DataFrame, case_col: str = "case_id", x: str = "x", y: str = "y",
                  partitions: int | None = None) -> DataFrame:
    """``(case_id, answer, n_points, path_length)`` without path strings; the length is null for ``NO``."""
    merged = _merged(route_pieces(points, case_col, x, y, partitions, moves=False), case_col, False).withColumn("yes", _answer())
    total = lambda f: F.aggregate("p", F.lit(0).cast("bigint"), lambda a, s: a + f(s))           # noqa: E731
    return merged.select(case_col, F.when(F.col("yes"), "YES").otherwise("NO").alias("answer"), total(lambda s: s["own"]["n"]).alias("n_points"),
                         F.when(F.col("yes"), total(lambda s: s["own"]["length"] + s["to"]["length"])).alias("path_length"))
