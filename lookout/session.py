"""Session helpers: building a session, the shared checkpoint folder, and
materialising an intermediate table so later stages read it back with real
file-size statistics and no lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Planner settings every job of the library relies on. AQE re-plans joins
# with measured sizes and splits skewed shuffle partitions; ANSI stays on.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lookout", driver_memory: str | None = None) -> SparkSession:
    """Session for scripts and tests. On a cluster, pass no master and let
    spark-submit decide; only settings that are unset are filled in.
    ``driver_memory`` matters in local mode, where the driver JVM is also the
    only executor (it applies only when this call starts the JVM)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when the session has none (local
    runs and tests) is a private folder created and registered, so a local
    temporary folder is never chosen behind a cluster's back."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        conf_dir = jdir.get() if jdir.isDefined() else None
    if not conf_dir:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="lookout-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


_SHIPPED: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    The HTML extraction job and the stem dictionary run Python functions of
    this package on executors. The package is zipped once per application
    and added with ``SparkContext.addPyFile``, which serves it to every
    executor (the zip is read only by the driver)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="lookout-py-"), "lookout.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("lookout", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside are deleted as soon as it is, not when the driver happens to collect
    its garbage: nothing reads them again, as what follows reads the table."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    Used where a result is reused or its size must be known before choosing
    a join strategy: the re-read relation carries the real file size, so the
    planner's broadcast threshold becomes a proven bound, and lineage is cut
    so a lost executor re-reads files instead of recomputing the job."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
    with shuffles_go(spark):
        df.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    table.written_path = path
    if _SCOPES:
        _SCOPES[-1].append(table)
    return table


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """:func:`materialize` as ``buckets`` files, dealt by the hash of ``key``. Spark knows the layout, so what is
    grouped by ``key`` later needs no shuffle, nor what is joined to a broadcast table before. ``dealt`` says that
    ``df`` is in that many partitions by ``key`` already."""
    spark = df.sparkSession
    table = f"{name}-{uuid.uuid4().hex}"
    path = os.path.join(checkpoint_root(spark), table)
    dealt_rows = df if dealt else df.repartition(buckets, key)
    with shuffles_go(spark):
        dealt_rows.write.format("parquet").option("compression", "zstd").bucketBy(buckets, key).option("path", path).saveAsTable(table.replace("-", "_"))
    out = spark.table(table.replace("-", "_"))
    out.written_path = path
    if _SCOPES:
        _SCOPES[-1].append(out)
    return out


_SCOPES: list[list[DataFrame]] = []


class Scratch:
    """The tables that :func:`materialize` writes inside a ``with`` block are deleted at its end, but
    for those given to :meth:`keep`, which the block around it, if any, takes over. What leaves
    the block may only read tables that are kept."""

    def __enter__(self) -> "Scratch":
        self.kept: list[DataFrame] = []
        _SCOPES.append([])
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        self.kept.append(table)
        return table

    def __exit__(self, *error) -> None:
        written = _SCOPES.pop()
        if _SCOPES:
            _SCOPES[-1].extend(self.kept)
        discard(*[t for t in written if all(t is not k for k in self.kept)])


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that :func:`materialize` returned and that nothing
    still to be computed reads, such as those of an earlier turn of a loop."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def partitions_for(spark: SparkSession, n_bytes: int, target: int = 64 << 20) -> int:
    """Number of partitions for ``n_bytes`` of data, about ``target`` in each; never
    fewer than ``spark.sql.shuffle.partitions``, so small data still uses the cores."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // target))


_LABELS: dict[int, list[int]] = {}


def labels(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers of which the one at ``i`` is dealt to partition ``i`` when rows are dealt by hash over ``n``."""
    found: dict[int, int] = {}
    start, step = 0, 16 * n
    while n not in _LABELS:
        number = F.col("id").cast("int")
        for r in spark.range(start, start + step, 1, 1).groupBy(F.pmod(F.hash(number), F.lit(n)).alias("to")).agg(F.min(number).alias("x")).collect():
            found.setdefault(r.to, r.x)
        start += step
        if len(found) == n:
            _LABELS[n] = [found[i] for i in range(n)]
    return _LABELS[n]


def label(spark: SparkSession, n: int, at: Column) -> Column:
    """The label (:func:`labels`) of partition ``at``: rows dealt by it over ``n`` partitions go there, and Spark knows
    that rows of one label are in one partition."""
    return F.element_at(F.lit(labels(spark, n)).cast("array<int>"), at.cast("int") + 1)


def written_bytes(df: DataFrame) -> int:
    """The planner's size of ``df``; the files' size for a written table."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(size.toString()) if hasattr(size, "toString") else int(size)


UNKNOWN_BYTES = 1 << 50      # what the planner takes rows of unknown size for is far above, data below


def broadcasts(df: DataFrame) -> bool:
    """Whether the planner broadcasts ``df`` in a join, by its size."""
    return written_bytes(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a table scan that has fewer splits than there are cores over
    the cores, as text work is bound by CPU and a file of one row group can't be split.
    Input of as many splits as cores or more stays as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
