from lookout.session import Scratch, checkpoint_root, discard, materialize, partitions_for, spread, written_bytes


def test_checkpoint_root_comes_from_session(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    df = materialize(spark.range(10), "t")
    assert all(root in f for f in df.inputFiles())


def test_partitions_follow_the_size(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert partitions_for(spark, 10) == least
    assert partitions_for(spark, 1000 << 20, 10 << 20) == 100
    t = materialize(spark.range(1000), "sized")
    assert 0 < written_bytes(t) < 1 << 20


def test_spread_scans_with_few_splits(spark, sf_small):
    scan = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert spread(scan).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = materialize(scan.repartition(64), "many")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert spread(many) is many                           # as many splits as cores: unchanged
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_ship_library_adds_the_package_once(spark):
    import os
    import zipfile

    from pyspark import SparkFiles

    from lookout.session import _SHIPPED, ship_library
    ship_library(spark)
    ship_library(spark)                                       # once per application
    assert spark.sparkContext.applicationId in _SHIPPED
    shipped = os.path.join(SparkFiles.getRootDirectory(), "lookout.zip")
    assert os.path.exists(shipped)
    names = zipfile.ZipFile(shipped).namelist()
    assert "lookout/__init__.py" in names and "lookout/operators/extract.py" in names


def test_discard_deletes_a_written_table(spark):
    import os
    kept, gone = materialize(spark.range(5), "kept"), materialize(spark.range(5), "gone")
    discard(gone)
    assert kept.count() == 5
    assert not os.path.exists(gone.written_path.removeprefix("file:"))


def test_scratch_keeps_what_is_asked_for(spark):
    import os
    exists = lambda t: os.path.exists(t.written_path.removeprefix("file:"))                       # noqa: E731
    with Scratch() as outer:
        a = materialize(spark.range(1), "a")
        with Scratch() as inner:
            b, c = materialize(spark.range(2), "b"), inner.keep(materialize(spark.range(3), "c"))
        assert exists(a) and not exists(b) and exists(c)
        outer.keep(a)
    assert exists(a) and not exists(c) and a.count() == 1
    after = materialize(spark.range(1), "after")
    assert exists(after)
