"""List literals against Python's own repr, fields of TSV files, page files in order."""

import ast
import random
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lookout.operators import places as PL
from lookout.sources import index_store as IS
from lookout.sources import places as SP

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
text = st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("'\"\\\n\r\t\0[], xuUN{}0\x7f\x85\xa0\u2028\U000e0001")), max_size=12)


@SETTINGS
@given(st.lists(st.lists(text, max_size=5), min_size=30, max_size=60))
def test_codec_equals_repr_both_ways(spark, lists):
    df = spark.createDataFrame([(v, repr(v)) for v in lists], "v array<string>, printed string")
    rows = df.select("v", "printed", PL.encode_list(F.col("v")).alias("e"), PL.decode_list(F.col("printed")).alias("d")).collect()
    assert all(r.e == r.printed and r.d == r.v for r in rows)


def test_every_character(spark):
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    lists = ["".join(chars[i:i + 4096]) for i in range(0, len(chars), 4096)]
    df = spark.createDataFrame([(v, repr([v])) for v in lists], "v string, printed string").repartition(8)
    bad = df.where((PL.encode_list(F.array("v")) != F.col("printed")) | (F.get(PL.decode_list(F.col("printed")), 0) != F.col("v")))
    assert bad.count() == 0


def test_literals_with_all_escapes(spark):
    texts = [r"""['\x41\u00e9\U0001F600\101\7\0', "it's", 'a\
b', '\a\b\f\v\\\'\"', '\N{LATIN SMALL LETTER E WITH ACUTE}' , '\q']""", "[ 'a' ,\"b\",\n'c' , ]", "  []  ", "[\t]"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(PL.decode_list(F.col("t"))).collect()]
    assert got == [ast.literal_eval(t.strip().replace(r"\q", r"\\q")) for t in texts]
    odd = ["['a'", "['a' 'b']", "['a', 1]", "[None]", "nope", "'a'", "['a',, 'b']", "__import__('os')", "['a']]", "['\\']"]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select(PL.decode_list(F.col("t")).alias("d")).collect()
    assert all(r.d is None for r in rows)                        # counted, not swallowed
    long = ["x" * 300_000, "y\\" * 50_000]
    assert spark.createDataFrame([(repr(long),)], "t string").select(PL.decode_list(F.col("t"))).first()[0] == long


PLACES = [(1, "a\tb", "line\nbreak\r\n", "back\\slash \\n \\N", "00186", "", None, "\\N", "\\E", ["x\ty", "it's\n"], [], '"quoted" \'', "nul\0"),
          (2, None, None, None, None, None, None, None, None, [], [], None, None),
          (3, " blanks ", "caf\u00e9 \u2028 \x85 \U0001F600", ",;", "#x", "''", '""', "\\\\", "\\", ["\\N"], ["a"], "x" * 5000, "end\\")]


@pytest.mark.parametrize("quoted", [False, True])
def test_places_round_trip(spark, quoted):
    rows = PLACES if not quoted else [tuple(x.replace("\0", "").replace("\\N", "N").replace("\r\n", "\n") if isinstance(x, str) else x for x in r)
                                      for r in PLACES]
    if quoted:
        rows = [(*r[:9], [], r[10], *r[11:]) for r in rows]
    path = IS.scratch_path(spark, "tsv")
    SP.write_places_tsv(spark.createDataFrame(rows, SP.PLACE_SCHEMA), path, quoted=quoted)
    assert sorted(map(tuple, SP.read_places_tsv(spark, path, quoted=quoted).collect())) == sorted(rows)


def test_one_file_spans_tasks(spark):
    rng = random.Random(1)
    rows = [(i, f"name {i}", *["".join(rng.choice("ab\n\t\\") for _ in range(50)) for _ in range(7)], ["x\n"], [], "", "w") for i in range(4000)]
    path = IS.scratch_path(spark, "tsv-large")
    SP.write_places_tsv(spark.createDataFrame(rows, SP.PLACE_SCHEMA).coalesce(1), path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        back = SP.read_places_tsv(spark, path)
        assert len(back.inputFiles()) == 1 and back.rdd.getNumPartitions() > 2
        assert back.select(F.spark_partition_id()).distinct().count() > 2
        assert sorted(map(tuple, back.collect())) == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_page_files_in_order(spark):
    pages = spark.createDataFrame([(n, f"<h1>{n}</h1>\nx") for n in (30, 2, 100, 7)] + [(None, "no number"), (11, None)], "page_id long, html string")
    path = IS.scratch_path(spark, "pages")
    SP.write_page_files(pages.where("page_id is not null"), path, name="restaurant")
    rows = SP.ordered_page_files(spark, path).orderBy("rank").collect()
    assert [(r.rank, r.page_id) for r in rows] == list(enumerate([2, 7, 11, 30, 100]))
    assert rows[0].html == "<h1>2</h1>\nx\n" and rows[2].html == "\n" and "restaurant_2/" in rows[0].path
    # many small files share a split
    assert SP.read_page_files(spark, path).rdd.getNumPartitions() < 5 or spark.sparkContext.defaultParallelism >= 5
