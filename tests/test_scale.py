"""What is shuffled and written by the index and its searches, on tables too large for a plan of small ones."""

import re

import pytest
from pyspark.sql import functions as F

from lookout import session
from lookout.index import SearchIndex
from lookout.operators import corpus as C
from lookout.operators import geo as G
from lookout.operators import search as S
from lookout.operators import stemming as ST
from lookout.plans import queries as Q
from lookout.sources import index_store as IS
from lookout.sources import places as SP


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def index(spark):
    docs = [(i, f"courses running w{i % 7} w{i % 3} relations dog{i}") for i in range(200)]
    return SearchIndex(spark.createDataFrame(docs, "doc_id long, text string"), min_cf=1, max_cf=10 ** 9)


@pytest.fixture
def written(monkeypatch):
    """Names and columns of the tables that the searches write."""
    seen = {}
    for module in (S, G):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, real=real: (seen.setdefault(name, df.columns), real(df, name))[1])
    return seen


def batch(spark):
    return spark.createDataFrame([(0, "courses w1"), (1, "relation dog7 dog8")], "query_id long, text string")


def test_postings_stay_with_their_document(index):
    assert "Exchange hashpartitioning" not in plan(index.weighted)         # neither stems nor norms shuffle postings
    stems = ST.stem_postings(index.raw_postings, index.stems, "doc_no", 8)
    assert "Exchange hashpartitioning" not in plan(stems)
    norms = index.weighted.groupBy("doc_no").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert len(norms) == 200 and all(abs(r.n - 1) < 1e-9 for r in norms)


def test_weights_are_not_written(index):
    assert not hasattr(index.weighted, "written_path")


def test_result_texts_stream(spark, sf_small):
    found = plan(Q.q_ranked_search_stemmed(spark, sf_small))
    assert len(re.findall("LeftSemi, BuildRight", found)) >= 2


def test_semi_by_id_writes_ids(spark, written):
    got = G.semi_by_id(spark.range(5).withColumnRenamed("id", "doc_id"), spark.createDataFrame([(3,), (3,), (9,)], "doc_id long"))
    assert [r.doc_id for r in got.collect()] == [3] and written["result-ids"] == ["doc_id"]


def test_bounds_carry_no_terms(spark, index, written):
    S.ranked_blocks(index.store, index.located(batch(spark)), 3, 1).top.collect()
    assert written["block-bounds"] == ["query_id", "block", "bound", "n"]


def test_second_pass_of_totals(index):
    totals = ST.second_pass(index.term_stats.select("term", F.col("cf").alias("tf")))
    each = ST.second_pass(index.postings).groupBy("term").agg(F.sum("tf").alias("tf"))
    assert sorted(totals.select("term", "tf").collect()) == sorted(each.collect())
    assert "cour" in {r.term for r in totals.collect()}


def test_query_tables_are_written(spark, index, written):
    assert {r.query_id for r in S.conjunctive_bitmaps(index.store, index.located(batch(spark))).collect()} == {0}
    assert {"known", "query-places"} <= written.keys()


def test_two_stage_blocks_are_written(spark, index, written):
    places = spark.createDataFrame([], "doc_id long, cuisine string, facilities array<string>, price_range string")
    S.two_stage_stored(index.store, index.located(batch(spark)), places, "x", "y").collect()
    assert "full-blocks" in written


def test_scores_are_shuffled_once(spark, index):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    located = index.located(batch(spark))
    places = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("x").alias("cuisine"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = plan(S.stored_scores(index.store, located).join(places, "doc_id", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = re.findall(r"Exchange hashpartitioning\((\w+)#\w+, (?:(\w+)#)?", found)
    assert ("doc_id", "") in dealt and not any(of == "query_id" or second == "doc_id" for of, second in dealt), found


def test_page_files_by_all_tasks(spark):
    path = IS.scratch_path(spark, "pages")
    SP.write_page_files(spark.range(40).selectExpr("id page_id", "'<p>' html").coalesce(1), path)
    files = SP.read_page_files(spark, path).collect()
    assert sorted(r.page_id for r in files) == list(range(40))
    assert len({re.search(r"part-(\d+)", r.path).group(1) for r in files}) > 4


@pytest.fixture
def no_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def above(node, df):
    """The nodes above the first ``node`` of a plan."""
    lines = [line for line in plan(df).split("\n") if line.strip()]
    at = next(i for i, line in enumerate(lines) if node in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))                   # noqa: E731
    out = []
    for line in reversed(lines[:at]):
        if depth(line) < depth(lines[at]) and (not out or depth(line) < depth(out[-1])):
            out.append(line)
    return "\n".join(out)


def rounded(df, *cols):
    return sorted((*(r[c] for c in cols), None if r.weight is None else round(r.weight, 9)) for r in df.collect())


def test_large_term_tables_come_to_postings(spark, index, no_broadcasts):
    want = rounded(index.weighted, "doc_id", "term", "tf")
    found = index.weigh(index.idf.select("term", "idf"))
    assert "Exchange" not in above("FileScan parquet spark_catalog", found), plan(found)
    assert rounded(found, "doc_id", "term", "tf") == want and len(want) > 200
    stemmed = ST.sum_stems(C.with_terms(index.raw_postings, index.raw_terms, index.stems, index.parts))
    assert "Exchange" not in above("FileScan parquet spark_catalog", stemmed)
    key = ["doc_id", "term", "tf"]
    assert sorted(stemmed.select(key).collect()) == sorted(index.postings.select(key).collect())


def test_weighted_postings_shuffle_no_postings(spark, sf_small, no_broadcasts):
    found = Q.q_weighted_postings(spark, sf_small)
    assert "Exchange" not in above("FileScan parquet spark_catalog", found), plan(found)
    assert not hasattr(Q._model(spark, sf_small).weighted, "written_path")


def test_labels_name_partitions(spark):
    n = 13
    at = spark.range(n).withColumn("label", session.label(spark, n, F.col("id"))).repartition(n, "label")
    assert all(r.id == r.p for r in at.select("id", F.spark_partition_id().alias("p")).collect())


def test_store_is_dealt_without_sampling(spark, index, monkeypatch):
    """Terms of any frequency in shards of their own places; no weights are written or evaluated twice for it."""
    monkeypatch.setattr(IS, "SHARD_BYTES", 1 << 10)
    small = SearchIndex(index.docs, min_cf=1, max_cf=10 ** 9, reuse=index)
    shards = small.store.blocks.groupBy("term").agg(F.collect_set("shard").alias("s"), F.sum("n").alias("n")).collect()
    hot = {r.term: len(r.s) for r in shards if r.n == 200}
    assert hot and min(hot.values()) > 1 and max(len(r.s) for r in shards if r.n == 1) == 1
    assert small.store.blocks.groupBy("term", "block").count().where("count > 1").isEmpty()
    key = ["doc_id", "term", "tf"]
    assert rounded(small.store.postings(), *key) == rounded(index.weighted, *key)
    q = batch(spark)
    assert sorted(small.conjunctive(q).collect()) == sorted(index.conjunctive(q).collect())
    assert sorted(small.ranked(q).collect()) == sorted(small.ranked(q, maxima=False).collect())


def test_written_tables_leave_no_shuffle_files(spark):
    before = spark.conf.get(session.CLEANUP)
    with session.shuffles_go(spark):
        assert spark.conf.get(session.CLEANUP) == "true"
    assert spark.conf.get(session.CLEANUP) == before
    table = spark.range(1000).groupBy(F.col("id") % 7).count()
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    spark.sparkContext._jvm.System.gc()
    old = manager.shuffleStatuses().size()
    assert session.materialize(table, "counted").count() == 7 and manager.shuffleStatuses().size() <= old + 1      # of count()
