"""The term-ordered index: layout, pruned scans, and searches against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lookout.index import SearchIndex
from lookout.operators import search as S
from lookout.sources import index_store as IS
from lookout.sources import tables

import bruteforce as B

HOT = "hotword"


@pytest.fixture(scope="module")
def corpus():
    """3000 documents: one word in all, words of falling frequency, empty and null texts."""
    rng = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    docs = {i: " ".join([HOT] + rng.choices(words, weights, k=rng.randint(1, 30))) for i in range(3000)}
    docs |= {5000: "", 5001: None, 5002: "the and of", 2 ** 40: f"{HOT} lonely"}
    queries = {0: f"{HOT} word3", 1: "word1 word2 word250", 2: "unknownterm", 3: f"{HOT} unknownterm word7 word7", 4: "", 5: None,
               6: f"{HOT}", 7: "word0 word1 word2 word3 word4 word5", 8: "lonely word299"}
    return docs, queries


@pytest.fixture(scope="module")
def index(spark, corpus):
    docs = spark.createDataFrame(list(corpus[0].items()), "doc_id long, text string").repartition(3, "doc_id")
    idx = SearchIndex(docs, stem=False, min_cf=1, max_cf=10 ** 9, shards=40)
    idx.__dict__["store"] = IS.PostingStore.write(idx.weighted, idx.term_stats.join(idx.idf.select("term", "idf"), "term"), shards=40, dense=40)
    return idx


def batch(spark, queries):
    return spark.createDataFrame(list(queries.items()), "query_id long, text string")


def files_read(df):
    """Number of files that the scans of the executed query read, by the scan's own metric."""
    df.collect()
    seen = []

    def walk(node):
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan parquet") and "entries" in node.schema().catalogString():
            seen.append(node.metrics().apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return seen


def test_layout(index, corpus):
    store = index.store
    blocks = store.blocks.collect()
    want = Counter((t, d) for d, text in corpus[0].items() for t in B.tokens(text))
    got = {(b.term, e.doc_id): e.tf for b in blocks for e in b.entries}
    assert got == dict(want)
    assert all(b.n == len(b.entries) <= 1 << IS.BLOCK_BITS and b.max_weight == max(e.weight for e in b.entries) for b in blocks)
    shards = {}
    for b in blocks:
        shards.setdefault(b.shard, []).append((b.term, b.block))
    assert len(shards) > 6                                     # ranged on (term, block), one file each
    ranges = sorted((min(v), max(v)) for v in shards.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    assert len(store.blocks.inputFiles()) == len(shards)
    assert len({b.shard for b in blocks if b.term == HOT}) > 1  # a frequent term spans shards
    directory = store.directory.collect()
    assert sum(r.n for r in directory if r.term == HOT) == 3001 == next(r.df for r in directory if r.term == HOT)
    dense = {(r.term, r.bucket): r.n for r in store.bitmaps.collect()}
    assert all(n >= 40 for n in dense.values()) and len({b for t, b in dense if t == HOT}) == 3
    assert [r.n for r in store.bitmaps.select(F.bitmap_count("bitmap").alias("n"), F.col("n").alias("m")).where("n != m").collect()] == []


def test_opened_again_by_path(spark, index):
    again = IS.PostingStore(spark, index.store.path)
    rows = lambda df: sorted(df.select("term", "doc_id", "tf", F.round("weight", 9)).collect())
    assert rows(again.postings()) == rows(index.weights)
    wanted = spark.createDataFrame([("lonely",), ("absent",)], "term string")
    assert [(r.term, r.doc_id) for r in again.lookup(wanted).collect()] == [("lonely", 2 ** 40)]


def test_terms_prune_the_scan(spark, index):
    wanted = spark.createDataFrame([("lonely",)], "term string")
    found = index.store.lookup(wanted)
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    assert files_read(found) == [1]
    # the same for a search, and for one that reads headers alone
    located = index.located(batch(spark, {0: "lonely word299"}))
    assert 0 < max(files_read(S.stored_scores(index.store, located))) < len(index.store.blocks.inputFiles()) / 4
    heads = S.full_blocks(index.store, located)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in heads and "entries" not in heads


def test_conjunctive_bitmaps(spark, index, corpus):
    docs, queries = corpus
    got = [(r.query_id, r.doc_id) for r in index.conjunctive(batch(spark, queries)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == B.conjunctive(docs, {q: t or "" for q, t in queries.items()}, stem=False)
    both = {d for d, t in docs.items() if {HOT, "word3"} <= set(B.tokens(t))}
    assert {r.doc_id for r in S.term_intersect(index.store, HOT, "word3").collect()} == both
    assert S.term_intersect(index.store, HOT, "absent").collect() == []
    assert {r.doc_id for r in S.term_intersect(index.store, HOT, HOT).collect()} == {d for d, t in docs.items() if HOT in B.tokens(t)}


def brute_ranked(docs, queries, k):
    idf, weights = B.tfidf(docs, stem=False, min_cf=1, max_cf=10 ** 9)
    out = {}
    for q, text in queries.items():
        w = {t: c * idf[t] for t, c in Counter(t for t in B.tokens(text) if t in idf).items()}
        norm = sum(v * v for v in w.values()) ** 0.5
        scores = {d: round(sum(w[t] / norm * dw[t] for t in w if t in dw), 6) for d, dw in weights.items() if w.keys() & dw.keys()}
        out |= {(q, i + 1): (d, s) for i, (d, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k])}
    return out


@pytest.mark.parametrize("k, seeds", [(1, 1), (5, 2), (5, 16), (4000, 3)])
def test_block_maxima(spark, index, corpus, k, seeds):
    docs, queries = corpus
    r = S.ranked_blocks(index.store, index.located(batch(spark, queries)), k, seeds)
    got = {(x.query_id, x.rank): (x.doc_id, x.score) for x in r.top.collect()}
    want = brute_ranked(docs, queries, k)
    assert got.keys() == want.keys()
    assert all(abs(got[i][1] - want[i][1]) <= 1.1e-6 for i in want)
    plain = {(x.query_id, x.rank): (x.doc_id, x.score) for x in index.ranked(batch(spark, queries), k, maxima=False).collect()}
    assert got == plain
    total, scored = r.bounds.agg(F.sum("n")).first()[0], r.scored.agg(F.sum("n")).first()[0]
    assert total == sum(len(set(B.tokens(t)) & set(B.tokens(q))) for q in queries.values() for t in docs.values())
    assert scored < total if k < 10 else scored == total
    assert r.scored.select("query_id", "block").distinct().count() == r.scored.count()


def test_two_stage_reads_postings_once(spark, index, corpus, sf_small):
    docs, queries = corpus
    places = spark.createDataFrame([(0, "Italian", ["Terrace"], "€"), (7, "Thai", None, None)],
                                   "doc_id long, cuisine string, facilities array<string>, price_range string")
    q = batch(spark, queries)
    located = index.located(q)
    got = S.two_stage_stored(index.store, located, places, "Ital", "Terrace", k=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<term:string,block:bigint,entries") == 1
    terms = located.select("query_id", "term").distinct()
    want = S.two_stage_search(index.postings, terms, index.weights, index.query_vectors(q), places, "Ital", "Terrace", k=4,
                              terms_distinct=True)
    assert sorted(map(tuple, got.select("query_id", "doc_id", "score", "rank").collect())) == sorted(map(tuple, want.collect()))


def test_empty_corpus(spark):
    idx = SearchIndex(spark.createDataFrame([], "doc_id long, text string"), stem=False)
    q = spark.createDataFrame([(0, "word")], "query_id long, text string")
    assert idx.conjunctive(q).collect() == [] and idx.ranked(q).collect() == [] and idx.store.postings().collect() == []


def test_maxima_on_the_test_corpus(spark, sf_small):
    docs, q = tables.documents(spark, sf_small), tables.query_batch(spark, sf_small)
    idx = SearchIndex(docs, stem=False)
    rows = lambda df: sorted(map(tuple, df.collect()))           # noqa: E731
    assert rows(idx.ranked(q)) == rows(idx.ranked(q, maxima=False)) == rows(S.ranked_search(idx.weights, idx.query_vectors(q)))
