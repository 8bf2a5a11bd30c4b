"""The public SearchIndex API on the smallest corpus, against brute force."""

from lookout.index import SearchIndex
from lookout.sources import tables

import bruteforce as B


def test_search_index_matches_brute_force(spark, sf_small):
    docs = tables.documents(spark, sf_small)
    queries = tables.query_batch(spark, sf_small)
    idx = SearchIndex(docs, stem=True, min_cf=2, max_cf=1900)
    texts = {r.doc_id: r.text for r in docs.collect()}
    qs = {r.query_id: r.text for r in queries.collect()}

    got = {(r.query_id, r.doc_id) for r in idx.conjunctive(queries).collect()}
    assert got == B.conjunctive(texts, qs, stem=True)

    ranked = {}
    for r in sorted(idx.ranked(queries, k=3).collect(), key=lambda r: (r.query_id, r.rank)):
        ranked.setdefault(r.query_id, []).append(r.doc_id)
    want = {q: [d for d, _ in v] for q, v in B.ranked(texts, qs, k=3, stem=True).items() if v}
    assert ranked == want


def test_indexes_share_tables(spark, sf_small):
    docs = tables.documents(spark, sf_small)
    plain = SearchIndex(docs, stem=False)
    stemmed = SearchIndex(docs, stem=True, reuse=plain)
    assert stemmed.forward is plain.forward
    two_pass = SearchIndex(docs, stem=True, passes=2, reuse=stemmed)
    assert two_pass.numbered is stemmed.numbered and two_pass.stems is stemmed.stems
    assert two_pass.idf.count() > 0


def test_vocabulary_bound_grows_with_the_corpus(spark):
    # a relative bound keeps a word of 1900 of 2200 documents, the absolute bound of 1800 drops it
    docs = spark.createDataFrame([(i, "garden" if i < 1900 else "kitchen") for i in range(2200)], "doc_id long, text string")
    grown = SearchIndex(docs, stem=False, max_cf=1800, max_per_doc=0.9)
    assert {r.term for r in grown.idf.collect()} == {"garden", "kitchen"}
    fixed = SearchIndex(docs, stem=False, max_cf=1800, max_per_doc=None, reuse=grown)
    assert {r.term for r in fixed.idf.collect()} == {"kitchen"}
