"""Property tests on random small corpora (few examples: each runs Spark jobs)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lookout.operators import corpus as C
from lookout.operators import search as S

import bruteforce as B

WORDS = ["alpha", "beta", "gamma", "delta", "épée", "zeta", "theta", "iota", "kappa", "lambda",
         "Über", "x1y", "2024", "the", "and", "it's", "co-op", "naïve"]
texts = st.lists(st.lists(st.sampled_from(WORDS), max_size=12).map(" ".join), min_size=1, max_size=8)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _docs(spark, ts):
    return spark.createDataFrame(list(enumerate(ts)), "doc_id bigint, text string")


@SETTINGS
@given(texts)
def test_dense_ids_are_sorted_and_dense(spark, ts):
    tf = C.term_counts(_docs(spark, ts))
    rows = sorted((r.term_id, r.term) for r in C.vocabulary(tf).collect())
    terms = sorted({t for x in ts for t in B.tokens(x)})
    assert rows == list(enumerate(terms))


@SETTINGS
@given(texts)
def test_tfidf_matches_brute_force(spark, ts):
    docs = _docs(spark, ts)
    tf = C.term_counts(docs)
    idf = C.fit_idf(tf, C.document_count(docs), min_cf=1, max_cf=10 ** 9, persist=False)
    got = {(r.doc_id, r.term): r.weight for r in C.transform(tf, idf).collect()}
    _, want = B.tfidf(dict(enumerate(ts)), stem=False, min_cf=1, max_cf=10 ** 9)
    flat = {(d, t): w for d, ws in want.items() for t, w in ws.items()}
    assert got.keys() == flat.keys()
    assert all(abs(got[k] - flat[k]) < 1e-9 for k in got)


@SETTINGS
@given(texts, st.lists(st.sampled_from(WORDS), min_size=1, max_size=3))
def test_conjunctive_subset_of_each_term(spark, ts, q):
    tf = C.term_counts(_docs(spark, ts))
    qt = spark.createDataFrame([(0, " ".join(q))], "query_id bigint, text string")
    terms = C.query_counts(qt).select("query_id", "term")
    got = {r.doc_id for r in S.conjunctive_search(tf, terms).collect()}
    want = {d for (_, d) in B.conjunctive(dict(enumerate(ts)), {0: " ".join(q)}, stem=False)}
    assert got == want
