"""Stemmed variants against a brute-force Python evaluation with a stemmer of its own
(the SQL oracle compiles the library's rule table)."""

from lookout.plans import queries as Q
from lookout.sources import tables

import bruteforce as B


def _inputs(spark, d):
    docs = {r["doc_id"]: r["text"] for r in tables.documents(spark, d).collect()}
    qs = {r["query_id"]: r["text"] for r in tables.query_batch(spark, d).collect()}
    return docs, qs


def test_stem_dictionary(spark, sf_small):
    got = {r["term"]: r["stem"] for r in Q.q_stem_dictionary(spark, sf_small).collect()}
    docs, _ = _inputs(spark, sf_small)
    terms = {t for text in docs.values() for t in B.tokens(text)}
    assert set(got) == terms
    assert all(got[t] == B.porter2.stem(t) for t in terms)


def test_conjunctive_search_stemmed(spark, sf_small):
    got = {(r["query_id"], r["doc_id"]) for r in Q.q_conjunctive_search_stemmed(spark, sf_small).collect()}
    docs, qs = _inputs(spark, sf_small)
    assert got == B.conjunctive(docs, qs, stem=True)
    assert got  # benchmark passages occur in documents


def test_ranked_search_stemmed(spark, sf_small):
    rows = Q.q_ranked_search_stemmed(spark, sf_small).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    docs, qs = _inputs(spark, sf_small)
    want = {q: v for q, v in B.ranked(docs, qs, k=5, stem=True).items() if v}
    assert got.keys() == want.keys()
    for q in want:
        assert [d for d, _ in got[q]] == [d for d, _ in want[q]], q
        for (_, a), (_, b) in zip(got[q], want[q]):
            assert abs(a - b) < 1e-6


def test_normalized_text_stemmed(spark, sf_small):
    got = {r["doc_id"]: r["normalized"] for r in Q.q_normalized_text_stemmed(spark, sf_small).collect()}
    docs, _ = _inputs(spark, sf_small)
    assert got == {d: " ".join(B.stemmed(t)) for d, t in docs.items()}


def test_corpus_stems_from_raw_documents(spark, sf_small):
    from lookout.operators.stemming import corpus_stems
    docs = tables.documents(spark, sf_small)
    got = {r["term"]: r["stem"] for r in corpus_stems(docs).collect()}
    texts, _ = _inputs(spark, sf_small)
    terms = {t for text in texts.values() for t in B.tokens(text)}
    assert got == {t: B.porter2.stem(t) for t in terms}
