"""Near duplicates against all pairs; the quality classifier on held-out labels."""
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lookout.llm import minhash_dedup, quality
from lookout.llm.common import uniform01
from lookout.llm.queries import QUERIES


def shingles(text, k=5):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, threshold):
    """Smallest reachable doc_id of every id, by all pairs of texts."""
    ids = sorted({d for d, _ in rows if d is not None})
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    sets = [(d, s) for d, t in rows if d is not None and (s := shingles(t))]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            shared = len(x & y)
            if 100 * shared >= threshold * (len(x) + len(y) - shared):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: find(d) for d in ids}


def near_copies(seed, groups=12):
    """Groups of copies with few and many changes, and one large group."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rng.randint(3, 200))]
        for _ in range(60 if g == 0 else rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = word()
            texts.append(" ".join(w))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("threshold", [80, 85])
def test_components(spark, threshold):
    rows = near_copies(threshold)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash_dedup.near_duplicates(docs, threshold=threshold).collect()
    want = brute(rows, threshold)
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) < len(want)
    assert all(r.kept == (r.component_id == r.doc_id) and r.n_shingles == len(shingles(dict(rows)[r.doc_id])) for r in got)


def test_op1(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = {r.doc_id: r.component_id for r in QUERIES["op1_minhash_dedup"](spark, sf_small).collect()}
    assert got == brute(rows, 85)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = minhash_dedup.near_duplicates(odd_docs).collect()
    assert len(got) == len(odd_rows)
    of = {r.doc_id: r.component_id for r in got}
    assert of[6] == of[7] == of[8] == of[9] == 6 and of[11] == of[12] == 11
    assert of[0] == 0 and of[1] == 1 and of[2] == 2
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert minhash_dedup.near_duplicates(no_docs).collect() == []


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    got = dict(minhash_dedup.components(spark.createDataFrame(edges, "x long, y long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 200, 200: 200}


def test_quality_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model, scores = quality.fit(docs, labels)
    held = scores.where("held").collect()
    good = np.array([r.log_weight for r in held if r.good])
    bad = np.array([r.log_weight for r in held if not r.good])
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert scores.where(F.col("perturbed") >= model.bound).count() == scores.where(F.col("log_weight") >= model.cut).count()
    kept = quality.keep(docs, labels)
    assert kept.schema == docs.schema
    rate = kept.join(labels, "doc_id").groupBy("quality").count().join(labels.groupBy("quality").agg(
        F.count("*").alias("all")), "quality").collect()
    rate = {r.quality: r["count"] / r["all"] for r in rate}
    assert rate[1] > 0.98 and rate.get(0, 0) < 0.15


def test_quality_equals_a_plain_evaluation(spark, sf_small):
    """Counts of both models, ratios, weights, noise, k and the rows kept, by plain Python over all rows."""
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    buckets = 1 << 12
    model, scores = quality.fit(docs, labels, buckets=buckets)
    got = {r.doc_id: r for r in scores.collect()}
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    mask, hashes = (1 << 64) - 1, {}

    def word(w):
        if w not in hashes:
            hashes[w] = int(pd.util.hash_array(np.array([w], dtype=object), categorize=False)[0])
        return hashes[w]

    def grams(text):
        h = [word(w) for w in text.lower().split()]
        pairs = [(a * 0x9E3779B97F4A7C15 + b) & mask for a, b in zip(h, h[1:])]
        return [(x >> 20) % buckets for x in h + pairs]

    good = {}
    for r in labels.collect():
        if r.quality is not None:
            good[r.doc_id] = good.get(r.doc_id, True) and r.quality == 1
    assert {d: r.good for d, r in got.items() if r.good is not None} == {d: g for d, g in good.items() if d in texts}
    every = {d: grams(t) for d, t in texts.items()}
    raw = Counter(b for g in every.values() for b in g)
    target = Counter(b for d, g in every.items() if got[d].good and not got[d].held for b in g)
    share = sum(target.values()) / sum(raw.values())
    ratio = [math.log((target[b] + quality.PRIOR) / (raw[b] * share + quality.PRIOR)) for b in range(buckets)]
    assert np.allclose(model.ratio, ratio)
    u = {r.doc_id: r.u for r in docs.select("doc_id", uniform01(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")),
                                                               F.lit(7)).alias("u")).collect()}
    for d, g in every.items():
        weight = quality.LENGTH * sum(ratio[b] for b in g) / len(g) if g else 0.0
        assert math.isclose(got[d].log_weight, weight, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(got[d].perturbed, weight - math.log(-math.log(u[d])), rel_tol=1e-9, abs_tol=1e-9)
    k = sum(r.log_weight >= model.cut for r in got.values())
    best = sorted(got, key=lambda d: -got[d].perturbed)[:k]
    assert {r.doc_id for r in quality.score(docs, labels, buckets=buckets).where("kept").collect()} == set(best)
    assert {r.doc_id for r in quality.keep(docs, labels, buckets=buckets).collect()} == set(best)


def test_quality_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(6, 1), (7, 1), (10, 0), (None, 1), (5, None), (6, 1)], "doc_id long, quality int")
    none = labels.limit(0)
    for lab in (labels, none):
        out = quality.keep(odd_docs, lab)
        assert out.schema == odd_docs.schema
        assert len(quality.score(odd_docs, lab).collect()) == len(odd_rows)
    assert quality.keep(odd_docs, none).count() == len(odd_rows)
    assert quality.keep(no_docs, labels).collect() == [] and quality.score(no_docs, labels).collect() == []


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3000), np.full(500, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    for k in (1, 17, 1500, 1700, 3499):
        assert quality.kth_largest(df, "v", k) == np.sort(x)[::-1][k - 1]


def test_pipeline(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_small)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > 0
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    packed = corpus_pipeline.run(spark, sf_small)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {d for d, _ in rows}


def test_pipeline_stages_on_odd_rows(spark, sf_small, odd_docs, odd_rows, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd_docs, sf_small)
        assert out.count() > 0 and (name == "packing" or out.columns == odd_docs.columns)
        assert stage(spark, no_docs, sf_small).collect() == []
    left = [r.doc_id for r in corpus_pipeline.dedup_stage(spark, odd_docs, sf_small).collect()]
    assert left.count(None) == 2 and sorted(d for d in left if d is not None) == [0, 1, 2, 3, 4, 5, 6, 10, 11, 13, 14, 15, 16]
