"""Batched facet search against a plain evaluation of the same rules."""

import random

import pytest

from lookout.operators import facets as FA
from lookout.operators import search as S

PLACE = ("doc_id long, name string, city string, cuisine string, price_range string, region string, cards array<string>, "
         "facilities array<string>, address string")
REQUEST = ("request_id long, name string, city string, cuisine string, price_low string, price_high string, regions array<string>, "
           "cards array<string>, facilities array<string>, extra int")
BANDS = S.PRICE_BANDS


@pytest.fixture(scope="module")
def places():
    rng = random.Random(2)
    some = lambda xs: rng.choice([None, [], rng.sample(xs, rng.randint(1, len(xs)))])             # noqa: E731
    rows = [(i, f"{rng.choice(['blue', 'red', 'la'])} {rng.choice(['bolt', 'Bolt!', 'ring'])}", rng.choice(["Roma", "La Spezia", "Forlì-Cesena", None]),
             rng.choice(["thai", "Fusion Thai", "", None]), rng.choice([*BANDS, "", None, "€€€€€"]), rng.choice(["Lazio", "Liguria", None]),
             some(["Jcb", "Visa"]), some(["Terrace", "Car park, covered"]), "x") for i in range(600)]
    return rows + [(10 ** 12, "blue bolt", "Roma", "thai", "€", "Lazio", ["JCB"], ["terrace", "Terrace"], None)]


REQUESTS = [
    (1, "Blue bolt", "", None, None, None, None, None, None, 0), (2, "blue blue ring", "roma", "thai", "€", "€€€", ["Lazio"], ["jcb"], ["TERRACE"], 0),
    (3, None, "forlì-cesena", "", "€€", "€€", [], [], ["car park, covered", "Terrace"], 0), (4, "the", None, None, None, None, None, None, None, 0),
    (5, "blue", None, None, "€€€", "€", None, None, None, 0), (6, "blue", None, None, "cheap", None, None, None, None, 0),
    (7, "unknownword", None, None, None, None, ["Lazio"], None, None, 0), (8, "bolt", None, "fusion", None, "€€", ["Lazio", "Liguria", "Lazio"], ["visa", "Visa"], None, 0),
    (9, "blue", None, None, None, None, ["Atlantis"], None, None, 0), (10, None, "la spezia", None, None, None, None, ["jcb", "visa", "amex"], None, 0)]

STOP = {"the", "la"}


def words(text, field):
    text = (text or "").lower().strip()
    if field != "city":
        kept = "".join(c for c in text if c.isalnum() or c in " _'")
        return [w for w in kept.split() if w not in STOP]
    return text.split()


def passes(p, r):
    band = lambda b: BANDS.index(b) + 1 if b in BANDS else None                                   # noqa: E731
    low, high = (band(r[4]) if r[4] is not None else 1), (band(r[5]) if r[5] is not None else 4)
    if low is None or high is None or band(p[4]) is None or not low <= band(p[4]) <= high:
        return False
    have = lambda xs: {x.lower() for x in xs or []}                                               # noqa: E731
    return (not r[6] or p[5] in r[6]) and have(r[7]) <= have(p[6]) and have(r[8]) <= have(p[7])


def scores(p, r):
    return sum(1 for i, f in ((1, "name"), (2, "city"), (3, "cuisine")) for w in words(r[i], f) if w in set(words(p[i], f)))


@pytest.fixture(scope="module")
def index(spark, places):
    return FA.FacetIndex.write(spark.createDataFrame(places, PLACE).repartition(4), shards=6)


def test_batch_equals_plain_rules(spark, index, places):
    requests = spark.createDataFrame(REQUESTS, REQUEST)
    got = {(x.request_id, x.rank): (x.doc_id, x.score) for x in index.search(requests, 7).collect()}
    want = {}
    for r in REQUESTS:
        hits = sorted((-scores(p, r), p[0]) for p in places if scores(p, r) and passes(p, r))
        want |= {(r[0], i + 1): (d, -s) for i, (s, d) in enumerate(hits[:7])}
    assert got == want and {q for q, _ in want} == {1, 2, 3, 8}
    all_ = {(x.request_id, x.doc_id): x.score for x in index.match_scores(requests).collect()}
    assert all_ == {(r[0], p[0]): scores(p, r) for r in REQUESTS for p in places if scores(p, r)}


def test_field_index_and_reopening(spark, index, places):
    again = FA.FacetIndex(spark, index.path)
    got = [(x.field, x.term, x.doc_id) for x in again.field_index().collect()]
    want = {(f, w, p[0]) for p in places for i, f in ((1, "name"), (2, "city"), (3, "cuisine")) for w in words(p[i], f)}
    assert len(got) == len(want) and set(got) == want
    assert again.search(spark.createDataFrame([], REQUEST)).collect() == []
    shown = again.search(spark.createDataFrame(REQUESTS[:1], REQUEST), 1).first()
    assert (shown.name.lower()[:9], shown.website) == ("blue bolt", None)


def test_one_request_equals_the_single_search(spark, index, places):
    df = spark.createDataFrame(places, PLACE)
    one = S.SearchRequest(name="blue bolt", city="roma", price_range=("€", "€€€"), regions=["Lazio"], cards=["jcb"])
    single = [(x.doc_id, x.score) for x in S.advanced_search(df, S.place_field_index(df), one, 5).collect()]
    rows = [(1, "blue bolt", "roma", "", "€", "€€€", ["Lazio"], ["jcb"], [], 0)]
    batch = index.search(spark.createDataFrame(rows, REQUEST), 5).orderBy("rank").collect()
    assert [(x.doc_id, x.score) for x in batch] == single and len(single) == 5


def test_filters_come_before_words_and_scans_are_pruned(spark, index):
    plan = index.search(spark.createDataFrame(REQUESTS, REQUEST))._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_no_places(spark):
    empty = FA.FacetIndex.write(spark.createDataFrame([], PLACE))
    assert empty.search(spark.createDataFrame(REQUESTS, REQUEST)).collect() == []
