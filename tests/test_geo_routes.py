from pyspark.sql import functions as F

from lookout.operators import geo as G
from lookout.operators.routes import monotone_route, route_steps

GEO = [
    ("00100", {"town": "Frascati", "state": "Lazio"}, 41.8, 12.7),      # town only, state only
    ("00200", {"city": "", "village": "Borgo", "region": "Umbria"}, 42.0, 12.5),  # empty city
    ("00300", {"municipality": "Comune"}, None, 12.0),                 # no coordinates
]
PLACES = [(1, "A", "via 1", "Roma", "00100", "€"), (2, "B", "via 2", "Terni", "00200", "€€€€"),
          (3, "C", "via 3", "Nowhere", "00300", "€€"), (4, "D", "via 4", "Parsed", "99999", "€€"),
          (5, "E", "via 5", "Null", None, "x")]


def _frames(spark):
    geo = spark.createDataFrame(GEO, "postal_code string, address map<string,string>, "
                                     "latitude double, longitude double")
    places = spark.createDataFrame(PLACES, "doc_id bigint, name string, address string, city string, "
                                           "postal_code string, price_range string")
    return geo, places


def test_enrich_and_fallbacks(spark):
    geo, places = _frames(spark)
    rows = {r.doc_id: r for r in G.enrich(places, geo).collect()}
    assert (rows[1].city, rows[1].region) == ("Frascati", "Lazio")
    assert (rows[2].city, rows[2].region) == ("Borgo", "Umbria")
    assert (rows[3].city, rows[3].region) == ("Comune", None)
    assert rows[4].city == "Parsed" and rows[4].latitude is None   # key missing: parsed city kept
    strict = {r.doc_id: r for r in G.enrich(places, geo, keep_parsed_city=False).collect()}
    assert strict[4].city is None


def test_enrich_takes_one_geocoder_row_per_key(spark):
    geo, places = _frames(spark)
    more = spark.createDataFrame([("00100", {"town": "Albano"}, 41.7, 12.6), ("00300", {"city": "X"}, 45.0, 9.0),
                                  ("00200", {"city": "Aaa"}, None, None)], geo.schema)
    rows = {r.doc_id: r for r in G.enrich(places, geo.union(more)).collect()}
    assert len(rows) == 5 and G.enrich(places, geo.union(more)).count() == 5
    assert rows[1].city == "Albano" and rows[2].city == "Borgo" and rows[3].latitude == 45.0


def test_missing_keys_known_markers_and_avg(spark):
    geo, places = _frames(spark)
    known = G.known_coordinates(geo)
    assert sorted(r[0] for r in G.missing_keys(places, known).collect()) == ["00300", "99999"]
    e = G.enrich(places, geo)
    assert sorted(r.doc_id for r in G.known_coordinates(e).collect()) == [1, 2]
    m = {r.doc_id: r.popup for r in G.marker_rows(G.known_coordinates(e)).collect()}
    assert m[1] == "A<br>via 1<br>Frascati<br>Lazio"
    avg = {r.region: r.price_numeric for r in G.avg_price_by_region(e).collect()}
    assert avg == {"Lazio": 1.0, "Umbria": 4.0}


def _brute_route(points):
    cx = cy = 0
    path = []
    for x, y in sorted(points):
        if x < cx or y < cy:
            return "NO", None
        path.append("R" * (x - cx) + "U" * (y - cy))
        cx, cy = x, y
    return "YES", "".join(path)


def test_monotone_route_cases(spark):
    cases = {1: [(1, 3), (1, 2), (3, 3)], 2: [(1, 2), (2, 1)], 3: [(5, 0)], 4: [(0, 1), (0, 4), (0, 2)],
             5: [(2, 2), (4, 1)]}
    rows = [(c, x, y) for c, pts in cases.items() for x, y in pts]
    df = spark.createDataFrame(rows, "case_id bigint, x int, y int")
    got = {r.case_id: (r.answer, r.path) for r in monotone_route(df).collect()}
    assert got == {c: _brute_route(p) for c, p in cases.items()}
    assert got[1] == ("YES", "RUUURR") and got[2] == ("NO", None)


def test_semi_joins_return_every_copy(spark):
    docs = spark.createDataFrame([(1, "same text"), (2, "same text"), (3, "other"), (4, "same text ")],
                                 "doc_id bigint, text string")
    result = spark.createDataFrame([(1, "same text")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in G.semi_by_text(docs, result).collect()) == [1, 2]
    assert [r.doc_id for r in G.semi_by_id(docs, result).collect()] == [1]


def test_route_steps_hot_case_split_over_partitions(spark):
    import random
    rnd = random.Random(7)
    cases = {1: [(i, i // 3) for i in range(300)],                       # one huge feasible case
             2: [(i, 300 - i) for i in range(40)],                       # infeasible
             3: [(5, 5)]}
    for c in range(4, 30):
        cases[c] = [(rnd.randint(0, 9), rnd.randint(0, 9)) for _ in range(rnd.randint(1, 6))]
        cases[c] = list(dict.fromkeys(cases[c]))
    rows = [(c, x, y) for c, pts in cases.items() for x, y in pts]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "case_id bigint, x int, y int")
    steps = route_steps(df, partitions=7).orderBy("case_id", "seq").collect()
    got = {}
    for c in cases:
        mine = [s for s in steps if s.case_id == c]
        ok = all(s.ok for s in mine)
        got[c] = ("YES" if ok else "NO", "".join(s.moves for s in mine) if ok else None)
    assert got == {c: _brute_route(p) for c, p in cases.items()}
    assert got == {r.case_id: (r.answer, r.path) for r in monotone_route(df).collect()}


def test_routes_hot_case_is_folded_in_pieces(spark):
    import random

    from lookout.operators.routes import route_pieces, route_summary
    rnd = random.Random(9)
    cases = {1: [(i, i // 3) for i in range(5000)], 2: [(i, 40 - i) for i in range(40)], 3: [(5, 5)], 4: [(-1, 2)], 5: [(0, 0)],
             6: [(i, i + (i == 3000)) for i in range(4000)]}            # infeasible in one step
    cases |= {c: [(rnd.randint(0, 5), rnd.randint(0, 5)) for _ in range(rnd.randint(1, 5))] for c in range(7, 60)}
    rows = [(c, x, y, "z") for c, pts in cases.items() for x, y in pts] + [(5, None, 3, "z"), (5, 3, None, "z")]
    rows += [(3, 5, 5, "z")] * 5000                                     # a third of all rows is one point
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "case_id bigint, x int, y int, piece string")
    pieces = route_pieces(df, partitions=9).collect()
    n = {c: [p.n for p in pieces if p.case_id == c] for c in cases}
    assert len(n[1]) > 3 and max(n[1]) < 2500 and sum(n[1]) == 5000 and n[3] == [1]
    want = {c: _brute_route(p) for c, p in cases.items()}
    assert {r.case_id: (r.answer, r.path) for r in monotone_route(df, partitions=9).collect()} == want
    got = {r.case_id: (r.answer, r.n_points, r.path_length) for r in route_summary(df, partitions=9).collect()}
    assert got == {c: (a, len(set(cases[c])), None if p is None else len(p)) for c, (a, p) in want.items()}
    assert monotone_route(df.limit(0)).collect() == []
