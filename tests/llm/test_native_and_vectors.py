"""I-Match and URL rules against plain Python; vector search against all pairs."""
import hashlib
import random
import struct

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from lookout.llm import imatch, urls, vptree
from lookout.llm.queries import QUERIES, URL_RULES


def check_edited(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        want.append((str(r[0]), len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got) == sorted(want)


def test_fingerprints_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = imatch.fingerprints(odd_docs).collect()
    check_edited(odd_rows, got)
    of = {r.doc_id: r for r in got}
    assert of[6].fingerprint == of[7].fingerprint and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert imatch.fingerprints(no_docs).collect() == []
    one = imatch.fingerprints(odd_docs.where("doc_id = 6").limit(1)).first()
    assert one.near_next == 1.0


def test_op3(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = QUERIES["op3_imatch"](spark, sf_small).collect()
    check_edited(rows, got)
    texts, prints = dict(rows), {r.doc_id: r.fingerprint for r in got}
    by = {}
    for d, t in texts.items():
        assert by.setdefault(t, prints[d]) == prints[d]
    assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got])


def test_fingerprint_by_hand(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    lex = {r.t: r.subsets for r in imatch.lexicon(docs).collect()}
    terms = {r.doc_id: r.t for r in docs.select("doc_id", imatch.term_ids(F.col("text")).alias("t")).collect()}
    n = len(terms)
    df = {}
    for ts in terms.values():
        for t in ts:
            df[t] = df.get(t, 0) + 1
    assert set(lex) == {t for t, c in df.items() if max(2, imatch.LEAST * n) <= c <= max(2, imatch.MOST * n)}
    for r in imatch.fingerprints(docs).select("doc_id", "fingerprint").collect():
        mine = [sorted(t for t in terms[r.doc_id] if t in lex and k in lex[t]) for k in range(len(imatch.SUBSETS))]
        want = ".".join(hashlib.sha1(" ".join(map(str, m)).encode()).hexdigest()[:10] if m else "-" for m in mine)
        assert r.fingerprint == want


def test_copies_rare_words_and_texts_without_terms(spark):
    rng = np.random.default_rng(8)
    common = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(common, 60)) for _ in range(3000)]
    copy = " ".join(f"copied{i}" for i in range(60))
    source = [f"rare{i}" for i in range(40)]
    texts += [" ".join(rng.permutation(source)) for _ in range(5)]      # a source of 0.1% of the rows
    texts[1::3] = [copy] * len(texts[1::3])                             # a third of the rows
    texts += ["unrelated", "words", "alone", "alone", "", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in imatch.fingerprints(docs, whole=True).collect()}
    own = [got[i].fingerprint for i, t in enumerate(texts) if t == copy]
    assert len(set(own)) == 1 and set(own[0]) != set("-.")
    # words of the copies are in one text only; the copies take all their words for terms
    assert np.mean([got[i].near_edited for i, t in enumerate(texts) if t == copy]) > 0.1
    assert len({got[i].fingerprint for i, t in enumerate(texts) if t.startswith("rare")}) == 1
    lex = {r.t for r in imatch.lexicon(docs, whole=True).collect()}
    ids = spark.createDataFrame([(" ".join(source),)], "text string").select(imatch.term_ids(F.col("text")).alias("t"))
    assert set(ids.first().t) <= lex
    n = len(texts)
    assert len({got[i].fingerprint for i in range(n - 6, n)}) == 4
    assert [got[i].near_next for i in range(n - 6, n - 1)] == [0.0, 0.0, 1.0, 0.0, 1.0]


def test_document_frequency_counts_distinct_texts(spark):
    texts = ["shared one", "shared two", "shared one"] + ["copied words"] * 50 + ["copied other"] + [f"x{i} y{i}" for i in range(60)]
    lex = {r.t for r in imatch.lexicon(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                                          whole=True).collect()}
    ids = spark.createDataFrame([("shared copied one words",)], "text string").select(imatch.term_ids(F.col("text")).alias("t"))
    shared, copied, one, words = ids.first().t
    assert lex == {shared, copied}


def test_blocks_with_sparse_ids(spark, monkeypatch):
    monkeypatch.setattr(imatch, "BLOCK_ROWS", 3)
    ids = [1, 2, 3, 900, 901, 5000, 5001, 5002, 5003, 99_999, -(2 ** 63), 2 ** 63 - 1, 2 ** 62]
    rows = [(i, f"text of {i} " * (i % 7 + 1)) for i in ids]
    check_edited(rows[-3:], imatch.fingerprints(spark.createDataFrame(rows[-3:], "doc_id long, text string")).collect())
    check_edited(rows, imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def signed(data, seed=42):
    x = xxhash.xxh64_intdigest(data, seed)
    return x - (1 << 64) if x >> 63 else x


def plain_fingerprints(texts):
    """Every whole text's (n_chars, fingerprint, edited fingerprint, near_edited, near_next), by plain Python."""
    def terms(text):
        return {signed(w.encode()) for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w}

    def within(t, k):
        return signed(struct.pack("<i", k + 1), signed(struct.pack("<q", t)) % (1 << 64)) % imatch.SUBSETS[k] == 0

    def listed(sets):
        return [hashlib.sha1(" ".join(map(str, sorted(s))).encode()).hexdigest()[:10] if s else "-" for s in sets]

    def alike(a, b):
        held = [x == y for x, y in zip(a, b) if (x, y) != ("-", "-")]
        return sum(held) / len(held) if held else 1.0

    distinct, df, all_k = set(texts), {}, range(len(imatch.SUBSETS))
    for t in (t for text in distinct for t in terms(text)):
        df[t] = df.get(t, 0) + 1
    lex = {t for t, c in df.items() if 2 <= c <= max(2, imatch.MOST * len(distinct))}

    def prints(text):
        mine = terms(text)
        narrow = listed([{t for t in mine & lex if within(t, k)} for k in all_k])
        return narrow, listed([mine] + [{t for t in mine if within(t, k)} for k in all_k[1:]])

    def near(a, b):
        return alike(a[1], b[1]) if "-" * len(all_k) in ("".join(a[0]), "".join(b[0])) else alike(a[0], b[0])

    def shown(a):
        return ".".join(a[1] if set(a[0]) == {"-"} else a[0])

    own, out = [prints(t) for t in texts], []
    for i, text in enumerate(texts):
        j = (i + 1) % len(texts)
        edited = prints(text[:len(text) - len(text) // 2] + texts[j][:len(text) // 2])
        out.append((len(text), shown(own[i]), shown(edited), near(own[i], edited), near(own[i], own[j])))
    return out


@pytest.mark.parametrize("by_shuffle", [False, True])
def test_whole_fingerprints_equal_plain_ones(spark, sf_small, monkeypatch, by_shuffle):
    """Also with the lexicon over its bound, where every term of a text is joined to it by shuffle."""
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())[:60]
    more = ["", "   ", "alone here", "alone here", rows[3][1], rows[3][1] + " and more", "x", "Straight-forward it's 12"]
    rows += [(10_000 + i, t) for i, t in enumerate(more)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        if by_shuffle:
            monkeypatch.setattr(imatch, "LEXICON_BOUND", 0)
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = imatch.fingerprints(docs, whole=True)
        assert ("SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()) == by_shuffle
        got = [tuple(r)[1:2] + tuple(r)[3:] for r in found.orderBy("doc_id").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = plain_fingerprints([t for _, t in rows])
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3:] for g in got], [w[3:] for w in want])


def test_no_postings_are_shuffled_beyond_the_bound(spark, monkeypatch):
    """Copies in several blocks, words that one text has, words that only cutting a text makes."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))
    texts = [" ".join(word() for _ in range(rng.randint(0, 9))) for _ in range(40)] + ["only once here"] * 4 + ["bbbcab a", "x"]
    texts = texts + texts[::3]
    monkeypatch.setattr(imatch, "LEXICON_BOUND", 0)
    monkeypatch.setattr(imatch, "BLOCK_ROWS", 7)
    monkeypatch.setattr(imatch, "COPIES_BOUND", 3, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = imatch.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), whole=True)
        got = [tuple(r)[1:2] + tuple(r)[3:] for r in found.orderBy("doc_id").collect()]
        lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_term = [" ".join(lines[i:i + 3]) for i, x in enumerate(lines) if "Exchange hashpartitioning(t#" in x]
    assert by_term and not any("meta" in x for x in by_term)
    want = plain_fingerprints(texts)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3:] for g in got], [w[3:] for w in want])


def judged(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda f: len(f[0])) if fits else (None, None))


URLS = [None, "", "nothing", "http://", "http://NET/", "http://a.net", "http://a.net/x", "http://xnet/", "ftp://Example.NET/en/1?x=1#y",
        "http://example.net/en", "http://www.example.com/de/", "http://example.com/fr/", "http://a.org/fr/", "https://a.org?/fr/",
        "http://a.b/c://net/", "http://" + chr(0xC9) + ".Org/fr/\n2", "http://x.org/fr/" + "y/" * 20_000]


def test_urls(spark):
    rows = [(i, u, "h", "p", "t") for i, u in enumerate(URLS * 3)] + [(None, URLS[6], None, None, None), (0, URLS[7], None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, tokens string")
    got = urls.judge(pages, URL_RULES).collect()
    assert len(got) == len(rows)
    want = sorted((str(r[0]), *map(str, judged(r[1])[:3])) for r in rows)
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in got) == want
    given = {str(judged(u)[2]): judged(u)[3] for u in URLS}
    assert all(r.verdict == given[r.rule] for r in got if r.rule) and {r.verdict for r in got} == {"allow", "block"}
    assert urls.judge(pages.limit(0), URL_RULES).collect() == []


def test_op10(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op10_urls"](spark, sf_small).collect()}
    assert len(got) == len(rows)
    for r in rows:
        host, path, rule, verdict = judged(r.url)
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == (host, path, rule) and (rule is None or g.verdict == verdict)


def test_mined_rules(spark):
    label = ["block"] * 20 + ["allow"] * 20 + ["none"] * 20
    items = [["a", "b"]] * 18 + [["b"]] * 2 + [["c"]] * 20 + [["b", "d"]] * 20
    got = urls.mine(spark.createDataFrame(list(zip(items, label)), "tokens array<string>, label string"))
    rules = {tuple(r.tokens): (r.verdict, round(r.confidence, 3)) for r in got.collect()}
    assert rules == {("a",): ("block", 1.0), ("a", "b"): ("block", 1.0), ("c",): ("allow", 1.0)}


def rules_by_hand(rows, support, confidence, lift):
    """All rules over items that are merged where they stand in the same rows, by enumeration."""
    import itertools
    n = len(rows)
    cover = {}
    for i, (tokens, _) in enumerate(rows):
        for t in set(tokens):
            cover.setdefault(t, set()).add(i)
    items = {}
    for t, c in cover.items():
        if len(c) >= support * n:
            items.setdefault(frozenset(c), []).append(t)
    out = {}
    for size in range(1, len(items) + 1):
        for some in itertools.combinations(items, size):
            both = set.intersection(*map(set, some))
            for verdict in ("block", "allow"):
                of = {i for i, r in enumerate(rows) if r[1] == verdict}
                hits = len(both & of)
                if hits >= support * n and hits >= confidence * len(both) and hits / len(both) / (len(of) / n) >= lift:
                    out[tuple(sorted(t for c in some for t in items[c])), verdict] = round(hits / len(both), 6)
    return out


def test_mined_rules_equal_enumeration(spark):
    import random
    rng = random.Random(6)
    rows = []
    for _ in range(160):
        tokens = [t for t in "abcdef" if rng.random() < 0.45]
        tokens += [t + "2" for t in tokens if t in "ab"] + (["c2", "c3"] if "c" in tokens else [])
        label = "block" if "a" in tokens and rng.random() < 0.95 else "allow" if "d" in tokens and "e" in tokens else rng.choice(["none", "allow", "block"])
        rows.append((tokens, label))
    got = urls.mine(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.05, 0.8, 1.05)
    found = {(tuple(r.tokens), r.verdict): round(r.confidence, 6) for r in got.collect()}
    assert found == rules_by_hand(rows, 0.05, 0.8, 1.05) and any("a2" in t for t, _ in found)


def test_forty_tokens_that_stand_together(spark):
    words = "/".join("w" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(40))
    hot = f"https://deep.host.example.com/de/{words}"
    rows = [(i, hot if i % 3 == 0 else f"https://h{i % 7}.example.net/{'en' if i % 2 else 'xx'}/{'wab' if i % 5 == 0 else 'z'}/p") for i in range(2100)]
    rows += [(5000, f"https://deep.host.example.com/fr/{words}"), (5001, "https://a." + "b." * 5000 + "org/q")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()}
    assert len(got) == len(rows) and got[0].rule == "example.com/de/" and got[0].verdict == "block"
    # given rules block the hot url; its words without the rule's path are mined
    assert got[5000].rule is None and got[5000].verdict == "block" and "path:waz" in got[5000].mined_rule


def nearest_by_hand(vectors, k, queries):
    out = {}
    for q in queries:
        scored = sorted((-float((vectors[q] * v).sum()), i) for i, v in vectors.items() if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    return {i: centres[i % 8] + 0.4 * rng.normal(size=dim) for i in range(n)}


def frame(spark, vectors):
    return spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<double>")


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (vptree.FACTOR, 0.97)])
def test_nearest(spark, factor, least):
    vectors = clustered(2000, 16, 3)
    rows = vptree.clean(frame(spark, vectors))
    got = vptree.nearest(rows, F.col("vec_id") % 20 == 0, 20, factor=factor, shard=700, block=40).collect()
    want = nearest_by_hand(vectors, 20, range(0, 2000, 20))
    found = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in want}
    assert np.mean([len(set(found[q]) & set(want[q])) / 20 for q in want]) >= least
    if least == 1.0:
        assert found == want


def test_nearest_ties_and_odd_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 0.0]), (101, None), (102, [1.0, None]),
            (103, [float("nan"), 1.0]), (104, [float("inf"), 1.0]), (105, [1.0, 2.0, 3.0]), (106, []), (None, [1.0, 1.0]),
            (107, [2.0, 0.0]), (107, [2.0, 0.0]), (20, [1.0, 0.0])]
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, q int, v string")
    got = vptree.nearest(vptree.clean(vectors), F.col("vec_id") % 20 == 0, 5).collect()
    of = {q: [(r["rank"], r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 20, 40)}
    assert {r.query_id for r in got} == {0, 20, 40}
    assert of[0] == list(enumerate([107, 1, 2, 3, 4], 1)) and of[40] == list(enumerate([107, 0, 1, 2, 3], 1))
    assert vptree.nearest(vptree.clean(vectors.limit(0)), F.col("vec_id") % 20 == 0, 5).collect() == []
    few = vptree.nearest(vptree.clean(vectors.where("vec_id in (20, 21, 107)")), F.col("vec_id") % 20 == 0, 5).collect()
    assert sorted(r.vec_id for r in few) == [21, 107]


def test_recall_on_the_given_vectors(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    got = QUERIES["op6_nearest"](spark, "/root/testdata/sf0.1").collect()
    vectors = {r.vec_id: np.array(r.embedding, "float64") for r in spark.read.parquet(path).collect()}
    queries = [i for i in vectors if i % 20 == 0]
    want = nearest_by_hand(vectors, 20, queries[:100])
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(found[q] & set(want[q])) / 20 for q in want]) >= 0.97
    assert len(got) == 20 * len(queries)


def test_ties_of_different_vectors(spark):
    # 300 different vectors of one inner product with every query, and a few nearer ones
    rng = np.random.default_rng(2)
    vectors = {i: np.concatenate([[1.0], rng.integers(-3, 4, 6)]) for i in range(300)}
    vectors |= {1000 + i: np.concatenate([[1.0 + i / 8], np.zeros(6)]) for i in range(5)}
    vectors |= {2000 + 20 * i: np.concatenate([[1.0], np.zeros(6)]) for i in range(3)}
    rows = vptree.clean(frame(spark, vectors))
    got = vptree.nearest(rows, F.col("vec_id") >= 2000, 20, factor=1.0, shard=90, block=2).collect()
    want = nearest_by_hand(vectors, 20, [2000, 2020, 2040])
    found = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in want}
    assert found == want and want[2000][:4] == [1004, 1003, 1002, 1001] and want[2000][4:7] == [0, 1, 2]
