import pytest
from pyspark.sql import functions as F

from lookout.functions import text as T
from lookout.functions.stopwords import COMBINED_STOP_WORDS, ENGLISH_STOP_WORDS, ITALIAN_STOP_WORDS

import bruteforce as B

CASES = [
    ("This is an example text with stopwords and punctuation, like 0hello!",
     ["example", "text", "stopwords", "punctuation", "like"]),
    ("fine-dining st.john l'aquila 1,5 wine", ["wine"]),
    ("l’aquila and the chef's table", ["aquila", "chef", "table"]),
    ("Modern, seasonal cuisine... (since 2019)", ["modern", "seasonal", "cuisine", "since", "2019"]),
    ("007 bond 0zero x0y 00é café", ["bond", "x0y", "café"]),
    ("\"Quoted\" 'single' end. Dots... -- dash", ["quoted", "single", "end", "dots", "dash"]),
    ("wouldn't don't can't it's", ["would"]),
    ("tab\tsep nbsp　wide", ["tab", "sep", "nbsp", "wide"]),
    ("", []),
    (None, []),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_normalized_tokens(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(T.normalized_tokens(F.col("t")).alias("x")).first()["x"]
    assert got == expected
    assert B.tokens(text) == expected


def test_brute_force_tokeniser_agrees_on_corpus(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["x"] for r in
           docs.select("doc_id", T.normalized_tokens(F.col("text")).alias("x")).collect()}
    for r in docs.collect():
        assert got[r["doc_id"]] == B.tokens(r["text"]), r["doc_id"]


def test_clean_field_and_basic(spark):
    df = spark.createDataFrame([("  La Trattoria del Porto, d'Amalfi! ", " Forlì-Cesena ")],
                               "name string, city string")
    r = df.select(T.clean_field(F.col("name")).alias("n"), T.clean_basic(F.col("city")).alias("c")).first()
    assert r["n"] == "trattoria porto d'amalfi"
    assert r["c"] == "forlì-cesena"


def test_url_sort_key(spark):
    df = spark.createDataFrame([("https://x/en/restaurants/page/12",), ("https://x/en/restaurants",),
                                ("https://x/a/",), ("https://x/" + "9" * 30,), ("https://x/0007",),
                                ("https://x/000",)], "u string")
    keys = [tuple(r[0]) for r in df.select(T.url_sort_key(F.col("u"))).collect()]
    assert keys == [(2, "12"), (1, "1"), (1, "1"), (30, "9" * 30), (1, "7"), (0, "")]
    assert sorted(keys) == sorted(keys, key=lambda k: int(k[1] or 0))


def test_stop_word_lists():
    assert len(ENGLISH_STOP_WORDS) == 179 and len(set(ENGLISH_STOP_WORDS)) == 179
    assert len(ITALIAN_STOP_WORDS) == 34
    assert set(COMBINED_STOP_WORDS) == set(ENGLISH_STOP_WORDS) | set(ITALIAN_STOP_WORDS)
