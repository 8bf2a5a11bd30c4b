from pyspark.sql import functions as F

from lookout.operators import places as PL
from lookout.sources import index_store as IS
from lookout.sources import places as SP

ROWS = [
    (1, "Da Mario", "Via del Corso, 12", "Roma", "00186", "Italia", "€€", "Italian",
     "Line one\nline \"two\"\twith tab ", ["Terrace", "Car park, covered", "Chef's table", 'a "b"'],
     ["Jcb", "Cartasi"], "", "https://m.example"),
    (2, "Senza", "Piazza 1", "La Spezia", "19121", "Italia", "", "Seafood", None, [], [], "", ""),
]


def _places(spark):
    return spark.createDataFrame(ROWS, SP.PLACE_SCHEMA)


def test_tsv_round_trip(spark):
    path = IS.scratch_path(spark, "test-tsv")
    SP.write_places_tsv(_places(spark), path)
    back = {r.doc_id: r for r in SP.read_places_tsv(spark, path).collect()}
    for row in ROWS:
        r = back[row[0]]
        assert tuple(r) == row
    assert back[1].postalCode == "00186"  # leading zero kept


def test_decode_list_forms(spark):
    texts = ["['Air conditioning', 'Terrace']", '["Chef\'s table", \'x\']', "[]", None, "nan",
             "['a\\'b']"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(PL.decode_list(F.col("t"))).collect()]
    assert got == [["Air conditioning", "Terrace"], ["Chef's table", "x"], [], [], [], ["a'b"]]


def test_encode_list_matches_python(spark):
    values = [["Terrace", "Chef's table", 'say "hi"', "back\\slash"], []]
    df = spark.createDataFrame([(v,) for v in values], "v array<string>")
    got = [r[0] for r in df.select(PL.encode_list(F.col("v"))).collect()]
    assert got == [f"{v}" for v in values]


def test_list_codec_keeps_control_characters(spark):
    values = [["a\nb", "ok"], ["tab\there", "cr\r"], ["back\\nslash", "\\x41", "it's\n"]]
    df = spark.createDataFrame([(v, f"{v}") for v in values], "v array<string>, printed string")
    rows = df.select(PL.encode_list(F.col("v")), PL.decode_list(PL.encode_list(F.col("v"))),
                     PL.decode_list(F.col("printed"))).collect()
    assert [tuple(r) for r in rows] == [(f"{v}", v, v) for v in values]
    other = spark.createDataFrame([("['x\\xa0y']",), ('["raw\nline"]',)], "t string")
    assert [r[0] for r in other.select(PL.decode_list(F.col("t"))).collect()] == [["x\xa0y"], ["raw\nline"]]


def test_csv_and_url_sinks(spark):
    vocab = spark.createDataFrame([(0, "abc"), (1, "cucina")], "term_id bigint, term string")
    p = IS.scratch_path(spark, "test-csv")
    SP.write_csv(vocab, p)
    assert sorted(SP.read_csv(spark, p, "term_id bigint, term string").collect()) == sorted(vocab.collect())
    urls = spark.createDataFrame([("https://a/1",), ("https://a/2",)], "url string")
    p2 = IS.scratch_path(spark, "test-urls")
    SP.write_url_list(urls, p2)
    assert sorted(r[0] for r in spark.read.text(p2).collect()) == ["https://a/1", "https://a/2"]


def test_page_files(spark, tmp_path):
    for n in (3, 12):
        d = tmp_path / f"page {n // 20 + 1}"
        d.mkdir(exist_ok=True)
        (d / f"restaurant_{n}.html").write_text(f"<h1>R{n}</h1>\n<p>x</p>")
    rows = sorted(SP.read_page_files(spark, str(tmp_path)).collect())
    assert [r.page_id for r in rows] == [3, 12]
    assert rows[0].html == "<h1>R3</h1>\n<p>x</p>"


def test_split_location_modes(spark):
    df = spark.createDataFrame([("Via del Corso, 12, Roma, 00186, Italia",), ("Only street",)], "loc string")
    default = [tuple(r) for r in df.select(*PL.split_location(F.col("loc"))).collect()]
    assert default == [("Via del Corso", "12", "Roma", "00186"), ("Only street", None, None, None)]
    tail = [tuple(r) for r in df.select(*PL.split_location(F.col("loc"), from_end=True)).collect()]
    assert tail[0] == ("Via del Corso, 12", "Roma", "00186", "Italia")
    strict = df.select(*PL.split_location(F.col("loc"), strict=True)).first()
    assert tuple(strict) == ("Via del Corso", " 12", " Roma", " 00186")
