from html import unescape

from pyspark.sql import functions as F

from lookout.functions import html as H

PAGE = ('<html><head><title>t</title></head><body><nav><ul><li><a href="/a">A</a></li>'
        '<li><a class="x" href="/b?page=2">B</a></li><li><a href="/next">»</a></li></ul></nav>'
        '<h1 class="data-sheet__title"> Caf&eacute; <b>Roma</b> &amp; Bar </h1><h1>second</h1>'
        '<p><a href="https://other.example/x">ext</a></p></body></html>')


def test_title_links_and_nav(spark):
    df = spark.createDataFrame([("https://guide.example.com/en/rest/12", PAGE)], "url string, html string")
    r = df.select(H.first_h1_text(F.col("html")).alias("title"), H.hrefs(F.col("html")).alias("links"),
                  H.nav_hrefs(F.col("html")).alias("nav"), H.host_of(F.col("url")).alias("host")).first()
    # tags inside the first h1 are dropped, references decoded, text stripped
    assert r.title == "Café Roma & Bar"
    assert r.links == ["/a", "/b?page=2", "/next", "https://other.example/x"]
    assert r.nav == ["/a", "/b?page=2", "/next"]
    assert r.host == "https://guide.example.com"
    links = df.select(F.transform(H.hrefs(F.col("html")), lambda h: H.absolute(h, H.host_of(F.col("url"))))).first()[0]
    assert links[0] == "https://guide.example.com/a" and links[3] == "https://other.example/x"


def test_every_character_reference_is_decoded_once(spark):
    texts = ["plain", "", "a & b", "&amp;lt; &lt;", "&eacute;&Eacute;&euro;", "&#8364;&#x20AC;&#X1f600;", "&#128;&#x96;",
             "&#0;&#xD800;&#1114112;", "&unknown; &#; &;", "&&#35;38;", "&NotEqualTilde;&hellip;", "A &amp B &eacute c", "&notit; &copy2 &ampx;",
             "&#65&#x42 &#1;&#x7f;&#xfdd0;&#x1fffe;", "&#99999999999999999999999;", "&lt&gt", "&" * 50, "&" + "a" * 100 + ";", "&am&#112;;", "&#xFEFF;x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.o for r in df.select("i", H.decode_entities(F.col("t")).alias("o")).collect()}
    assert got == {i: unescape(t) for i, t in enumerate(texts)}
    assert df.limit(1).select(H.decode_entities(F.lit(None).cast("string"))).first()[0] is None


PIECES = ["<h1>", "</h1>", "<H1 class='a'>", '<h1 title=">">', "</h1 >", "<h10>", "<div>", "</div>", "<p>", "</p>", "<li>", "<b>", "</b>", "<br>", "<img src=x/>",
          "<!-- <h1> > -->", "<script>var t='<h1>';</script>", "<style>h1{}</style>", "text", " &amp; ", "&eacute", " < ", "\n", "<h1/>", "<a href='/x'>", "</a>",
          "<!DOCTYPE html>", "<option>", "<ul class='l'>", "</ul>"]


def test_titles_equal_those_of_the_parser(spark):
    import random

    from lookout.operators.extract import parse_page
    rng = random.Random(3)
    pages = ["".join(rng.choices(PIECES, k=rng.randint(1, 25))) for _ in range(1500)]
    rows = spark.createDataFrame([(p,) for p in pages], "html string").repartition(8) \
        .select("html", H.first_h1_text(F.col("html")).alias("t")).collect()
    bad = [(r.html, r.t, parse_page(r.html)["name"]) for r in rows if r.t != parse_page(r.html)["name"]]
    assert not bad, bad[:3]


class Tree:
    """First anchors and list links by the parser's tree."""

    def __init__(self, html):
        from lookout.operators.extract import _TreeBuilder
        b = _TreeBuilder()
        b.feed(html)
        b.close()
        self.root = b.root

    @staticmethod
    def links(node):
        return [a.attrs["href"] for a in node.find_all("a") if "href" in a.attrs]

    def of(self, tag, name):
        return self.root.find_all(tag, lambda n: name in n.attrs.get("class", "").split())


CARD_PIECES = ["<div class='card x'>", '<DIV CLASS="y card">', "<div class=cards>", "<div>", "</div>", "</div>", "<a href='/1'>", '<A HREF="/2?a=1&amp;b=2">',
               "<a name='n'>", "</a>", "<a href=/3>", "<a href='//cdn/4' href='/5'>", "<a title='href=\"/no\"' href = '/6'>", "<p>", "<li>", "<b>", "t", "<br>",
               "<!-- <a href='/7'> -->", "<script>'<a href=\"/8\">'</script>", "<ul class='card'>", "</ul>", "<ul class='pagination'>", "<a href>", "<a href=''>"]


def test_card_and_list_links_equal_those_of_the_parser(spark):
    import random
    rng = random.Random(4)
    pages = ["".join(rng.choices(CARD_PIECES, k=rng.randint(1, 30))) for _ in range(1500)]
    rows = spark.createDataFrame([(p,) for p in pages], "html string").repartition(8).select(
        "html", H.card_hrefs(F.col("html"), "card").alias("cards"), H.list_hrefs(F.col("html"), "pagination").alias("all"),
        H.list_hrefs(F.col("html"), "pagination", drop_last=True).alias("first"), H.hrefs(F.col("html")).alias("every")).collect()
    for r in rows:
        tree = Tree(r.html)
        assert r.cards == [next(iter(tree.links(c)), None) for c in tree.of("div", "card")], r.html
        pages_ = tree.of("ul", "pagination")
        links = tree.links(pages_[0]) if pages_ else []
        assert (r.all, r.first, r.every) == (links, links[:-1], tree.links(tree.root)), r.html


def test_absolute_links(spark):
    links = ["/a", "//cdn.x/e", "http://o/x", "rel", "", None, "?q"]
    df = spark.createDataFrame([(x,) for x in links], "h string").select(H.absolute(F.col("h"), F.lit("https://s.y")))
    assert [r[0] for r in df.collect()] == ["https://s.y/a", "https://cdn.x/e", "http://o/x", "rel", "", None, "?q"]


def test_no_h1_gives_empty_title(spark):
    df = spark.createDataFrame([("<p>x</p>",), (None,)], "html string")
    assert [r[0] for r in df.select(H.first_h1_text(F.col("html"))).collect()] == ["", ""]
