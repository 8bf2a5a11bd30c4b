"""Section 2.2 extraction job on hand-made pages (no oracle for these
blocks in the synthetic pages)."""

from lookout.operators.extract import extract_places, parse_page

FULL = """<html><head><script>var t="</p>";</script></head><body>
<h1 class="data-sheet__title">  Osteria &amp; Co  </h1>
<div class="data-sheet__block--text">Via Roma 1, Forlì-Cesena, 00186, Italia</div>
<div class="data-sheet__block--text">€€ · Italian Contemporary</div>
<div class="data-sheet__description"><p>Seasonal <b>modern cuisine<p>by the sea.</div>
<div class="col col-12 col-lg-6"><ul><li> Terrace </li><li>Car park, covered</li><li>Chef's table</li></ul></div>
<div class="col col-12 col-lg-6"><div><img data-src="https://x/img/jcb-logo.svg"><img data-src="/a/b/cartasi-card.png"></div></div>
<a data-event="CTA_tel" href="tel:+39 06 123">call</a>
<a data-event="CTA_website" href="https://osteria.example">site</a>
</body></html>"""

BARE = "<html><body><h1>Bare</h1><div class='data-sheet__block--text'>Only street</div></body></html>"


def test_parse_full_page():
    r = parse_page(FULL)
    assert r["name"] == "Osteria & Co"
    assert r["location"] == "Via Roma 1, Forlì-Cesena, 00186, Italia"
    assert r["attributes"] == "€€ · Italian Contemporary"
    assert r["description"] == "Seasonal modern cuisineby the sea."
    assert r["facilities"] == ["Terrace", "Car park, covered", "Chef's table"]
    assert r["card_srcs"] == ["https://x/img/jcb-logo.svg", "/a/b/cartasi-card.png"]
    assert r["phone"] == "+39 06 123" and r["website"] == "https://osteria.example"


def test_extract_places_job(spark):
    pages = spark.createDataFrame([(1, FULL), (2, BARE), (3, None)], "page_id bigint, html string")
    rows = {r["page_id"]: r for r in extract_places(pages).collect()}
    a = rows[1]
    assert (a.address, a.city, a.postal_code, a.country) == ("Via Roma 1", "Forlì-Cesena", "00186", "Italia")
    assert a.priceRange == "€€" and a.cuisineType == "Italian Contemporary"
    assert a.creditCards == ["Jcb", "Cartasi"]
    assert a.facilitiesServices == ["Terrace", "Car park, covered", "Chef's table"]
    b = rows[2]
    # a page without service blocks gets empty lists, not the previous page's
    assert b.facilitiesServices == [] and b.creditCards == []
    assert b.address == "Only street" and b.city is None
    assert b.priceRange == "" and b.description == "" and b.website == ""
    assert rows[3].restaurantName == ""


def test_strict_keeps_blanks(spark):
    pages = spark.createDataFrame([(1, FULL)], "page_id bigint, html string")
    r = extract_places(pages, strict=True).first()
    assert r.city == " Forlì-Cesena" and r.country == " Italia"
