"""Readers for the input tables and the derived ``catalog`` of places.

All readers are plain ``spark.read.parquet`` scans: Catalyst prunes columns
and pushes filters into them, so callers select only what they use."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus ``(doc_id, text)``; a null text counts as empty. Text work is
    CPU-bound, so a scan with fewer splits than cores is spread first."""
    return spread(table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw pages ``(page_id, url, html)``, spread like :func:`documents`."""
    return spread(table(spark, sf_dir, "pages"))


def query_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch of free-text queries ``(query_id, text)`` from ``benchmark``."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places with facets, derived from the TPC-H-like tables.

    ``doc_id, name, cuisine, price_range, facilities, cards, city, region,
    address, postal_code``.
    Every part is a place. Lists are sorted distinct flag values of its
    large-quantity line items, the supplier is the smallest of all its line
    items; a part without line items has empty lists and no supplier. The
    line-item aggregation is the only shuffle of size (partial aggregation
    first, so each task ships at most one row per part); the dimension joins
    are on tables bounded by the part count."""
    large = F.col("l_quantity") >= 45
    part = table(spark, sf_dir, "part")
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_partkey")
          .agg(F.sort_array(F.collect_set(F.when(large, F.col("l_returnflag")))).alias("facilities"),
               F.sort_array(F.collect_set(F.when(large, F.col("l_linestatus")))).alias("cards"),
               F.min("l_suppkey").alias("suppkey")))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    band = F.least(F.lit(4), F.lit(1) + F.floor((F.col("p_retailprice") - 900) / 25)).cast("int")
    none = F.array().cast("array<string>")
    return (part.join(li, part.p_partkey == li.l_partkey, "left")
            .join(supplier, F.col("suppkey") == supplier.s_suppkey, "left")
            .join(nation, F.col("s_nationkey") == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
            .select(F.col("p_partkey").alias("doc_id"),
                    F.col("p_name").alias("name"),
                    F.col("p_type").alias("cuisine"),
                    F.repeat(F.lit("€"), band).alias("price_range"),
                    F.coalesce("facilities", none).alias("facilities"), F.coalesce("cards", none).alias("cards"),
                    F.col("n_name").alias("city"),
                    F.col("r_name").alias("region"),
                    F.col("s_name").alias("address"),
                    F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal_code")))


# SQL text of the same view for the DuckDB oracle.
CATALOG_SQL = """
select p.p_partkey as doc_id, p.p_name as name, p.p_type as cuisine,
       repeat('€', cast(least(4, 1 + floor((p.p_retailprice - 900) / 25)) as int)) as price_range,
       coalesce(l.facilities, []) as facilities, coalesce(l.cards, []) as cards, n.n_name as city, r.r_name as region,
       s.s_name as address, lpad(cast(n.n_nationkey as varchar), 5, '0') as postal_code
from part p
left join (select l_partkey,
             list_sort(list(distinct l_returnflag) filter (where l_quantity >= 45)) as facilities,
             list_sort(list(distinct l_linestatus) filter (where l_quantity >= 45)) as cards,
             min(l_suppkey) as suppkey
      from lineitem group by l_partkey) l on l.l_partkey = p.p_partkey
left join supplier s on s.s_suppkey = l.suppkey
left join nation n on n.n_nationkey = s.s_nationkey
left join region r on r.r_regionkey = n.n_regionkey
"""


LISTING = 20                 # cards of a listing page
LISTING_HOST = "https://guide.example.com"


def listings(places: DataFrame) -> DataFrame:
    """Listing pages ``(page, html)`` of places, ``LISTING`` cards each: with cards inside cards, cards
    without a link, unclosed and void tags, comments, ``>`` in attributes, both kinds of quotes and
    a decoy list before the pagination."""
    doc_id = F.col("doc_id")
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    inner = F.when(doc_id % 3 == 0, text('<div class="js-map card__menu"><br><a href=//cdn.example/', doc_id.cast("string"), ">n</a></div>")) \
        .otherwise(F.lit(""))
    card = F.when(doc_id % 5 == 1, text('<div class="card__menu"><!-- <a href="/no">x</a> --><b>', F.col("name"), "</div>")) \
        .otherwise(text('<DIV class="card__menu js-map" data-x="a>b"><h3>', F.col("name"), "</h3>", inner, "<p>text<p><a class='l' HREF='/rest/",
                        doc_id.cast("string"), "?x=1&amp;y=2'>go</a><a href=\"/second/", doc_id.cast("string"), '">b</a></DIV>'))
    page = F.floor(doc_id / LISTING).alias("page")
    cards = places.select(page, F.struct(doc_id.alias("id"), card.alias("card")).alias("c")).groupBy("page") \
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda c: c["card"]), "\n").alias("cards"))
    links = F.transform(F.sequence(F.lit(1), F.col("page") % 4 + 1), lambda i: F.concat(F.lit('<li><a href="/p/'), i, F.lit('">'), i, F.lit("</a>")))
    return cards.select("page", text(
        '<html><ul class="menu"><li><a href="/menu">m</a></ul><a href="/top">t</a><ul class="pagination">', F.array_join(links, ""),
        "<li><a href='/p/next", F.col("page").cast("string"), "'>&raquo;</a></ul>", F.col("cards"), "</html>").alias("html"))


def place_pages(places: DataFrame) -> DataFrame:
    """Record pages ``(page_id, html)`` of places with every block a record is read from; some lack the
    description, lists, phone or website, and tags are left open."""
    n = F.col("doc_id")
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))                              # noqa: E731
    block = lambda when, *parts: F.when(when, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])).otherwise(F.lit(""))
    each = lambda col, before, after: F.array_join(F.transform(col, lambda v: F.concat(F.lit(before), v, F.lit(after))), "")
    always = F.lit(True)
    return places.select(n.alias("page_id"), F.concat(
        block(always, '<html><script>"</h1>"</script><h1 class="data-sheet__title"> ', word("name"), " &amp; <b>Co</h1>"),
        block(always, '<div class="data-sheet__block--text">', word("address"), ", ", word("city"), " , ", word("postal_code"), ",", word("region"), "</div>"),
        block(always, "<div class='x data-sheet__block--text'>", word("price_range"), " · ", word("cuisine"), " </div>"),
        block(n % 4 != 0, '<div class="data-sheet__description"><p>', word("name"), " <i>serves</i> &eacute; ", word("cuisine"), "<br></div>"),
        block(F.size("facilities") > 0, '<div class="col col-12 col-lg-6"><ul>', each("facilities", "<li> Item ", " "), "</ul></div>"),
        block(F.size("cards") > 0, '<div class="col col-12 col-lg-6"><div>', each("cards", '<img data-src="/img/x/', '-icon-2.svg">'), "</div></div>"),
        block(n % 3 == 0, '<p><a data-event="CTA_tel" href="tel:+39 0', n.cast("string"), '">call</a>'),
        block(n % 5 != 0, '<p><a data-event=CTA_website href="https://p', n.cast("string"), '.example/?a=1&amp;b=2">site</a>')).alias("html"))


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocoder results keyed by postal code, derived from ``nation`` and
    ``region``: ``(postal_code, address map<string,string>, latitude,
    longitude)``. The address map has the shapes a geocoder returns: some
    nations carry a city, some only a town (city empty), region or only a
    state; one region has no coordinates."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    address = F.create_map(
        F.lit("city"), F.when(F.col("n_regionkey") <= 1, F.col("n_name")).otherwise(F.lit("")),
        F.lit("town"), F.when(F.col("n_regionkey") == 2, F.lower(F.col("n_name"))),
        F.lit("village"), F.when(F.col("n_regionkey") == 3, F.concat(F.lit("v-"), F.col("n_name"))),
        F.lit("region"), F.when(F.col("n_regionkey") != 4, F.col("r_name")),
        F.lit("state"), F.concat(F.lit("state of "), F.col("r_name")),
    )
    lat = F.when(F.col("n_regionkey") != 4, F.lit(36.0) + F.col("n_nationkey") * 0.4)
    return j.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("postal_code"),
                    address.alias("address"), lat.alias("latitude"),
                    (F.lit(6.5) + F.col("n_regionkey") * 2.5).alias("longitude"))


GEO_SQL = """
select lpad(cast(n_nationkey as varchar), 5, '0') as postal_code,
       map {'city': case when n_regionkey <= 1 then n_name else '' end,
            'town': case when n_regionkey = 2 then lower(n_name) end,
            'village': case when n_regionkey = 3 then 'v-' || n_name end,
            'region': case when n_regionkey <> 4 then r_name end,
            'state': 'state of ' || r_name} as address,
       case when n_regionkey <> 4 then 36.0::double + n_nationkey * 0.4::double end as latitude,
       6.5::double + n_regionkey * 2.5::double as longitude
from nation join region on n_regionkey = r_regionkey
"""
