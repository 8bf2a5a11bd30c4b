"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads whole input tables (``documents``, ``benchmark``, the
TPC-H-like tables, ``pages``) and composes the library's operators. Result
columns are aliased to the names the SQL oracle (:mod:`.oracle`) uses;
doubles are rounded to 6 digits and arrays are rendered as joined strings so
both engines can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..operators import corpus as C
from ..operators import extract as EX
from ..operators import facets as FA
from ..operators import geo as G
from ..operators import places as PL
from ..operators import routes as RT
from ..operators import search as S
from ..operators import stemming as ST
from ..index import SearchIndex
from ..session import materialize
from ..sources import index_store as IS
from ..sources import places as SP
from ..sources import tables
from . import index_cache as IC

# Parameters of the original ranked engine as its driver called it.
VOCAB_MIN_CF = 2
VOCAB_MAX_CF = 1900
# Its upper bound was set for 2000 records; beyond them it grows in proportion.
VOCAB_MAX_PER_DOC = 0.95
RANKED_K = 5
TWO_STAGE_K = 10
ADVANCED_TOP_N = 10

# A single free-text query, as the original demo ran one (words of the corpus).
SINGLE_QUERY = "Modern seasonal cuisine: tion, thon and ther"

# Two frequent corpus terms for the two-list intersection.
TERM_A, TERM_B = "tion", "ing"


def _single_query(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, SINGLE_QUERY)], "query_id bigint, text string")


# ------------------------------------------------------------------ text --

def q_strip_zero_words(spark, d):
    docs = tables.documents(spark, d)
    return docs.select("doc_id", T.strip_zero_words(F.lower(F.col("text"))).alias("stripped"))


def q_tokens(spark, d):
    docs = tables.documents(spark, d)
    return docs.select("doc_id", F.posexplode(T.raw_tokens(F.col("text"))).alias("pos", "token")) \
        .withColumn("pos", F.col("pos").cast("bigint"))


def q_tokens_nostop(spark, d):
    return C.tokens(tables.documents(spark, d)).withColumn("pos", F.col("pos").cast("bigint"))


def q_normalized_text(spark, d):
    return C.normalized_documents(tables.documents(spark, d))


# -------------------------------------------------------------- corpus --

def _docs_path(d):
    return f"{d}/documents.parquet"


def _index(spark, d, stem=False, passes=1) -> SearchIndex:
    """The search index of a corpus, built once per corpus and settings (see
    :mod:`.index_cache`); its upper vocabulary bound grows with the corpus.
    Indexes with other settings share the tables they have in common."""
    def build():
        reuse = None
        if passes != 1:
            reuse = _index(spark, d, stem=stem)
        elif stem:
            reuse = _index(spark, d)
        return SearchIndex(tables.table(spark, d, "documents"), stem=stem, min_cf=VOCAB_MIN_CF, max_cf=VOCAB_MAX_CF,
                           max_per_doc=VOCAB_MAX_PER_DOC, passes=passes, reuse=reuse)
    return IC.cached(spark, "index", [_docs_path(d)], (stem, passes), build)


def _stems(spark, d):
    return _index(spark, d, stem=True).stems


def _vocab(spark, d):
    return _index(spark, d).vocabulary


def q_vocabulary(spark, d):
    return _vocab(spark, d)


def q_vocabulary_csv(spark, d):
    """The vocabulary written as CSV (S5) and read back (S3)."""
    path = IS.scratch_path(spark, "vocabulary-csv")
    SP.write_csv(_vocab(spark, d), path)
    return SP.read_csv(spark, path, "term_id bigint, term string")


def q_term_frequency(spark, d):
    return _index(spark, d).term_stats.select("term", "cf")


def q_bounded_vocabulary(spark, d):
    stats = _index(spark, d).term_stats
    return C.dense_ids(stats.where(F.col("cf").between(VOCAB_MIN_CF, VOCAB_MAX_CF)),
                       "term", "term_id")


def q_vocab_size(spark, d):
    cf = _index(spark, d).term_stats
    return cf.agg(F.count(F.lit(1)).alias("n_terms"),
                  F.count_if(F.col("cf").between(VOCAB_MIN_CF, VOCAB_MAX_CF)).alias("n_bounded"))


def q_inverted_index(spark, d):
    return C.inverted_index(_index(spark, d).postings, _vocab(spark, d))


def _model(spark, d, stem=False, passes=1) -> SearchIndex:
    """The fitted ranked-search state (idf, weighted index) of a corpus."""
    return _index(spark, d, stem=stem, passes=passes)


def _rounded(df, col="weight"):
    return df.withColumn(col, F.round(F.col(col), 6))


def q_tfidf(spark, d):
    return _rounded(_model(spark, d).weights)


def q_weighted_postings(spark, d):
    m = _model(spark, d)
    # ids come to the postings with the idf, so no posting is shuffled by term for them
    vocab = materialize(C.number_rows(m.idf.select("term", "idf"), ["term"], "term_id"), "vocabulary")
    return _rounded(m.weigh(vocab).where("weight is not null").select("term_id", "doc_id", "weight"))


def q_query_vectors(spark, d):
    m = _model(spark, d)
    return _rounded(m.query_vectors(tables.query_batch(spark, d)))


# -------------------------------------------------------------- search --

RESULT_COLUMNS = ["name", "address", "description", "website"]


def _with_places(spark, d, df):
    """Search results with the columns of their places. A result is small and written, so the planner
    broadcasts its ids, and texts and place columns stream past them: a left join can't broadcast
    its left side, and would shuffle and sort all texts."""
    df = materialize(df, "results")
    only = lambda table: table.join(df.select("doc_id"), "doc_id", "left_semi")
    docs = only(tables.table(spark, d, "documents").select("doc_id", F.col("text").alias("description")))
    site = only(tables.table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("website")))
    catalog = only(_catalog(spark, d).select("doc_id", "name", "address"))
    return df.join(catalog.join(site, "doc_id", "left"), "doc_id", "left").join(docs, "doc_id", "left")


def q_conjunctive_search(spark, d):
    res = _index(spark, d).conjunctive(tables.query_batch(spark, d))
    return _with_places(spark, d, res).select("query_id", "doc_id", *RESULT_COLUMNS)


def q_term_intersect(spark, d):
    return S.term_intersect(_index(spark, d).store, TERM_A, TERM_B)


def _ranked(spark, d, queries, maxima=False):
    res = _model(spark, d).ranked(queries, RANKED_K, maxima)
    return _with_places(spark, d, res).select("query_id", "doc_id", *RESULT_COLUMNS, "score", "rank")


def q_ranked_search(spark, d):
    return _ranked(spark, d, _single_query(spark))


def q_ranked_search_batch(spark, d):
    return _ranked(spark, d, tables.query_batch(spark, d))


def q_ranked_search_maxima(spark, d):
    """The same result as the batch's, with postings skipped by block maxima."""
    return _ranked(spark, d, tables.query_batch(spark, d), maxima=True)


QUERIES = {
    "strip_zero_words": q_strip_zero_words,
    "tokens": q_tokens,
    "tokens_nostop": q_tokens_nostop,
    "normalized_text": q_normalized_text,
    "vocabulary": q_vocabulary,
    "vocabulary_csv": q_vocabulary_csv,
    "term_frequency": q_term_frequency,
    "bounded_vocabulary": q_bounded_vocabulary,
    "vocab_size": q_vocab_size,
    "inverted_index": q_inverted_index,
    "tfidf": q_tfidf,
    "weighted_postings": q_weighted_postings,
    "query_vectors": q_query_vectors,
    "conjunctive_search": q_conjunctive_search,
    "term_intersect": q_term_intersect,
    "ranked_search": q_ranked_search,
    "ranked_search_batch": q_ranked_search_batch,
    "ranked_search_maxima": q_ranked_search_maxima,
}


# ------------------------------------------------------- places / facets --


# The search request of the advanced search (values a user would pick).
REQUEST = S.SearchRequest(name="Blue bolt and the red gear", city="  NATION_7 ",
                          cuisine="economy brushed", price_range=("€", "€€€"),
                          regions=["ASIA", "EUROPE", "AMERICA"], cards=["f"], facilities=["R"])
# Composite-score preferences (cuisine substring, wanted facility).
PREF_CUISINE = "ECONOMY"
PREF_FACILITY = "R"
# Texts of the request batch.
REQUEST_NAMES = ["Blue bolt and the red gear", "small ring", "hot hot widget"]
REQUEST_CUISINES = ["economy brushed", "PROMO", "large", ""]
FILTER_BANDS = ("€€", "€€€")
FILTER_CARDS = ["F"]
FILTER_FACILITIES = ["A", "R"]
FILTER_REGIONS = ["ASIA", "EUROPE"]


CATALOG_INPUTS = ("part", "lineitem", "supplier", "nation", "region")


def _catalog(spark, d):
    """The place table, derived from the TPC-H-like tables once per input
    and written to the checkpoint folder (places are parsed once and
    searched many times)."""
    return IC.cached(spark, "catalog", [f"{d}/{t}.parquet" for t in CATALOG_INPUTS], (),
                     lambda: materialize(tables.catalog(spark, d), "catalog"))


def _places(spark, d):
    """The place table with its web address (the page of the same number)."""
    site = tables.table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("website"))
    return _catalog(spark, d).join(site, "doc_id", "left")


def _facets(spark, d) -> FA.FacetIndex:
    """The stored field index and facet bitmaps of the places, built once."""
    return IC.cached(spark, "facets", [f"{d}/{t}.parquet" for t in (*CATALOG_INPUTS, "pages")], (),
                     lambda: FA.FacetIndex.write(_places(spark, d)))


def _requests(spark, d):
    """A batch of search requests, one per nation: its name as the city, and filters of all kinds."""
    n = F.col("n_nationkey")
    nation, region = tables.table(spark, d, "nation"), tables.table(spark, d, "region")
    none = F.array().cast("array<string>")
    pick = lambda *values: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        n.cast("bigint").alias("request_id"), pick(*REQUEST_NAMES).alias("name"),
        F.concat(F.lit("  "), F.lower("n_name"), F.lit(" ")).alias("city"), pick(*REQUEST_CUISINES).alias("cuisine"),
        pick("€", "€€").alias("price_low"), pick("€€€", "€€€€", None).alias("price_high"),
        F.when(n % 3 == 0, none).otherwise(F.array(F.col("r_name"), F.lit("ASIA"))).alias("regions"),
        F.when(n % 2 == 0, F.array(F.lit("f"))).otherwise(none).alias("cards"),
        F.when(n % 5 == 0, F.array(F.lit("R"), F.lit("a"))).when(n % 5 == 1, F.array(F.lit("n"))).alias("facilities"))


def _joined(col):
    return F.array_join(F.col(col), ",").alias(col)


def q_price_ordinal(spark, d):
    return _catalog(spark, d).select("doc_id", "price_range",
                                     S.price_ordinal(F.col("price_range")).alias("price_numeric"))


def q_filter_price(spark, d):
    return S.filter_price(_catalog(spark, d), *FILTER_BANDS).select("doc_id", "price_range")


def q_filter_contains_all(spark, d):
    c = _catalog(spark, d)
    c = S.filter_contains_all(c, "cards", FILTER_CARDS)
    c = S.filter_contains_all(c, "facilities", FILTER_FACILITIES)
    return c.select("doc_id", _joined("facilities"), _joined("cards"))


def q_filter_region(spark, d):
    return S.filter_region(_catalog(spark, d), FILTER_REGIONS).select("doc_id", "region")


def q_clean_field(spark, d):
    return tables.documents(spark, d).select("doc_id", T.clean_field(F.col("text")).alias("cleaned"))


def q_clean_basic(spark, d):
    return tables.documents(spark, d).select("doc_id", T.clean_basic(F.col("text")).alias("cleaned"))


def q_field_index(spark, d):
    return _facets(spark, d).field_index()


def _request_terms(spark):
    return S.field_query_terms(spark, {"name": (REQUEST.name, "field"),
                                       "city": (REQUEST.city, "basic"),
                                       "cuisine": (REQUEST.cuisine, "field")})


def q_field_match_score(spark, d):
    return S.field_match_score(q_field_index(spark, d), _request_terms(spark))


def q_advanced_search(spark, d):
    found = S.advanced_search(_places(spark, d), q_field_index(spark, d), REQUEST, ADVANCED_TOP_N)
    return found.select("doc_id", "name", "address", "city", "cuisine", "price_range", "region", "website", "score")


def q_advanced_search_batch(spark, d):
    """Many requests at once, filtered by bitmaps before scoring."""
    return _facets(spark, d).search(_requests(spark, d), ADVANCED_TOP_N)


def q_field_match_batch(spark, d):
    return _facets(spark, d).match_scores(_requests(spark, d))


def q_composite_score(spark, d):
    cos = _model(spark, d).cosines(tables.query_batch(spark, d))
    c = _catalog(spark, d).select("doc_id", "cuisine", "facilities", "price_range")
    return (cos.join(c, "doc_id", "left")
            .select("query_id", "doc_id",
                    F.round(S.composite_score(F.col("score"), F.col("cuisine"), F.col("facilities"),
                                              F.col("price_range"), PREF_CUISINE, PREF_FACILITY),
                            6).alias("score")))


def _two_stage(spark, d):
    return _model(spark, d).two_stage(tables.query_batch(spark, d), _catalog(spark, d),
                                      PREF_CUISINE, PREF_FACILITY, price=True, k=TWO_STAGE_K)


def q_two_stage_search(spark, d):
    return _with_places(spark, d, _two_stage(spark, d)) \
        .withColumn("website", F.coalesce("website", F.lit("N/A"))) \
        .select("query_id", "doc_id", *RESULT_COLUMNS, "score", "rank")


# ------------------------------------------------------------- geography --

def _enriched(spark, d, keep_parsed_city=True):
    return G.enrich(_catalog(spark, d), tables.geo(spark, d), keep_parsed_city)


def q_geo_enrich(spark, d):
    return _enriched(spark, d).select("doc_id", "postal_code", "city", "region",
                                      "latitude", "longitude")


def q_address_coalesce(spark, d):
    return _enriched(spark, d, keep_parsed_city=False).select("doc_id", "city", "region")


def q_geo_known(spark, d):
    return G.known_coordinates(_enriched(spark, d)).select("doc_id", "latitude", "longitude")


def q_geo_missing_keys(spark, d):
    known = G.known_coordinates(tables.geo(spark, d))
    return G.missing_keys(_catalog(spark, d), known)


def q_avg_price_by_region(spark, d):
    return G.avg_price_by_region(_enriched(spark, d)) \
        .withColumn("price_numeric", F.round("price_numeric", 6))


def q_region_price_table(spark, d):
    avg = G.avg_price_by_region(_enriched(spark, d))
    regions = tables.table(spark, d, "region")
    return (G.region_price_table(regions, avg, "r_name")
            .select("r_regionkey", "r_name", F.round("price_numeric", 6).alias("price_numeric")))


def q_marker_rows(spark, d):
    return G.marker_rows(G.known_coordinates(_enriched(spark, d)))


def q_semi_by_text(spark, d):
    docs = tables.documents(spark, d)
    top_ids = _model(spark, d).ranked(tables.query_batch(spark, d), RANKED_K, maxima=False).select("doc_id").distinct()
    # texts of the result rows; the ids are written so that the search runs once
    top_texts = docs.join(materialize(top_ids, "top-ids"), "doc_id", "left_semi")
    return G.semi_by_text(docs, top_texts).select("doc_id")


def q_semi_by_id(spark, d):
    top = _two_stage(spark, d)
    return G.semi_by_id(_enriched(spark, d), top).select("doc_id", "latitude", "longitude")


# ---------------------------------------------------------- place records --

def q_split_location(spark, d):
    c = _catalog(spark, d)
    loc = F.concat_ws(", ", "address", "city", "postal_code", "region")
    return c.select("doc_id", *PL.split_location(loc))


def _attributes():
    """Attribute line of a place: ``<price band> · <cuisine>``."""
    return F.concat(F.col("price_range"), F.lit(" · "), F.col("cuisine"))


def q_price_band(spark, d):
    return _catalog(spark, d).select("doc_id", PL.price_band(_attributes()).alias("price_band"))


def q_cuisine_label(spark, d):
    return _catalog(spark, d).select("doc_id", PL.cuisine_label(_attributes()).alias("cuisine"))


def q_missing_report(spark, d):
    e = _enriched(spark, d).select("name", "address", "city", "postal_code", "price_range",
                                   "cuisine", "facilities", "cards", "region", "latitude")
    return PL.missing_report(e)


def q_place_union(spark, d):
    c = _catalog(spark, d).select("doc_id", "name", "price_range")
    cheap = S.filter_price(c, "€", "€€")
    dear = S.filter_price(c, "€€€", "€€€€").select("name", "doc_id", "price_range")
    return cheap.unionByName(dear)


# ------------------------------------------------------------ pages / urls --

def _pages(spark, d):
    return tables.pages(spark, d)


def q_page_scan(spark, d):
    p = _pages(spark, d)
    last = T.url_last_segment(F.col("url"))
    return p.select("page_id", "url",
                    F.regexp_extract(last, "([0-9]+)", 1).alias("file_no"),
                    F.length("html").cast("bigint").alias("n_chars"))


def q_page_bucket(spark, d):
    return _pages(spark, d).select("page_id", (F.floor(F.col("page_id") / 20) + 1)
                                   .cast("bigint").alias("bucket"))


def q_url_sort(spark, d):
    keyed = _pages(spark, d).select("url", T.url_sort_key(F.col("url")).alias("sort_key"))
    return keyed.orderBy("sort_key", "url").select("url", "sort_key.n_digits", "sort_key.digits")


def q_url_dedup(spark, d):
    return q_page_links(spark, d).select("link").distinct()


def q_url_list(spark, d):
    """The URL list written as text (S7) and read back."""
    path = IS.scratch_path(spark, "urls")
    SP.write_url_list(q_url_dedup(spark, d), path, col="link")
    return spark.read.text(path).withColumnRenamed("value", "url")


def q_path_token(spark, d):
    return _pages(spark, d).select("page_id", PL.path_token(F.col("url")).alias("token"))


def q_page_title(spark, d):
    return _pages(spark, d).select("page_id", H.first_h1_text(F.col("html")).alias("title"))


def q_page_links(spark, d):
    p = _pages(spark, d)
    return p.select("page_id", F.posexplode(H.hrefs(F.col("html"))).alias("pos", "href"),
                    H.host_of(F.col("url")).alias("host")) \
        .select("page_id", F.col("pos").cast("bigint").alias("pos"),
                H.absolute(F.col("href"), F.col("host")).alias("link"))


def q_nav_links(spark, d):
    """Anchors of the navigation list without the last one (the first
    pass of the listing crawl drops the 'next' arrow)."""
    kept = H.list_hrefs(F.col("html"), tag="nav", drop_last=True)
    return _pages(spark, d).select("page_id", F.posexplode(kept).alias("pos", "href")) \
        .select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


def q_card_links(spark, d):
    """H1 on listing pages of the places: the first link of each card."""
    links = H.card_hrefs(F.col("html"), "card__menu")
    return tables.listings(_catalog(spark, d)).select("page", F.posexplode(links).alias("pos", "href")).where("href is not null") \
        .select("page", F.col("pos").cast("bigint").alias("pos"), H.absolute(F.col("href"), F.lit(tables.LISTING_HOST)).alias("link"))


def q_pagination_links(spark, d):
    """H2 on the same pages: the first pass drops the last link, the second keeps all."""
    listed = tables.listings(_catalog(spark, d))
    passes = [listed.select("page", F.lit(n).alias("pass"), F.posexplode(H.list_hrefs(F.col("html"), "pagination", drop_last=n == 1))
                            .alias("pos", "href")) for n in (1, 2)]
    return passes[0].unionByName(passes[1]).select("page", F.col("pass").cast("bigint").alias("pass"), F.col("pos").cast("bigint").alias("pos"),
                                                   H.absolute(F.col("href"), F.lit(tables.LISTING_HOST)).alias("link"))


def q_page_files(spark, d):
    """Pages written as files, one each, and read back in the order of their numbers."""
    path = IS.scratch_path(spark, "page-files")
    SP.write_page_files(tables.table(spark, d, "pages"), path)
    html = F.regexp_replace("html", r"\n\z", "")            # the line break that ends a file
    return SP.ordered_page_files(spark, path).select("rank", "page_id", F.length(html).cast("bigint").alias("n_chars"),
                                                     F.md5(html).alias("html_md5"))


def q_decode_list(spark, d):
    c = _catalog(spark, d).select("doc_id", PL.encode_list(F.col("facilities")).alias("printed"))
    return c.select("doc_id", "printed",
                    F.array_join(PL.decode_list(F.col("printed")), "|").alias("decoded"))


# ------------------------------------------------ routes, I/O, extraction --



def _points(spark, d):
    li = tables.table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("x"),
                     F.col("l_quantity").cast("int").alias("y"))


def q_monotone_route(spark, d):
    return RT.monotone_route(_points(spark, d))


def q_route_summary(spark, d):
    """Longer cases, without path strings: the orders of each part."""
    li = tables.table(spark, d, "lineitem")
    return RT.route_summary(li.select(F.col("l_partkey").alias("case_id"), F.col("l_orderkey").alias("x"),
                                      (F.floor(F.col("l_orderkey") / 8) + F.col("l_linenumber")).alias("y")))


def q_index_roundtrip(spark, d):
    """The persisted index opened again by its path, all ranked postings read back."""
    path = _model(spark, d).store.path
    return _rounded(IS.PostingStore(spark, path).postings().where("weight is not null"))


def _typed_places(spark, d):
    c = _catalog(spark, d)
    docs = tables.documents(spark, d)
    return c.join(docs, "doc_id", "left").select(
        "doc_id", F.col("name").alias("restaurantName"), "address", "city",
        F.col("postal_code").alias("postalCode"), F.col("region").alias("country"),
        F.col("price_range").alias("priceRange"), F.col("cuisine").alias("cuisineType"),
        F.col("text").alias("description"), F.col("facilities").alias("facilitiesServices"),
        F.col("cards").alias("creditCards"), F.lit("").alias("phoneNumber"),
        F.lit("").alias("website"))


def q_place_scan(spark, d):
    path = IS.scratch_path(spark, "places-tsv")
    SP.write_places_tsv(_typed_places(spark, d), path)
    back = SP.read_places_tsv(spark, path)
    return back.select("doc_id", "restaurantName", "postalCode", "priceRange", "description",
                       F.array_join("facilitiesServices", "|").alias("facilities"),
                       F.array_join("creditCards", "|").alias("cards"), "phoneNumber")


def q_extract_places(spark, d):
    return _listed(EX.extract_places(_pages(spark, d)))


def q_extract_records(spark, d):
    """H3 to H10 and H12 on record pages of the places, with every block."""
    return _listed(EX.extract_places(tables.place_pages(_catalog(spark, d))))


def _listed(out):
    return out.select(*[F.array_join(c, "|").alias(c) if c in SP.LIST_COLUMNS else c
                        for c in out.columns])


QUERIES.update({
    "monotone_route": q_monotone_route,
    "route_summary": q_route_summary,
    "index_roundtrip": q_index_roundtrip,
    "place_scan": q_place_scan,
    "extract_places": q_extract_places,
    "extract_records": q_extract_records,
})

QUERIES.update({
    "price_ordinal": q_price_ordinal,
    "filter_price": q_filter_price,
    "filter_contains_all": q_filter_contains_all,
    "filter_region": q_filter_region,
    "clean_field": q_clean_field,
    "clean_basic": q_clean_basic,
    "field_index": q_field_index,
    "field_match_score": q_field_match_score,
    "advanced_search": q_advanced_search,
    "advanced_search_batch": q_advanced_search_batch,
    "field_match_batch": q_field_match_batch,
    "composite_score": q_composite_score,
    "two_stage_search": q_two_stage_search,
    "geo_enrich": q_geo_enrich,
    "address_coalesce": q_address_coalesce,
    "geo_known": q_geo_known,
    "geo_missing_keys": q_geo_missing_keys,
    "avg_price_by_region": q_avg_price_by_region,
    "region_price_table": q_region_price_table,
    "marker_rows": q_marker_rows,
    "semi_by_text": q_semi_by_text,
    "semi_by_id": q_semi_by_id,
    "split_location": q_split_location,
    "price_band": q_price_band,
    "cuisine_label": q_cuisine_label,
    "missing_report": q_missing_report,
    "place_union": q_place_union,
    "page_scan": q_page_scan,
    "page_bucket": q_page_bucket,
    "url_sort": q_url_sort,
    "url_dedup": q_url_dedup,
    "url_list": q_url_list,
    "path_token": q_path_token,
    "page_title": q_page_title,
    "page_links": q_page_links,
    "nav_links": q_nav_links,
    "card_links": q_card_links,
    "pagination_links": q_pagination_links,
    "page_files": q_page_files,
    "decode_list": q_decode_list,
})


# ------------------------------------------------------------- stemming --
# The stemmer is one rule table, compiled for both engines; tests hold it against
# a plain implementation of the algorithm.

def q_stem_dictionary(spark, d):
    return _stems(spark, d)


def q_normalized_text_stemmed(spark, d):
    docs = tables.documents(spark, d)
    return ST.stemmed_text(docs, C.tokens(docs), _stems(spark, d))


def q_conjunctive_search_stemmed(spark, d):
    res = _index(spark, d, stem=True).conjunctive(tables.query_batch(spark, d))
    return _with_places(spark, d, res).select("query_id", "doc_id", *RESULT_COLUMNS)


def _ranked_of(spark, d, model):
    res = model.ranked(tables.query_batch(spark, d), RANKED_K, maxima=False)
    return _with_places(spark, d, res).select("query_id", "doc_id", *RESULT_COLUMNS, "score", "rank")


def q_ranked_search_stemmed(spark, d):
    return _ranked_of(spark, d, _model(spark, d, stem=True))


def q_ranked_search_two_pass(spark, d):
    return _ranked_of(spark, d, _model(spark, d, stem=True, passes=2))


QUERIES.update({
    "stem_dictionary": q_stem_dictionary,
    "normalized_text_stemmed": q_normalized_text_stemmed,
    "conjunctive_search_stemmed": q_conjunctive_search_stemmed,
    "ranked_search_stemmed": q_ranked_search_stemmed,
    "ranked_search_two_pass": q_ranked_search_two_pass,
})
