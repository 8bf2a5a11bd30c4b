"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Tables are the pre-registered views ``documents``, ``benchmark``, ``part``,
``lineitem``, ... . Column names match the Spark results exactly."""

from __future__ import annotations

from ..functions.html import HOST
from ..sources.tables import CATALOG_SQL, GEO_SQL, LISTING, LISTING_HOST
from ..functions.stem import stem_sql
from . import sqltext as X
from .queries import (ADVANCED_TOP_N, FILTER_BANDS, FILTER_CARDS, FILTER_FACILITIES,
                      FILTER_REGIONS, PREF_CUISINE, PREF_FACILITY, RANKED_K, REQUEST, REQUEST_CUISINES, REQUEST_NAMES,
                      SINGLE_QUERY, TERM_A, TERM_B, TWO_STAGE_K, VOCAB_MAX_CF, VOCAB_MAX_PER_DOC, VOCAB_MIN_CF)

NORM = X.normalized_tokens("text")

TF = f"""
tf as (select doc_id, term, count(*)::bigint as tf
       from (select doc_id, unnest({NORM}) as term from documents) group by doc_id, term)
"""

QTF_BATCH = f"""
qtf as (select query_id, term, count(*)::bigint as tf
        from (select item_id as query_id, unnest({X.normalized_tokens('text')}) as term from benchmark)
        group by query_id, term)
"""

QTF_SINGLE = f"""
qtf as (select query_id, term, count(*)::bigint as tf
        from (select 0::bigint as query_id, unnest({X.normalized_tokens(X.lit(SINGLE_QUERY))}) as term)
        group by query_id, term)
"""

IDF = f"""
idf as (select term, ln((1 + n) / (1 + df)) + 1 as idf
        from (select term, count(*) as df, sum(tf) as cf from tf group by term
              having sum(tf) between {VOCAB_MIN_CF} and greatest({VOCAB_MAX_CF}, {VOCAB_MAX_PER_DOC} * (select count(*) from documents))) s,
             (select count(*)::double as n from documents) c)
"""

WEIGHTS = """
dw as (select doc_id, term, tf, tf * idf as w from tf join idf using (term)),
weights as (select doc_id, term, tf, w / sqrt(sum(w * w) over (partition by doc_id)) as weight from dw)
"""

QVEC = """
qw as (select query_id, term, tf, tf * idf as w from qtf join idf using (term)),
qvec as (select query_id, term, tf, w / sqrt(sum(w * w) over (partition by query_id)) as weight from qw)
"""

CATALOG = f"catalog as ({CATALOG_SQL})"


# the columns of a result's places (r: the result rows)
SHOWN = "c.name, c.address, t.text as description, g.url as website"
PLACES = """left join catalog c on c.doc_id = r.doc_id left join documents t on t.doc_id = r.doc_id
left join pages g on g.page_id = r.doc_id"""


def _ranked(qtf: str, tf: str = TF, idf: str = IDF) -> str:
    return f"""
with {tf}, {qtf}, {idf}, {WEIGHTS}, {QVEC}, {CATALOG},
scores as (select query_id, doc_id, round(sum(weights.weight * qvec.weight), 6) as score
           from weights join qvec using (term) group by query_id, doc_id),
ranked as (select query_id, doc_id, score,
                  row_number() over (partition by query_id order by score desc, doc_id) as rank
           from scores)
select r.query_id, r.doc_id, {SHOWN}, r.score, r.rank::bigint as rank
from ranked r {PLACES} where r.rank <= {RANKED_K}
"""


def _ranked_ids(qtf: str) -> str:
    """The ids alone."""
    return f"select distinct doc_id from ({_ranked(qtf)})"


ORACLE = {
    "strip_zero_words": f"select doc_id, {X.strip_zero_words('lower(text)')} as stripped from documents",
    "tokens": f"""
select doc_id, (generate_subscripts(l, 1) - 1)::bigint as pos, unnest(l) as token
from (select doc_id, {X.raw_tokens('text')} as l from documents)
""",
    "tokens_nostop": f"""
select doc_id, (generate_subscripts(l, 1) - 1)::bigint as pos, unnest(l) as term
from (select doc_id, {NORM} as l from documents)
""",
    "normalized_text": f"select doc_id, {X.normalized_text('text')} as normalized from documents",
    "vocabulary": f"""
with {TF}
select (row_number() over (order by term) - 1)::bigint as term_id, term
from (select distinct term from tf)
""",
    "term_frequency": f"with {TF} select term, sum(tf)::bigint as cf from tf group by term",
    "bounded_vocabulary": f"""
with {TF}
select (row_number() over (order by term) - 1)::bigint as term_id, term
from (select term from tf group by term having sum(tf) between {VOCAB_MIN_CF} and {VOCAB_MAX_CF})
""",
    "vocab_size": f"""
with {TF}, cf as (select term, sum(tf) as cf from tf group by term)
select count(*)::bigint as n_terms,
       count(*) filter (where cf between {VOCAB_MIN_CF} and {VOCAB_MAX_CF})::bigint as n_bounded
from cf
""",
    "inverted_index": f"""
with {TF}, vocab as (select (row_number() over (order by term) - 1)::bigint as term_id, term
                     from (select distinct term from tf))
select term_id, doc_id from tf join vocab using (term)
""",
    "tfidf": f"""
with {TF}, {IDF}, {WEIGHTS}
select doc_id, term, tf, round(weight, 6) as weight from weights
""",
    "weighted_postings": f"""
with {TF}, {IDF}, {WEIGHTS},
vocab as (select (row_number() over (order by term) - 1)::bigint as term_id, term from idf)
select term_id, doc_id, round(weight, 6) as weight from weights join vocab using (term)
""",
    "query_vectors": f"""
with {TF}, {QTF_BATCH}, {IDF}, {QVEC}
select query_id, term, tf, round(weight, 6) as weight from qvec
""",
    "conjunctive_search": f"""
with {TF}, {CATALOG},
q as (select distinct item_id as query_id, unnest({X.normalized_tokens('text')}) as term
      from benchmark),
hits as (select q.query_id, tf.doc_id, tf.term from tf join q using (term)),
known as (select query_id, count(distinct term) as n_known from hits group by query_id),
m as (select query_id, doc_id, count(*) as n_hit from hits group by query_id, doc_id),
r as (select query_id, doc_id from m join known using (query_id) where n_hit = n_known)
select r.query_id, r.doc_id, {SHOWN} from r {PLACES}
""",
    "term_intersect": f"""
with {TF}
select doc_id from tf where term = '{TERM_A}'
intersect
select doc_id from tf where term = '{TERM_B}'
""",
    "ranked_search": _ranked(QTF_SINGLE),
    "ranked_search_batch": _ranked(QTF_BATCH),
}

ORACLE["vocabulary_csv"] = ORACLE["vocabulary"]
ORACLE["ranked_search_maxima"] = ORACLE["ranked_search_batch"]


# ------------------------------------------------------- places / facets --


L = X.lit


def _ordinal(x):
    return (f"(case {x} when '€' then 1 when '€€' then 2 when '€€€' then 3 "
            f"when '€€€€' then 4 end)::integer")


def _band_no(b):
    return ["€", "€€", "€€€", "€€€€"].index(b) + 1


def _list(values):
    return "[" + ", ".join(L(v) for v in values) + "]"


def _has_all(col, want):
    return (f"list_has_all(list_transform(coalesce({col}, []::varchar[]), lambda x: lower(x)), "
            f"{_list([w.lower() for w in want])})")


def _composite(cos, cuisine, facilities, price):
    return (f"(coalesce({cos}, 0.0::double) * 0.5::double"
            f" + case when coalesce(contains({cuisine}, {L(PREF_CUISINE)}), false) then 0.2::double else 0.0::double end"
            f" + case when coalesce(list_contains({facilities}, {L(PREF_FACILITY)}), false) then 0.2::double else 0.0::double end"
            f" + case {price} when '€' then 0.1::double when '€€' then 0.08::double"
            f" when '€€€' then 0.05::double else 0.0::double end)")


FIELD_INDEX = f"""
fvals as (select doc_id, 'name' as field, {X.clean_field('name')} as v from catalog
          union all select doc_id, 'city', {X.clean_basic('city')} from catalog
          union all select doc_id, 'cuisine', {X.clean_field('cuisine')} from catalog),
fi as (select distinct field, term, doc_id
       from (select field, unnest({X.words('v')}) as term, doc_id from fvals))
"""

REQ_TERMS = f"""
req as (select 'name' as field, {X.clean_field(L(REQUEST.name))} as v
        union all select 'city', {X.clean_basic(L(REQUEST.city))}
        union all select 'cuisine', {X.clean_field(L(REQUEST.cuisine))}),
rt as (select field, term, count(*) as mult
       from (select field, unnest({X.words('v')}) as term from req) group by field, term),
fs as (select doc_id, sum(mult)::bigint as score from fi join rt using (field, term) group by doc_id)
"""

COS_BATCH = f"""
{TF}, {QTF_BATCH}, {IDF}, {WEIGHTS}, {QVEC},
cos as (select query_id, doc_id, sum(weights.weight * qvec.weight) as score
        from weights join qvec using (term) group by query_id, doc_id)
"""

CONJ = f"""
q as (select distinct item_id as query_id, unnest({X.normalized_tokens('text')}) as term
      from benchmark),
hits as (select q.query_id, tf.doc_id, tf.term from tf join q using (term)),
known as (select query_id, count(distinct term) as n_known from hits group by query_id),
m as (select query_id, doc_id, count(*) as n_hit from hits group by query_id, doc_id),
cand as (select query_id, doc_id from m join known using (query_id) where n_hit = n_known)
"""

TWO_STAGE = f"""
ts_scored as (select cand.query_id, cand.doc_id,
                     round({_composite('cos.score', 'c.cuisine', 'c.facilities', 'c.price_range')}, 6) as score
              from cand left join cos using (query_id, doc_id) left join catalog c using (doc_id)),
ts as (select query_id, doc_id, score,
              row_number() over (partition by query_id order by score desc, doc_id)::bigint as rank
       from ts_scored qualify rank <= {TWO_STAGE_K})
"""

GEO = f"""
geo_t as ({GEO_SQL}),
g as (select postal_code,
             coalesce(nullif(address['city'], ''), nullif(address['town'], ''),
                      nullif(address['village'], ''), nullif(address['municipality'], '')) as geo_city,
             coalesce(nullif(address['region'], ''), nullif(address['state'], '')) as geo_region,
             latitude, longitude from geo_t),
enriched as (select c.doc_id, c.name, c.address, c.postal_code, c.price_range, c.cuisine,
                    c.facilities, c.cards, coalesce(g.geo_city, c.city) as city,
                    g.geo_region as region, g.latitude, g.longitude, g.geo_city
             from catalog c left join g using (postal_code))
"""

AVG = f"""
avgp as (select region, avg({_ordinal('price_range')}) as price_numeric
         from enriched where region is not null group by region)
"""

ATTR = "(price_range || ' · ' || cuisine)"


def _strip(x):
    return X._strip_ws(x)


# plain patterns, enough for the given pages; the library reads tokens
FIRST_H1 = r"(?s)<h1[^>]*>(.*?)</h1>"
NAV_BLOCK = r"(?s)<nav[^>]*>(.*?)</nav>"
HREF = r"<a\s[^>]*?href=\"([^\"]*)\""
TAG = r"<[^>]*>"

# The character references that occur in the given pages, '&amp;' last so that
# '&amp;lt;' gives '&lt;'; the library decodes all of them (see tests).
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&euro;", "€"),
    ("&amp;", "&"),
]


def _element_text(x):
    out = f"regexp_replace({x}, {L(TAG)}, '', 'g')"
    for name, char in ENTITIES:
        out = f"replace({out}, {L(name)}, {L(char)})"
    return _strip(out)


PAGE_LINKS = f"""
pl as (select page_id, pos, case when starts_with(href, '/')
              then regexp_extract(url, {L(HOST)}, 1) || href else href end as link
       from (select page_id, url, (generate_subscripts(l, 1) - 1)::bigint as pos, unnest(l) as href
             from (select page_id, url, regexp_extract_all(html, {L(HREF)}, 1) as l from pages)))
"""


def _py_list(col):
    q = ("list_transform(coalesce({c}, []::varchar[]), lambda x: case when contains(x, '''') "
         "and not contains(x, '\"') then '\"' || replace(x, '\\', '\\\\') || '\"' "
         "else '''' || replace(replace(x, '\\', '\\\\'), '''', '\\''') || '''' end)").format(c=col)
    return f"('[' || array_to_string({q}, ', ') || ']')"


MISSING_COLS = [("name", "s"), ("address", "s"), ("city", "s"), ("postal_code", "s"),
                ("price_range", "s"), ("cuisine", "s"), ("facilities", "a"), ("cards", "a"),
                ("region", "s"), ("latitude", "n")]


def _missing_sql():
    parts = []
    for col, kind in MISSING_COLS:
        cond = {"s": f"{col} is null or {col} = ''",
                "a": f"{col} is null or len({col}) = 0",
                "n": f"{col} is null"}[kind]
        parts.append(f"select '{col}' as field, count(*) filter (where {cond})::bigint as missing "
                     f"from enriched")
    return " union all ".join(parts)


ORACLE.update({
    "price_ordinal": f"with {CATALOG} select doc_id, price_range, {_ordinal('price_range')} as price_numeric from catalog",
    "filter_price": f"""with {CATALOG} select doc_id, price_range from catalog
        where {_ordinal('price_range')} between {_band_no(FILTER_BANDS[0])} and {_band_no(FILTER_BANDS[1])}""",
    "filter_contains_all": f"""with {CATALOG}
        select doc_id, array_to_string(facilities, ',') as facilities, array_to_string(cards, ',') as cards
        from catalog where {_has_all('cards', FILTER_CARDS)} and {_has_all('facilities', FILTER_FACILITIES)}""",
    "filter_region": f"with {CATALOG} select doc_id, region from catalog where region in ({', '.join(L(r) for r in FILTER_REGIONS)})",
    "clean_field": f"select doc_id, {X.clean_field('text')} as cleaned from documents",
    "clean_basic": f"select doc_id, {X.clean_basic('text')} as cleaned from documents",
    "field_index": f"with {CATALOG}, {FIELD_INDEX} select field, term, doc_id from fi",
    "field_match_score": f"with {CATALOG}, {FIELD_INDEX}, {REQ_TERMS} select doc_id, score from fs",
    "advanced_search": f"""with {CATALOG}, {FIELD_INDEX}, {REQ_TERMS}
        select doc_id, name, address, city, cuisine, price_range, region, url as website, score
        from fs join catalog using (doc_id) left join pages on page_id = doc_id
        where {_ordinal('price_range')} between {_band_no(REQUEST.price_range[0])} and {_band_no(REQUEST.price_range[1])}
          and {_has_all('cards', REQUEST.cards)} and {_has_all('facilities', REQUEST.facilities)}
          {"and region in (" + ", ".join(L(r) for r in REQUEST.regions) + ")" if REQUEST.regions else ""}
        order by score desc, doc_id limit {ADVANCED_TOP_N}""",
    "composite_score": f"""with {COS_BATCH}, {CATALOG}
        select query_id, doc_id,
               round({_composite('cos.score', 'c.cuisine', 'c.facilities', 'c.price_range')}, 6) as score
        from cos left join catalog c using (doc_id)""",
    "two_stage_search": f"""with {COS_BATCH}, {CATALOG}, {CONJ}, {TWO_STAGE}
        select r.query_id, r.doc_id, {SHOWN.replace('g.url', "coalesce(g.url, 'N/A')")}, r.score, r.rank from ts r {PLACES}""",
    "geo_enrich": f"""with {CATALOG}, {GEO}
        select doc_id, postal_code, city, region, latitude, longitude from enriched""",
    "address_coalesce": f"with {CATALOG}, {GEO} select doc_id, geo_city as city, region from enriched",
    "geo_known": f"""with {CATALOG}, {GEO} select doc_id, latitude, longitude from enriched
        where latitude is not null and longitude is not null""",
    "geo_missing_keys": f"""with {CATALOG}, geo_t as ({GEO_SQL})
        select distinct postal_code from catalog where postal_code is not null
        and postal_code not in (select postal_code from geo_t
                                where latitude is not null and longitude is not null)""",
    "avg_price_by_region": f"with {CATALOG}, {GEO}, {AVG} select region, round(price_numeric, 6) as price_numeric from avgp",
    "region_price_table": f"""with {CATALOG}, {GEO}, {AVG}
        select r.r_regionkey, r.r_name, round(a.price_numeric, 6) as price_numeric
        from region r join avgp a on r.r_name = a.region""",
    "marker_rows": f"""with {CATALOG}, {GEO}
        select doc_id, latitude, longitude,
               concat_ws('<br>', coalesce(name, 'nan'), coalesce(address, 'nan'),
                         coalesce(city, 'nan'), coalesce(region, 'nan')) as popup,
               name as tooltip
        from enriched where latitude is not null and longitude is not null""",
    "semi_by_text": f"""select doc_id from documents
        where text in (select text from documents where doc_id in ({_ranked_ids(QTF_BATCH)}))""",
    "semi_by_id": f"""with {COS_BATCH}, {CATALOG}, {CONJ}, {TWO_STAGE}, {GEO}
        select doc_id, latitude, longitude from enriched where doc_id in (select doc_id from ts)""",
    "split_location": f"""with {CATALOG},
        s as (select doc_id, string_split(concat_ws(', ', address, city, postal_code, region), ',') as p from catalog)
        select doc_id, {_strip('p[1]')} as address, {_strip('p[2]')} as city,
               {_strip('p[3]')} as postal_code, {_strip('p[4]')} as country from s""",
    "price_band": f"with {CATALOG} select doc_id, regexp_extract({ATTR}, '€+', 0) as price_band from catalog",
    "cuisine_label": f"with {CATALOG} select doc_id, {_strip(f'string_split({ATTR}, {L(chr(183))})[-1]')} as cuisine from catalog",
    "missing_report": f"with {CATALOG}, {GEO} {_missing_sql()}",
    "place_union": f"""with {CATALOG}
        select doc_id, name, price_range from catalog where {_ordinal('price_range')} between 1 and 2
        union all
        select doc_id, name, price_range from catalog where {_ordinal('price_range')} between 3 and 4""",
    "page_scan": """select page_id, url, regexp_extract(string_split(url, '/')[-1], '([0-9]+)', 1) as file_no,
        length(html)::bigint as n_chars from pages""",
    "page_bucket": "select page_id, (floor(page_id / 20) + 1)::bigint as bucket from pages",
    "url_sort": """select url, cast(length(digits) as int) as n_digits, digits from (
        select url, case when regexp_full_match(string_split(url, '/')[-1], '[0-9]+')
        then ltrim(string_split(url, '/')[-1], '0') else '1' end as digits from pages)
        order by n_digits, digits, url""",
    "url_dedup": f"with {PAGE_LINKS} select distinct link from pl",
    "url_list": f"with {PAGE_LINKS} select distinct link as url from pl",
    "path_token": """select page_id, upper(left(t, 1)) || lower(substr(t, 2)) as token
        from (select page_id, string_split(string_split(url, '/')[-1], '-')[1] as t from pages)""",
    "page_title": f"select page_id, {_element_text(f'regexp_extract(html, {L(FIRST_H1)}, 1)')} as title from pages",
    "page_links": f"with {PAGE_LINKS} select page_id, pos, link from pl",
    "nav_links": f"""select page_id, (generate_subscripts(k, 1) - 1)::bigint as pos, unnest(k) as href
        from (select page_id, list_slice(l, 1, greatest(len(l) - 1, 0)) as k
              from (select page_id, regexp_extract_all(regexp_extract(html, {L(NAV_BLOCK)}, 1), {L(HREF)}, 1) as l
                    from pages))""",
    "decode_list": f"""with {CATALOG}
        select doc_id, {_py_list('facilities')} as printed, array_to_string(facilities, '|') as decoded
        from catalog""",
})


REQUESTS = f"""
rq as (select n_nationkey::bigint as request_id, {_list(REQUEST_NAMES)}[n_nationkey % {len(REQUEST_NAMES)} + 1] as name,
              '  ' || lower(n_name) || ' ' as city, {_list(REQUEST_CUISINES)}[n_nationkey % {len(REQUEST_CUISINES)} + 1] as cuisine,
              1 + n_nationkey % 2 as low, [3, 4, 4][n_nationkey % 3 + 1] as high,
              case when n_nationkey % 3 = 0 then [] else [r_name, 'ASIA'] end as regions,
              case when n_nationkey % 2 = 0 then ['f'] else [] end as cards,
              case n_nationkey % 5 when 0 then ['r', 'a'] when 1 then ['n'] else [] end as facilities
       from nation join region on n_regionkey = r_regionkey),
rqv as (select request_id, 'name' as field, {X.clean_field('name')} as v from rq
        union all select request_id, 'city', {X.clean_basic('city')} from rq
        union all select request_id, 'cuisine', {X.clean_field('cuisine')} from rq),
rqs as (select request_id, doc_id, count(*)::bigint as score
        from (select request_id, field, unnest({X.words('v')}) as term from rqv) join fi using (field, term)
        group by request_id, doc_id)
"""


def _lower(col):
    return f"list_transform(coalesce({col}, []::varchar[]), lambda x: lower(x))"


ORACLE.update({
    "card_links": f"""with {CATALOG},
        cards as (select doc_id, 0 as inside, case when doc_id % 5 = 1 then null when doc_id % 3 = 0 then 'https://cdn.example/' || doc_id
                         else '{LISTING_HOST}/rest/' || doc_id || '?x=1&y=2' end as link from catalog
                  union all select doc_id, 1, 'https://cdn.example/' || doc_id from catalog where doc_id % 3 = 0 and doc_id % 5 <> 1),
        placed as (select doc_id // {LISTING} as page, link, row_number() over (partition by doc_id // {LISTING} order by doc_id, inside) - 1 as pos from cards)
        select page, pos, link from placed where link is not null""",
    "pagination_links": f"""with {CATALOG}, pages_ as (select distinct doc_id // {LISTING} as page from catalog),
        links as (select page, i - 1 as pos, '{LISTING_HOST}/p/' || i as link from (select page, unnest(range(1, page % 4 + 2)) as i from pages_)
                  union all select page, page % 4 + 1, '{LISTING_HOST}/p/next' || page from pages_)
        select page, 2::bigint as pass, pos, link from links union all
        select page, 1::bigint, pos, link from links where pos < page % 4 + 1""",
    "page_files": """select row_number() over (order by page_id) - 1 as rank, page_id, length(html)::bigint as n_chars, md5(html) as html_md5
        from pages""",
    "field_match_batch": f"with {CATALOG}, {FIELD_INDEX}, {REQUESTS} select request_id, doc_id, score from rqs",
    "advanced_search_batch": f"""with {CATALOG}, {FIELD_INDEX}, {REQUESTS}
        select request_id, row_number() over (partition by request_id order by score desc, doc_id) as rank,
               doc_id, score, c.name, c.address, c.city, c.cuisine, c.price_range, c.region, url as website
        from rqs join catalog c using (doc_id) join rq using (request_id) left join pages on page_id = doc_id
        where {_ordinal('c.price_range')} between low and high and (len(regions) = 0 or list_contains(regions, c.region))
          and list_has_all({_lower('c.cards')}, rq.cards) and list_has_all({_lower('c.facilities')}, rq.facilities)
        qualify rank <= {ADVANCED_TOP_N}""",
})

ORACLE.update({
    "monotone_route": """
with pts as (select l_orderkey as case_id, l_linenumber as x, cast(l_quantity as integer) as y from lineitem),
st as (select case_id, x, y,
              coalesce(lag(x) over w, 0) as px, coalesce(lag(y) over w, 0) as py
       from pts window w as (partition by case_id order by x, y)),
s2 as (select case_id, x, y, (x >= px and y >= py) as ok,
              repeat('R', greatest(x - px, 0)) || repeat('U', greatest(y - py, 0)) as moves from st)
select case_id, case when bool_and(ok) then 'YES' else 'NO' end as answer,
       case when bool_and(ok) then string_agg(moves, '' order by x, y) end as path
from s2 group by case_id
""",
    "route_summary": """
with pts as (select distinct l_partkey as case_id, l_orderkey as x, l_orderkey // 8 + l_linenumber as y from lineitem),
st as (select case_id, x, y, coalesce(lag(x) over w, 0) as px, coalesce(lag(y) over w, 0) as py
       from pts window w as (partition by case_id order by x, y))
select case_id, case when bool_and(x >= px and y >= py) then 'YES' else 'NO' end as answer, count(*)::bigint as n_points,
       case when bool_and(x >= px and y >= py) then sum(x - px + y - py)::bigint end as path_length
from st group by case_id
""",
    "index_roundtrip": f"""
with {TF}, {IDF}, {WEIGHTS}
select term, doc_id, tf, round(weight, 6) as weight from weights
""",
    "place_scan": f"""
with {CATALOG}
select c.doc_id, c.name as restaurantName, c.postal_code as postalCode, c.price_range as priceRange,
       d.text as description, array_to_string(c.facilities, '|') as facilities,
       array_to_string(c.cards, '|') as cards, '' as phoneNumber
from catalog c left join documents d using (doc_id)
""",
    "extract_records": f"""
with {CATALOG}
select doc_id as page_id, name || ' & Co' as restaurantName, coalesce(address, '') as address, coalesce(city, '') as city,
       coalesce(postal_code, '') as postal_code, coalesce(region, '') as country, price_range as priceRange, cuisine as cuisineType,
       case when doc_id % 4 <> 0 then name || ' serves é ' || cuisine else '' end as description,
       array_to_string(list_transform(facilities, lambda x: 'Item ' || x), '|') as facilitiesServices,
       array_to_string(list_transform(cards, lambda x: upper(left(x, 1)) || lower(substr(x, 2))), '|') as creditCards,
       case when doc_id % 3 = 0 then '+39 0' || doc_id else '' end as phoneNumber,
       case when doc_id % 5 <> 0 then 'https://p' || doc_id || '.example/?a=1&b=2' else '' end as website
from catalog
""",
    "extract_places": f"""
select page_id, {_element_text(f'regexp_extract(html, {L(FIRST_H1)}, 1)')} as restaurantName,
       '' as address, null::varchar as city, null::varchar as postal_code, null::varchar as country,
       '' as priceRange, '' as cuisineType, '' as description, '' as facilitiesServices,
       '' as creditCards, '' as phoneNumber, '' as website
from pages
""",
})


# ------------------------------------------------------------- stemming --
# term counts in stems: the rule table's SQL over the distinct terms of documents and queries

RAW_QTF = QTF_BATCH.replace("qtf as", "qraw as")
STEM_TF = f"""
{TF.replace('tf as', 'raw as')}, {RAW_QTF},
stems as materialized (select term, {stem_sql('term', 'duckdb')} as stem
                       from (select term from raw union select term from qraw)),
tf as (select doc_id, stem as term, sum(tf)::bigint as tf from raw join stems using (term) group by doc_id, stem)
"""
STEM_QTF = "qtf as (select query_id, stem as term, sum(tf)::bigint as tf from qraw join stems using (term) group by query_id, stem)"
STEM_IDF = IDF.replace("having sum(tf)", "having length(term) >= 2 and sum(tf)")
# the vocabulary of stems that are normalised and stemmed once more
TWO_PASS_IDF = f"""
again as materialized (select term, {stem_sql('term', 'duckdb')} as stem
  from (select distinct term from tf where regexp_full_match(term, {X.lit(X.T.TOKEN_RULE[1:-1])}) and not list_contains({X.ENGLISH}, term))),
vocab2 as (select stem as term from tf join again using (term) group by stem
           having sum(tf) between {VOCAB_MIN_CF} and greatest({VOCAB_MAX_CF}, {VOCAB_MAX_PER_DOC} * (select count(*) from documents))),
idf as (select term, ln((1 + n) / (1 + df)) + 1 as idf
        from (select term, count(*) as df from tf where term in (select term from vocab2) group by term having length(term) >= 2) s,
             (select count(*)::double as n from documents) c)
"""

ORACLE.update({
    "stem_dictionary": f"with {TF} select term, {stem_sql('term', 'duckdb')} as stem from (select distinct term from tf)",
    "normalized_text_stemmed": f"""
with tok as (select doc_id, generate_subscripts(l, 1) as pos, unnest(l) as term from (select doc_id, {NORM} as l from documents)),
stems as materialized (select term, {stem_sql('term', 'duckdb')} as stem from (select distinct term from tok)),
said as (select doc_id, string_agg(stem, ' ' order by pos) as normalized from tok join stems using (term) group by doc_id)
select doc_id, coalesce(normalized, '') as normalized from documents left join said using (doc_id)
""",
    "conjunctive_search_stemmed": f"""
with {STEM_TF}, {CATALOG},
q as (select distinct query_id, stem as term from qraw join stems using (term)),
hits as (select q.query_id, tf.doc_id, tf.term from tf join q using (term)),
known as (select query_id, count(distinct term) as n_known from hits group by query_id),
m as (select query_id, doc_id, count(*) as n_hit from hits group by query_id, doc_id),
r as (select query_id, doc_id from m join known using (query_id) where n_hit = n_known)
select r.query_id, r.doc_id, {SHOWN} from r {PLACES}
""",
    "ranked_search_stemmed": _ranked(STEM_QTF, STEM_TF, STEM_IDF),
    "ranked_search_two_pass": _ranked(STEM_QTF, STEM_TF, TWO_PASS_IDF),
})
