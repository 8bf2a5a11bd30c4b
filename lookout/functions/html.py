"""Elements of raw HTML as Catalyst expressions: titles, card links, link lists.

A page is cut into a stream of tokens (tags, text, comments) by one regular
expression, and elements are found by a fold over that stream that keeps the stack of
open tags, as a tolerant parser does: an end tag closes the nearest open element of
its name and what is open inside it, an unknown end tag is ignored, void elements
never open, and ``p``, ``li`` and ``option`` close an open sibling. So unclosed
tags, nested elements, ``>`` in quoted attributes, comments and tags inside scripts
are read as :func:`lookout.operators.extract.parse_page` reads them, without Python."""

from __future__ import annotations

import json
from html import unescape
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Characters by reference name: the published HTML table (names that also stand without
# a semicolon included), and the numbers that stand for another character than their own.
REFERENCES = dict(html5) | {f"#{n}": unescape(f"&#{n};") for n in (0, 13, *range(0x80, 0xA0))}
LONGEST_BARE = max(len(name) for name in html5 if not name.endswith(";"))
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

VOID = "area base br col embed hr img input link meta param source track wbr".split()
SIBLINGS = ["p", "li", "option"]         # opening one closes an open one just around it

ATTRIBUTES = r"""(?:[^'">]++|"[^"]*+"|'[^']*+')*+"""
RAW_TEXT = rf"(?i:<(?:script(?=[\s/>]){ATTRIBUTES}>(?s:.*?)(?=</script|\z)|style(?=[\s/>]){ATTRIBUTES}>(?s:.*?)(?=</style|\z)))"
TOKEN = rf"<!--(?s:.*?)(?:--!?>|\z)|<[!?][^>]*+>|{RAW_TEXT}|</?[A-Za-z]{ATTRIBUTES}>|[^<]++|<"
TAG_NAME = r"^</?([A-Za-z][^\s/>]*)"
ATTRIBUTE = r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
HOST = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)"
ELEMENT = "array<struct<text:string,hrefs:array<string>>>"


# -------------------------------------------------------------- references --

def _character(ref: Column, prefixes: bool) -> Column:
    """The text that a character reference (``&`` included) stands for; an unknown name stays. With
    ``prefixes`` the longest known name that it begins with counts, too."""
    bare = F.rtrim(F.substr(ref, F.lit(2)), F.lit(";"))
    digits = F.when(ref.rlike("^&#[xX]"), F.conv(F.substr(bare, F.lit(3)), 16, 10)) \
        .when(ref.startswith("&#"), F.substr(bare, F.lit(2)))
    number = digits.try_cast("bigint")
    table = F.from_json(F.lit(json.dumps(REFERENCES)), "map<string,string>")
    name = F.substr(ref, F.lit(2))
    named = F.try_element_at(table, name)
    if prefixes:
        named = F.coalesce(named, *[F.when(F.length(name) > n, F.concat(
            F.try_element_at(table, F.substr(name, F.lit(1), F.lit(n))), F.substr(name, F.lit(n + 1))))
            for n in range(LONGEST_BARE, 1, -1)])
    # numbers that stand for nothing: control characters and code points that are no characters
    nothing = number.between(0x1, 0x8) | (number == 0xB) | number.between(0xE, 0x1F) | number.between(0x7F, 0x9F) \
        | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    valid = (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    # a byte order mark first, so that the number U+FEFF isn't taken for one
    own = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(number), 8, "0"))), "UTF-32")
    numbered = F.coalesce(F.try_element_at(table, F.concat(F.lit("#"), number.cast("string"))),
                          F.when(valid & nothing, F.lit("")), F.when(valid, own), F.lit(chr(0xFFFD)))
    return F.when(ref.startswith("&#"), numbered).otherwise(F.coalesce(named, ref))


def decode_entities(col: Column, prefixes: bool = True) -> Column:
    """Every character reference replaced, each once: what a decoded reference
    leaves is not read again, so ``&amp;lt;`` gives ``&lt;``. As in published HTML, old names
    also stand without a semicolon, in running text even before other letters; attribute
    values are read without ``prefixes``, so ``?a=1&copy=2`` stays."""
    between, refs = F.split(col, REFERENCE, -1), F.regexp_extract_all(col, F.lit(REFERENCE), F.lit(0))
    parts = F.zip_with(between, refs, lambda text, ref: F.concat(text, F.coalesce(_character(ref, prefixes), F.lit(""))))
    return F.when(col.contains("&"), F.array_join(parts, "")).otherwise(col)


# ----------------------------------------------------------------- elements --

def tokens(html: Column) -> Column:
    """The page as an array of tokens: tags, comments, scripts and stretches of text."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(TOKEN), F.lit(0))


def _attributes(tag: Column) -> tuple[Column, Column]:
    """Names (lower case) and raw values of a tag's attributes."""
    inner = F.regexp_replace(F.regexp_replace(tag, TAG_NAME, ""), r"/?>$", "")
    names = F.transform(F.regexp_extract_all(inner, F.lit(ATTRIBUTE), F.lit(1)), lambda n: F.lower(n))
    return names, F.regexp_extract_all(inner, F.lit(ATTRIBUTE), F.lit(2))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, references decoded; null when the tag hasn't got it. Of
    repeated attributes the last counts."""
    names, values = _attributes(tag)
    pairs = F.filter(F.arrays_zip(names.alias("n"), values.alias("v")), lambda p: p["n"] == name)
    raw = F.try_element_at(F.transform(pairs, lambda p: p["v"]), F.lit(-1))
    quoted = raw.startswith('"') | raw.startswith("'")
    return decode_entities(F.when(quoted, F.substr(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw),
                           prefixes=False)


def _let(value: Column, body) -> Column:
    """``body(value)``, the value evaluated once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def elements(html: Column, tag: str, class_name: str | None = None, text: bool = False, links: bool = False,
             first: bool = False) -> Column:
    """All elements ``tag`` (with a class, if named) in document order, nested ones included, as an
    array of ``(text, hrefs)``: the text inside, and the ``href`` of each anchor inside that has one.
    ``text`` and ``links`` say which is wanted; ``first`` keeps the first element only."""
    def is_tag(t: Column) -> Column:
        return t.rlike("^</?[A-Za-z]")

    stream = tokens(html) if text else F.filter(tokens(html), is_tag)
    state = F.struct(F.array().cast("array<string>").alias("stack"), F.array().cast("array<struct<depth:int,no:int>>").alias("open"),
                     F.array().cast(ELEMENT).alias("out"))

    def put(s: Column, change) -> Column:
        """The open elements' entries changed."""
        inside = F.transform(s["open"], lambda o: o["no"])
        return F.transform(s["out"], lambda e, i: F.when(F.array_contains(inside, i + 1), change(e)).otherwise(e))

    def moved(s: Column, stack: Column, out: Column | None = None) -> Column:
        """The state with another stack; elements that are no longer on it are closed."""
        return F.struct(stack.alias("stack"), F.filter(s["open"], lambda o: o["depth"] <= F.size(stack)).alias("open"),
                        (s["out"] if out is None else out).alias("out"))

    def linked(s: Column, t: Column, name: Column) -> Column:
        """The anchor's link added to the elements around it."""
        def add(href: Column) -> Column:
            return F.when(href.isNull(), s).otherwise(moved(s, s["stack"], put(s, lambda e: F.struct(
                e["text"].alias("text"), F.concat(e["hrefs"], F.array(href)).alias("hrefs")))))
        return F.when((name == "a") & (F.size(s["open"]) > 0), _let(attribute(t, "href"), add)).otherwise(s)

    def entered(s: Column, t: Column, name: Column) -> Column:
        """The tag's element opened, and listed if it is one of those wanted."""
        wanted = name == tag
        if class_name is not None:
            wanted = F.when(wanted, _let(F.coalesce(attribute(t, "class"), F.lit("")), lambda c: (
                c == class_name) | F.array_contains(F.split(c, r"\s+"), class_name))).otherwise(F.lit(False))
        if first:
            wanted = (F.size(s["out"]) == 0) & wanted
        holds = ~name.isin(VOID) & ~t.endswith("/>")
        entry = F.array(F.struct(F.lit("").alias("text"), F.array().cast("array<string>").alias("hrefs")))
        mark = F.array(F.struct((F.size(s["stack"]) + 1).alias("depth"), (F.size(s["out"]) + 1).alias("no")))
        return _let(wanted, lambda w: F.struct(
            F.when(holds, F.concat(s["stack"], F.array(name))).otherwise(s["stack"]).alias("stack"),
            F.when(w & holds, F.concat(s["open"], mark)).otherwise(s["open"]).alias("open"),
            F.when(w, F.concat(s["out"], entry)).otherwise(s["out"]).alias("out")))

    def opened(s: Column, t: Column, name: Column) -> Column:
        sibling = name.isin(SIBLINGS) & (F.try_element_at(s["stack"], F.lit(-1)) == name)
        start = F.when(sibling, moved(s, F.slice(s["stack"], 1, F.size(s["stack"]) - 1))).otherwise(s)
        if not links:
            return _let(start, lambda x: entered(x, t, name))
        return _let(start, lambda x: _let(linked(x, t, name), lambda y: entered(y, t, name)))

    def closed(s: Column, name: Column) -> Column:
        return _let(F.array_position(F.reverse(s["stack"]), name).cast("int"), lambda back: F.when(back == 0, s).otherwise(
            moved(s, F.slice(s["stack"], 1, F.size(s["stack"]) - back))))

    def said(s: Column, words: Column) -> Column:
        return F.when(F.size(s["open"]) == 0, s).otherwise(_let(words, lambda w: moved(s, s["stack"], put(
            s, lambda e: F.struct(F.concat(e["text"], w).alias("text"), e["hrefs"].alias("hrefs"))))))

    def tagged(s: Column, t: Column, name: Column) -> Column:
        return F.when(t.startswith("</"), closed(s, name)).otherwise(opened(s, t, name))

    def step(s: Column, t: Column) -> Column:
        tag_step = _let(F.lower(F.regexp_extract(t, TAG_NAME, 1)), lambda name: tagged(s, t, name))
        if not text:
            return tag_step
        script = F.lower(F.regexp_extract(t, TAG_NAME, 1)).isin("script", "style") & ~t.startswith("</")
        body = F.regexp_replace(t, f"^<[A-Za-z]{ATTRIBUTES}>", "")
        return F.when(script, _let(tagged(s, F.lit("<script>"), F.lower(F.regexp_extract(t, TAG_NAME, 1))), lambda x: said(x, body))) \
            .when(is_tag(t), tag_step).when(t.startswith("<!") | t.startswith("<?"), s).otherwise(said(s, decode_entities(t)))

    return F.aggregate(stream, state, step)["out"]


def first_h1_text(html: Column) -> Column:
    """H3: stripped text of the first ``h1``; '' when there is none."""
    found = elements(html, "h1", text=True, first=True)
    return strip(F.coalesce(F.get(F.transform(found, lambda e: e["text"]), F.lit(0)), F.lit("")))


def hrefs(html: Column) -> Column:
    """``href`` values of all anchors of a page or fragment, in document order."""
    anchors = F.filter(tokens(html), lambda t: t.rlike(r"^<[aA](?=[\s/>])"))
    return F.array_compact(F.transform(anchors, lambda t: attribute(t, "href")))


def card_hrefs(html: Column, class_name: str, tag: str = "div") -> Column:
    """H1: the first link of every card (element of that class), null for a card without one."""
    return F.transform(elements(html, tag, class_name, links=True), lambda e: F.get(e["hrefs"], F.lit(0)))


def list_hrefs(html: Column, class_name: str | None = None, tag: str = "ul", drop_last: bool = False) -> Column:
    """H2: the links of the first list of that class (or of that tag alone). The first pass over the
    listing drops the last one, the 'next' arrow; the pass over each page keeps all."""
    found = elements(html, tag, class_name, links=True, first=True)
    links = F.coalesce(F.get(F.transform(found, lambda e: e["hrefs"]), F.lit(0)), F.array().cast("array<string>"))
    return F.slice(links, 1, F.greatest(F.size(links) - 1, F.lit(0))) if drop_last else links


def nav_hrefs(html: Column) -> Column:
    """The links of the first ``nav``."""
    return list_hrefs(html, tag="nav")


def host_of(url: Column) -> Column:
    """``scheme://host`` of a URL."""
    return F.regexp_extract(url, HOST, 1)


def absolute(href: Column, host: Column) -> Column:
    """A link from the root of its site gets the page's host, one without a scheme
    (``//cdn.example/x``) the page's scheme; any other stays."""
    return F.when(href.startswith("//"), F.concat(F.regexp_extract(host, "^[^/]*", 0), href)) \
        .when(href.startswith("/"), F.concat(host, href)).otherwise(href)
