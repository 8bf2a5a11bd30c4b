"""Place records: field splitting, attribute extraction, list text codecs
and the missing-value report (H4..H6, H9, H11, L1, L2). All are Catalyst
expressions over columns; nothing runs in Python."""

from __future__ import annotations

import sys
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

LOCATION_PARTS = ("address", "city", "postal_code", "country")


def split_location(col: Column, strict: bool = False, from_end: bool = False) -> list[Column]:
    """H4: ``address, city, postal code, country`` from one comma-separated
    location string, by position.

    A missing part is null (the original raised). ``strict`` keeps the blanks
    around parts exactly as split; the default trims them. ``from_end`` reads
    the last three parts from the right and keeps everything before them as
    the address, so an address containing a comma stays whole."""
    parts = F.split(F.coalesce(col, F.lit("")), ",")
    if from_end:
        n = F.size(parts)
        address = F.array_join(F.slice(parts, 1, F.greatest(n - 3, F.lit(1))), ",")
        values = [address] + [F.get(parts, n - k) for k in (3, 2, 1)]
        values[0] = F.when(n >= 4, address).otherwise(F.get(parts, 0))
    else:
        values = [F.get(parts, i) for i in range(4)]
    if not strict:
        values = [strip(v) for v in values]
    return [v.alias(name) for v, name in zip(values, LOCATION_PARTS)]


def price_band(col: Column) -> Column:
    """H5: the first run of euro signs, or ''."""
    return F.regexp_extract(F.coalesce(col, F.lit("")), "€+", 0)


def cuisine_label(col: Column) -> Column:
    """H6: text after the last middle dot, stripped."""
    return strip(F.element_at(F.split(F.coalesce(col, F.lit("")), "·"), -1))


def capitalize(col: Column) -> Column:
    """First character upper case, the rest lower case."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substr(col, F.lit(2))))


def path_token(col: Column) -> Column:
    """H9: last path part of a URL, up to its first '-', capitalised (card
    names from image paths)."""
    last = F.substring_index(F.coalesce(col, F.lit("")), "/", -1)
    return capitalize(F.substring_index(last, "-", 1))


# ------------------------------------------------------------ list codec --

# FIXED VALUES -- what follows a backslash in a Python string literal, and the character meant.
SIMPLE_ESCAPES = {"\n": "", "\\": "\\", "'": "'", '"': '"', "a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t",
                  "v": "\v"}
LITERAL = r"""(?s:'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+")"""
LIST_TEXT = rf"^\s*\[\s*(?:{LITERAL}(?:\s*,\s*{LITERAL})*+\s*,?)?\s*\]\s*$"
ESCAPE = r"(?s:\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|N\{[^}]*\}|[0-7]{1,3}|.))"


def _replaced(text: Column, pattern: str, change) -> Column:
    """Every match of ``pattern`` replaced by ``change(match)``, once, from left to right."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(between, found, lambda t, m: F.concat(t, F.coalesce(change(m), F.lit(""))))
    return F.when(text.rlike(pattern), F.array_join(parts, "")).otherwise(text)


def _code_point(number: Column) -> Column:
    """The character of a number; U+FFFD for numbers that are none."""
    valid = (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    # a byte order mark first, so that the number U+FEFF isn't taken for one
    bytes_ = F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(number), 8, "0")))
    return F.when(valid, F.decode(bytes_, "UTF-32")).otherwise(F.lit(chr(0xFFFD)))


def _unescaped(escape: Column) -> Column:
    """The text that one escape sequence of a string literal stands for; an unknown one stays."""
    kind, rest = F.substr(escape, F.lit(2), F.lit(1)), F.substr(escape, F.lit(3))
    simple = F.create_map(*[F.lit(x) for pair in SIMPLE_ESCAPES.items() for x in pair])
    octal = F.conv(F.substr(escape, F.lit(2)), 8, 10).cast("bigint")
    named = F.try_reflect(F.lit("java.lang.Character"), F.lit("codePointOf"), F.substr(rest, F.lit(2), F.length(rest) - 2))
    return F.when(escape.rlike(r"^\\[xuU][0-9a-fA-F]+$"), _code_point(F.conv(rest, 16, 10).cast("bigint"))) \
        .when(escape.rlike(r"^\\[0-7]"), _code_point(octal)) \
        .when(escape.rlike(r"^\\N\{"), F.coalesce(_code_point(named.cast("bigint")), escape)) \
        .otherwise(F.coalesce(F.try_element_at(simple, kind), escape))


def decode_list(col: Column) -> Column:
    """L1: a printed Python list of strings -> ``array<string>``; null, '' or
    ``nan`` -> empty array; text that is no such list -> null, so it can be counted. Both quotes and
    all escapes of string literals are read (``\\n``, ``\\xNN``, ``\\uNNNN``, ``\\UNNNNNNNN``, ``\\N{name}``,
    octal), and raw control characters; nothing is evaluated."""
    literals = F.regexp_extract_all(col, F.lit(LITERAL), F.lit(0))
    items = F.transform(literals, lambda x: _replaced(F.substr(x, F.lit(2), F.length(x) - 2), ESCAPE, _unescaped))
    none = F.array().cast("array<string>")
    return F.when(col.isNull() | F.trim(col).isin("", "nan"), none).when(col.rlike(LIST_TEXT), items)


@cache
def _unprintable() -> str:
    """A character class of what Python doesn't print as it is, by its own rule."""
    ranges, start = [], None
    for code in range(sys.maxunicode + 2):
        hidden = code <= sys.maxunicode and not chr(code).isprintable() and not 0xD800 <= code <= 0xDFFF
        if hidden and start is None:
            start = code
        elif not hidden and start is not None:
            ranges.append(rf"\x{{{start:x}}}-\x{{{code - 1:x}}}")
            start = None
    return f"[{''.join(ranges)}]"


def encode_list(col: Column) -> Column:
    """L2: ``array<string>`` -> the text Python prints for a list of str."""
    def hidden(char: Column) -> Column:
        code = F.lower(F.hex(F.encode(char, "UTF-32")))
        return F.when(char == "\n", "\\n").when(char == "\r", "\\r").when(char == "\t", "\\t") \
            .when(code.startswith("000000"), F.concat(F.lit("\\x"), F.right(code, F.lit(2)))) \
            .when(code.startswith("0000"), F.concat(F.lit("\\u"), F.right(code, F.lit(4)))).otherwise(F.concat(F.lit("\\U"), code))

    def quote(x: Column) -> Column:
        escaped = _replaced(F.replace(x, F.lit("\\"), F.lit("\\\\")), _unprintable(), hidden)
        double = F.concat(F.lit('"'), escaped, F.lit('"'))
        single = F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.when(x.contains("'") & ~x.contains('"'), double).otherwise(single)

    items = F.transform(F.coalesce(col, F.array().cast("array<string>")), quote)
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def missing_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(field, missing)`` -- per column, how many rows are null,
    empty text or an empty list. One aggregation pass, then unpivot."""
    cols = columns or df.columns
    types = dict(df.dtypes)

    def is_missing(c):
        t = types[c]
        if t.startswith("array"):
            return F.col(c).isNull() | (F.size(F.col(c)) == 0)
        if t == "string":
            return F.col(c).isNull() | (F.col(c) == "")
        return F.col(c).isNull()

    counts = df.agg(*[F.count_if(is_missing(c)).cast("bigint").alias(c) for c in cols])
    return counts.unpivot([], cols, "field", "missing")
