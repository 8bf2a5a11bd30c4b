"""Text normalisation as Spark column expressions.

Everything here is a Catalyst expression (regexp_replace, split, filter,
array_join, ...) and runs inside whole-stage code generation: no Python
worker is involved. The regular expressions avoid ``\\b``, ``\\w`` and
look-around so that the same pattern means the same thing in Java regex
(Spark) and RE2 (the SQL oracle).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stopwords import COMBINED_STOP_WORDS, ENGLISH_STOP_WORDS

# Whitespace as Python's str.split() sees it (used by the original tokeniser).
WS_CLASS = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = "[" + WS_CLASS + "]"
WORD_CHAR = r"[\p{L}\p{N}_]"
NON_WORD_CHAR = r"[^\p{L}\p{N}_]"

# Words beginning with the digit 0 are deleted before tokenising.
ZERO_WORD = r"(^|" + NON_WORD_CHAR + r")0" + WORD_CHAR + "*"

# Tokeniser chain: (pattern, group kept after a blank, or None).
TOKENISER_STEPS = [
    # punctuation that always stands alone, ellipsis, double dash
    (r"[;@#$%&?!()\[\]{}<>\"“”„«»‘’`*]|\.\.\.|--", None),
    # comma or colon unless it sits before a digit (1,5 stays one token)
    (r"[:,]([^\p{N}]|$)", 1),
    # English clitics split off the word they end
    (r"('s|'m|'d|'ll|'re|'ve|n't)(" + WS + "|$)", 2),
    # opening quotes
    (r"(^|" + WS + ")'+", None),
    # closing quotes and sentence-final dots
    (r"['.]+(" + WS + "|$)", 1),
]

# A kept token: letters and digits only, at least three of them.
TOKEN_RULE = r"^[\p{L}\p{N}]{3,}$"
SPLIT_RE = WS + "+"

# The Spark expressions run Java-only forms of the same rules: they match
# the same text but cost less per character (one predicate call for
# whitespace; a look-behind instead of an alternation with ``^``). The
# portable forms above stay the definition (the SQL oracle runs them), and
# the tests compare both over whole corpora.
J_WS = r"[\p{javaWhitespace}\x{85}\x{A0}\x{2007}\x{202F}]"
J_ZERO_WORD = r"(?<![\p{L}\p{N}_])0[\p{L}\p{N}_]*"
J_TOKENISER_STEPS = [
    (TOKENISER_STEPS[0][0], " "),
    (TOKENISER_STEPS[1][0], " $1"),
    (r"('s|'m|'d|'ll|'re|'ve|n't)(" + J_WS + "|$)", " $2"),
    (r"(?<![^" + J_WS[1:-1] + "])'+", " "),
    (r"['.]+(" + J_WS + "|$)", " $1"),
]
J_SPLIT = J_WS + "+"


def strip_zero_words(col: Column) -> Column:
    """Delete words that start with ``0``."""
    return F.regexp_replace(col, J_ZERO_WORD, "")


def tokenizer_text(col: Column) -> Column:
    """T1 + T2 + tokeniser steps: a lower-cased string whose whitespace
    separated pieces are the raw tokens."""
    out = strip_zero_words(F.lower(F.coalesce(col, F.lit(""))))
    for pattern, replacement in J_TOKENISER_STEPS:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def raw_tokens(col: Column) -> Column:
    """Array of raw tokens, in text order (empty pieces removed)."""
    return F.filter(F.split(tokenizer_text(col), J_SPLIT), lambda t: t != F.lit(""))


def keep_token(t: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """T4 + T6: not a stop word, only letters/digits, longer than two."""
    return t.rlike(TOKEN_RULE) & ~t.isin(list(stop_words))


def normalized_tokens(col: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """T1..T6 as one array expression (before stemming)."""
    return F.filter(F.split(tokenizer_text(col), J_SPLIT),
                    lambda t: keep_token(t, stop_words))


def normalized_text(col: Column) -> Column:
    """T8 without stemming: kept tokens re-joined by single blanks."""
    return F.array_join(normalized_tokens(col), " ")


# ---- field cleaners of the advanced search -------------------------------

FIELD_PUNCT = r"[^\p{L}\p{N}_" + WS_CLASS + "']"


def clean_basic(col: Column) -> Column:
    """Strip + lower; null becomes ''."""
    return F.lower(_strip_ws(F.coalesce(col, F.lit(""))))


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace (Unicode, as str.strip())."""
    return F.regexp_replace(col, "^" + WS + "+|" + WS + "+$", "")


_strip_ws = strip


def clean_field_words(col: Column) -> Column:
    """T9 as an array: lower, strip, drop all but word chars, blanks and
    apostrophes, split on whitespace, drop the combined stop words."""
    text = F.regexp_replace(F.lower(_strip_ws(F.coalesce(col, F.lit("")))), FIELD_PUNCT, "")
    words = F.filter(F.split(text, SPLIT_RE), lambda t: t != F.lit(""))
    return F.filter(words, lambda t: ~t.isin(COMBINED_STOP_WORDS))


def clean_field(col: Column) -> Column:
    """The cleaned field as text."""
    return F.array_join(clean_field_words(col), " ")


def words(col: Column) -> Column:
    """Whitespace split of an already cleaned field (empty pieces dropped)."""
    return F.filter(F.split(F.coalesce(col, F.lit("")), SPLIT_RE), lambda t: t != F.lit(""))


# ---- URL helpers ---------------------------------------------------------

def url_last_segment(col: Column) -> Column:
    return F.element_at(F.split(col, "/"), -1)


def url_sort_key(col: Column) -> Column:
    """The last path segment as a number when it is all digits, else 1.

    The number is given as a struct of its digit count and its digits without
    leading zeros, which orders as the number does at any length."""
    last = url_last_segment(col)
    digits = F.when(last.rlike("^[0-9]+$"), F.regexp_replace(last, "^0+", "")).otherwise(F.lit("1"))
    return F.struct(F.length(digits).alias("n_digits"), digits.alias("digits"))
