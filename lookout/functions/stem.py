"""English Snowball (Porter2) stemming (T7) as a rule table compiled to SQL expressions.

Written from the published algorithm definition (snowballstem.org, "The English (Porter2)
stemming algorithm"). The steps are data; :func:`stem_sql` compiles them to one
expression, which Spark evaluates inside Catalyst, and in the other dialect
DuckDB: the longest suffix of a step that a word ends with decides, and applies if its
condition holds. Values that are used often (the word after each step, the starts of
the regions R1 and R2) are bound once by a one-element array transform.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES -- exceptional forms of the published algorithm (word: stem).
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
# FIXED VALUES -- words left alone after step 1a.
STEP1A_INVARIANTS = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
# FIXED VALUES -- prefixes whose end is taken as the start of R1.
R1_PREFIXES = ("gener", "commun", "arsen")
QUOTE = "'"
TAKEN = "\u0001"                # marks a word that lost a suffix in step 1b
VOWEL, OTHER = "[aeiouy]", "[^aeiouy]"
# a vowel is followed by a letter that closes a short syllable at the word's end
SHORT_END = f"({OTHER}{VOWEL}[^aeiouywxY]|^{VOWEL}{OTHER})$"


@dataclass(frozen=True)
class Rule:
    """``suffix`` becomes ``to`` if it begins in ``region`` and the text before it matches ``before``;
    else it becomes ``orelse`` (None: it stays)."""
    suffix: str
    to: str
    region: str = ""                 # "", "R1" or "R2"
    before: str = ""                 # a regular expression on what stands before the suffix
    orelse: str | None = None


def _rules(region: str, pairs: str, before: str = "") -> list[Rule]:
    """Rules from words ``suffix:replacement``."""
    return [Rule(*p.split(":"), region, before) for p in pairs.split()]


# FIXED VALUES -- the suffix steps of the published algorithm.
STEP0 = _rules("", "'s': 's: ':")
STEP1A = [Rule("sses", "ss"), Rule("ied", "i", before="..$", orelse="ie"), Rule("ies", "i", before="..$", orelse="ie"),
          Rule("us", "us"), Rule("ss", "ss"), Rule("s", "", before=f"{VOWEL}.+$")]
STEP1B = [Rule("eedly", "ee", "R1"), Rule("eed", "ee", "R1"), *[Rule(x, TAKEN, before=VOWEL) for x in ("ingly", "edly", "ing", "ed")]]
STEP1B_AFTER = [*[Rule(x + TAKEN, x + "e") for x in ("at", "bl", "iz")], *[Rule(f"{c}{c}{TAKEN}", c) for c in "bdfgmnprt"]]
STEP1C = [Rule("y", "i", before=f".{OTHER}$"), Rule("Y", "i", before=f".{OTHER}$")]
STEP2 = [*_rules("R1", "ization:ize ational:ate fulness:ful ousness:ous iveness:ive tional:tion biliti:ble lessli:less "
                       "entli:ent ation:ate alism:al aliti:al ousli:ous iviti:ive fulli:ful enci:ence anci:ance abli:able "
                       "izer:ize ator:ate alli:al bli:ble"),
         Rule("ogi", "og", "R1", "l$"), Rule("li", "", "R1", "[cdeghkmnrt]$")]
STEP3 = [*_rules("R1", "ational:ate tional:tion alize:al icate:ic iciti:ic ical:ic ness: ful:"), Rule("ative", "", "R2")]
STEP4 = [*_rules("R2", "ement: ance: ence: able: ible: ment: ant: ent: ism: ate: iti: ous: ive: ize: al: er: ic:"),
         Rule("ion", "", "R2", "[st]$")]


class Dialect:
    """What Spark's and DuckDB's SQL spell differently."""

    def __init__(self, name: str):
        self.spark = name == "spark"
        self._n = 0

    def let(self, value: str, body) -> str:
        """``body(name)`` with ``value`` bound to the name."""
        self._n += 1
        x = f"w{self._n}"
        if self.spark:
            return f"transform(array({value}), {x} -> {body(x)})[0]"
        return f"list_transform([{value}], lambda {x}: {body(x)})[1]"

    def quoted(self, text: str) -> str:
        return "'" + text.replace("'", "\\'" if self.spark else "''") + "'"

    def matches(self, value: str, pattern: str) -> str:
        return f"({value} rlike '{pattern}')" if self.spark else f"regexp_matches({value}, '{pattern}')"

    def replace_all(self, value: str, pattern: str, to: str) -> str:
        return f"regexp_replace({value}, '{pattern}', '{to.replace(chr(92), '$')}')" if self.spark \
            else f"regexp_replace({value}, '{pattern}', '{to}', 'g')"


def _ends(d: Dialect, w: str, suffix: str) -> str:
    return f"right({w}, {len(suffix)}) = {d.quoted(suffix)}"


def _step(d: Dialect, w: str, rules: list[Rule], p1: str, p2: str) -> str:
    """``w`` after one step: the rule of the longest suffix that it ends with."""
    cases = []
    for r in sorted(rules, key=lambda r: -len(r.suffix)):
        stem = f"left({w}, length({w}) - {len(r.suffix)})"
        holds = []
        if r.region:
            holds.append(f"length({w}) - {len(r.suffix)} >= {p1 if r.region == 'R1' else p2}")
        if r.before:
            holds.append(d.matches(stem, r.before))
        other = w if r.orelse is None else f"{stem} || {d.quoted(r.orelse)}"
        out = f"{stem} || {d.quoted(r.to)}"
        cases.append(f"when {_ends(d, w, r.suffix)} then " + (f"case when {' and '.join(holds)} then {out} else {other} end" if holds else out))
    return f"case {' '.join(cases)} else {w} end"


def stem_sql(word: str, dialect: str = "spark") -> str:
    """SQL for the stem of the lower-case ``word`` (a column or expression)."""
    d = Dialect(dialect)

    def region(w: str, start: str) -> str:
        """End of the first non-vowel after a vowel, from ``start`` on; the word's length if there is none."""
        found = f"regexp_extract(substr({w}, {start} + 1), '^{OTHER}*{VOWEL}+{OTHER}', 0)"
        return d.let(found, lambda m: f"case when {m} = '' then length({w}) else {start} + length({m}) end")

    def after_1b(w: str, p1: str) -> str:
        """A word whose step 1b took a suffix is marked; what is left is mended."""
        bare = f"left({w}, length({w}) - 1)"
        short = f"{d.matches(bare, SHORT_END)} and {p1} >= length({w}) - 1"
        mended = _step(d, w, STEP1B_AFTER, p1, p1)
        listed = " or ".join(_ends(d, w, r.suffix) for r in STEP1B_AFTER)
        return f"case when not ({_ends(d, w, TAKEN)}) then {w} when {listed} then {mended} when {short} then {bare} || 'e' else {bare} end"

    def step5(w: str, p1: str, p2: str) -> str:
        bare, n = f"left({w}, length({w}) - 1)", f"length({w}) - 1"
        e = f"{n} >= {p2} or ({n} >= {p1} and not {d.matches(bare, SHORT_END)})"
        return (f"case when {_ends(d, w, 'e')} then case when {e} then {bare} else {w} end "
                f"when {_ends(d, w, 'll')} and {n} >= {p2} then {bare} else {w} end")

    def chain(w: str, p1: str, p2: str, steps: list) -> str:
        if not steps:
            return f"replace({w}, 'Y', 'y')"
        first, *rest = steps
        return d.let(first(w), lambda x: chain(x, p1, p2, rest))

    def suffixes(w: str) -> str:
        def with_regions(p1: str, p2: str) -> str:
            table = lambda rules: lambda x: _step(d, x, rules, p1, p2)                            # noqa: E731
            late = [table(STEP1B), lambda x: after_1b(x, p1), table(STEP1C), table(STEP2), table(STEP3), table(STEP4),
                    lambda x: step5(x, p1, p2)]
            kept = ", ".join(map(d.quoted, STEP1A_INVARIANTS))

            def from_1b(x: str) -> str:
                return f"case when {x} in ({kept}) then {x} else {chain(x, p1, p2, late)} end"
            return d.let(table(STEP0)(w), lambda x: d.let(table(STEP1A)(x), from_1b))

        prefixes = " ".join(f"when left({w}, {len(p)}) = {d.quoted(p)} then {len(p)}" for p in R1_PREFIXES)
        return d.let(f"case {prefixes} else {region(w, '0')} end", lambda p1: d.let(region(w, p1), lambda p2: with_regions(p1, p2)))

    def stemmed(w: str) -> str:
        special = " ".join(f"when {w} = {d.quoted(k)} then {d.quoted(v)}" for k, v in EXCEPTIONS.items())
        marked = d.replace_all(f"ltrim({d.quoted(QUOTE)}, {w})" if d.spark else f"ltrim({w}, {d.quoted(QUOTE)})", f"(^|{VOWEL})y", r"\1Y")
        return f"case when length({w}) <= 2 then {w} {special} else {d.let(marked, suffixes)} end"

    return d.let(word, stemmed)


def stem(column: str) -> Column:
    """The stem of a column of lower-case words, evaluated inside Catalyst."""
    return F.expr(stem_sql(f"`{column}`"))
