"""English Snowball (Porter2) stemming of a single word in plain Python, written from the
published algorithm definition; the tests hold the compiled rule table against it."""

from __future__ import annotations

VOWELS = frozenset("aeiouy")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = frozenset("cdeghkmnrt")

# FIXED VALUES -- exceptional forms of the published algorithm (word: stem).
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
# FIXED VALUES -- words left alone after step 1a.
STEP1A_INVARIANTS = frozenset(["inning", "outing", "canning", "herring", "earring",
                               "proceed", "exceed", "succeed"])
# FIXED VALUES -- prefixes whose end is taken as the start of R1.
R1_PREFIXES = ("gener", "commun", "arsen")

# FIXED VALUES -- suffix tables of steps 1b..4 (suffix, replacement),
# longest suffix first within each step.
STEP1B = ("eedly", "ingly", "edly", "eed", "ing", "ed")
STEP2 = (("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
         ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
         ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"),
         ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"),
         ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"),
         ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""))
STEP3 = (("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"),
         ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""))
STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate",
         "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")


def _region_start(w: str, start: int) -> int:
    """Index after the first non-vowel that follows a vowel at or after ``start``."""
    for i in range(start + 1, len(w)):
        if w[i] not in VOWELS and w[i - 1] in VOWELS:
            return i + 1
    return len(w)


def _ends_short_syllable(w: str) -> bool:
    if len(w) >= 3:
        return (w[-3] not in VOWELS and w[-2] in VOWELS
                and w[-1] not in VOWELS and w[-1] not in "wxY")
    return len(w) == 2 and w[0] in VOWELS and w[1] not in VOWELS


def _longest(w: str, suffixes):
    for entry in suffixes:
        suffix = entry if isinstance(entry, str) else entry[0]
        if w.endswith(suffix):
            return entry
    return None


def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    w = word.lstrip("'")
    # Mark consonant y: initial y, or y after a vowel, becomes Y.
    chars = list(w)
    for i, c in enumerate(chars):
        if c == "y" and (i == 0 or chars[i - 1] in VOWELS):
            chars[i] = "Y"
    w = "".join(chars)

    p1 = next((len(p) for p in R1_PREFIXES if w.startswith(p)), None)
    if p1 is None:
        p1 = _region_start(w, 0)
    p2 = _region_start(w, p1)

    # Step 0: possessive endings.
    for suffix in ("'s'", "'s", "'"):
        if w.endswith(suffix):
            w = w[: -len(suffix)]
            break

    # Step 1a.
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith(("us", "ss")):
        pass
    elif w.endswith("s"):
        if any(c in VOWELS for c in w[:-2]):
            w = w[:-1]
    if w in STEP1A_INVARIANTS:
        return w.replace("Y", "y")

    # Step 1b.
    suffix = _longest(w, STEP1B)
    if suffix in ("eedly", "eed"):
        if len(w) - len(suffix) >= p1:
            w = w[: -len(suffix)] + "ee"
    elif suffix is not None:
        base = w[: -len(suffix)]
        if any(c in VOWELS for c in base):
            w = base
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif w.endswith(DOUBLES):
                w = w[:-1]
            elif _ends_short_syllable(w) and p1 >= len(w):
                w += "e"

    # Step 1c.
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"

    # Step 2.
    hit = _longest(w, STEP2)
    if hit is not None:
        suffix, repl = hit
        start = len(w) - len(suffix)
        if start >= p1:
            if suffix == "ogi":
                if start > 0 and w[start - 1] == "l":
                    w = w[:start] + repl
            elif suffix == "li":
                if start > 0 and w[start - 1] in LI_ENDINGS:
                    w = w[:start]
            else:
                w = w[:start] + repl

    # Step 3.
    hit = _longest(w, STEP3)
    if hit is not None:
        suffix, repl = hit
        start = len(w) - len(suffix)
        if start >= p1 and (suffix != "ative" or start >= p2):
            w = w[:start] + repl

    # Step 4.
    suffix = _longest(w, STEP4)
    if suffix is not None:
        start = len(w) - len(suffix)
        if start >= p2:
            if suffix == "ion":
                if start > 0 and w[start - 1] in "st":
                    w = w[:start]
            else:
                w = w[:start]

    # Step 5.
    if w.endswith("e"):
        start = len(w) - 1
        if start >= p2 or (start >= p1 and not _ends_short_syllable(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        start = len(w) - 1
        if start >= p2 and len(w) > 1 and w[-2] == "l":
            w = w[:-1]

    return w.replace("Y", "y")
