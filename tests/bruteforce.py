"""Plain-Python evaluation of the library's definitions, for small inputs.

Uses the same pattern constants as the Spark expressions (through the
``regex`` module, which understands ``\\p{L}`` and ``\\x{..}``), so a
difference points at the Spark plumbing (joins, aggregation, ranking)."""

from __future__ import annotations

import math
from collections import Counter

import porter2
import regex

from lookout.functions import text as T
from lookout.functions.stopwords import ENGLISH_STOP_WORDS

STOP = set(ENGLISH_STOP_WORDS)


def _py(pattern):
    # Java/RE2 write a code point as \x{85}; Python regex wants \u0085
    py = regex.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: "\\u%04X" % int(m.group(1), 16), pattern)
    return regex.compile(py)


def _repl(group):
    return " " if group is None else " \\" + str(group)


def tokenizer_text(text):
    out = _py(T.ZERO_WORD).sub(r"\1", (text or "").lower())
    for pattern, group in T.TOKENISER_STEPS:
        out = _py(pattern).sub(_repl(group), out)
    return out


def tokens(text):
    pieces = [p for p in _py(T.SPLIT_RE).split(tokenizer_text(text))]
    rule = _py(T.TOKEN_RULE)
    return [p for p in pieces if p and rule.match(p) and p not in STOP]


def stemmed(text):
    return [porter2.stem(t) for t in tokens(text)]


def conjunctive(docs: dict, queries: dict, stem=True):
    f = stemmed if stem else tokens
    sets = {d: set(f(t)) for d, t in docs.items()}
    vocab = set().union(*sets.values()) if sets else set()
    out = set()
    for q, text in queries.items():
        known = set(f(text)) & vocab
        if not known:
            continue
        for d, s in sets.items():
            if known <= s:
                out.add((q, d))
    return out


def tfidf(docs: dict, stem=True, min_cf=2, max_cf=1900):
    f = stemmed if stem else tokens
    counts = {d: Counter(t for t in f(text) if len(t) >= 2 or not stem) for d, text in docs.items()}
    cf, df = Counter(), Counter()
    for c in counts.values():
        cf.update(c)
        df.update(c.keys())
    n = len(docs)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in cf if min_cf <= cf[t] <= max_cf}
    weights = {}
    for d, c in counts.items():
        w = {t: tf * idf[t] for t, tf in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        weights[d] = {t: v / norm for t, v in w.items()} if norm else {}
    return idf, weights


def ranked(docs: dict, queries: dict, k=5, stem=True):
    f = stemmed if stem else tokens
    idf, weights = tfidf(docs, stem)
    out = {}
    for q, text in queries.items():
        c = Counter(t for t in f(text) if t in idf)
        w = {t: tf * idf[t] for t, tf in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        if not norm:
            out[q] = []
            continue
        w = {t: v / norm for t, v in w.items()}
        scores = {}
        for d, dw in weights.items():
            s = sum(w[t] * dw[t] for t in w if t in dw)
            if any(t in dw for t in w):
                scores[d] = round(s, 6)
        out[q] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out
