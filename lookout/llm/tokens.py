"""Token ids of whole texts by the tokenizers library, at word-cache speed.

Both vocabularies split a text into words before any merge, so the ids of a
text are the ids of its words in a row. A text is cut at places where the
vocabulary's own splitting rule always cuts, each distinct piece goes through
the library once per cache generation, and the rest is a dictionary lookup.
Texts for which the cut can't be shown to be safe (a special token's string,
characters whose normalisation needs context) go through the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable

CACHE_WORDS = 120_000
ID_CACHE_WORDS = 300_000         # serialised ids are short, so more words fit

# White space as the tokenizers' pattern engine sees it (the Unicode property).
_WIDE = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPACE = "\t-\r " + _WIDE
_BYTE_PIECE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# The common layout: single spaces and single line feeds between words.
_BYTE_ODD = re.compile(f"[\t\x0b-\r{_WIDE}]| [ \n]|\n[ \n]")
# Lower case and NFC are per character below this bound (U+0130 left out), and
# the four separators are white space to Python only.
_WORD_ODD = re.compile(f"[\x1c-\x1f{chr(0x130)}{chr(0x250)}-{chr(0x10FFFF)}]")


class PieceCache:
    """Two generations of at most ``size`` pieces each; frequent pieces are
    carried over, so memory is bounded and common words stay."""

    def __init__(self, encode: Callable[[list[str]], list], size: int = CACHE_WORDS):
        self.encode, self.size = encode, size
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def lookup(self, keys: list[str]) -> list:
        got = list(map(self.new.get, keys))
        if None in got:
            gone = [i for i, v in enumerate(got) if v is None]
            missing = list({keys[i] for i in gone})
            found = {k: v for k in missing if (v := self.old.get(k)) is not None}
            rest = [k for k in missing if k not in found]
            found.update(zip(rest, self.encode(rest)))
            for i in gone:
                got[i] = found[keys[i]]
            if len(self.new) + len(found) > self.size:
                self.old, self.new = self.new, {}
            self.new.update(found)
        return got


class TextEncoder:
    """``encode(texts)`` gives each text's value: its pieces' values joined by
    ``join``. ``pieces`` encodes a list of pieces, ``whole`` one whole text."""

    def __init__(self, pieces: Callable[[list[str]], list], whole: Callable[[str], object],
                 join: Callable[[Iterable], object], specials: list[str], lower: bool, size: int = CACHE_WORDS):
        self.whole, self.join, self.lower = whole, join, lower
        self.specials = specials
        self.raw = PieceCache(pieces, size)
        self.spaced = PieceCache(lambda keys: pieces([k if k[0] == "\n" else " " + k for k in keys]), size)

    def _split(self, text: str) -> tuple[PieceCache, list[str]] | None:
        if any(s in text for s in self.specials):
            return None
        if self.lower:
            return None if _WORD_ODD.search(text) else (self.raw, text.lower().split())
        if not text or text[0] in " \n" or text[-1] in " \n" or _BYTE_ODD.search(text):
            return self.raw, _BYTE_PIECE.findall(text)
        head, *rest = text.replace("\n", " \n").split(" ")
        self._head = head
        return self.spaced, rest

    def encode(self, texts: list[str]) -> list:
        out: list = [None] * len(texts)
        batches: dict[int, tuple[PieceCache, list[str], list[tuple[int, int, int]]]] = {
            id(self.raw): (self.raw, [], []), id(self.spaced): (self.spaced, [], [])}
        heads: list[tuple[int, str]] = []
        for i, text in enumerate(texts):
            cut = self._split(text)
            if cut is None:
                out[i] = self.whole(text)
                continue
            cache, keys = cut
            _, flat, places = batches[id(cache)]
            places.append((i, len(flat), len(flat) + len(keys)))
            flat.extend(keys)
            if cache is self.spaced:
                heads.append((i, self._head))
        first = dict(zip((i for i, _ in heads), self.raw.lookup([h for _, h in heads]))) if heads else {}
        for cache, flat, places in batches.values():
            values = cache.lookup(flat) if flat else []
            for i, a, b in places:
                part = values[a:b]
                if i in first:
                    part.insert(0, first[i])
                out[i] = self.join(part)
        return out


def library(path: str):
    """The tokenizer of a vocabulary file, without worker threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def specials(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


def byte_alphabet() -> dict[int, str]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1
    bytes stand for themselves, the others for U+0100 upwards in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


_ALPHABET = byte_alphabet()
_MARKS = ".,!?;:"


def word_pieces(tok, lower: bool) -> Callable[[list[str]], list[bytes]]:
    """Encoder of pieces to serialised ids. A piece of letters, but for a
    leading space or line feed and one mark at its end, is one word to the
    splitting rule and goes straight to the library's merge model; any other
    piece takes the library's whole way."""
    def plain(keys: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tok.encode_batch_fast(keys, add_special_tokens=False)]

    merge = tok.model.tokenize
    fixed = dict(zip([*_MARKS, "\n"], plain([*_MARKS, "\n"])))
    fixed[""] = b""

    def pieces(keys: list[str]) -> list[bytes]:
        out: list = [None] * len(keys)
        rest = []
        for i, key in enumerate(keys):
            lead = "" if lower or key[0] not in " \n" else key[0]
            word, mark = (key[len(lead):-1], key[-1]) if key[-1] in _MARKS else (key[len(lead):], "")
            if not word.isalpha():
                rest.append(i)
                continue
            if not word.isascii():
                word = word.encode("utf-8").decode("latin-1").translate(_ALPHABET)
            if lead == " ":
                word = _ALPHABET[32] + word
            ids = array("I", [t.id for t in merge(word)]).tobytes() + fixed[mark]
            out[i] = fixed["\n"] + ids if lead == "\n" else ids
        for i, ids in zip(rest, plain([keys[i] for i in rest])):
            out[i] = ids
        return out

    return pieces


_ENCODERS: dict[tuple[str, bool], TextEncoder] = {}


def id_encoder(path: str, lower: bool) -> TextEncoder:
    """Encoder to little-endian unsigned 32-bit ids, one per worker process.
    ``lower``: the vocabulary lower-cases and drops white space."""
    if (path, lower) not in _ENCODERS:
        tok = library(path)

        def whole(text: str) -> bytes:
            return array("I", tok.encode(text, add_special_tokens=False).ids).tobytes()

        _ENCODERS[path, lower] = TextEncoder(word_pieces(tok, lower), whole, b"".join, specials(tok), lower, ID_CACHE_WORDS)
    return _ENCODERS[path, lower]


def slices(texts: list[str], chars: int = 500_000) -> Iterable[tuple[int, int]]:
    """Ranges of ``texts`` of about ``chars`` characters, for bounded memory."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= chars:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
