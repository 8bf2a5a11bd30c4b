"""BPE encoding by a tokenization automaton.

The merge list is compiled into a deterministic automaton over tokens that
accepts exactly the token sequences byte-pair encoding produces. It starts with
one state and a loop for every byte. Each merge ``u v -> w`` applies a merge
gadget: the state reached by ``u`` is split from its class, loses its ``v`` arc
(``u`` and ``v`` never stand side by side again), and every state with a ``u`` arc
gets a ``w`` arc to the state that ``v`` led to. The state after a token depends
on the token alone, so the automaton is an array of target states and a bit
table of the arcs.

A pre-split word is encoded by table-driven transitions: over its bytes, the
token trie proposes arcs, and the automaton keeps the one that is allowed; each
prefix of a word has exactly one accepted sequence, so each position holds one
state. Decoding emits the arcs' labels (the tokens' bytes).

Defined results: null text is empty (no ids, empty decoded text); a special
token's string becomes its id; equal ``doc_id`` and repeated rows give a row
each; null ``doc_id`` stays null; an empty table gives no rows; other columns
are ignored. Words are cached within a fixed bound; a word of any length is
encoded in time linear in its length.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lookout.llm.common import id_text, prepare
from lookout.llm.tokens import TextEncoder, byte_alphabet, library, slices

OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Automaton:
    """Tables of the automaton: ``target[t]`` is the state after token ``t``,
    ``arcs`` has a row of state bits for each token."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        size = max(labels, default=-1) + 1
        made = {w for _, _, w in merges}
        arcs = np.zeros((size, 1 + len({u for u, _, _ in merges}) // 8), "uint8")
        target = np.zeros(size, "int64")
        for t, label in labels.items():
            if len(label) == 1 and t not in made:
                arcs[t, 0] = 1                              # a loop on the first state
        members = {0: 1 + size}                             # how many tokens lead to a state
        n = 1
        for u, v, w in merges:
            s, after = int(target[u]), int(target[v])
            if not arcs[v, s >> 3] >> (s & 7) & 1:
                continue                                    # u v never stand side by side: w is never made
            if members[s] > 1 or u == v:
                if n >> 3 >= arcs.shape[1]:
                    arcs = np.pad(arcs, ((0, 0), (0, arcs.shape[1] // 4 + 1)))
                has = (arcs[:, s >> 3] >> (s & 7)) & 1      # split: a copy of s, reached by u alone
                arcs[:, n >> 3] |= has << (n & 7)
                members[s] -= 1
                members[n], target[u], s, n = 1, n, n, n + 1
            arcs[v, s >> 3] &= 255 ^ (1 << (s & 7))
            arcs[w] = arcs[u]
            target[w] = after
            members[after] = members.get(after, 0) + 1
        self.states = n
        self.row = (n + 7) // 8
        self.arcs = arcs[:, :self.row].tobytes()
        self.target = target.tolist()
        trie: dict[int, int] = {}
        ends: list[int] = [-1]
        for t, label in labels.items():
            node = 0
            for b in label:
                key = node << 8 | b
                if key not in trie:
                    trie[key] = len(ends)
                    ends.append(-1)
                node = trie[key]
            if arcs[t].any():
                ends[node] = t
        self.trie, self.ends = trie, ends

    def encode(self, word: bytes) -> list[int]:
        """The accepted token sequence of one pre-split word.

        Arcs are tried longest first; where no arc goes on, the last one is taken
        back. A prefix has one accepted sequence, so a position that led nowhere
        is never tried again, and time stays linear in the word's length."""
        n = len(word)
        trie, ends, arcs, row, target = self.trie, self.ends, self.arcs, self.row, self.target
        out: list[int] = []
        at, state = 0, 0
        open_: list[tuple[int, int, list]] = []             # (position, state, shorter arcs) of each token in out
        dead: set[int] = set()
        while at < n:
            proposed, node, k = [], 0, at
            while k < n:
                node = trie.get(node << 8 | word[k])
                if node is None:
                    break
                k += 1
                if ends[node] >= 0:
                    proposed.append((ends[node], k))
            while True:
                while proposed:
                    t, end = proposed.pop()
                    if arcs[t * row + (state >> 3)] >> (state & 7) & 1 and end not in dead:
                        break
                else:
                    dead.add(at)
                    at, state, proposed = open_.pop()
                    out.pop()
                    continue
                break
            open_.append((at, state, proposed))
            out.append(t)
            at, state = end, target[t]
        return out


def compile_vocabulary(path: str) -> Automaton:
    """The automaton of a byte-level BPE vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    alphabet, vocab = {c: b for b, c in byte_alphabet().items()}, model["vocab"]
    labels = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items() if all(c in alphabet for c in token)}
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return Automaton(labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])


# letters, numbers and white space of the pre-splitting rule, for the regex module
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def split_words(piece: str) -> list[str]:
    """Pre-split words of a text, as byte-level vocabularies split."""
    import regex
    global _SPLIT
    if "_SPLIT" not in globals():
        # white space is the Unicode property, whatever the engine's \s
        _SPLIT = regex.compile(_WORDS.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
                               .replace(r"\s", r"\p{White_Space}"))
    return _SPLIT.findall(piece)


_LOADED: dict[str, tuple[TextEncoder, list[bytes], list[str]]] = {}


def _loaded(path: str, automaton: Automaton) -> tuple[TextEncoder, list[bytes], list[str]]:
    """Encoder, labels and decimal names of all ids, once per worker process."""
    if path not in _LOADED:
        special = {t.content: i for i, t in library(path).get_added_tokens_decoder().items()}
        labels = [b""] * (max([*automaton.labels, *special.values()]) + 1)
        for i, label in [*automaton.labels.items(), *((i, s.encode()) for s, i in special.items())]:
            labels[i] = label
        cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") \
            if special else None

        def ids(piece: str) -> list[int]:
            # a space and letters are one word to the splitting rule
            words = [piece] if (piece[1:] if piece[0] == " " else piece).isalpha() else split_words(piece)
            return [t for word in words for t in automaton.encode(word.encode("utf-8"))]

        def pieces(keys: list[str]) -> list[bytes]:
            return [array("I", ids(k)).tobytes() for k in keys]

        def whole(text: str) -> bytes:
            return array("I", [t for part in cut.split(text) if part
                               for t in ([special[part]] if part in special else ids(part))]).tobytes()

        _LOADED[path] = (TextEncoder(pieces, whole, b"".join, list(special), lower=False), labels,
                         list(map(str, range(len(labels)))))
    return _LOADED[path]


def decode(ids: list[int], labels: list[bytes]) -> str:
    """The text of the arcs' labels."""
    return b"".join(map(labels.__getitem__, ids)).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """Per document: number of ids and the digests of ids and decoded text;
    ``with_ids`` adds the ids themselves. ``tokenizer``: a vocabulary file."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(compile_vocabulary(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, labels, names = _loaded(tokenizer, shared.value)
        for b in batches:
            docs_, texts = b.column("doc_id"), b.column("text").to_pylist()
            for lo, hi in slices(texts):
                counts, ids_sha, text_sha, kept = [], [], [], []
                for data in encoder.encode(texts[lo:hi]):
                    ids = np.frombuffer(data, "<u4").tolist()
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(decode(ids, labels).encode("utf-8")).hexdigest())
                    if with_ids:
                        kept.append(ids)
                cols = {"doc_id": docs_.slice(lo, hi - lo), "n_tokens": pa.array(counts, pa.int64()),
                        "ids_sha256": pa.array(ids_sha), "decoded_sha256": pa.array(text_sha)}
                if with_ids:
                    cols["ids"] = pa.array(kept, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(cols)

    return id_text(docs).mapInArrow(run, OUT + (", ids array<int>" if with_ids else ""))
