"""Token store, packing and BPE automaton against the tokenizers library."""
import hashlib
import zlib
from array import array
from collections import defaultdict

import pytest

from lookout.llm import bpe_automaton, packing, token_store
from lookout.llm.queries import QUERIES, tokenizer
from lookout.llm.tokens import library


def le(ids):
    return array("I", ids).tobytes()


def want_ids(rows, name):
    tok = library(tokenizer(name))
    return [(r[0], tok.encode(r[1] or "", add_special_tokens=False).ids) for r in rows]


@pytest.fixture(scope="module")
def small_rows(spark, sf_small):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]


def check_store(spark, df, rows, folder):
    got = [tuple(r) for r in token_store.read_store(spark, folder).collect()]
    want = [(d, ids + [1]) for d, ids in want_ids(rows, "word_bpe_49k.json")]
    assert sorted((str(d), n, c) for d, _, n, c in got) == sorted((str(d), len(x), zlib.crc32(le(x))) for d, x in want)
    at = 0
    for d, start, n, _ in sorted(got, key=lambda r: r[1]):
        assert start == at
        at += n
    known = [d for d, *_ in sorted(got, key=lambda r: r[1]) if d is not None]
    assert known == sorted(known)


def test_token_store(spark, odd_docs, odd_rows):
    folder = token_store.write_store(odd_docs, tokenizer("word_bpe_49k.json"), True, 1)
    check_store(spark, odd_docs, odd_rows, folder)
    want = dict(want_ids(odd_rows[:17], "word_bpe_49k.json"))
    assert token_store.read_document(spark, folder, 13) == [want[13] + [1]]
    assert len(token_store.read_document(spark, folder, 6)) == 3          # repeated rows
    assert token_store.read_document(spark, folder, 999) == []


def test_token_store_empty(spark, no_docs):
    folder = token_store.write_store(no_docs, tokenizer("word_bpe_49k.json"), True, 1)
    assert token_store.read_store(spark, folder).collect() == []


def test_op2(spark, sf_small, small_rows):
    got = {r.doc_id: r for r in QUERIES["op2_token_store"](spark, sf_small).collect()}
    at = 0
    for d, ids in sorted(want_ids(small_rows, "word_bpe_49k.json")):
        ids = ids + [1]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(le(ids)))
        at += len(ids)


def check_packed(got, want, capacity):
    pieces = defaultdict(list)
    for r in got:
        pieces[str(r.doc_id)].append((r.piece, r.start, r.length, r.ids_crc32))
    expect = defaultdict(list)
    for d, ids in want:
        n, first = len(ids), len(ids) % capacity or capacity
        edges = [0, n] if n <= capacity else [0, *range(first, n + 1, capacity)]
        expect[str(d)] += [(k, a, b - a, zlib.crc32(le(ids[a:b]))) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    assert {d: sorted(p) for d, p in pieces.items()} == {d: sorted(p) for d, p in expect.items()}
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, odd_docs, odd_rows, no_docs):
    args = tokenizer("byte_bpe_50k.json"), False, 0, 64
    want = [(d, ids + [0]) for d, ids in want_ids(odd_rows, "byte_bpe_50k.json")]
    got = packing.pack_documents(odd_docs, *args, with_ids=True).collect()
    check_packed(got, want, 64)
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in got)
    assert packing.pack_documents(no_docs, *args).collect() == []


def test_op7_is_nearly_full(spark, sf_small, small_rows):
    got = QUERIES["op7_packing"](spark, sf_small).collect()
    want = [(d, ids + [0]) for d, ids in want_ids(small_rows, "byte_bpe_50k.json")]
    made = check_packed(got, want, 2048)
    assert made <= 1 + -(-sum(len(x) for _, x in want) // 2048)


def test_best_fit_closes_the_fullest():
    b = packing.BestFit(10, 2)
    assert [b.place(x) for x in (4, 7, 8)] == [(0, 0), (1, 0), (2, 0)]    # bin 1 (3 free) closes for bin 2
    assert b.place(3) == (0, 4) and b.place(2) == (2, 8) and b.place(3) == (0, 7)


def check_encoded(got, rows):
    tok = library(tokenizer("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(str(d), len(x), sha(",".join(map(str, x))), sha(tok.decode(x, skip_special_tokens=False)))
            for d, x in want_ids(rows, "byte_bpe_50k.json")]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)


def test_automaton(spark, odd_docs, odd_rows, no_docs):
    check_encoded(bpe_automaton.encode_decode(odd_docs, tokenizer("byte_bpe_50k.json")).collect(), odd_rows)
    assert bpe_automaton.encode_decode(no_docs, tokenizer("byte_bpe_50k.json")).collect() == []


def test_op8(spark, sf_small, small_rows):
    check_encoded(QUERIES["op8_bpe"](spark, sf_small).collect(), small_rows)


def merge_words(word, merges):
    """Plain byte-pair encoding: the first merge in the list, leftmost."""
    word = [bytes([b]) for b in word]
    while True:
        pairs = [(merges.index((x, y)), i) for i, (x, y) in enumerate(zip(word, word[1:])) if (x, y) in merges]
        if not pairs:
            return word
        rank = min(pairs)[0]
        out, i = [], 0
        while i < len(word):
            if i + 1 < len(word) and (word[i], word[i + 1]) == merges[rank]:
                out.append(word[i] + word[i + 1])
                i += 2
            else:
                out.append(word[i])
                i += 1
        word = out


def test_merge_gadgets_on_random_merge_lists():
    import random
    for seed in range(40):
        rng = random.Random(seed)
        tokens, merges = [b"a", b"b", b"c"], []
        while len(merges) < 14:
            x, y = rng.choice(tokens), rng.choice(tokens)
            if x + y not in tokens:
                tokens.append(x + y)
                merges.append((x, y))
        at = {t: i for i, t in enumerate(tokens)}
        automaton = bpe_automaton.Automaton(dict(enumerate(tokens)), [(at[x], at[y], at[x + y]) for x, y in merges])
        for _ in range(150):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 14)))
            assert [tokens[t] for t in automaton.encode(word)] == merge_words(word, merges)
