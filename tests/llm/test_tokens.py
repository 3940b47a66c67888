"""Token counts, byte-level BPE and packing beside the libraries."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import messy
import numpy as np
import public_tokenizers
import pytest
from cellferry.llm import bpe, packing, tokens

COUNTS, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return {p: Tokenizer.from_file(p) for p in (COUNTS, WORDS)}


@pytest.fixture(scope="module")
def tiktoken_own():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    parts = ["a", "it's", " ", "  ", "\n", "\t", "é", "́", "Σ", "İ", "12", "½", "<|endoftext|>", "!!", "日本", "\x85", "\x1c", "\xa0", "the", "'S"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(1500)] + ["ab" * 900, "x" * 5000]


def test_counts_equal_the_library(docs, library):
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, COUNTS).collect())
    want = Counter()
    for i, t in messy.texts_of(docs):
        n = len(library[COUNTS].encode(t, add_special_tokens=False).ids)
        want[i, len(t.encode()), n, n > 1024] += 1
    assert got == want


def test_odd_texts_are_counted_like_the_library(library):
    counter = tokens.PieceCounter(COUNTS, {})
    want = [len(e.ids) for e in library[COUNTS].encode_batch(odd_texts(), add_special_tokens=False)]
    assert counter.counts(odd_texts()) == want
    counter.cache = dict.fromkeys(map(str, range(tokens.CACHE_ENTRIES + 1)), 0)  # a full cache starts again
    assert counter.counts(odd_texts()) == want


def test_ids_and_bytes_equal_the_library(docs, tiktoken_own):
    made = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in made) == Counter((i, t.encode()) for i, t in messy.texts_of(docs))
    for r in made:
        ids = tiktoken_own.encode_ordinary(bytes(r.decoded).decode())
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded).hexdigest()


def test_odd_texts_are_encoded_like_the_library(tiktoken_own, monkeypatch):
    for generation in (300_000, 20):
        monkeypatch.setattr(bpe, "GENERATION", generation)
        encoder = bpe.WordEncoder(RANKS, public_tokenizers.PATTERN)
        for start in range(0, len(odd_texts()), 100):
            part = odd_texts()[start : start + 100]
            for text, (n, ids, decoded) in zip(part, encoder.encoded(part)):
                want = tiktoken_own.encode_ordinary(text)
                assert (n, ids, decoded) == (len(want), ",".join(map(str, want)).encode(), text.encode())


def test_the_heap_gives_what_the_query_gives():
    encoder = bpe.WordEncoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(2)
    made = [bytes(rng.choice(b"abthe ining") for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    assert encoder.queried(made) == [encoder.contracted(w) for w in made]


def test_packing_ids_equal_the_library(library):
    encoder = packing.WordIds(WORDS)
    want = [np.array(e.ids, "<u4").tobytes() for e in library[WORDS].encode_batch(odd_texts(), add_special_tokens=False)]
    assert encoder.encoded(odd_texts()) == want


def check_packing(made, docs, library, length, most_documents, most_cost):
    by_sequence = {}
    for r in made:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length and len(rows) <= most_documents and sum(r.length**2 for r in rows) <= most_cost
    want = Counter()
    for i, t in messy.texts_of(docs):
        ids = np.array(library[WORDS].encode(t, add_special_tokens=False).ids + [0], "<u4")
        for k, start in enumerate(range(0, len(ids), length)):
            part = ids[start : start + length]
            want[i, k, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in made) == want
    return len(by_sequence)


@pytest.mark.parametrize("rule", ["residual", "dot"])
def test_every_capacity_holds(docs, library, rule):
    made = packing.pack(docs, WORDS, length=128, documents=3, attention=20_000, rule=rule).collect()
    check_packing(made, docs, library, 128, 3, 20_000)


def test_pieces_fill_sequences(docs, library):
    made = packing.pack(docs, WORDS, length=64).collect()
    assert check_packing(made, docs, library, 64, 64, 64 * 64) <= -(-sum(r.length for r in made) // 64) * 1.05 + 1


def test_best_fit_is_near_the_bound():
    lengths = np.minimum(2047, np.random.default_rng(1).lognormal(6.5, 0.9, 5000).astype(np.int64) + 1)
    bins, offsets = packing.fit(lengths, np.array([2048.0, 2048, 2048**2]), np.array([1, 0.05, 0.05]))
    assert bins.max() + 1 <= lengths.sum() / 2048 * 1.01 + 1
    assert (np.bincount(bins, lengths) <= 2048).all()


def test_empty_tables(none):
    assert tokens.count_tokens(none, COUNTS).count() == 0
    assert bpe.encode_decode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert packing.pack(none, WORDS).count() == 0


def test_many_long_words_stay_within_the_memory_of_the_query(tiktoken_own):
    rng = random.Random(3)
    words = ["".join(chr(97 + rng.randrange(26)) for _ in range(390)) for _ in range(420)]
    words += ["".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(130)) for _ in range(20)]
    encoder = bpe.WordEncoder(RANKS, public_tokenizers.PATTERN)
    text = " ".join(words)
    (n, ids, raw), = encoder.encoded([text])
    assert raw == text.encode() and ids.decode() == ",".join(map(str, tiktoken_own.encode_ordinary(text))) and n == ids.count(b",") + 1


def test_parts_keep_order_and_size():
    words = [b"x" * n for n in (1, 400, 3000, 5, 2000, 1, 1)]
    parts = list(bpe.in_parts(words))
    assert [w for p in parts for w in p] == words
    assert all(sum(len(w) ** 2 for w in p) <= bpe.SQUARES_AT_ONCE or len(p) == 1 for p in parts)


def test_a_full_generation_of_words_is_kept_until_the_next(monkeypatch, library):
    monkeypatch.setattr(bpe, "GENERATION", 3)
    encoder = packing.WordIds(WORDS)
    for text in ["a b c d e f", "g h a", "x y z w v", "a b", *odd_texts()[:300]]:
        want = np.array(library[WORDS].encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encoded([text]) == [want]


def test_plain_texts_are_cut_into_words(library):
    """Words were learned once for each sign beside them; now they are cut apart first, as the library does."""
    rng = random.Random(9)
    parts = ["a", "It", "'s", "'S", "'", "'RE", "'ll", " ", "  ", "\n", "ß", "É", "ſ", "ŉ", "ª", "½", "²", "12", "!", "«", "\xad", "|", "<|", "_", "$"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4000)]
    odd = [rng.choice(["İ", "\t", "\xa0", "\x85", "\x7f", "́", "ƀ", "日"]).join(pair) for pair in zip(texts[:1000], texts[1000:2000])]
    encoder = packing.WordIds(WORDS)
    made = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encoded(texts + odd)]
    assert made == [e.ids for e in library[WORDS].encode_batch(texts + odd, add_special_tokens=False)]
    encoder = packing.WordIds(WORDS)
    encoder.encoded(["word, word. (word) word's\nword;word 12"])
    assert set(encoder.pieces) == {"", "word", ",", ".", "(", ")", "'s", ";", "1", "2"}


def test_pieces_of_letters_are_words_without_the_pattern(tiktoken_own):
    """The pattern was run over each new piece; one of ASCII letters is a word by itself."""
    encoder = bpe.WordEncoder(RANKS, public_tokenizers.PATTERN)
    seen, pattern = [], encoder.pattern

    class Pattern:
        @staticmethod
        def findall(text):
            seen.append(text)
            return pattern.findall(text)

    encoder.pattern = Pattern
    texts = ["Headless wordly Wordling's  wordly", "wordly", "", " wordly é1 x", "wordly \n wordly"]
    for text, (n, ids, decoded) in zip(texts, encoder.encoded(texts)):
        want = tiktoken_own.encode_ordinary(text)
        assert (n, ids, decoded) == (len(want), ",".join(map(str, want)).encode(), text.encode())
    assert " wordly" not in seen and " Wordling's" in seen and " é1" in seen
