"""Byte-level BPE and unigram counts against the tokenizer libraries."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from obsflow.llm import byte_bpe, token_counts

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PIECES = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
PARTS = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "l", "L", "1", "2", "é", "ß", "中", "!", "?", "\t", "\x1c", "\x85",
         "\xa0", "​", "😀", "the ", " and", "tion", "aaaa", "　", "²", "ⅷ", "ſ", "▁", "<|endoftext|>"]


def texts(seed, n, most=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("leaves", [(8192, 64), (1, 1), (5, 3), (17, 4)])
def test_trees_of_any_leaf_size(leaves):
    encoder = byte_bpe.TreeEncoder(RANKS, leaf_chars=leaves[0], leaf_bytes=leaves[1])
    for text in texts(sum(leaves), 1500):
        ids = encoder.encode(text)
        assert ids == LIBRARY.encode_ordinary(text), repr(text)
        assert encoder.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    encoder = byte_bpe.TreeEncoder(RANKS, leaf_chars=4, leaf_bytes=2)
    assert encoder.encode(text) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, "aab" * 900 + " " * 500 + "é" * 999, "\n " * 900, "9" * 2500])
def test_long_pieces(text):
    assert byte_bpe.TreeEncoder(RANKS).encode(text) == LIBRARY.encode_ordinary(text)
    assert byte_bpe.merge(text.encode()[:400], RANKS) == byte_bpe.merge_short(text.encode()[:400], RANKS)


def test_documents(documents):
    rows = {r.doc_id: r for r in byte_bpe.round_trip(documents).collect()}
    for d in documents.collect():
        ids, r = LIBRARY.encode_ordinary(d.text or ""), rows[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == sha256((d.text or "").encode()).hexdigest()


def test_decode_table(odd):
    back = {r.doc_id: r.text for r in byte_bpe.decode(byte_bpe.encode(odd)).collect()}
    assert back == {r.doc_id: r.text or "" for r in odd.collect()}


def test_other_vocabulary():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    other = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.TreeEncoder(ranks, leaf_chars=9, leaf_bytes=5)
    assert all(encoder.encode(t) == other.encode_ordinary(t) for t in texts(3, 800))


def unigram(pieces):
    vocab = [("<unk>", 0.0)] + [(f"<0x{i:02X}>", 0.0) for i in range(256)] + pieces
    return tokenizers.Tokenizer(tokenizers.models.Unigram(vocab, unk_id=0, byte_fallback=True))


def library_count(library, text):
    return len(library.encode(f" {text}".replace(" ", "▁")).ids) if text else 0


def test_counts_like_the_library():
    counter, library = token_counts.ViterbiCounter(PIECES), unigram(PIECES)
    for text in texts(7, 3000):
        assert counter.count(text) == library_count(library, text), repr(text)


def test_ties_and_pieces_across_words():
    rng = random.Random(11)
    for _ in range(40):
        chars = ["a", "b", "▁"]
        inner = {"".join(rng.choice(chars) for _ in range(rng.randint(1, 4))) for _ in range(12)} | {"a", "▁"}
        pieces = [(p, float(-rng.randint(1, 3))) for p in sorted(inner)]
        counter, library = token_counts.ViterbiCounter(pieces), unigram(pieces)
        for _ in range(60):
            text = "".join(rng.choice("ab cé") for _ in range(rng.randint(0, 12)))
            assert counter.count(text) == library_count(library, text), (pieces, text)


def test_counts_over_documents(documents, odd, none):
    library = unigram(PIECES)
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents).collect()}
    assert got == {r.doc_id: library_count(library, r.text or "") for r in documents.collect()}
    rows = token_counts.count_tokens(odd).collect()
    assert len(rows) == 8 and {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}
    assert token_counts.count_tokens(none).count() == byte_bpe.round_trip(none).count() == 0
