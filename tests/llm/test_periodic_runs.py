"""Periodic runs against a brute-force search and the contract's definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from obsflow.llm import periodic_runs as pr


def plain_runs(words, min_length=6, exponent=4):
    """All maximal stretches of smallest period q, by trying every period at every start."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, exponent * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + r] for k in range(length - r)) for r in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def random_texts(seed, n, letters=2, longest=60):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = [str(rng.randrange(letters)) for _ in range(rng.randrange(longest))]
        for _ in range(rng.randrange(3)):
            at, q = rng.randrange(len(words) + 1), rng.randrange(1, 9)
            loop = [str(rng.randrange(letters)) for _ in range(q)]
            words[at:at] = (loop * 8)[: rng.randrange(1, 6 * q + 2)]
        out.append(" ".join(words).encode())
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 8])
@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (5, 3), (10, 2)])
def test_against_brute_force(letters, limits):
    texts = [b"", b" \n ", *random_texts(letters, 120, letters)]
    for text, (n, runs, collapsed) in zip(texts, pr.runs_of_block(texts, *limits), strict=True):
        words = text.split()
        assert n == len(words)
        assert runs == plain_runs(words, *limits), text
        assert collapsed == plain_collapsed(words, runs)


def test_places_in_small_blocks(monkeypatch):
    monkeypatch.setattr(pr, "BLOCK_PLACES", 4)
    rng = random.Random(5)
    order = rng.sample(range(500), 200)
    places, have = pr.Places(order[0]), [order[0]]
    for p in order[1:]:
        before, after = places.add(p)
        assert before == max((x for x in have if x < p), default=None)
        assert after == min((x for x in have if x > p), default=None)
        have.append(p)
    assert list(places) == sorted(have) and places.size == 200
    texts = random_texts(9, 60, 2, 200)
    for text, (_, runs, _) in zip(texts, pr.runs_of_block(texts), strict=True):
        assert runs == plain_runs(text.split())


def test_suffix_order():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 60):
        letters = rng.integers(0, 3, n)
        order, common = pr.suffix_order(letters)
        suffixes = [tuple(letters[i:]) for i in range(n)]
        assert [tuple(letters[i:]) for i in order] == sorted(suffixes)
        for k in range(n - 1):
            a, b = suffixes[order[k]], suffixes[order[k + 1]]
            assert common[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_long_loops():
    """Long texts of one word, of a long period, and a Fibonacci word, which has many runs."""
    fib = [b"a", b"ab"]
    while len(fib[-1]) < 3000:
        fib.append(fib[-1] + fib[-2])
    letters = b" ".join(bytes([c]) for c in fib[-1])
    texts = [b"w " * 50_000, b" ".join(b"%d" % (i % 997) for i in range(20_000)), letters]
    (one, long, many) = pr.runs_of_block(texts)
    assert one == (50_000, [(0, 50_000, 1)], b"w")
    assert long[1] == [(0, 20_000, 997)] and long[2] == b" ".join(b"%d" % i for i in range(997))
    assert many[1] == []  # no fourth power in it
    (_, many, _), = pr.runs_of_block([letters], 6, 2)
    assert many == plain_runs(letters.split(), 6, 2) and len(many) > 500


def plain_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    words = [w.encode() for w in words]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    milli = best[1] * 1000 // best[2] if runs else None
    lines = "".join("%d,%d,%d\n" % r for r in runs).encode()
    return (doc_id, len(runs), *best, milli, sha(lines), sha(plain_collapsed(words, runs)))


def test_report(spark):
    rng = random.Random(1)
    rows = [(i, " \t".join(rng.choice("abcdé") for _ in range(rng.randrange(90)))) for i in range(300)]
    rows += [(300, None), (301, ""), (None, "x " * 30), (7, "again " * 9), (7, "again " * 9), (302, "a\xa0a " * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in pr.run_report(pr.with_loops(docs)).collect()]
    assert sorted(got, key=repr) == sorted((plain_report(*r) for r in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 20


def test_odd_rows(odd, none):
    rows = pr.run_report(pr.with_loops(odd)).collect()
    assert len(rows) == odd.count()
    assert {(r.doc_id, r.n_runs, r.period) for r in rows if r.n_runs} == {(4, 1, 1)}
    assert pr.run_report(none).count() == 0 and pr.periodic_runs(none).count() == 0


def test_documents(spark, documents):
    got = {r[0]: tuple(r) for r in pr.run_report(pr.with_loops(documents)).collect()}
    short = [r for r in documents.select("doc_id", "text").collect() if len(r.text) < 6000]
    assert len(short) > 100
    for doc_id, text in short:
        assert got[doc_id] == plain_report(doc_id, text)
