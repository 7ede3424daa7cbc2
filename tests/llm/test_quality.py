"""The CRF classifier and the weakly supervised rules."""

import itertools
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from obsflow.llm import arrays, quality_crf, quality_rules


def test_span_hashes_tell_words_apart():
    texts = [b"one two  one\ttwo", b"", b"two one", "ünï ünï x".encode(), b"z" * 300_000 + b" z"]
    block = arrays.Block(texts)
    starts, ends = block.words()
    words = [bytes(block.data[a:b]) for a, b in zip(starts, ends)]
    assert words == [w for t in texts for w in t.split()]
    codes = block.hashes(starts, ends)
    for (w, c), (v, d) in itertools.combinations(zip(words, codes), 2):
        assert (w == v) == (c == d)


def test_hashes_do_not_depend_on_the_block(monkeypatch):
    block = arrays.Block([b"some words " * 500, b"other words"])
    want = block.hashes(*block.words())
    monkeypatch.setattr(arrays, "HASH_BYTES", 64)
    assert (block.hashes(*block.words()) == want).all()


def brute_marginals(odds, stay):
    weights = {}
    for labels in itertools.product((0, 1), repeat=len(odds)):
        w = sum(o for o, y in zip(odds, labels) if y)
        w += sum(stay[a] for a, b in zip(labels, labels[1:]) if a == b)
        weights[labels] = np.exp(w)
    total = sum(weights.values())
    return [sum(w for y, w in weights.items() if y[i]) / total for i in range(len(odds))]


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    sizes = np.array([3, 1, 5, 2, 5])
    starts = np.cumsum(sizes) - sizes
    odds, stay = rng.normal(size=sizes.sum()), np.array([0.7, 1.3])
    forward, backward = quality_crf.forward_backward(odds, starts, sizes, stay)
    got = quality_crf.sigmoid(forward + backward)
    for s, n in zip(starts, sizes):
        assert np.allclose(got[s : s + n], brute_marginals(odds[s : s + n], stay))


def test_classifier_on_held_out_rows(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_crf.classify(docs, labels)
    rows = scored.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.98
    again = {r.doc_id: r.score for r in quality_crf.classify(docs.repartition(7), labels.repartition(3)).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in rows)


def test_sample_reads_whole_documents(spark):
    """Long documents give whole chains of all their parts, the curve their whole goodness; an id counts once."""
    for n in (0, 5, 512, 513, 5_000, 100_000):
        at = quality_crf.spread(n)
        assert len(at) <= 512 and (np.diff(at) > 0).all() and (n > 512 or len(at) == n)
        assert n < 5_000 or (at.max() > n / 2 and (at[::64] % 64 == 0).all())
    good, bad = "Plain words stand here in a line.\n", "$$$ ### %%% BUY!!! | | |\n"
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    texts = {i: good * 520 + bad * 5_000 if i % 2 else good * 30 for i in ids}
    rows = [(i, texts[i]) for i in ids] + [(ids[0], texts[ids[0]])] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in ids], "doc_id long, quality int")
    assert quality_crf.sample(docs, labels).count() == len(ids)
    weights, stay, _ = quality_crf.trained(docs, labels).value
    bad_line, good_line = (quality_crf.line_features(arrays.Block([t.encode() * 9]))[2][4] for t in (bad, good))
    assert bad_line @ weights < 0 < good_line @ weights
    assert all(r.predicted == 1 - r.doc_id % 2 for r in quality_crf.classify(docs, labels).collect())


def test_classifier_edges(spark, odd, none, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    nothing = quality_crf.classify(odd, labels.where("false")).collect()
    assert len(nothing) == 8 and {r.score for r in nothing} == {0.5}
    mixed = spark.createDataFrame([(3, 1), (4, 0), (4, None), (None, 1), (6, 0)], "doc_id long, quality int")
    rows = quality_crf.classify(odd, mixed).collect()
    assert len(rows) == 8 and all(r.score == 0 for r in rows if r.doc_id in (1, 2, 5))
    assert quality_crf.classify(none, mixed).count() == 0


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_rule_measures():
    rng = random.Random(2)
    parts = ["a", "b", " a b", " ", "\n", "é ", "#", "| ", "\t", "\r\n", "a b a b a b a b "]
    for _ in range(200):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(1, 8))]
        found = quality_rules.measure(arrays.Block([t.encode() for t in texts]))
        assert [tuple(int(c[i]) for c in found[:5]) for i in range(len(texts))] == [plain_measures(t) for t in texts]


def test_rules_over_documents(spark, documents, sf_dir):
    rows = {r.doc_id: r for r in quality_rules.judge(documents).collect()}
    for d in documents.collect():
        r, (n, chars, symbols, dup, again) = rows[d.doc_id], plain_measures(d.text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, again)
        assert r.base_failed == (n < 20 or 100 * again > 30 * n) and not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").collect()
    assert np.mean([rows[x.doc_id].kept for x in labels if not rows[x.doc_id].base_failed]) > 0.95


def test_rule_accuracies_are_recovered():
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.8
    bad_on_bad = np.array([0.6, 0.5, 0.7, 0.4])
    votes = np.where(rng.random((20_000, 4)) < np.where(good[:, None], 0.01, bad_on_bad), "0", "1")
    votes[rng.random(votes.shape) < 0.2] = "-"
    texts, counts = np.unique(["".join(v) for v in votes], return_counts=True)
    _, share, (on_bad, on_good) = quality_rules.estimate(list(texts), list(counts))
    assert abs(share - 0.8) < 0.03 and np.abs(on_bad - bad_on_bad).max() < 0.06 and (on_good > 0.98).all()


def test_source_that_fails_one_rule_is_kept():
    """A third of all rows are clean but for one rule, as tables have no full stops."""
    for rule in range(8):
        one = "".join("0" if k == rule else "1" for k in range(8))
        seen = {"1" * 8: 60_000, one: 33_000, "10011000": 4_000, "0-000000": 3_000}
        posterior, share, (_, on_good) = quality_rules.estimate(list(seen), list(seen.values()))
        assert (posterior[:2] > 0.95).all() and (posterior[2:] < 0.05).all(), (rule, posterior)
        assert abs(share - 0.93) < 0.01 and abs(on_good[rule] - 60 / 93) < 0.01


def test_share_of_good_may_be_small():
    rng = np.random.default_rng(6)
    good = rng.random(20_000) < 0.2
    bad_on_bad = np.array([0.6, 0.5, 0.7, 0.4, 0.6])
    votes = np.where(rng.random((20_000, 5)) < np.where(good[:, None], 0.05, bad_on_bad), "0", "1")
    texts, counts = np.unique(["".join(v) for v in votes], return_counts=True)
    _, share, (on_bad, on_good) = quality_rules.estimate(list(texts), list(counts))
    assert abs(share - 0.2) < 0.03 and np.abs(on_bad - bad_on_bad).max() < 0.05 and np.abs(on_good - 0.95).max() < 0.05


def test_rules_edges(odd, none):
    rows = quality_rules.judge(odd).collect()
    assert len(rows) == 8 and quality_rules.judge(none).count() == 0
    assert all(r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 5))
    assert [r.n_repeat_words for r in rows if r.doc_id == 4] == [30_000]
    own = quality_rules.judge(odd, rules=[F.when(F.col("n_words") < 3, 0)]).collect()
    assert len(own) == 8
