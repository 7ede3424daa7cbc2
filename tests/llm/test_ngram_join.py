"""The n-gram join against all pairs."""

import random
import re

import pytest

from obsflow.llm import ngram_join
from obsflow.llm.components import components


def plain_set(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def plain_components(rows):
    """[(doc_id, n_shingles, component_id)] and the number of linked pairs of different sets."""
    sets = [plain_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), set()
    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[find(parent, i)] = find(parent, j)
                if x != y:
                    links.add(frozenset((x, y)))
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = find(parent, i)
            lowest[root] = min(doc_id, lowest.get(root, doc_id))
    out = [(d, len(s), lowest.get(find(parent, i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]
    return sorted(out, key=repr), len(links)


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = [" ".join(rng.choice(words) for _ in range(25)) for _ in range(3)]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 8, 30, 60, 120]))] for _ in range(12)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.2:
            text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))
        else:
            copy = list(rng.choice(bases[:3] if kind < 0.7 else bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            text = " ".join(copy)
        if rng.random() < 0.4:
            text = f"{rng.choice(common)}\n{text}"
        rows.append((i * 7 % 1000, text.title() if rng.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize("options", [{}, {"part_entries": 40}])
def test_components(spark, options):
    """part_entries=40: common shingles count as hot and are dealt over all parts."""
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want, _ = plain_components(rows)
    got = sorted(map(tuple, ngram_join.component_rows(docs, **options).collect()), key=repr)
    assert got == want


def test_links(spark):
    rows = corpus(6, 90)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ngram_join.Join(docs).links().count() == plain_components(rows)[1]


def test_links_of_hot_shingles(spark):
    """part_entries=40: as in test_components; a third of the rows are near copies that share hot shingles only."""
    rng = random.Random(10)
    base = [f"b{i}" for i in range(60)]
    near = [(2000 + i, " ".join([*base[:50], *(f"x{i}" for _ in range(rng.randint(0, 3)))])) for i in range(45)]
    rows = corpus(6, 90) + near
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = ngram_join.Join(docs, part_entries=40).links().collect()
    assert len(set(map(tuple, found))) == len(found) == plain_components(rows)[1] > 500
    assert ngram_join.Join(docs.where("false"), part_entries=40).links().count() == 0


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = sorted(map(tuple, ngram_join.component_rows(documents).collect()), key=repr)
    assert got == plain_components(rows)[0]


def test_edges(spark, odd, none):
    got = sorted(map(tuple, ngram_join.component_rows(odd).collect()), key=repr)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert got == plain_components(rows)[0]
    assert ngram_join.component_rows(none).count() == 0
    clash = [(None, "a b c d e f"), (2, "A b C d e f"), (2, "other words than those"), (None, None)]
    docs = spark.createDataFrame(clash, "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.component_rows(docs).collect()), key=repr) == plain_components(clash)[0]


def test_bounds():
    for n in range(1, 60):
        assert ngram_join.prefix_size(n) == n - -(-3 * n // 4) + 1
        for m in range(n, 60):
            need = ngram_join.least_overlap(n, m)
            assert 100 * need >= 75 * (n + m - need) and 100 * (need - 1) < 75 * (n + m - need + 1)


def test_connected_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, 1000 + i) for i in range(1, 40)]
    edges += [(2000 + i, 2001 + i) for i in range(60)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        parent[find(parent, a)] = find(parent, b)
    lowest = {}
    for x in parent:
        lowest[find(parent, x)] = min(x, lowest.get(find(parent, x), x))
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == lowest[find(parent, x)] for x in parent)
