"""Hard negatives against a brute-force search, and the tree's exclusions against plain distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import gnat, hard_negatives


def plain(rows, anchor, scale=256, positives=5, negatives=3, low=50, high=95):
    usable = {}
    for id_, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        usable[id_, tuple(int(np.floor(scale * float(x))) for x in vector), label] = None
    usable, out = list(usable), []
    rank = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a in usable:
        if a[0] is None or not anchor(a[0]):
            continue
        scored = [(sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2] == a[2]) for b in usable if b != a]
        for p in sorted((s for s in scored if s[2]), key=rank)[:positives]:
            fits = [s for s in scored if not s[2] and low * p[0] <= 100 * s[0] <= high * p[0]]
            for n, s in enumerate(sorted(fits, key=rank)[:negatives], 1):
                out.append((a[0], p[1], n, s[1], p[0], s[0]))
    return sorted(out, key=repr)


def mined(spark, rows, every=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = hard_negatives.mine(df, F.col("vec_id") % every == 0, **options)
    assert [c for c, _ in found.dtypes] == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def clustered(seed, n, dimensions=8, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dimensions))
    which = rng.integers(0, centres, n)
    vectors = (middle[which] + 0.2 * rng.normal(size=(n, dimensions))).astype(np.float32)
    labels = (which + rng.integers(0, 2, n)) % 5
    return [(i, [float(x) for x in v], int(c)) for i, (v, c) in enumerate(zip(vectors, labels))]


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(gnat, "LEAF_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", 40 * 8 * 9)
    monkeypatch.setattr(hard_negatives, "TASK_QUERIES", 7)
    monkeypatch.setattr(hard_negatives, "QUERY_ROWS", 5)
    monkeypatch.setattr(hard_negatives, "HOT_ROWS", 3)
    monkeypatch.setattr(hard_negatives.Index.__init__, "__defaults__", (200, 50, 16))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, small_parts, seed):
    rows = clustered(seed, 500)
    want = plain(rows, lambda i: i % 5 == 0)
    assert len(want) > 500 and mined(spark, rows) == want


def test_copies_ties_and_odd_rows(spark, small_parts):
    rows = clustered(3, 150)
    hot, other = rows[0][1], rows[1][1]
    rows += [(1000 + i, hot, 1) for i in range(120)] + [(2000 + i, hot, 2) for i in range(60)]
    rows += [(3000 + i, other, i % 5) for i in range(60)] + [(3000, other, 0)] * 40
    rows += [(None, other, 1), (None, hot, 2), (5, None, 1), (10, hot, None), (15, [1.0, None], 2)]
    rows += [(20, [float("nan")] * 8, 1), (25, [float("inf")] * 8, 1), (4000, [], 1), (4005, hot[:3], 2), (4010, hot + [9.0], 1)]
    rows += [(4015, [0.0] * 8, 9), (4020, [-x for x in hot], 2)]
    want = plain(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows) == want


def test_large_numbers(spark):
    """Scores that doubles cannot hold."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=3) * 3e5], int(i % 3)) for i in range(60)]
    want = plain(rows, lambda i: i % 5 == 0)
    assert max(abs(r[4]) for r in want) > 2**53 / 3 and mined(spark, rows) == want


def test_empty(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, None, 1)]) == []
    assert mined(spark, [(0, [1.0], 1)]) == []


def test_other_columns_and_parameters(spark):
    rows = clustered(6, 80)
    df = spark.createDataFrame(rows, "n long, v array<double>, kind int")
    df = df.withColumns({c: F.lit("clash") for c in ("id", "key", "label", "vector", "q", "cell", "anchor", "found")})
    found = hard_negatives.mine(df, F.col("n") % 7 == 0, "n", "v", "kind", scale=100, positives=2, negatives=4, low=20, high=80)
    want = plain(rows, lambda i: i % 7 == 0, 100, 2, 4, 20, 80)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want


def test_exclusion():
    """On clustered vectors most leaves are passed over, and none that holds a row of the annulus."""
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(40, 6)) * 1000
    vectors = (middle[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 6)) * 20).astype(np.int64)
    space = gnat.Space(6, (vectors**2).sum(1).max(), np.abs(vectors).max())
    lifted = space.lifted(vectors)
    tree = gnat.build(lifted, np.arange(4000), 32, rng)
    queries = vectors[:50]
    dist = gnat.distances(space.of_queries(queries), lifted)
    inner, outer = np.quantile(dist, 0.1, axis=1), np.quantile(dist, 0.12, axis=1)
    seen = np.zeros((50, 4000), bool)
    gnat.walk(
        tree, space.of_queries(queries), np.arange(50), lambda: inner, lambda: outer, space.slack,
        lambda rows, windows: seen.__setitem__(np.ix_(windows, rows), True),
    )
    inside = (dist >= inner[:, None]) & (dist <= outer[:, None])
    assert not (inside & ~seen).any() and seen.mean() < 0.5
