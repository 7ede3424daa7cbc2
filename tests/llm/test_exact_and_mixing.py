"""Exact deduplication and mixing, against their SQL and by their contracts."""

import os
import sys
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check import _rows  # noqa: E402

from obsflow.llm import exact_dedup, mixing, texts  # noqa: E402


def against_sql(df, docs, sql):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, result.fetchall())


@pytest.mark.parametrize("work, sql", [(exact_dedup.deduplicate, exact_dedup.ORACLE), (mixing.mix, mixing.ORACLE)])
def test_edges(odd, none, work, sql):
    against_sql(work(odd), odd.select("doc_id", "text", "source"), sql)
    assert work(none).count() == 0


def test_hot_text_and_source(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 5)
    monkeypatch.setattr(mixing, "HOT_ROWS", 5)
    rows = [(i, "The Same text" if i % 3 else f"text {i} of many", "hot" if i % 2 else f"s{i % 7}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    against_sql(exact_dedup.deduplicate(docs), docs, exact_dedup.ORACLE)
    against_sql(mixing.mix(docs), docs, mixing.ORACLE)


def test_index_outlives_a_batch(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    index = exact_dedup.DigestIndex(spark, path, buckets=4)
    batch = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string")
    first = {r.doc_id: r for r in exact_dedup.deduplicate(batch((1, "a"), (2, "A"), (3, "b")), index).collect()}
    assert [first[i].kept for i in (1, 2, 3)] == [False, True, True]
    spark.sql(f"DROP TABLE {index.name}")  # the files stay
    index = exact_dedup.DigestIndex(spark, path)
    assert index.buckets == 4
    for other in ({"buckets": 8}, {"id_type": "string"}):
        with pytest.raises(ValueError, match="4 buckets"):
            exact_dedup.DigestIndex(spark, path, **other)
    later = batch((9, "a"), (8, "c"), (2, "a"))
    for _ in range(2):  # the same batch again changes nothing
        second = {r.doc_id: r for r in exact_dedup.deduplicate(later, index).collect()}
        assert [(second[i].keep_id, second[i].kept) for i in (9, 8, 2)] == [(2, False), (8, True), (2, True)]
        assert index.read().count() == 3
    groups = later.select(F.unhex(F.sha2("text", 256)).alias("digest"), F.col("doc_id").alias("keep_id"))
    plan = groups.join(index.read().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_index_follows_its_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET_ROWS", 5)
    monkeypatch.setattr(exact_dedup, "LEAST_BUCKETS", 2)
    path = f"file://{tmp_path}/index"
    index = exact_dedup.DigestIndex(spark, path, rows=12)
    assert index.buckets == 3
    batches = [spark.createDataFrame([(i, f"text {i % 40}") for i in range(n, n + 30)], "doc_id long, text string") for n in (0, 20, 40)]
    for docs in batches:
        exact_dedup.deduplicate(docs, index).count()
    new = index.copy_to(f"file://{tmp_path}/larger")
    assert new.buckets == 8 and index.read().count() == 40
    assert sorted(map(tuple, new.read().collect())) == sorted(map(tuple, index.read().collect()))
    again = [sorted(map(tuple, exact_dedup.deduplicate(batches[1], x).collect())) for x in (index, new)]
    assert again[0] == again[1] and new.read().count() == 40


def test_mixing_rows_alike(spark):
    """Many rows without an id, with one id, and repeated rows: by SQL, and no task gets a third of all."""
    rows = [(None, f"null id {'w ' * (i % 9)} {i}", "a") for i in range(600)]
    rows += [(7, f"one id {'w ' * (i % 5)} {i}", "a") for i in range(400)]
    rows += [(8, "the same row again", "b")] * 500 + [(None, None, None)] * 30 + [(i, f"other {i}", "c") for i in range(9, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    against_sql(mixing.mix(docs), docs, mixing.ORACLE)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixing.mix(docs).collect()))


def test_numbered_copies(spark, monkeypatch):
    monkeypatch.setattr(texts, "COPIES", 4)
    rows = spark.createDataFrame([("a", 1), ("b", 4), ("c", 9)], "x string, n long")
    found = texts.numbered_copies(rows, "n", "nth").select("x", "nth").collect()
    assert sorted(map(tuple, found)) == [(x, i + 1) for x, n in (("a", 1), ("b", 4), ("c", 9)) for i in range(n)]


def plain_levels(sizes, weights, cap=3):
    """Share by weight, clamp, share the excess again, until nothing is above."""
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = {s: w for s, w in weights.items() if s not in fixed}
        room = total - sum(fixed.values())
        share = {s: room * w / sum(open_.values()) for s, w in open_.items()}
        above = {s: cap * sizes[s] for s in open_ if share[s] > cap * sizes[s]}
        if not above:
            return fixed | share
        fixed |= above


def test_water_filling(spark):
    sizes = {"a": 10, "b": 5_000, "c": 30, "d": 700, "e": 1, "f": 0, "g": 90_000}
    weights = {s: i % 3 + 1 for i, s in enumerate(sizes)}
    rows = spark.createDataFrame([(s, n, weights[s]) for s, n in sizes.items()], "source string, source_size long, weight int")
    got = {r.source: r.target for r in mixing.water_level(rows).collect()}
    assert got == pytest.approx(plain_levels(sizes, weights))


def test_taken(documents):
    rows = mixing.mix(documents).collect()
    taken, target = defaultdict(int), {}
    sources = {r.doc_id: r.source for r in documents.collect()}
    for r in rows:
        taken[sources[r.doc_id]] += r.taken
        target[sources[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    again = mixing.mix(documents.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    other = mixing.mix(documents, seed=18).collect()
    assert sorted(map(tuple, rows)) != sorted(map(tuple, other))
