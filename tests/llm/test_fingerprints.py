"""Fingerprints against their SQL, and their likeness against the true likeness of shingle sets."""

import random

import pytest
from pyspark.sql import functions as F
from test_exact_and_mixing import against_sql

from obsflow.llm import fingerprints as fp


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_against_sql(odd, none):
    docs = odd.select("doc_id", "text")
    against_sql(fp.edit_report(odd), docs, fp.ORACLE)
    assert fp.edit_report(none).count() == 0 and fp.fingerprints(none).count() == 0


def test_documents(documents):
    short = documents.where("length(text) < 3000")
    against_sql(fp.edit_report(short), short.select("doc_id", "text"), fp.ORACLE)


def test_one_document(spark):
    (row,) = fp.edit_report(spark.createDataFrame([(5, "Only one text of seven words here")], "doc_id long, text string")).collect()
    assert row.near_next == 1.0 and 0 <= row.near_edited < 1


@pytest.mark.parametrize("words", [3, 40, 400, 4000])
def test_likeness(spark, words):
    """Estimates for pairs of known likeness stay within five standard errors, short texts with many empty bins too."""
    rng, rows = random.Random(words), []
    for k in range(60):
        a = [f"w{rng.randrange(10_000)}" for _ in range(words)]
        b = list(a)
        for _ in range(rng.randrange(1 + words // 20)):
            b[rng.randrange(words)] = "other"
        rows.append((k, " ".join(a), " ".join(b) if k % 10 else f"{k} something else"))
    df = spark.createDataFrame(rows, "k int, a string, b string")
    got = df.select("k", fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("near")).collect()
    errors = []
    for (k, a, b), row in zip(rows, sorted(got), strict=True):
        x, y = shingles(a), shingles(b)
        true = len(x & y) / len(x | y)
        effective = min(256, len(x | y))  # borrowed values tell nothing new
        errors.append(row.near - true)
        assert abs(row.near - true) <= 5 * (0.25 / effective + 0.25 / 256) ** 0.5
        assert true < 1 or row.near == 1
    assert abs(sum(errors) / len(errors)) < 0.06


def test_equal_texts_and_empty(spark):
    rows = [(1, "Same WORDS in both of them"), (2, "same\twords in both\nof them"), (3, ""), (4, None), (5, "x"), (6, "y")]
    got = {r.doc_id: list(r.fingerprint) for r in fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == got[2] and len(got[1]) == 16
    assert got[3] == got[4] == [] and got[5] != got[6]


def test_only_dataframe_functions(documents):
    plan = fp.edit_report(documents)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
    assert plan.count("SinglePartition") == 0
