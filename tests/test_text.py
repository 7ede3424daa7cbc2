"""Chunking against a plain Python fold, for arrays and for paragraph tables cut into blocks."""

import random

import pytest
from pyspark.sql import functions as F

from obsflow.operators.chunks import chunk_paragraphs, chunk_texts, document_context
from obsflow.sources.pages import page_paragraphs, page_tables


def fold(paragraphs):
    chunks, pending = [], ""
    for p in paragraphs:
        p = p.strip()
        if not p:
            continue
        p = f"{pending} {p}" if pending else p
        pending = ""
        if len(p.split()) < 5:
            pending = p
        else:
            chunks.append(p)
    return chunks + ([pending] if pending else [])


RNG = random.Random(3)
DOCUMENTS = {
    "golden": ["Intro", "a b c d e f", "x y", "z w", "tail"],
    "ones": ["x"] * 23,
    "threes": ["a b c"] * 17,
    "blank": ["", " 　", "\t"],
    "gap": ["one"] + [" "] * 9 + ["two three", "four five six seven"],
    **{
        f"random{i}": [
            " ".join("w" * RNG.randint(1, 3) for _ in range(RNG.choice([0, 1, 1, 2, 3, 4, 5, 9])))
            for _ in range(RNG.randint(1, 40))
        ]
        for i in range(20)
    },
}
WANT = sorted((d, i, c) for d, ps in DOCUMENTS.items() for i, c in enumerate(fold(ps)))


def test_golden():
    assert fold(DOCUMENTS["golden"]) == ["Intro a b c d e f", "x y z w tail"]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame(list(DOCUMENTS.items()), "source_document string, paragraphs array<string>")


def collected(df):
    return sorted((r.source_document, r.chunk_index, r.chunk_text) for r in df.collect())


def test_arrays(documents):
    assert collected(chunk_texts(documents)) == WANT


@pytest.mark.parametrize("block", [1, 2, 3, 7, 4096])
def test_paragraph_table(spark, documents, block):
    table = documents.select("source_document", F.posexplode("paragraphs").alias("para_idx", "text"))
    domains = spark.createDataFrame([("golden", "health")], "source_document string, domain string")
    chunks = chunk_paragraphs(table, domains, block)
    assert collected(chunks) == WANT
    tagged = {(r.source_document, r.domain) for r in chunks.collect()}
    assert ("golden", "health") in tagged and ("ones", None) in tagged


def test_context(spark):
    rows = [("a", i, f"p{i}") for i in range(9)] + [("b", 0, "x" * 2000)]
    df = spark.createDataFrame(rows, "source_document string, para_idx int, text string")
    got = {r.source_document: r.context for r in document_context(df).collect()}
    assert got == {"a": "p0 p1 p2 p3 p4", "b": "x" * 1500}


def test_pages(spark):
    pages = spark.createDataFrame([("d", 1, "one"), ("d", 2, " "), ("d", 4, "two")], "doc string, page int, text string")
    got = [tuple(r) for r in page_paragraphs(pages, 2).orderBy("para_idx").collect()]
    assert got == [("d", 0, "one"), ("d", 1, "two")]


def test_page_tables(spark):
    grids = spark.createDataFrame(
        [("d", 3, 0, [["a", None], ["1"]]), ("d", 3, 1, [])],
        "doc string, page int, table_no int, rows array<array<string>>",
    )
    tables, rows = page_tables(grids)
    assert [tuple(r) for r in tables.collect()] == [("d#0", "d", "pdf-page-3", "pdf_table")]
    assert sorted(tuple(r) for r in rows.collect()) == [("d#0", 0, ["a", None]), ("d#0", 1, ["1"])]
