"""The pipeline's stages: each against plain Python on its own input."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_ngram_join import find, plain_set

import corpus_pipeline as pipeline
from obsflow.llm import mixing, quality_crf


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input of each stage and what it made of it, each written and read again."""
    folder, out = tmp_path_factory.mktemp("pipeline"), []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id % 9 = 0")).unionByName(docs.where("doc_id % 7 = 0").withColumn("doc_id", F.lit(None)))
    for number, (_, step) in enumerate(pipeline.STAGES):
        step(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        made = spark.read.parquet(f"{folder}/{number}")
        out.append((docs, made))
        docs = made
    return out


def rows(df):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect())


def test_columns(stages):
    for docs, made in stages[:-1]:
        assert made.columns == docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(spark, sf_dir, stages):
    docs, made = stages[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality_crf.classify(docs.where("doc_id IS NOT NULL"), labels).where("predicted = 1").distinct()
    good = {r.doc_id for r in scored.collect()}
    assert rows(made.where("doc_id IS NOT NULL")) == Counter(
        {r: n for r, n in rows(docs).items() if r[0] is not None and r[0] in good}
    )
    assert made.count() > 0.8 * docs.count()


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_copies(stages):
    docs, made = stages[1]
    best = {}
    for doc_id, text, *_ in rows(docs):
        best[lower(text)] = max(best.get(lower(text), -1), -1 if doc_id is None else doc_id)
    assert Counter((-1 if r.doc_id is None else r.doc_id, lower(r.text)) for r in made.collect()) == Counter(
        (doc_id, text) for text, doc_id in best.items()
    )


def test_near_copies(stages):
    docs, made = stages[2]
    found = [(r.doc_id, r.text) for r in docs.collect()]
    sets, parent = [plain_set(t) for _, t in found], list(range(len(found)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                parent[find(parent, i)] = find(parent, j)
    groups = Counter(find(parent, i) for i in range(len(found)))
    kept = {r.text for r in made.collect()}
    of_group = Counter(find(parent, i) for i, (_, t) in enumerate(found) if t in kept)
    assert made.count() == len(groups) and set(of_group.values()) == {1}


def test_mixing(stages):
    docs, made = stages[3]
    before, after = rows(docs), rows(made)
    assert set(after) <= set(before) and max(after.values()) <= 3
    words = {r.doc_id: r.size for r in mixing.mix(docs).collect()}
    longest = max(words.values())
    sources = {r.source: r.target for r in mixing.mix(docs.withColumn("id", F.col("source")), "id").selectExpr("doc_id AS source", "target").collect()}
    for source, target in sources.items():
        taken = sum(len((r[1] or "").split()) * n for r, n in after.items() if r[3] == source)
        assert abs(taken - target) <= longest


def test_tokens(spark, sf_dir, stages):
    docs, made = stages[4]
    assert made.count() == docs.count()
    digests = Counter(r[0] for r in docs.select(F.sha2("text", 256)).collect())
    assert Counter(r.decoded_sha256 for r in made.collect()) == digests


def test_any_column_names(spark, sf_dir):
    """Columns named like those the stages work with come through every stage with their values."""
    names = ["_digest", "_id", "_no_id", "_key", "_times", "_nth", "_from", "row", "digest", "id", "no_id", "key", "times",
             "nth", "kept", "a.b"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plain = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for _, step in pipeline.STAGES[:-1]:
        made = step(spark, plain, sf_dir)
        assert made.columns == plain.columns
        other = step(spark, docs, sf_dir)
        assert Counter(r.doc_id for r in made.collect()) == Counter(r.doc_id for r in other.collect())
        assert all(r[n] == f"{n}{r.doc_id}" for r in made.collect() for n in names)


def test_one_row_of_an_id_used_twice(spark, sf_dir):
    """Rows of one id whose texts differ in capitals, and rows whose other columns differ: the same one in each run."""
    rows = [(1, "A text", "en", "a", n) for n in range(5)] + [(1, "a text", None, "b", 1), (0, "a TEXT", "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = [pipeline.one_of_copies(spark, docs.repartition(n), sf_dir).collect() for n in (1, 4)]
    assert found[0] == found[1] and len(found[0]) == 1 and found[0][0].doc_id == 1


def test_run(spark, sf_dir):
    assert pipeline.run(spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_odd_documents(spark, odd, none, sf_dir):
    for docs in (odd, none):
        for _, step in pipeline.STAGES[1:]:
            made = step(spark, docs, sf_dir)
            assert (made.count() == 0) == (docs is none)
    assert pipeline.good_quality(spark, odd, sf_dir).count() <= odd.count()
    assert pipeline.good_quality(spark, none, sf_dir).count() == 0
