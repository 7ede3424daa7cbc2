"""Batches that become visible at once, runs that fail, compaction, summaries, and files that arrive."""

import pytest
from pyspark.sql import functions as F

from obsflow.operators import query as Q
from obsflow.plans import batch as B
from obsflow.plans.staging import folders_in, scratch_mark
from obsflow.sinks import batches
from obsflow.streaming.ingest import ingest


def answering():
    def provider(prompt):  # inside, as tasks cannot import this module
        return (
            '{"_entity_column": 0, "_entity_type": "hospital", "_entity_type_confidence": 0.9, "_domain": "health", '
            '"0": {"field": "entity_name"}, "1": {"field": "value", "indicator": "beds"}}'
        )

    return provider


def no_domain():
    return lambda p: "{}"


def write_files(folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / name).write_text("Hospital,Beds\n" + "".join(f"{name}-{i},{i}\n" for i in range(5)))


def run(spark, folder, out, **options):
    return B.run_batch(spark, [str(folder)], str(out), 2025, answering(), no_domain(), **options)


def counts(spark, out):
    return {name: batches.read_table(spark, str(out), name).count() for name in batches.TABLES}


def reports(spark, out):
    obs = batches.read_table(spark, str(out), "observations")
    pairs = (
        (batches.list_datasets(spark, str(out)), Q.list_datasets(obs)),
        (batches.table_quality(spark, str(out)), Q.table_quality(obs)),
        (batches.domain_consistency(spark, str(out)), Q.domain_consistency(obs)),
    )
    for summary, scan in pairs:
        assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, scan.select(*summary.columns).collect()))


class Killed(Exception):
    pass


@pytest.mark.parametrize("after", ["document_chunks"])
def test_a_killed_run_leaves_nothing(spark, tmp_path, monkeypatch, after):
    folder, out = tmp_path / "in", tmp_path / "out"
    write_files(folder, ["a.csv", "b.csv"])
    write = batches.Batch.write

    def dying(self, df, table):
        write(self, df, table)
        if table == after:
            raise Killed

    before = scratch_mark(spark)
    with monkeypatch.context() as m:
        m.setattr(batches.Batch, "write", dying)
        with pytest.raises(Killed):
            run(spark, folder, out)
    assert set(counts(spark, out).values()) == {0} and scratch_mark(spark) == before
    assert folders_in(spark, f"{out}/{after}") != []  # files are there, and not seen
    obs, _ = run(spark, folder, out)
    assert obs.count() == 10
    assert counts(spark, out)["documents"] == 2 and len(folders_in(spark, f"{out}/{after}")) == 1
    reports(spark, out)


def test_another_request_after_a_failure(spark, tmp_path):
    """What a failed run left is neither seen nor reused by another request, and goes with vacuum."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    write_files(folder, ["a.csv"])
    lost = batches.open_batch(spark, out, "some other request")
    lost.write(spark.createDataFrame([("d", "d", 1, 0, "text")], batches.TEXT), "text")
    obs, _ = run(spark, folder, out)
    assert obs.count() == 5 and batches.newest_text(spark, out).count() == 0
    assert len(folders_in(spark, f"{out}/text")) == 2
    batches.vacuum(spark, out)
    assert len(folders_in(spark, f"{out}/text")) == 1
    assert batches.open_batch(spark, out, "some other request").name == lost.name


def test_compaction(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    write_files(folder, ["a.csv", "b.csv"])
    for _ in range(2):
        run(spark, folder, out)
    assert batches.compact(spark, str(tmp_path / "nothing")) is None
    rows = sorted(map(str, batches.read_table(spark, out, "observations").collect()))
    assert len(rows) == 20 and len(batches.visible_batches(spark, out)) == 2
    merged = batches.compact(spark, out)
    assert batches.visible_batches(spark, out) == [merged.name]
    assert sorted(map(str, batches.read_table(spark, out, "observations").collect())) == rows
    reports(spark, out)
    batches.vacuum(spark, out)
    assert folders_in(spark, f"{out}/observations") == [f"batch={merged.name}"]


def test_text_versions(spark, tmp_path):
    out = str(tmp_path)
    for run_no, texts in enumerate((["one", "two", "three"], ["new"])):
        batch = batches.open_batch(spark, out, "r")
        rows = [("d", "d", batch.version, i, t) for i, t in enumerate(texts)] + ([("e", "e", 1, 0, "other")] if not run_no else [])
        batch.write(spark.createDataFrame(rows, batches.TEXT), "text")
        seen = [("d", "d", batch.version)] + ([("e", "e", 1), ("f", "f", 1)] if not run_no else [])
        batch.write(spark.createDataFrame(seen, batches.DOCUMENTS), "documents")
        batch.commit()
    assert {tuple(r) for r in batches.document_texts(spark, out).collect()} == {("d", "new"), ("e", "other"), ("f", "")}
    batches.compact(spark, out)
    assert {tuple(r) for r in batches.document_texts(spark, out).collect()} == {("d", "new"), ("e", "other"), ("f", "")}
    assert batches.read_table(spark, out, "text").count() == 2


def test_look_up_opens_few_row_groups(spark, tmp_path):
    """Without a domain, an entity is found by Bloom filters and min/max: few rows are read of many files."""
    out = str(tmp_path)
    obs = spark.range(40_000).select(
        F.concat(F.lit("entity "), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("entity_name"),
        F.concat(F.lit("domain "), F.col("id") % 40).alias("domain"),
        F.lit("hospital").alias("entity_type"), F.lit(2025).alias("year"), F.lit("beds").alias("indicator"),
        F.col("id").cast("double").alias("value"),
    )
    batch = batches.open_batch(spark, out, "r")
    from obsflow.sinks.store import conform

    batch.write(conform(obs), "observations")
    batch.commit()
    rows = batches.read_table(spark, out, "observations")
    name = rows.where("domain = 'domain 7'").first().entity_name
    found = Q.get_entity(rows, name, include_flagged=True)
    assert found.count() == obs.where(F.col("entity_name") == name).count() > 0
    df = found.select("value")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = [p for p in _nodes(plan) if "Scan" in p.nodeName()]
    read = sum(p.metrics().apply("numOutputRows").value() for p in scans)
    assert read < 0.3 * 40_000


def _nodes(plan):
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        out.append(p)
        if "AdaptiveSparkPlan" in p.nodeName():
            todo.append(p.executedPlan())
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
    return out


def test_skipped_files_are_not_opened(spark, tmp_path, monkeypatch):
    folder, out = tmp_path / "in", tmp_path / "out"
    write_files(folder, ["a.csv", "b [1] {x}.csv"])
    run(spark, folder, out)
    write_files(folder, ["c [*].csv"])
    opened = []
    read = B.read_csv_tables
    monkeypatch.setattr(B, "read_csv_tables", lambda spark, paths: opened.extend(paths) or read(spark, paths))
    obs, _ = run(spark, folder, out, skip_loaded=True)
    assert len(opened) == 1 and opened[0].endswith("/c \\[\\*\\].csv")
    assert obs.count() == 15


def test_files_that_arrive(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    write_files(folder, ["a.csv", "b.csv"])
    load = lambda **options: ingest(spark, str(folder), out, checkpoint, 2025, answering(), no_domain(), **options)
    load().awaitTermination()
    assert batches.read_table(spark, out, "observations").count() == 10
    write_files(folder, ["c.csv", "notes.txt"])
    load().awaitTermination()
    assert batches.read_table(spark, out, "observations").count() == 15
    assert len(batches.visible_batches(spark, out)) == 2
    load().awaitTermination()
    assert batches.read_table(spark, out, "observations").count() == 15
    # A micro-batch that is replayed under its name adds nothing.
    name = batches.visible_batches(spark, out)[0]
    replayed, _ = B.run_batch(spark, [str(folder)], out, 2025, answering(), no_domain(), batch_name=name)
    assert replayed.count() == 15
    one_run = str(tmp_path / "one")
    files = [str(folder / n) for n in ("a.csv", "b.csv", "c.csv")]
    B.run_batch(spark, files, one_run, 2025, answering(), no_domain())
    rows = lambda where: sorted(map(str, batches.read_table(spark, where, "observations").drop("extracted_at").collect()))
    assert rows(out) == rows(one_run)
    reports(spark, out)
