"""What a run writes becomes visible at once, when the run is entered in the manifest.

Every table is a folder with a folder `batch=<id>` for each run. A run is first noted as begun, then writes all its tables
into its own folders, and is entered in the manifest last. Readers take the folders of entered runs only, so nothing of a
run that failed is ever seen. The same request begun again after a failure takes the same id: it overwrites what the failed
run left. `compact` rewrites all visible runs as one, which replaces them in the manifest in one step; `vacuum` removes
folders that no reader can see. The manifest has a row per run and is read on the driver.

One run at a time may write to a store. Tables sorted by what is looked up carry Bloom filters for it besides min and max,
so that a look-up without the partition column opens few row groups.
"""

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import functions as F

from ..plans.staging import folders_in, read_or_empty, remove
from ..schemas import (
    CHUNKS,
    DATASET_COUNTS,
    DOCUMENTS,
    INDICATOR_DOMAINS,
    OBSERVATIONS,
    OBSERVATIONS_REJECTED,
    REJECTS,
    RUNS,
    TABLE_COUNTS,
    TEXT,
)


@dataclass(frozen=True)
class Layout:
    """How a table is stored: its columns, partition column, order within files, columns with Bloom filters, and columns
    by whose ranges rows are dealt to files (where there is no partition column)."""

    schema: object
    by: str = None
    order: tuple = ()
    bloom: tuple = ()
    ranges: tuple = ()


TABLES = {
    "observations": Layout(OBSERVATIONS, "domain", ("entity_name", "indicator", "year"), ("entity_name", "indicator")),
    "observations_rejected": Layout(OBSERVATIONS_REJECTED),
    "document_chunks": Layout(CHUNKS, "domain", ("source_document", "chunk_index"), ("source_document",)),
    "text": Layout(TEXT, order=("document_id", "para_idx"), ranges=("document_id", "para_idx")),
    "documents": Layout(DOCUMENTS),
    "rejects": Layout(REJECTS),
    "dataset_counts": Layout(DATASET_COUNTS),
    "table_counts": Layout(TABLE_COUNTS),
    "indicator_domains": Layout(INDICATOR_DOMAINS),
}


def _runs(spark, out_dir, name):
    return read_or_empty(spark, f"{out_dir}/{name}", RUNS).select(*RUNS.names).collect()


def visible_batches(spark, out_dir):
    """Ids of the runs whose files count, oldest first."""
    entered = sorted(_runs(spark, out_dir, "manifest"), key=lambda r: r.version)
    replaced = {batch for run in entered for batch in run.replaces}
    return [run.batch for run in entered if run.batch not in replaced]


def read_table(spark, out_dir, name):
    """All visible rows of a table."""
    schema = TABLES[name].schema
    there = set(folders_in(spark, f"{out_dir}/{name}"))
    folders = [f"batch={b}" for b in visible_batches(spark, out_dir) if f"batch={b}" in there]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{out_dir}/{name}")
    return rows.parquet(*[f"{out_dir}/{name}/{folder}" for folder in folders]).select(*schema.names)


class Batch:
    """One run's place in a store."""

    def __init__(self, spark, out_dir, name, version, request):
        self.spark, self.out_dir, self.name, self.version, self.request = spark, out_dir, name, version, request

    def path(self, table):
        return f"{self.out_dir}/{table}/batch={self.name}"

    def write(self, df, table):
        """Write the run's rows of a table, in place of what an earlier attempt wrote."""
        layout = TABLES[table]
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout.schema])
        if layout.by:  # a value that holds most rows is split over tasks
            rows = rows.hint("rebalance", layout.by).sortWithinPartitions(layout.by, *layout.order)
        elif layout.ranges:
            rows = rows.repartitionByRange(*layout.ranges).sortWithinPartitions(*layout.order)
        writer = rows.write.mode("overwrite")
        for column in layout.bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        (writer.partitionBy(layout.by) if layout.by else writer).parquet(self.path(table))

    def _enter(self, where, replaces=()):
        row = self.spark.createDataFrame([(self.name, self.version, self.request, list(replaces))], RUNS)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.out_dir}/{where}/run={self.name}")

    def begin(self):
        self._enter("begun")

    def commit(self, replaces=()):
        """From here on readers see the run, and no longer the runs that it replaces."""
        self._enter("manifest", replaces)

    @property
    def committed(self):
        return any(r.batch == self.name for r in _runs(self.spark, self.out_dir, "manifest"))


def open_batch(spark, out_dir, request, name=None):
    """The batch of a run. A request that was begun and never entered gets its batch again, and so does a name; else the
    batch is new. Versions number the runs in the order in which they began."""
    if name is not None and not re.fullmatch(r"[A-Za-z0-9._-]+", name):
        raise ValueError("a batch name has letters, digits, dots, dashes and underscores only")
    begun = sorted(_runs(spark, out_dir, "begun"), key=lambda r: r.version)
    entered = {r.batch for r in _runs(spark, out_dir, "manifest")}
    if name is not None:
        same = [r for r in begun if r.batch == name]
    else:
        same = [r for r in begun if r.request == request and r.batch not in entered]
    if same:
        return Batch(spark, out_dir, same[-1].batch, same[-1].version, same[-1].request)
    version = max((r.version for r in begun), default=0) + 1
    batch = Batch(spark, out_dir, name or uuid.uuid4().hex, version, request)
    batch.begin()
    return batch


def newest_text(spark, out_dir):
    """(document_id, source_document, version, para_idx, text): of each document what the latest run read."""
    documents, text = read_table(spark, out_dir, "documents"), read_table(spark, out_dir, "text")
    latest = documents.groupBy("document_id").agg(F.max("version").alias("latest"))
    older = documents.join(latest, "document_id").where("version < latest").select("document_id", "version").distinct()
    return text if older.isEmpty() else text.join(older, ["document_id", "version"], "left_anti")


def document_texts(spark, out_dir):
    """(document_id, text): the newest paragraphs of each document, joined by line breaks; empty for one without any."""
    parts = F.array_sort(F.collect_list(F.struct("para_idx", "text")))
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), "\n")
    texts = newest_text(spark, out_dir).groupBy("document_id").agg(joined.alias("text"))
    documents = read_table(spark, out_dir, "documents").select("document_id").distinct()
    return documents.join(texts, "document_id", "left").select("document_id", F.coalesce("text", F.lit("")).alias("text"))


def compact(spark, out_dir):
    """Rewrite all visible runs as one. Of documents read more than once only the newest text stays."""
    merged = visible_batches(spark, out_dir)
    if len(merged) < 2:
        return None
    batch = open_batch(spark, out_dir, "compact " + " ".join(merged))
    for table in TABLES:
        rows = newest_text(spark, out_dir) if table == "text" else read_table(spark, out_dir, table)
        batch.write(_merged(rows, table), table)
    batch.commit(merged)
    return batch


def _merged(rows, table):
    """Rows of several runs as one run would have written them."""
    if table == "documents":
        return rows.groupBy("document_id", "source_document").agg(F.max("version").alias("version"))
    if table == "dataset_counts":
        return rows.groupBy("source_document", "extraction_method").agg(F.sum("row_count").alias("row_count"))
    if table == "table_counts":
        return rows.groupBy("table_id").agg(F.sum("rows").alias("rows"), F.sum("flagged").alias("flagged"))
    return rows.distinct() if table == "indicator_domains" else rows


def vacuum(spark, out_dir):
    """Remove folders of runs that no reader sees: failed ones and those that were replaced. Not while a run writes."""
    keep = {f"batch={b}" for b in visible_batches(spark, out_dir)}
    for table in TABLES:
        for folder in folders_in(spark, f"{out_dir}/{table}"):
            if folder not in keep:
                remove(spark, f"{out_dir}/{table}/{folder}")


# ---------------------------------------------------------------- summaries


def write_summaries(batch, observations):
    """Counts and domains of one run's accepted observations. They add up over runs, so that reports never scan the
    observations again."""
    batch.write(
        observations.groupBy("source_document", "extraction_method").agg(F.count("*").alias("row_count")), "dataset_counts"
    )
    flagged = F.sum(F.col("validation_flag").cast("long"))
    batch.write(observations.groupBy("table_id").agg(F.count("*").alias("rows"), flagged.alias("flagged")), "table_counts")
    batch.write(observations.select("source_document", "indicator", "domain").distinct(), "indicator_domains")


def list_datasets(spark, out_dir):
    """As query.list_datasets over all observations, from the summaries."""
    return _merged(read_table(spark, out_dir, "dataset_counts"), "dataset_counts")


def table_quality(spark, out_dir):
    """As query.table_quality over all observations, from the summaries."""
    return _merged(read_table(spark, out_dir, "table_counts"), "table_counts")


def domain_consistency(spark, out_dir):
    """As query.domain_consistency over all observations, from the summaries."""
    domains = F.count_distinct("domain")
    rows = read_table(spark, out_dir, "indicator_domains")
    return rows.groupBy("source_document", "indicator").agg(domains.alias("domains")).where("domains > 1")

