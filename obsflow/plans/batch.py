"""Whole-batch jobs: many files in, observations and chunks out."""

import hashlib
import json
import re
from functools import reduce

from pyspark.sql import functions as F

from ..operators.chunks import chunk_paragraphs, document_context
from ..operators.headers import data_starts, detect_headers, known_headers, table_samples
from ..operators.mapping import (
    domain_requests,
    map_documents,
    map_tables,
    mapping_rejects,
    mapping_requests,
    read_replies,
    replay_tables,
)
from ..operators.normalize import normalize_tables
from ..operators.validate import validate_observations
from ..schemas import CHUNKS, PARAGRAPHS, RAW_ROWS, RAW_TABLES
from ..sinks import batches, store
from ..sources.csv_tables import read_csv_tables
from ..sources.files import base_name, binary_files, list_files, rejects
from ..sources.ooxml import broken_files, docx_media, docx_paragraphs, docx_tables, parse_docx, parse_xlsx, xlsx_tables
from ..sources.pages import page_paragraphs, page_tables
from .staging import release, scratch_mark, spread_out, stage


def table_layout(raw_rows):
    """(starts, headers): data starts of every table; headers, read off where the format tells and detected elsewhere,
    of tables that have data. A table of text alone would make its whole length a header, and yields nothing."""
    free, known = raw_rows.where("NOT header_known"), raw_rows.where("header_known")
    detected = stage(data_starts(free))
    given = known_headers(known)
    counted = known.where("row_idx >= 0").groupBy("table_id").agg(F.count("*").alias("n_rows"))
    columns = ["table_id", "data_start", "n_rows"]
    starts = detected.select(*columns).unionByName(given.join(counted, "table_id").select(*columns))
    headers = detect_headers(free, detected.where("data_start < n_rows")).select("table_id", "headers")
    return stage(starts), headers.unionByName(given.select("table_id", "headers"))


def table_replies(raw_rows, raw_tables, contexts, provider, starts, headers, replies_path=None):
    """(table_id, reply, error): one request per table that has data rows; the others yield nothing whatever the mapping.

    With `replies_path` replies are kept there across runs, and only requests without one are asked.
    """
    filled = starts.where("data_start < n_rows")
    asked = headers.join(filled.select("table_id"), "table_id", "left_semi")
    requests = mapping_requests(asked, table_samples(raw_rows, filled), raw_tables, contexts)
    if replies_path:
        return stage(replay_tables(requests, provider, replies_path))
    return stage(map_tables(requests, provider))


def process_tables(
    raw_rows, raw_tables, contexts, provider, default_year, replies_path=None, staged=False, reject=None, **normalize
):
    """Validated observations of raw tables: headers, one mapping request per table, normalisation, checks.

    `provider` is a callable (prompt -> reply text) or a table (table_id, reply) of replies already in hand. Tables
    whose reply is missing, unreadable or names no entity or value column are given to `reject` (item, step, reason).
    """
    starts, headers = table_layout(raw_rows)
    if callable(provider):
        replies = table_replies(raw_rows, raw_tables, contexts, provider, starts, headers, replies_path)
    else:
        # Parsing is not pushed down into what makes them, where rows may be many more, nor left to one task.
        replies = stage(spread_out(provider, "table_id"))
    if reject:
        reject(mapping_rejects(replies).select(F.col("table_id").alias("item"), F.lit("mapping").alias("step"), "reason"))
    table_meta, column_map = read_replies(replies)
    keep = stage if staged else (lambda df: df)
    observations = normalize_tables(
        raw_rows, raw_tables, table_meta, column_map, default_year, starts=starts, keep=keep, **normalize
    )
    return validate_observations(stage(observations) if staged else observations)


def _union(frames, schema, spark):
    empty = spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), [f.select(*schema.names) for f in frames], empty)


def literal_path(path):
    """A path as a pattern that stands for itself."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def extract(spark, paths, staging, page_text=None, page_grids=None, without=None):
    """Read every supported file under the paths into staged paragraphs, raw tables and raw rows, parsing each once. Files
    named in `without` (path) are not opened.

    PDF content comes as tables made by an external extractor: page_text (doc, page, text) and page_grids
    (doc, page, table_no, rows).
    """
    listed = list_files(spark, paths)
    files = stage(listed if without is None else listed.join(without, "path", "left_anti"), f"{staging}/files")
    if without is not None:
        paths = [literal_path(r.path) for r in files.where("supported").select("path").collect()]
    present = {r.extension for r in files.where("supported").select("extension").distinct().collect()}
    paragraphs, tables, rows, broken = [], [], [], []

    def add(pair, header_known):
        tables.append(pair[0])
        rows.append(pair[1].withColumn("header_known", F.lit(header_known)))

    if ".docx" in present:
        parts = stage(parse_docx(binary_files(spark, paths, ".docx")), f"{staging}/docx")
        paragraphs.append(docx_paragraphs(parts))
        broken.append(broken_files(parts))
        add(docx_tables(parts), False)
        stage(docx_media(parts), f"{staging}/media")
    if ".xlsx" in present:
        sheets = stage(parse_xlsx(binary_files(spark, paths, ".xlsx")), f"{staging}/xlsx")
        broken.append(broken_files(sheets))
        add(xlsx_tables(sheets), True)
    if ".csv" in present:
        add(read_csv_tables(spark, paths), True)
    if page_text is not None:
        paragraphs.append(page_paragraphs(page_text))
    if page_grids is not None:
        add(page_tables(page_grids), False)
    paged = [p.select("doc") for p in (page_text, page_grids) if p is not None]
    paged = reduce(lambda a, b: a.unionByName(b), paged) if paged else None
    unread = reduce(lambda a, b: a.unionByName(b), [rejects(files, paged), *broken])
    return (
        unread.select(F.col("path").alias("item"), F.lit("reading").alias("step"), "reason"),
        stage(_union(paragraphs, PARAGRAPHS, spark), f"{staging}/paragraphs"),
        stage(_union(tables, RAW_TABLES, spark), f"{staging}/raw_tables"),
        stage(_union(rows, RAW_ROWS, spark), f"{staging}/raw_rows"),
    )


def _identified(df):
    """The full path as document_id; source_document becomes the file's name, as readers of the tables expect."""
    return df.withColumn("document_id", F.col("source_document")).withColumn(
        "source_document", base_name(F.col("source_document"))
    )


def run_batch(
    spark, paths, out_dir, default_year, table_provider, domain_provider, skip_loaded=False, batch_name=None, **options
):
    """Files under `paths` to the store at `out_dir` (`sinks.batches`): observations, observations_rejected,
    document_chunks, text, documents, rejects (a row per file or table that was not loaded, with the reason), summaries;
    and the replies of the table provider. Returns (observations, chunks) as they can then be read.

    Every stage is written to shared storage before the next one reads it, so lost executors cost one stage at most. All
    tables of the run become visible together, at its end; a run that failed leaves nothing visible, and the same call
    again replaces what it wrote. A named batch that was entered before is not run again. Scratch tables are removed at
    the end. With `skip_loaded` files that an earlier run loaded, by full path, are not opened.
    """
    request = json.dumps([sorted(paths), default_year, skip_loaded])
    batch = batches.open_batch(spark, out_dir, hashlib.sha256(request.encode()).hexdigest(), batch_name)
    mark = scratch_mark(spark)
    try:
        if not batch.committed:
            _load(batch, paths, default_year, table_provider, domain_provider, skip_loaded, options)
    finally:
        release(spark, mark)
    return batches.read_table(spark, out_dir, "observations"), batches.read_table(spark, out_dir, "document_chunks")


def _load(batch, paths, default_year, table_provider, domain_provider, skip_loaded, options):
    spark, out_dir = batch.spark, batch.out_dir
    staging = f"{out_dir}/staging"
    loaded = None
    if skip_loaded:
        loaded = stage(batches.read_table(spark, out_dir, "documents").select(F.col("document_id").alias("path")).distinct())
    unread, paragraphs, raw_tables, raw_rows = extract(spark, paths, staging, without=loaded, **options)
    if skip_loaded:  # page tables name their documents too
        known = loaded.withColumnRenamed("path", "source_document")
        paragraphs = paragraphs.join(known, "source_document", "left_anti")
        raw_tables = raw_tables.join(known, "source_document", "left_anti")
        raw_rows = raw_rows.join(raw_tables.select("table_id"), "table_id", "left_semi")
    version = F.lit(batch.version).alias("version")
    contexts = stage(document_context(paragraphs), f"{staging}/contexts")
    batch.write(_identified(paragraphs).select("*", version), "text")
    domains = stage(map_documents(domain_requests(contexts), domain_provider), f"{staging}/domains")
    batch.write(store.conform(_identified(chunk_paragraphs(paragraphs, domains=domains)), CHUNKS), "document_chunks")
    turned_away = [unread]
    observations = process_tables(
        raw_rows,
        raw_tables,
        contexts,
        table_provider,
        default_year,
        replies_path=f"{out_dir}/replies",
        reject=turned_away.append,
        staged=True,
    )
    accepted, rejected = store.accepted_and_rejected(_identified(observations))
    batch.write(accepted, "observations")
    batch.write(rejected, "observations_rejected")
    batches.write_summaries(batch, accepted)
    batch.write(reduce(lambda a, b: a.unionByName(b), turned_away), "rejects")
    seen = paragraphs.select("source_document").union(raw_tables.select("source_document")).distinct()
    batch.write(_identified(seen).select("*", version), "documents")
    batch.commit()
