"""The registered queries: each operator over whole given tables."""

import uuid

from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.names import letters_in, normalise_ascii
from ..functions.numbers import format_g, is_numeric, number_confidence, parse_number, parse_year
from ..operators import chunks as C
from ..operators import gazetteer as G
from ..operators import headers as H
from ..operators import mapping as M
from ..operators import normalize as N
from ..operators import query as Q
from ..operators.validate import validate_observations
from ..session import ensure_checkpoint_dir
from ..sinks import batches, store
from ..sources import pages as P
from ..sources.csv_tables import read_csv_tables
from . import derived as D
from .batch import process_tables
from .staging import split_enough, spread_out, stage

DEFAULT_YEAR = 2025


def _iso(df, *names):
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd") for n in names})


def _contexts(spark, sf_dir):
    """Opening text of the documents that report tables are said to come from."""
    firsts = D.documents(spark, sf_dir).select(
        F.regexp_replace("source_document", "^doc-(.*)$", "report-$1.docx").alias("source_document"),
        F.posexplode(C.texts_of("paragraphs")).alias("para_idx", "text"),
    )
    return C.document_context(firsts)


# ---------------------------------------------------------------- cells and rows


def parse_cells(spark, sf_dir):
    cell = F.col("cell")
    return (
        D.raw_rows(spark, sf_dir)
        .select("table_id", "row_idx", F.posexplode("cells").alias("col_idx", "cell"))
        .where("cell IS NOT NULL")
        .withColumn("parsed", parse_number(cell))
        .select(
            "table_id",
            "row_idx",
            "col_idx",
            F.coalesce("parsed", F.lit(-1.0)).alias("number"),
            number_confidence(cell).alias("number_confidence"),
            F.coalesce(format_g(F.col("parsed")), F.lit("-")).alias("number_text"),
            is_numeric(cell).alias("numeric"),
            F.coalesce(parse_year(cell), F.lit(-1)).alias("whole"),
            F.coalesce(F.date_format(parse_date(cell), "yyyy-MM-dd"), F.lit("-")).alias("date"),
        )
    )


def classify_rows(spark, sf_dir):
    return H.classify_rows(D.raw_rows(spark, sf_dir)).select("table_id", "row_idx", "kind")


def pad_rows(spark, sf_dir):
    padded = H.pad_rows(D.raw_rows(spark, sf_dir))
    return padded.select(
        "table_id", "row_idx", F.size("cells").alias("width"), F.to_json("cells").alias("cells")
    )


def detect_headers(spark, sf_dir):
    found = H.detect_headers(D.raw_rows(spark, sf_dir))
    return found.select("table_id", "data_start", F.posexplode("headers").alias("col_idx", "header"))


def table_samples(spark, sf_dir):
    rows = D.raw_rows(spark, sf_dir)
    samples = H.table_samples(rows, stage(H.data_starts(rows)))
    return samples.select("table_id", F.to_json("sample_rows").alias("sample_rows"))


def _named_rows(spark, sf_dir):
    grid = N.Grid(D.raw_rows(spark, sf_dir))
    tables = D.raw_tables(spark, sf_dir).select("table_id")
    cells = {"entity_raw": F.get("cells", F.lit(0)), "date_raw": F.get("cells", F.lit(2))}
    return grid, grid.with_tables(tables).withColumns(cells)


def forward_fill_entities(spark, sf_dir):
    return N.forward_fill(*_named_rows(spark, sf_dir)).select("table_id", "row_idx", "entity")


def sticky_period(spark, sf_dir):
    grid, rows = _named_rows(spark, sf_dir)
    stuck = N.fill_and_stick(grid, rows.where(F.col("row_idx") >= D.HEADER_ROWS))
    return _iso(stuck.select("table_id", "row_idx", "date", F.col("sticky").alias("period")), "date")


def csv_documents(spark, sf_dir):
    """Documents, with the line breaks and commas of their texts, written as CSV files and read back: cells by column."""
    folder = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    columns = ["doc_id", "source", "text", "lang", "n_chars"]
    written = split_enough(D.table(spark, sf_dir, "documents").select(*columns))
    quoting = {"header": "true", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    written.write.options(**quoting).csv(folder)
    tables, rows = read_csv_tables(spark, [folder])
    data = rows.where("row_idx >= 0").join(tables.select("table_id"), "table_id", "left_semi")
    return data.select(*[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(columns)], F.size("cells").alias("width"))


# ---------------------------------------------------------------- mapping


def compact_headers(spark, sf_dir):
    """Headers of each order: one per line item, made to share a suffix, a prefix or neither."""
    lines = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    part, flag, status = F.col("l_partkey").cast("string"), F.col("l_returnflag"), F.col("l_linestatus")
    header = (
        F.when(F.col("l_orderkey") % 3 == 0, F.concat(part, F.lit(" - "), flag, F.lit(" - "), status))
        .when(F.col("l_orderkey") % 3 == 1, F.concat(status, F.lit(" - "), part))
        .otherwise(part)
    )
    headers = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(header)).alias("headers"))
    return M.compact_headers(headers).select("l_orderkey", F.to_json("headers").alias("headers"))


def mapping_rejects(spark, sf_dir):
    """Tables that yield nothing because of their reply, with the reason."""
    return M.mapping_rejects(D.replies(spark, sf_dir))


def mapping_metadata(spark, sf_dir):
    return M.reply_metadata(D.replies(spark, sf_dir)).withColumn(
        "entity_column", F.coalesce("entity_column", F.lit(-1))
    )


def map_columns(spark, sf_dir):
    """Columns as later steps read them: one row per table with the chosen column of each role."""
    meta, columns = M.read_replies(D.replies(spark, sf_dir))
    chosen = N.interpret_mapping(meta, columns)
    none = lambda c: F.coalesce(c, F.lit(-1)).alias(c)
    return chosen.select(
        "table_id",
        "entity_column",
        none("year_column"),
        none("date_column"),
        none("period_column"),
        F.array_join(
            F.transform("value_columns", lambda v: F.concat_ws(":", v["col_idx"], v["indicator"], v["unit"])), "|"
        ).alias("value_columns"),
    )


def dedupe_indicators(spark, sf_dir):
    columns = M.dedupe_indicators(M.reply_columns(D.replies(spark, sf_dir)))
    return columns.select("table_id", "col_idx", "field", "indicator", "unit")


def mapping_requests(spark, sf_dir):
    rows, tables = D.raw_rows(spark, sf_dir), D.raw_tables(spark, sf_dir)
    starts = stage(H.data_starts(rows))
    headers = H.detect_headers(rows, starts)
    return M.mapping_requests(headers, H.table_samples(rows, starts), tables, _contexts(spark, sf_dir))


def pending_requests(spark, sf_dir):
    """What a second run asks when the replies of every table but each third are stored: by prompt, not by table."""
    requests = stage(mapping_requests(spark, sf_dir))
    answered = D.replies(spark, sf_dir).where("substring_index(table_id, '#', -1) % 3 <> 0")
    stored = requests.join(answered, "table_id").select("table_id", M.prompt_hash(), "reply")
    outdated = F.col("table_id").endswith("#5")
    stored = stored.withColumn("prompt_hash", F.when(outdated, F.lit("of an older prompt")).otherwise(F.col("prompt_hash")))
    return M.pending_requests(requests, stored).select("table_id", "prompt")


def domain_requests(spark, sf_dir):
    return M.domain_requests(_contexts(spark, sf_dir))


# ---------------------------------------------------------------- names


def gazetteer(spark, sf_dir):
    """How many rows match each gazetteer key exactly, keys without a match included."""
    keys = D.names(spark, sf_dir).select(normalise_ascii(G.clean_name(F.col("name"))).alias("alias_key"))
    used = keys.groupBy("alias_key").agg(F.count("*").alias("n"))
    return G.alias_table(spark).join(used, "alias_key", "left").select(
        "alias_key", "canonical", F.coalesce("n", F.lit(0)).alias("rows")
    )


def normalise_names(spark, sf_dir):
    named = G.normalise_names(D.names(spark, sf_dir), "name", ["id"])
    return named.select("id", "clean_name", "name_key", letters_in(F.col("name_key")).alias("letters"))


def resolve_districts(spark, sf_dir):
    return G.resolve_districts(D.names(spark, sf_dir), "name", ["id"]).select(
        "id", "canonical", "resolution_confidence", "resolution_method"
    )


def fuzzy_resolve(spark, sf_dir):
    return G.resolve_districts(D.misspelt_names(spark, sf_dir), "name", ["id"])


# ---------------------------------------------------------------- observations


def observations(spark, sf_dir):
    """As in a batch, replies and filled rows are written once and read by the steps that need them."""
    rows = D.raw_rows(spark, sf_dir)
    starts = stage(H.data_starts(rows))
    meta, columns = M.read_replies(stage(spread_out(D.replies(spark, sf_dir), "table_id")))
    tables = D.raw_tables(spark, sf_dir)
    done = N.normalize_tables(rows, tables, meta, columns, DEFAULT_YEAR, starts=starts, keep=stage)
    return done.drop("extracted_at")


def normalize_observations(spark, sf_dir):
    return _iso(observations(spark, sf_dir), "date")


def validated(spark, sf_dir):
    return validate_observations(stage(observations(spark, sf_dir)))


def validate(spark, sf_dir):
    return _iso(validated(spark, sf_dir), "date")


def validate_outside(spark, sf_dir):
    """The row rules over observations that no mapping made: all of them occur."""
    return validate_observations(D.outside_observations(spark, sf_dir))


def default_dates(spark, sf_dir):
    """Observations with a date and a period given by the caller, for tables that have none of their own."""
    rows = D.raw_rows(spark, sf_dir)
    meta, columns = M.read_replies(stage(spread_out(D.replies(spark, sf_dir), "table_id")))
    tables = D.raw_tables(spark, sf_dir)
    starts = stage(H.data_starts(rows))
    done = N.normalize_tables(
        rows, tables, meta, columns, DEFAULT_YEAR, starts=starts, default_date="1 March 2020", default_period="FY 2020"
    )
    return _iso(done.select("table_id", "row_idx", "col_idx", "date", "period"), "date")


def processed_tables(spark, sf_dir):
    """Raw tables to validated observations in one call, replies at hand."""
    done = process_tables(
        D.raw_rows(spark, sf_dir),
        D.raw_tables(spark, sf_dir),
        _contexts(spark, sf_dir),
        D.replies(spark, sf_dir),
        DEFAULT_YEAR,
        staged=True,
    )
    return _iso(done.drop("extracted_at"), "date")


_stored = {}


def _store_path(spark, sf_dir, name, fill):
    """Where a store made from sf_dir lies: filled by the first query of the session that reads it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        fill(path)
        _stored[key] = path
    return _stored[key]


def _observation_store(spark, sf_dir):
    """The fact table as two runs leave it: accepted rows, by domain, sorted, with summaries."""

    def fill(path):
        rows = validated(spark, sf_dir).withColumn("document_id", F.col("source_document"))
        accepted = store.accepted_and_rejected(rows)[0]
        half = F.pmod(F.xxhash64("table_id"), F.lit(2))
        for n in (0, 1):
            batch = batches.open_batch(spark, path, f"half {n}")
            part = accepted.where(half == n)
            batch.write(part, "observations")
            batches.write_summaries(batch, part)
            batch.commit()

    return _store_path(spark, sf_dir, "observations", fill)


def stored_observations(spark, sf_dir):
    rows = batches.read_table(spark, _observation_store(spark, sf_dir), "observations")
    return rows.drop("extracted_at", "document_id")


def stored_chunks(spark, sf_dir):
    path = _store_path(
        spark, sf_dir, "document_chunks", lambda path: store.append_chunks(chunk_documents(spark, sf_dir), path)
    )
    return store.read_chunks(spark, path).drop("document_id")


def _text_store(spark, sf_dir):
    """Documents as two runs leave them: the first reads every third document, and older forms of the others."""

    def fill(path):
        texts = D.documents(spark, sf_dir).select(
            F.col("source_document").alias("document_id"), "source_document", C.texts_of("paragraphs").alias("texts")
        )
        once = F.pmod(F.xxhash64("document_id"), F.lit(3)) == 0
        older = F.when(once, F.col("texts")).otherwise(F.transform(F.slice("texts", 1, 3), F.upper))
        for run in (texts.withColumn("texts", older), texts.where(~once)):
            batch = batches.open_batch(spark, path, "documents")
            known = run.withColumn("version", F.lit(batch.version))
            batch.write(known.select("*", F.posexplode("texts").alias("para_idx", "text")), "text")
            batch.write(known, "documents")
            batch.commit()

    return _store_path(spark, sf_dir, "text", fill)


def not_null_rejects(spark, sf_dir):
    """Observations that the store turns away for want of a required value."""
    rows = store.not_null_rejects(observations(spark, sf_dir))
    return rows.select("table_id", "row_idx", "col_idx", "reason")


def obs_datasets(spark, sf_dir):
    return batches.list_datasets(spark, _observation_store(spark, sf_dir))


def obs_entity(spark, sf_dir):
    return _iso(Q.get_entity(stored_observations(spark, sf_dir), "Shivamogga", year=1997), "date")


def obs_query(spark, sf_dir):
    found = Q.query_observations(
        stored_observations(spark, sf_dir),
        indicator="area",
        entity_type="district",
        domain="health",
        min_value=0,
        max_value=4e5,
    )
    return _iso(found, "date")


def obs_query_count(spark, sf_dir):
    return Q.result_count(
        Q.query_observations(stored_observations(spark, sf_dir), date="1997-05-28", include_flagged=True)
    )


def table_quality(spark, sf_dir):
    return batches.table_quality(spark, _observation_store(spark, sf_dir))


def domain_consistency(spark, sf_dir):
    return batches.domain_consistency(spark, _observation_store(spark, sf_dir))


# ---------------------------------------------------------------- text


def _paragraphs(spark, sf_dir):
    """Non-blank paragraphs of every document, numbered inside each document's own row."""
    return D.documents(spark, sf_dir).select(
        "source_document", F.posexplode(C.texts_of("paragraphs")).alias("para_idx", "text")
    )


def _domains(spark, sf_dir):
    return D.document_replies(spark, sf_dir).select(
        "source_document", M.document_domain(F.col("reply")).alias("domain")
    )


def chunk_documents(spark, sf_dir):
    """Documents meet their domain while each is still one row, then split."""
    tagged = D.documents(spark, sf_dir).join(_domains(spark, sf_dir), "source_document", "left")
    return C.chunk_texts(tagged)


def chunks_by_domain(spark, sf_dir):
    return Q.get_chunks(stored_chunks(spark, sf_dir), domain="health")


def chunk_paragraphs(spark, sf_dir):
    """The same chunks from a paragraph table, for sources that deliver one row per paragraph."""
    return C.chunk_paragraphs(_paragraphs(spark, sf_dir), _domains(spark, sf_dir))


def page_paragraphs(spark, sf_dir):
    return P.page_paragraphs(D.page_text(spark, sf_dir))


def chunk_pages(spark, sf_dir):
    return C.chunk_paragraphs(page_paragraphs(spark, sf_dir))


def page_tables(spark, sf_dir):
    tables, rows = P.page_tables(D.page_grids(spark, sf_dir))
    return rows.join(tables, "table_id").select(
        "table_id", "source_document", "source_page", "row_idx", F.to_json("cells").alias("cells")
    )


def document_context(spark, sf_dir):
    return C.document_context(_paragraphs(spark, sf_dir))


def document_domains(spark, sf_dir):
    return _domains(spark, sf_dir)


def document_counts(spark, sf_dir):
    pages = page_paragraphs(spark, sf_dir)
    tables = D.raw_tables(spark, sf_dir).withColumn(
        "source_document", F.regexp_replace("source_document", r"^report-(.*)\.docx$", "conv-$1")
    )
    return Q.document_counts(pages, tables, C.chunk_paragraphs(pages))


def dump_text(spark, sf_dir):
    texts = batches.document_texts(spark, _text_store(spark, sf_dir))
    return texts.withColumnRenamed("document_id", "source_document")


QUERIES = {
    "parse_cells": parse_cells,
    "classify_rows": classify_rows,
    "pad_rows": pad_rows,
    "detect_headers": detect_headers,
    "table_samples": table_samples,
    "forward_fill_entities": forward_fill_entities,
    "sticky_period": sticky_period,
    "csv_documents": csv_documents,
    "compact_headers": compact_headers,
    "mapping_rejects": mapping_rejects,
    "mapping_metadata": mapping_metadata,
    "map_columns": map_columns,
    "dedupe_indicators": dedupe_indicators,
    "mapping_requests": mapping_requests,
    "pending_requests": pending_requests,
    "domain_requests": domain_requests,
    "gazetteer": gazetteer,
    "normalize_names": normalise_names,
    "resolve_districts": resolve_districts,
    "fuzzy_resolve": fuzzy_resolve,
    "normalize_observations": normalize_observations,
    "validate_observations": validate,
    "validate_outside": validate_outside,
    "default_dates": default_dates,
    "process_tables": processed_tables,
    "not_null_rejects": not_null_rejects,
    "obs_datasets": obs_datasets,
    "obs_entity": obs_entity,
    "obs_query": obs_query,
    "obs_query_count": obs_query_count,
    "table_quality": table_quality,
    "domain_consistency": domain_consistency,
    "chunk_documents": chunk_documents,
    "chunks_by_domain": chunks_by_domain,
    "chunk_paragraphs": chunk_paragraphs,
    "chunk_pages": chunk_pages,
    "page_paragraphs": page_paragraphs,
    "page_tables": page_tables,
    "document_context": document_context,
    "document_domains": document_domains,
    "document_counts": document_counts,
    "text_dump": dump_text,
}
