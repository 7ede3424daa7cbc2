"""Output of a PDF extractor, already in tables: page texts and page grids."""

from pyspark.sql import functions as F

from ..functions.text import has_text
from ..plans.skew import dense_index

PAGES_PER_BLOCK = 10_000


def page_paragraphs(page_text, block_rows=PAGES_PER_BLOCK):
    """(doc, page, text) to paragraphs: one per page in page order, blank pages dropped."""
    kept = page_text.where(has_text(F.col("text"))).select(F.col("doc").alias("source_document"), "page", "text")
    return dense_index(kept, "source_document", "page", "para_idx", block_rows).select(
        "source_document", "para_idx", "text"
    )


def page_tables(tables):
    """(doc, page, table_no, rows) to (raw_tables, raw_rows); table_no counts within the document, empty ones drop."""
    filled = tables.where(F.size("rows") > 0).withColumn("table_id", F.concat_ws("#", "doc", "table_no"))
    raw_tables = filled.select(
        "table_id",
        F.col("doc").alias("source_document"),
        F.concat(F.lit("pdf-page-"), F.col("page")).alias("source_page"),
        F.lit("pdf_table").alias("extraction_method"),
    )
    raw_rows = filled.select("table_id", F.posexplode("rows").alias("row_idx", "cells"))
    return raw_tables, raw_rows.withColumn("row_idx", F.col("row_idx").cast("long"))
