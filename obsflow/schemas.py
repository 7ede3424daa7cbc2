"""Fixed schemas of the tables that pass between operators."""

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# One row per extracted table. Everything constant within a table lives here, so the wide row data below stays narrow.
RAW_TABLES = _struct(
    ("table_id", S),
    ("source_document", S),
    ("source_page", S),
    ("extraction_method", S),
)

# One row per table row. row_idx is 0-based; -1 holds the header row of formats whose header is known (CSV, XLSX).
RAW_ROWS = _struct(("table_id", S), ("row_idx", L), ("cells", T.ArrayType(S)), ("header_known", T.BooleanType()))

PARAGRAPHS = _struct(("source_document", S), ("para_idx", L), ("text", S))

MEDIA = _struct(("source_document", S), ("name", S), ("content", T.BinaryType()))

TABLE_META = _struct(
    ("table_id", S),
    ("entity_column", I),
    ("entity_type", S),
    ("entity_type_confidence", D),
    ("entity_type_reason", S),
    ("domain", S),
)

COLUMN_MAP = _struct(
    ("table_id", S),
    ("map_ord", I),
    ("col_idx", I),
    ("field", S),
    ("indicator", S),
    ("unit", S),
)

REPLIES = _struct(("table_id", S), ("reply", S))

STORED_REPLIES = _struct(("table_id", S), ("prompt_hash", S), ("reply", S))

# What was not loaded: a path or table, the step that turned it away, and why.
REJECTS = _struct(("item", S), ("step", S), ("reason", S))

DOCUMENTS = _struct(("document_id", S), ("source_document", S), ("version", I))

# A document's paragraphs as a run read them; a later run's version replaces an earlier one's.
TEXT = _struct(("document_id", S), ("source_document", S), ("version", I), ("para_idx", L), ("text", S))

# Additive summaries of the observations of one batch.
DATASET_COUNTS = _struct(("source_document", S), ("extraction_method", S), ("row_count", L))
TABLE_COUNTS = _struct(("table_id", S), ("rows", L), ("flagged", L))
INDICATOR_DOMAINS = _struct(("source_document", S), ("indicator", S), ("domain", S))

# One row per run: begun ones, and those whose files count.
RUNS = _struct(("batch", S), ("version", I), ("request", S), ("replaces", T.ArrayType(S)))

OBSERVATIONS = _struct(
    ("entity_name", S),
    ("entity_type", S),
    ("entity_resolution_method", S),
    ("domain", S),
    ("year", I),
    ("date", T.DateType()),
    ("period", S),
    ("indicator", S),
    ("value", D),
    ("unit", S),
    ("source_document", S),
    ("source_page", S),
    ("extraction_method", S),
    ("confidence", D),
    ("extracted_at", T.TimestampType()),
    ("validation_flag", T.BooleanType()),
    ("validation_reason", S),
    ("table_id", S),
    ("document_id", S),
)

OBSERVATIONS_REJECTED = T.StructType([*OBSERVATIONS, T.StructField("reason", S)])

OBSERVATIONS_NOT_NULL = ("entity_name", "entity_type", "year", "indicator")

CHUNKS = _struct(("source_document", S), ("domain", S), ("chunk_text", S), ("chunk_index", L), ("document_id", S))
