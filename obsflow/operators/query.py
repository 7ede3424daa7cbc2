"""Reading the fact table back: filters that reach the Parquet scan, and small reports."""

from pyspark.sql import functions as F


def _unflagged(df, include_flagged):
    return df if include_flagged else df.where(~F.col("validation_flag"))


def query_observations(
    obs,
    indicator=None,
    entity_type=None,
    domain=None,
    year=None,
    date=None,
    period=None,
    min_value=None,
    max_value=None,
    include_flagged=False,
):
    """All given conditions together. Empty text and year 0 mean no condition; a bound of 0 is a bound."""
    equal = {"indicator": indicator, "entity_type": entity_type, "domain": domain, "year": year, "period": period}
    for name, wanted in equal.items():
        if wanted:
            obs = obs.where(F.col(name) == wanted)
    if date:
        obs = obs.where(F.col("date") == F.lit(date).cast("date"))
    if min_value is not None:
        obs = obs.where(F.col("value") >= float(min_value))
    if max_value is not None:
        obs = obs.where(F.col("value") <= float(max_value))
    return _unflagged(obs, include_flagged)


def get_entity(obs, entity_name, year=None, include_flagged=False):
    """Observations of one entity; an unknown name gives an empty result."""
    obs = obs.where(F.col("entity_name") == entity_name)
    if year:
        obs = obs.where(F.col("year") == year)
    return _unflagged(obs, include_flagged)


def list_datasets(obs):
    return obs.groupBy("source_document", "extraction_method").agg(F.count("*").alias("row_count"))


def get_chunks(chunks, source_document=None, domain=None):
    """Chunks of a document and / or domain, in reading order."""
    if source_document:
        chunks = chunks.where(F.col("source_document") == source_document)
    if domain:
        chunks = chunks.where(F.col("domain") == domain)
    identity = ["document_id"] if "document_id" in chunks.columns else []
    return chunks.orderBy("source_document", *identity, "chunk_index")


def result_count(df):
    return df.agg(F.count("*").alias("count"))


def table_quality(obs):
    """Rows and flagged rows per table."""
    flagged = F.sum(F.col("validation_flag").cast("long"))
    return obs.groupBy("table_id").agg(F.count("*").alias("rows"), flagged.alias("flagged"))


def domain_consistency(obs):
    """Indicators that carry more than one domain within a source, with how many."""
    domains = F.count_distinct("domain")
    return obs.groupBy("source_document", "indicator").agg(domains.alias("domains")).where("domains > 1")


def document_counts(paragraphs, raw_tables, chunks):
    """Paragraphs, tables and chunks per document; each side is counted before they meet."""

    def counted(df, name):
        return df.groupBy("source_document").agg(F.count("*").alias(name))

    names = ("paragraphs", "tables", "chunks")
    sides = [counted(df, name) for df, name in zip((paragraphs, raw_tables, chunks), names)]
    joined = sides[0]
    for side in sides[1:]:
        joined = joined.join(side, "source_document", "full")
    return joined.fillna(0, list(names))
