"""Parquet tables of observations and chunks: fixed schema, partitioned by domain, sorted for min/max pruning."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.staging import stage
from ..schemas import CHUNKS, OBSERVATIONS, OBSERVATIONS_NOT_NULL

SORT_KEYS = ("entity_name", "indicator", "year")


def clean_doubles(df):
    """NaN becomes null in every double column."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in doubles})


def conform(df, schema=OBSERVATIONS):
    """Cast to the fixed columns; columns that old data lacks come out null, a missing flag is false."""
    have = set(df.columns)
    columns = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    out = df.select(*columns)
    if "validation_flag" in schema.names:
        out = out.withColumn("validation_flag", F.coalesce("validation_flag", F.lit(False)))
    return out


def split_not_null(df, required=OBSERVATIONS_NOT_NULL):
    """(accepted, rejected) by the columns that must be present."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return df.where(complete), df.where(~complete)


def not_null_rejects(df, required=OBSERVATIONS_NOT_NULL):
    """Rows that lack a required value, with the reason."""
    missing = F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])), ", ")
    return split_not_null(df, required)[1].withColumn("reason", F.concat(F.lit("missing "), missing))


def accepted_and_rejected(df):
    """(accepted, rejected with the reason): both in the fixed columns, the rows worked out once."""
    rows = stage(conform(clean_doubles(df)))
    return split_not_null(rows)[0], not_null_rejects(rows)


def append_observations(df, path, rejected_path=None):
    """Append. Rows lacking a required value go to `rejected_path` with the reason, by default beside the table.

    A domain holding most rows is split over tasks.
    """
    accepted, rejected = accepted_and_rejected(df)
    rejected.write.mode("append").parquet(rejected_path or f"{path.rstrip('/')}_rejected")
    (
        accepted.hint("rebalance", "domain")
        .sortWithinPartitions("domain", *SORT_KEYS)
        .write.mode("append")
        .partitionBy("domain")
        .parquet(path)
    )


def append_chunks(df, path):
    """Append (source_document, domain, chunk_text, chunk_index, document_id)."""
    (
        conform(df, CHUNKS)
        .hint("rebalance", "domain")
        .sortWithinPartitions("domain", "source_document", "chunk_index")
        .write.mode("append")
        .partitionBy("domain")
        .parquet(path)
    )


def read_observations(spark, path):
    """The stored table; files written before a column existed read it as null."""
    return spark.read.schema(OBSERVATIONS).parquet(path)


def read_chunks(spark, path):
    return spark.read.schema(CHUNKS).parquet(path)


def merge_versions(old, new):
    """Rows of an older layout next to new ones, missing columns as null."""
    return old.unionByName(new, allowMissingColumns=True)


def text_dump(documents, paragraphs="paragraphs"):
    """(source_document, text) of documents that carry their paragraphs as one array: joined by line breaks."""
    return documents.select("source_document", F.array_join(paragraphs, "\n").alias("text"))
