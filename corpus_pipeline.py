"""From raw documents to token counts: quality, exact copies, near copies, mixing, tokens.

Each stage takes what its predecessor kept. Rows are told apart by their text's digest where ids could be null or used
twice: after exact deduplication texts are all different. Null and empty texts have no quality and go first. While a
stage joins, a row of the input is one struct, so its columns may have any names. Repeated rows are copies of one text.
An empty table gives no rows in any stage.
"""

from pyspark.sql import functions as F

from obsflow.llm import byte_bpe, exact_dedup, mixing, ngram_join, quality_crf
from obsflow.llm.texts import lower_ascii, numbered_copies, sha256_hex, whole
from obsflow.plans.staging import stage


def _digest():
    return sha256_hex(lower_ascii(whole(F.col("text"))))


def _rows(docs, *more):
    """Rows as structs beside their digest."""
    return docs.select(F.struct("*").alias("row"), _digest().alias("digest"), *more)


def good_quality(spark, docs, sf_dir):
    """Documents that the line classifier accepts."""
    return quality_crf.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_copies(spark, docs, sf_dir):
    """One document of each text: the largest id. Of rows that share it, with capitals or other columns that differ, the
    one whose JSON form has the smallest digest."""
    found = exact_dedup.deduplicate(docs).where("kept")
    keys = [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id")]
    kept = found.select(*keys, F.col("text_sha256").alias("digest"))
    names = ["no_id", "id", "digest"]
    rows = _rows(docs, *keys).join(kept, names, "left_semi")
    order = F.sha2(F.to_json("row").cast("binary"), 256)
    return rows.groupBy(*names).agg(F.min_by("row", order).alias("row")).select("row.*")


def one_of_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies: the smallest id. Documents without words are in no group."""
    keyed = docs.select(F.struct("doc_id", _digest().alias("digest")).alias("key"), "text")
    found = ngram_join.component_rows(keyed, "key")
    stays = (F.col("n_shingles") == 0) | F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = found.where(stays).select(F.col("doc_id.digest").alias("digest")).distinct()
    return _rows(docs).join(kept, "digest", "left_semi").select("row.*")


def mixed_sources(spark, docs, sf_dir):
    """Documents as often as the mix takes them; the one that the mix takes in part is rounded to the nearest."""
    keyed = docs.select(_digest().alias("key"), "text", "source")
    rows = mixing.mix(keyed, "key")
    whole_times = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(whole_times).cast("bigint")
    taken = rows.select(F.col("doc_id").alias("digest"), times.alias("times")).where("times > 0")
    repeated = numbered_copies(_rows(docs).join(taken, "digest"), "times", "nth")
    return repeated.select("row.*")


def tokens(spark, docs, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return byte_bpe.round_trip(docs)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", one_of_copies),
    ("near_dedup", one_of_near_copies),
    ("mixing", mixed_sources),
    ("tokens", tokens),
]

#: The classifier, the join and the tokenizer have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, step) in enumerate(STAGES, 1):
        docs = step(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs)
    return docs
