"""Exact deduplication against a persistent index of digests, bucketed and sorted by digest.

Texts are equal when identical after lower-casing A-Z; a null text is empty, and all empty texts are equal. A batch is
reduced to one row per digest before anything is joined. Digests the index lacks are found by a sort-merge anti-join,
which reads the index bucket by bucket without shuffling it, and are appended. Only DataFrame functions are used.

Repeated rows (same id, same text): one of them stays. Null ids rank below all others. An empty table gives no rows.
Other columns of the input are not read.
"""

import uuid

from pyspark.sql import functions as F

from ..plans.skew import attach
from ..plans.staging import folders_in, scratch_path, stage
from .texts import lower_ascii, numbered_copies, sha256_hex, whole

HOT_ROWS = 1_000
BUCKET_ROWS = 2_000_000  # digests a bucket is meant to hold, some 100 MB
LEAST_BUCKETS = 32
SHAPE = "buckets int, id_type string"


class DigestIndex:
    """digest -> keep_id in buckets, in the folder `path`: the sorted files, and beside them the number of buckets.

    A new index gets the buckets that `rows` digests need (or `buckets`); whoever opens it again gets the number it was
    made with, and asking for another number or id type is an error, as digests would be looked for in wrong buckets. An
    append that is run again after a failure finds its digests there and adds none.
    """

    def __init__(self, spark, path, id_type=None, buckets=None, rows=0):
        self.spark, self.path = spark, path
        known = "shape" in folders_in(spark, path)
        made = spark.read.schema(SHAPE).parquet(f"{path}/shape").head() if known else None
        if made is None:
            most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
            made_for = buckets or min(most, max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)))
            made = (made_for, id_type or "bigint")
            shape = spark.range(1).select(F.lit(made[0]).alias("buckets"), F.lit(made[1]).alias("id_type"))
            shape.write.mode("overwrite").parquet(f"{path}/shape")
        self.buckets, self.id_type = made
        if buckets not in (None, self.buckets) or id_type not in (None, self.id_type):
            raise ValueError(
                f"{path} has {self.buckets} buckets and ids of type {self.id_type}, not {buckets} and {id_type}; "
                "`copy_to` makes an index of another shape"
            )
        self.name = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {self.id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}/digests'"
        )

    def read(self):
        return self.spark.table(self.name)

    def append(self, groups):
        """Add the digests of `groups` (digest, keep_id) that the index does not have."""
        fresh = groups.select("digest", "keep_id").join(self.read().hint("merge"), "digest", "left_anti")
        self._insert(stage(fresh))

    def _insert(self, rows):
        rows.repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def copy_to(self, path, buckets=None):
        """A new index with the same digests, one file a bucket: for one that many appends have cut into small files, or
        that has outgrown its buckets. The old one stays as it is."""
        new = DigestIndex(self.spark, path, self.id_type, buckets, self.read().count())
        new.append(self.read())
        return new


def digest_rows(docs, id_col="doc_id", text_col="text"):
    """One row per (digest, doc_id), with the number of rows that share both."""
    text = sha256_hex(lower_ascii(whole(F.col(text_col))))
    rows = docs.select(F.unhex(text).alias("digest"), F.col(id_col).alias("doc_id"))
    return rows.groupBy("digest", "doc_id").agg(F.count("*").alias("copies"))


def deduplicate(docs, index=None, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, keep_id, group_size (rows of this batch with the text), kept, text_sha256.

    Without an index, a new one is made in the shared folder, which goes with the session's scratch tables. A text that the index already has keeps the id it was
    first stored with; within a batch the largest id stays. A digest that holds many rows is joined by broadcast of at
    most 10,000 such digests (`attach`), so no task gets all its rows.
    """
    spark = docs.sparkSession
    rows = stage(digest_rows(docs, id_col, text_col))
    groups = stage(
        rows.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"), F.count("*").alias("n_rows")
        )
    )
    if index is None:
        id_type = rows.schema["doc_id"].dataType.simpleString()
        index = DigestIndex(spark, scratch_path(spark, "digests"), id_type, rows=groups.count())
    index.append(groups)
    known = groups.drop("keep_id").join(index.read().hint("merge"), "digest")
    found = attach(rows, stage(known), ["digest"], ["doc_id"], hot_rows=HOT_ROWS)
    return numbered_copies(found, "copies", "nth").select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("nth") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE = """
WITH x AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents
)
SELECT doc_id,
  max(doc_id) OVER w AS keep_id,
  count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AND row_number() OVER (PARTITION BY h, doc_id) = 1 AS kept,
  h AS text_sha256
FROM x WINDOW w AS (PARTITION BY h)
"""
