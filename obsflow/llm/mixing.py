"""Mixing sources to target weights by capped water-filling, with whole and fractional repetitions.

Sources, in code point order with null last, weigh 1, 2, 3, 1, 2, 3, ... (or as given) and share the words of the whole
corpus. A source whose share is above `max_epochs` times its own words is clamped there; the excess goes to the others
by weight until none is above. With sources in order of cap per weight the clamped ones come first, so the final level
follows from running sums over sources, without iterating.

A document is repeated floor(target / source_size) times. The fraction left is taken from documents in the order of a
seeded hash of id and text until it is used up: whole documents, and of the last one the part that is still missing.
Running sums per source are taken over hash buckets first and within one bucket then, and repeated rows are one row with
a count until the end, so no task gets all rows of a source, of an id or of no id.

Null or empty texts have size 0 and nothing is taken of them; a source of size 0 has target 0. Repeated rows are
separate documents, in any order among themselves. Null ids are ordered by their texts. An empty table gives no rows.
Other columns are not read, whatever their names. Only DataFrame functions are used.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.skew import attach
from ..plans.staging import stage
from .texts import WORD, numbered_copies, whole

MAX_EPOCHS = 3
SEED = 17
HEX_DIGITS = 3  # of the hash, for 4,096 buckets a source
HOT_ROWS = 1_000


def water_level(sources, max_epochs=MAX_EPOCHS):
    """Target of every source. sources: source, source_size, weight; a row per source."""
    everything = W.partitionBy()
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, W.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    room = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
    level = room / F.sum("weight").over(onward)
    return (
        sources.withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("clamped", level * F.col("weight") > F.col("cap"))
        .withColumn("rest", total - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(everything), F.lit(0)))
        .withColumn("open", F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(
                (F.col("rest") * F.col("weight")).cast("double") / F.col("open")
            ),
        )
        .select("source", "source_size", "target")
    )


def turn_weights(sources):
    """Weights 1, 2, 3, repeating, in code point order of the sources."""
    place = F.row_number().over(W.partitionBy().orderBy(F.col("source").asc_nulls_last()))
    return sources.withColumn("weight", (place - 1) % 3 + 1)


def mix(docs, id_col="doc_id", text_col="text", source_col="source", weigh=turn_weights, max_epochs=MAX_EPOCHS, seed=SEED):
    """One row per document: doc_id, size, source_size, target (of its source), taken (words, repeats counted)."""
    text = whole(F.col(text_col))
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
            F.md5(F.concat(id_text, F.lit(f"#{seed}#"), F.md5(text.cast("binary")))).alias("key"),
        )
        .groupBy("doc_id", "source", "size", "key")
        .agg(F.count("*").alias("copies"))
    )
    bucket = F.substring("key", 1, HEX_DIGITS)
    words = F.col("size") * F.col("copies")
    buckets = stage(
        rows.groupBy("source", bucket.alias("bucket")).agg(F.sum(words).alias("size"), F.count("*").alias("rows"))
    )
    sizes = buckets.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("rows").alias("n_rows"))
    levels = water_level(weigh(sizes.drop("n_rows")), max_epochs)
    sources = stage(levels.join(sizes.drop("source_size"), levels["source"].eqNullSafe(sizes["source"])).drop(sizes["source"]))

    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = buckets.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"),
    )
    known = attach(rows, sources, ["source"], ["key"], hot_rows=HOT_ROWS).withColumn("bucket", bucket)
    placed = known.join(
        starts.hint("merge"), F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    )
    within = W.partitionBy("_source", "_bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    whole_times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    known = (
        placed.withColumn("times", whole_times)
        .withColumn("part", F.floor("target") - F.col("times") * F.col("source_size"))
        .withColumn("before", F.col("start") + F.coalesce(F.sum(words).over(within), F.lit(0)))
    )
    used = F.col("before") + (F.col("nth") - 1) * F.col("size")
    more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("part") - used))
    return numbered_copies(known, "copies", "nth").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("times") * F.col("size") + more).cast("bigint").alias("taken"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || '#17#' || md5(coalesce(text, ''))) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), c AS (
  SELECT *, sum(source_size) OVER () AS total,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * weight > cap AS clamped
  FROM s WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)
), t AS (
  SELECT source, source_size,
    CASE WHEN clamped THEN cap::DOUBLE
      ELSE ((total - coalesce(sum(CASE WHEN clamped THEN cap END) OVER (), 0)) * weight)::DOUBLE
        / sum(CASE WHEN NOT clamped THEN weight END) OVER () END AS target
  FROM c
), p AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (times * size + greatest(0, least(size, floor(target)::BIGINT - times * source_size - used)))::BIGINT AS taken
FROM p
"""
