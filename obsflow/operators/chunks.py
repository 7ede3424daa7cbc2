"""Narrative text: paragraphs merged into chunks, and the opening text used as context.

Whether a paragraph ends a chunk depends only on how many words are pending (0 to 4), so paragraphs are written as a
string of word counts capped at five and one regular expression cuts that string: each match is one chunk.
"""

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import has_text, strip_long, word_count_upto
from ..plans.staging import stage
from .mapping import CONTEXT_CHARS, CONTEXT_PARAGRAPHS

MIN_WORDS = 5
BLOCK_PARAGRAPHS = 4096


def _chunk_pattern(pending=0):
    """Shortest run of word counts that brings the pending words to MIN_WORDS."""
    ends = "".join(str(w) for w in range(MIN_WORDS - pending, MIN_WORDS + 1))
    goes_on = [f"{w}{_chunk_pattern(pending + w)}" for w in range(1, MIN_WORDS - pending)]
    return "(?:" + "|".join([f"[{ends}]", *goes_on]) + ")"


CHUNK = _chunk_pattern()


def _marked(counts):
    """'15314' -> '15E314' and so on: an E after the last paragraph of each complete chunk."""
    return F.regexp_replace(counts, CHUNK, "$0E")


def _ends(marked, n, skip=0):
    """Positions (0-based) of the n paragraphs that end a chunk; `skip` leading counts stand for pending words."""
    flags = F.regexp_replace(F.regexp_replace(marked, "[1-5](?!E)", "-"), "[1-5]E", "E")
    flags = F.slice(F.split(flags, ""), skip + 1, n)
    return F.filter(F.transform(flags, lambda f, i: F.when(f == "E", i)), lambda i: i.isNotNull())


def _closed(ends, n, close):
    """End positions; `close` also ends a chunk at the last of n paragraphs."""
    open_tail = close & (F.coalesce(F.array_max(ends), F.lit(-1)) < n - 1)
    return F.concat(ends, F.when(open_tail, F.array(n - 1)).otherwise(F.array().cast("array<int>")))


def _spans(ends):
    """(ord, lo, hi) of each chunk, given the column that holds the end positions."""
    return F.transform(
        ends,
        lambda hi, i: F.struct(
            i.alias("ord"), (F.coalesce(F.get(ends, i - 1), F.lit(-1)) + 1).alias("lo"), hi.alias("hi")
        ),
    )


def texts_of(paragraphs):
    """Stripped, non-blank paragraphs of an array."""
    return F.transform(F.filter(paragraphs, has_text), strip_long)


def chunk_texts(documents, paragraphs="paragraphs"):
    """Chunks of documents that carry their paragraphs as one array: no shuffle, work linear in the text.

    Adds chunk_index and chunk_text (one row per chunk) in place of the array.
    """
    rest = [c for c in documents.columns if c != paragraphs]
    counts = F.array_join(F.transform("_p", lambda p: word_count_upto(p, MIN_WORDS).cast("string")), "")
    length = F.col("_s.hi") - F.col("_s.lo") + 1
    return (
        documents.withColumn("_p", texts_of(paragraphs))
        .withColumn("_cut", _ends(_marked(counts), F.size("_p")))
        .withColumn("_ends", _closed(F.col("_cut"), F.size("_p"), F.size("_p") > 0))
        # The outer form keeps Spark from working the spans out again to test for any; empty documents drop after it.
        .select(*rest, "_p", F.explode_outer(_spans(F.col("_ends"))).alias("_s"))
        .where("_s IS NOT NULL")
        .select(
            *rest,
            F.col("_s.ord").cast("long").alias("chunk_index"),
            F.array_join(F.slice("_p", F.col("_s.lo") + 1, length), " ").alias("chunk_text"),
        )
    )


def _scan_blocks(batches):
    """Walk the block summaries of each document in order and give every block its entry state.

    Input is sorted by (source_document, block); only a few values are held at a time.
    """
    document, pending, chunks, words = None, 0, 0, ""
    for batch in batches:
        rows = []
        for doc, block, last, ends, emits, tails in batch.itertuples(index=False):
            if doc != document:
                document, pending, chunks, words = doc, 0, 0, ""
            rows.append((doc, block, last, pending, chunks, words))
            words = tails[pending] if emits[pending] else f"{words} {tails[pending]}".strip()
            chunks += int(emits[pending])
            pending = int(ends[pending])
        yield pd.DataFrame(rows, columns=["source_document", "block", "last", "pending", "chunks", "words"])


def _block_entries(blocks):
    """(source_document, block, last, pending, chunks, words) for each block of the documents that span several.

    Each block is first reduced, in parallel, to what it does from each of the five possible entry states.
    """
    counts = F.array_join(F.transform("items", lambda p: p["w"].cast("string")), "")
    states = F.transform(
        F.array(*[F.lit(str(s) if s else "") for s in range(MIN_WORDS)]), lambda s: _marked(F.concat(s, "_counts"))
    )
    tail = lambda m: F.regexp_extract(m, "[1-5]*$", 0)
    total = lambda t: F.aggregate(
        F.filter(F.split(t, ""), lambda d: d != ""), F.lit(0), lambda a, d: a + d.cast("int")
    )
    held = lambda t: F.least(F.length(t), F.size("items"))
    tail_words = lambda t: F.array_join(
        F.transform(F.slice("items", F.size("items") - held(t) + 1, held(t)), lambda p: p["short"]), " "
    )
    emitted = lambda m: F.length(m) - F.length(F.replace(m, F.lit("E"), F.lit("")))
    summary = (
        blocks.withColumn("_counts", counts)
        .withColumn("_states", states)
        .select(
            "source_document",
            "block",
            F.transform("_states", lambda m: total(tail(m))).alias("ends"),
            F.transform("_states", emitted).alias("emits"),
            # With no chunk completed the whole block is pending and the entry digit is not one of its paragraphs.
            F.transform("_states", lambda m: tail_words(tail(m))).alias("tails"),
        )
    )
    following = F.lead("block").over(W.partitionBy("source_document").orderBy("block"))
    ordered = (
        summary.select("source_document", "block", following.isNull().alias("last"), "ends", "emits", "tails")
        .repartition("source_document")
        .sortWithinPartitions("source_document", "block")
    )
    return ordered.mapInPandas(
        _scan_blocks, "source_document string, block long, last boolean, pending int, chunks long, words string"
    )


def chunk_paragraphs(paragraphs, domains=None, block_paragraphs=BLOCK_PARAGRAPHS):
    """Chunks of a paragraph table (source_document, para_idx, text) of any length per document.

    Word counts, and the texts too short to stand alone, are gathered per bounded block; long texts move once, to the
    chunk they end, by a join on their own key. Returns (source_document, chunk_index, chunk_text), and the document's
    domain if `domains` (source_document, domain) is given.
    """
    text = paragraphs.where(has_text(F.col("text"))).select(
        "source_document", "para_idx", strip_long(F.col("text")).alias("text")
    )
    words = word_count_upto(F.col("text"), MIN_WORDS)
    block = F.floor(F.col("para_idx") / block_paragraphs).alias("block")
    blocks = (
        text.withColumn("block", block)
        .withColumn("w", words)
        .withColumn("short", F.when(F.col("w") < MIN_WORDS, F.col("text")))
        .groupBy("source_document", "block")
        .agg(F.array_sort(F.collect_list(F.struct("para_idx", "w", "short"))).alias("items"))
    )
    # Only documents past one block need entry states; mostly there are none, and then nothing is planned for them.
    later = stage(
        paragraphs.where(F.col("para_idx") >= block_paragraphs).select("source_document", block).distinct()
    )
    split = not later.isEmpty()
    entered = {"last": F.lit(True), "pending": F.lit(0), "chunks": F.lit(0).cast("long"), "words": F.lit("")}
    if split:
        # Both joins reuse the grouping's partitioning.
        several = later.union(later.select("source_document", F.lit(0).cast("long"))).distinct()
        entries = _block_entries(blocks.join(several, ["source_document", "block"], "left_semi"))
    tags = []
    if domains is not None:
        # Tagged per block, so that a document holding most paragraphs is not one task here either.
        tags = ["domain"]
        places = text.select("source_document", block).distinct()
        tagged = places.join(domains.select("source_document", "domain"), "source_document", "left")
        blocks = blocks.join(tagged, ["source_document", "block"])
    placed = blocks.join(entries, ["source_document", "block"], "left") if split else blocks
    placed = placed.select(
        "source_document",
        "items",
        *[(F.coalesce(c, default) if split else default).alias(c) for c, default in entered.items()],
        *tags,
    )
    entry = F.when(F.col("pending") > 0, F.col("pending").cast("string")).otherwise("")
    counts = F.concat(entry, F.array_join(F.transform("items", lambda p: p["w"].cast("string")), ""))
    before = F.transform(F.slice("items", F.col("_s.lo") + 1, F.col("_s.hi") - F.col("_s.lo")), lambda p: p["short"])
    carried = F.when((F.col("_s.ord") == 0) & (F.col("words") != ""), F.array("words"))
    carried = F.coalesce(carried, F.array().cast("array<string>"))
    heads = (
        placed.withColumn("_cut", _ends(_marked(counts), F.size("items"), F.length(entry)))
        .withColumn("_ends", _closed(F.col("_cut"), F.size("items"), F.col("last")))
        .withColumn("_s", F.explode_outer(_spans(F.col("_ends"))))
        .where("_s IS NOT NULL")
        .select(
            "source_document",
            F.element_at("items", F.col("_s.hi") + 1)["para_idx"].alias("para_idx"),
            (F.col("chunks") + F.col("_s.ord")).alias("chunk_index"),
            F.concat(carried, before).alias("before"),
            *tags,
        )
    )
    return text.join(heads, ["source_document", "para_idx"]).select(
        "source_document",
        "chunk_index",
        F.array_join(F.concat("before", F.array("text")), " ").alias("chunk_text"),
        *tags,
    )


def document_context(paragraphs, n=CONTEXT_PARAGRAPHS, chars=CONTEXT_CHARS):
    """(source_document, context): first n paragraphs joined by a space, cut at `chars` characters.

    Each paragraph is cut before it moves; what lies past the cut could not be in the result.
    """
    opening = F.substring("text", 1, chars).alias("text")
    first = paragraphs.where(F.col("para_idx") < n).select("source_document", "para_idx", opening)
    ordered = F.array_sort(F.collect_list(F.struct("para_idx", "text")))
    joined = F.array_join(F.transform(ordered, lambda p: p["text"]), " ")
    return first.groupBy("source_document").agg(F.substring(joined, 1, chars).alias("context"))
