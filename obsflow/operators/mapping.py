"""Column mapping: prompts out, replies in, and the checks between."""

import time
from functools import reduce

import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import clamp01, parse_float, parse_whole, round2
from ..functions.text import null_like, strip
from ..plans.staging import read_or_empty, spread_out, stage
from ..schemas import STORED_REPLIES
from ..sources.files import base_name

# Entity types a reply may use; anything else becomes "other" (fixed values).
ENTITY_TYPES = (
    "district",
    "region",
    "state",
    "city",
    "village",
    "school",
    "university",
    "hospital",
    "highway",
    "government_scheme",
    "department",
    "municipality",
    "crop",
    "commodity",
    "indicator",
    "other",
)

# Roles a column may take (fixed values); row_label and ignore are accepted and carry no observation.
FIELDS = ("entity_name", "year", "date", "period", "row_label", "value", "ignore")

DEFAULT_REASON = "Entity type resolved from table content and context."  # fixed value
NOT_SPECIFIED = "Not specified"  # fixed value
CONTEXT_PARAGRAPHS = 5
CONTEXT_CHARS = 1500
PROMPT_ROWS = 5

TABLE_PROMPT = """Map the columns of one statistics table to fixed roles and name its subject.

Document: %s
Nearby text: %s
Column headers: %s
First rows: %s

Roles: {fields}. Use exactly one entity_name column. Use date or period where a plain year would lose detail.
Entity kinds: {types}. Judge the kind by the cell contents and the text, not by the header alone.
Subject (_domain): a lower-case topic such as health or agriculture, the same for the same indicator throughout a
document; null only if nothing in the document tells.
Give every value column its own snake_case indicator and, if known, a unit.

Answer with one JSON object: the keys _entity_column, _entity_type, _entity_type_confidence (0 to 1),
_entity_type_reason and _domain, and one key per zero-based column index holding
{{"field": role, "indicator": name, "unit": unit}}.
""".format(fields=", ".join(FIELDS), types=", ".join(ENTITY_TYPES))

DOCUMENT_PROMPT = """Name the main subject of one document in a lower-case word such as health or agriculture.

Document: %s
Opening text: %s

Answer with one JSON object with the key domain; its value is null if the text does not tell.
"""


# ---------------------------------------------------------------- requests


def _frequent(parts):
    """At most three texts, among them every one that makes up over a quarter of the parts: three counters, one pass. A
    part that has no counter takes a free one, or takes one off each."""
    slots = ("a", "b", "c")

    def step(s, x):
        held = [s[k].eqNullSafe(x) for k in slots]
        free = [s["n" + k] == 0 for k in slots]
        known, room = held[0] | held[1] | held[2], free[0] | free[1] | free[2]
        fields = []
        for k, (mine, empty) in enumerate(zip(held, free)):
            taken = ~known & empty
            for earlier in free[:k]:
                taken = taken & ~earlier
            n = s["n" + slots[k]]
            fields.append(F.when(taken, x).otherwise(s[slots[k]]).alias(slots[k]))
            fields.append(
                F.when(mine & known, n + 1).when(taken, 1).when(known | room, n).otherwise(n - 1).alias("n" + slots[k])
            )
        return F.struct(*fields)

    none = F.struct(*[x for k in slots for x in (F.lit(None).cast("string").alias(k), F.lit(0).alias("n" + k))])
    # Free counters hold a text too; they are told from it by their count, so none is held twice.
    return F.aggregate(parts, none, step, lambda s: F.array(*[F.when(s["n" + k] > 0, s[k]) for k in slots]))


def _most_common(parts, enough):
    """The most frequent text, smallest first among equals, if it occurs often enough: `enough` is at least 2 and half of
    the parts, so the candidates of one pass are counted in another."""
    counted = F.transform(
        F.array_compact(_frequent(parts)),
        lambda t: F.struct((-F.size(F.filter(parts, lambda x: x == t))).alias("n"), t.alias("text")),
    )
    best = F.array_min(counted)
    return F.when(-best["n"] >= enough, best["text"])


def _without(texts, at, start, common):
    """Headers with their part at `at` removed where it equals the column `common`."""

    def one(h):
        parts = F.split(h, " - ")
        rest = strip(F.array_join(F.slice(parts, start, F.size(parts) - 1), " - "))
        return F.when((F.size(parts) > 1) & (strip(F.element_at(parts, at)) == F.col(common)), rest).otherwise(h)

    return F.transform(texts, one)


def compact_headers(df, headers="headers"):
    """Drop the trailing (else leading) ' - ' part that at least half of a table's headers share.

    Applies from three headers on, where the part occurs at least twice; ties go to the smallest text.
    """
    multi = F.filter(F.transform("_texts", lambda h: F.split(h, " - ")), lambda p: F.size(p) > 1)
    enough = F.greatest(F.lit(2), F.floor(F.size("_texts") / 2))
    return (
        df.withColumn("_texts", F.transform(headers, lambda h: F.coalesce(h, F.lit(""))))
        .withColumn("_lasts", F.transform(multi, lambda p: strip(F.element_at(p, -1))))
        .withColumn("_firsts", F.transform(multi, lambda p: strip(F.element_at(p, 1))))
        .withColumn("_suffix", _most_common(F.col("_lasts"), enough))
        .withColumn("_prefix", _most_common(F.col("_firsts"), enough))
        .withColumn(
            headers,
            F.when(F.size(headers) < 3, F.col(headers))
            .when(F.col("_suffix").isNotNull(), _without(F.col("_texts"), -1, 1, "_suffix"))
            .when(F.col("_prefix").isNotNull(), _without(F.col("_texts"), 1, 2, "_prefix"))
            .otherwise(F.col("_texts")),
        )
        .drop("_texts", "_lasts", "_firsts", "_suffix", "_prefix")
    )


def _or_unspecified(c):
    return F.when(c.isNull() | (c == ""), NOT_SPECIFIED).otherwise(c)


def mapping_requests(headers, samples, raw_tables, contexts, prompt_rows=PROMPT_ROWS):
    """(table_id, prompt): one request per table from its document, context, compacted headers and its first
    `prompt_rows` sample rows."""
    return (
        compact_headers(headers).join(raw_tables, "table_id")
        .join(samples, "table_id", "left")
        .join(contexts.select("source_document", "context"), "source_document", "left")
        .select(
            "table_id",
            F.format_string(
                TABLE_PROMPT,
                _or_unspecified(base_name(F.col("source_document"))),
                _or_unspecified(F.col("context")),
                F.to_json("headers", {"ignoreNullFields": "false"}),
                F.to_json(F.slice(F.coalesce("sample_rows", F.array().cast("array<array<string>>")), 1, prompt_rows)),
            ).alias("prompt"),
        )
    )


def domain_requests(contexts):
    """(source_document, prompt): one request per document that has any text."""
    return contexts.where(F.col("context").isNotNull()).select(
        "source_document",
        F.format_string(DOCUMENT_PROMPT, _or_unspecified(base_name(F.col("source_document"))), F.col("context")).alias("prompt"),
    )


class RateLimited(Exception):
    """Raised by a provider to ask for another try later."""


TRIES = 6
WAIT_SECONDS = 5


def _pause(seconds):
    time.sleep(seconds)


def _ask_once(requests, key, provider, calls):
    """(key, prompt, reply, error, limited): one call for each request; `limited` ones were asked to come later."""

    def answer(batches):
        for batch in batches:
            rows = []
            for prompt in batch["prompt"]:
                try:
                    rows.append((provider(prompt), None, False))
                except RateLimited as later:
                    rows.append((None, f"provider failed: {later}"[:500], True))
                except Exception as failure:  # one failed call is one rejected request, not a failed batch
                    rows.append((None, f"provider failed: {failure}"[:500], False))
            reply, error, limited = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame(
                {key: batch[key], "prompt": batch["prompt"], "reply": reply, "error": error, "limited": limited}
            )

    spread = requests.repartition(calls, key) if calls else spread_out(requests, key)
    schema = f"{key} string, prompt string, reply string, error string, limited boolean"
    return stage(spread.select(key, "prompt").mapInPandas(answer, schema))


def ask(requests, key, provider, wait, tries, calls, keep=lambda answers: None):
    """(key, reply, error) of all requests, asked in rounds: who is turned away for now is asked again in the next.

    The pause before a round is the job's, not a task's: no executor waits. Each round's answers are written, and given
    to `keep`, before the next begins, so a failure costs the calls under way. After `tries` rounds being turned away
    counts as a failure.
    """
    rounds, pending = [], requests
    for attempt in range(1, tries + 1):
        asked = _ask_once(pending, key, provider, calls)
        done = asked if attempt == tries else asked.where("NOT limited")
        rounds.append(done.select(key, "reply", "error"))
        keep(rounds[-1])
        pending = asked.where("limited")
        if attempt == tries or pending.isEmpty():
            break
        _pause(wait * attempt)
    return reduce(lambda a, b: a.unionByName(b), rounds)


def map_tables(requests, provider, wait=WAIT_SECONDS, tries=TRIES, calls=None, keep=lambda answers: None):
    """(table_id, reply, error): asks the caller's provider (prompt -> text) once per table, again on RateLimited.

    A call that fails for good has no reply and says why. `calls` is how many requests may be under way at once; by
    default one per shuffle partition.
    """
    return ask(requests, "table_id", provider, wait, tries, calls, keep)


def map_documents(requests, provider, wait=WAIT_SECONDS, tries=TRIES, calls=None):
    """(source_document, domain): asks once per document; a failed or unreadable reply leaves the domain null."""
    replies = ask(requests, "source_document", provider, wait, tries, calls)
    return replies.select("source_document", document_domain(F.col("reply")).alias("domain"))


def prompt_hash():
    return F.sha2("prompt", 256).alias("prompt_hash")


def pending_requests(requests, stored):
    """Requests without a stored reply (table_id, prompt_hash, reply) to just this prompt."""
    asked = requests.select("table_id", "prompt", prompt_hash())
    return asked.join(stored, ["table_id", "prompt_hash"], "left_anti")


def stored_replies(spark, path):
    """(table_id, prompt_hash, reply) at the path; empty where nothing has been stored yet."""
    return read_or_empty(spark, path, STORED_REPLIES)


def replay_tables(requests, provider, path, **options):
    """(table_id, reply, error) of the requests: replies stored at the path are used again, only the rest is asked.

    New replies are appended round by round, before they are used, so that neither a later step's failure nor a second
    run asks twice.
    """
    spark = requests.sparkSession
    asked = stage(requests.select("table_id", "prompt", prompt_hash()))
    pending = stage(pending_requests(asked, stored_replies(spark, path)))

    def keep(answers):
        new = answers.where("error IS NULL").join(pending.select("table_id", "prompt_hash"), "table_id")
        new.select(*STORED_REPLIES.names).write.mode("append").parquet(path)

    answers = map_tables(pending, provider, keep=keep, **options)
    known = stored_replies(spark, path).join(asked.select("table_id", "prompt_hash"), ["table_id", "prompt_hash"], "left_semi")
    used = known.dropDuplicates(["table_id"]).select("table_id", "reply", F.lit(None).cast("string").alias("error"))
    return used.unionByName(answers.where("error IS NOT NULL"))


# ---------------------------------------------------------------- replies


def json_object(reply):
    """The JSON object inside a reply, without code fences or surrounding text, as a map of raw JSON values."""
    return F.from_json(F.regexp_extract(reply, r"(?s)\{.*\}", 0), "map<string,string>")


def document_domain(reply):
    return null_like(F.try_element_at(json_object(reply), F.lit("domain")))


def reply_metadata(replies):
    """(table_id, entity_column, entity_type, entity_type_confidence, entity_type_reason, domain), all checked."""
    value = lambda k: F.try_element_at("_m", F.lit(k))
    kind = F.lower(strip(value("_entity_type")))
    column = parse_whole(value("_entity_column"))
    reason = value("_entity_type_reason")
    domain = F.when(F.map_contains_key("_m", "_domain"), value("_domain")).otherwise(value("domain"))
    return (
        replies.withColumn("_m", json_object(F.col("reply")))
        .where(F.col("_m").isNotNull())
        .select(
            "table_id",
            F.when(column >= 0, column).alias("entity_column"),
            F.when(kind.isin(*ENTITY_TYPES), kind).otherwise("other").alias("entity_type"),
            round2(
                clamp01(F.coalesce(parse_float(value("_entity_type_confidence")), F.lit(0.0)))
            ).alias("entity_type_confidence"),
            F.when(reason.isNull() | (reason == ""), DEFAULT_REASON).otherwise(reason).alias("entity_type_reason"),
            null_like(domain).alias("domain"),
        )
    )


def reply_columns(replies):
    """(table_id, map_ord, col_idx, field, indicator, unit) from the all-digit keys of each reply."""
    spec = lambda k: F.try_element_at("_spec", F.lit(k))
    return (
        # The outer form keeps Spark from parsing the reply again to test it for entries first.
        replies.select("table_id", F.posexplode_outer(json_object(F.col("reply"))).alias("map_ord", "_key", "_value"))
        .where(F.col("_key").rlike("^[0-9]+$"))
        .withColumn("_spec", F.from_json("_value", "map<string,string>"))
        .select(
            "table_id",
            "map_ord",
            F.col("_key").try_cast("int").alias("col_idx"),
            spec("field").alias("field"),
            F.coalesce(spec("indicator"), F.concat(F.lit("value_col_"), F.col("_key"))).alias("indicator"),
            F.when(F.map_contains_key("_spec", "unit"), spec("unit")).otherwise("").alias("unit"),
        )
    )


def dedupe_indicators(column_map):
    """Second and later value columns of a table with the same indicator get _2, _3, ... by column order."""
    is_value = F.col("field") == "value"
    nth = F.row_number().over(W.partitionBy("table_id", "indicator", "field").orderBy("col_idx"))
    return (
        column_map.repartition("table_id")
        .withColumn("_nth", nth)
        .withColumn(
            "indicator",
            F.when(is_value & (F.col("_nth") > 1), F.concat_ws("_", "indicator", "_nth")).otherwise(F.col("indicator")),
        )
        .drop("_nth")
    )


def mapping_rejects(replies):
    """(table_id, reason) of tables that yield nothing because of their reply (table_id, reply; error if there is one)."""
    failed = F.col("error") if "error" in replies.columns else F.lit(None).cast("string")
    meta, columns = reply_metadata(replies), reply_columns(replies)
    roles = columns.groupBy("table_id").agg(
        F.max(F.col("field") == "value").alias("has_value"), F.max(F.col("field") == "entity_name").alias("has_entity")
    )
    flag = lambda c: F.coalesce(c, F.lit(False))
    reason = (
        F.when(failed.isNotNull(), failed)
        .when(F.col("entity_type").isNull(), "unreadable reply")
        .when(~flag(F.col("has_entity")) & F.col("entity_column").isNull(), "no entity column")
        .when(~flag(F.col("has_value")), "no value column")
    )
    return (
        replies.join(meta, "table_id", "left")
        .join(roles, "table_id", "left")
        .select("table_id", reason.alias("reason"))
        .where("reason IS NOT NULL")
    )


def read_replies(replies):
    """(table_meta, column_map) from raw replies."""
    return reply_metadata(replies), dedupe_indicators(reply_columns(replies))
