"""Document fingerprints: one-permutation MinHash of word shingles, densified, cut to a few low-order bits, packed.

A text is lower-cased (A-Z), cut into words and into the set of its shingles of five neighbouring words (with fewer words
the whole sequence is one shingle). Every shingle is hashed once; the hash names one of `BINS` bins and a value, and each
bin keeps its smallest value. An empty bin borrows: it asks other bins in an order of its own, drawn at random once for
all texts, and takes the value of the first that has one (optimal densification: borrowers of one bin are independent of
their places). Of each bin `BITS` bits are stored, of a hash of its value and its number, so that values borrowed twice
do not agree or differ together. Two fingerprints that agree in e bins have the likeness (e / BINS - r) / (1 - r), not
below 0, where r = 2^-BITS is the share of bins that agree by chance.

With 256 bins and 4 bits a fingerprint has 128 bytes; the likeness has a standard error of about 0.03.

A text without words has an empty fingerprint, which is like another empty one (1) and unlike any other (0). A null text
is empty. An empty table gives no rows. Only the two named columns are read, so other columns cannot clash. All work is
done by DataFrame functions, inside the row: no shingle is shuffled. A task holds the words of one text at a time.
"""

import hashlib

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import let
from ..plans.staging import stage
from .texts import WORD, lower_ascii, sha256_hex, whole

SHINGLE = 5
BINS = 256
BITS = 4
A_WORD = 64 // BITS  # stored values in a long

# The hash of a shingle: its words' checksums times these, modulo a prime below 2^44; then mixed once more.
FACTORS = (179424673, 198491317, 217645177, 236887691, 256203161)
PRIME = 2**44 - 17
MIX = 198733
BIN_SHIFT = 37  # bits below the bin's number in a sort key
EMPTY = 1 << 36  # above all values
STORED_PRIME = 2**31 - 1
TRIES = 6  # steps of the borrowing order that are written out before it is walked


def _bin_numbers():
    """For each bin (start, odd step, factor): the order in which it asks others, and the hash of what it stores."""
    digests = [hashlib.md5(str(j).encode()).digest() for j in range(BINS)]
    return [(d[0], d[1] | 1, int.from_bytes(d[2:5]) + 1) for d in digests]


def _no_longs():
    return F.array().cast("array<bigint>")


def _longs(values):
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def shingle_hashes(text):
    """One 44-bit hash for each place of a shingle in the text; no shingle, no hash.

    A value used twice is worked out in a step of its own: inside lambdas nothing else keeps it from being worked out
    again."""
    words = F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))
    codes = F.transform(words, lambda w: F.crc32(w.cast("binary")) + 1)
    filled = let(codes, lambda c: F.concat(c, F.array_repeat(F.lit(0).cast("bigint"), SHINGLE - F.size(c))))

    def sums(codes):
        at = lambda i, k: F.get(codes, i + k) * F.lit(FACTORS[k])
        summed = lambda i: (at(i, 0) + at(i, 1) + at(i, 2) + at(i, 3) + at(i, 4)) % F.lit(PRIME)
        none = F.get(codes, F.lit(0)) == 0
        return F.when(~none, F.transform(F.sequence(F.lit(0), F.size(codes) - SHINGLE), summed)).otherwise(_no_longs())

    return F.transform(let(filled, sums), lambda x: x.bitwiseXOR(F.shiftright(x, 21)) * F.lit(MIX) % F.lit(PRIME))


def fingerprint(text):
    """The packed fingerprint of a text: array of longs, or an empty array."""
    mask = (1 << BIN_SHIFT) - 1
    marks = _longs([(j << BIN_SHIFT) | EMPTY for j in range(BINS)])
    starts, steps, factors = (_longs(v) for v in zip(*_bin_numbers()))
    every_bin = F.sequence(F.lit(0), F.lit(BINS - 1))
    keyed = lambda h: F.shiftleft(h.bitwiseAND(F.lit(BINS - 1)), BIN_SHIFT) + F.shiftright(h, 8)

    def smallest(ordered):
        """One value for each bin, in order of bins; null where it has none."""
        new = lambda x, i: (i == 0) | (F.shiftright(x, BIN_SHIFT) != F.shiftright(F.get(ordered, i - 1), BIN_SHIFT))
        return F.transform(F.filter(ordered, new), lambda x: F.nullif(x.bitwiseAND(F.lit(mask)), F.lit(EMPTY)))

    def dense(bins):
        def asked(j, t):
            return F.get(bins, (F.get(starts, j) + F.get(steps, j) * t).bitwiseAND(F.lit(BINS - 1)).cast("int"))

        def of(j):
            walk = F.aggregate(
                F.sequence(F.lit(TRIES), F.lit(BINS - 1)), F.lit(None).cast("bigint"), lambda a, t: F.coalesce(a, asked(j, t))
            )
            return F.coalesce(F.get(bins, j), *[asked(j, t) for t in range(TRIES)], walk)

        return F.transform(every_bin, of)

    def stored(v, j):
        return v.bitwiseXOR(F.shiftright(v, 18)) * F.get(factors, j) % F.lit(STORED_PRIME) % (1 << BITS)

    def packed(values):
        word = lambda w: F.aggregate(
            F.slice(values, w * A_WORD + 1, A_WORD), F.lit(0).cast("bigint"), lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v)
        )
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // A_WORD - 1)), word)

    def of_hashes(hashes):
        ordered = F.sort_array(F.concat(F.transform(hashes, keyed), marks))
        bits = let(F.transform(let(let(ordered, smallest), dense), stored), packed)
        return F.when(F.size(hashes) > 0, bits).otherwise(_no_longs())

    return let(shingle_hashes(text), of_hashes)


def agreeing(a, b):
    """In how many bins two fingerprints agree."""
    ones = int("0" * (BITS - 1) + "1", 2)
    for _ in range(A_WORD - 1):
        ones = ones << BITS | 1

    def equal(x, y):
        folded = differ = x.bitwiseXOR(y)
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(differ, k))
        return F.lit(A_WORD) - F.bit_count(folded.bitwiseAND(F.lit(ones)))

    return F.aggregate(F.zip_with(a, b, equal), F.lit(0), lambda s, x: s + x)


def likeness(a, b):
    """Estimated Jaccard likeness of two texts' shingles, from their fingerprints."""
    by_chance = BINS >> BITS
    estimate = F.greatest(F.lit(0.0), (agreeing(a, b) - by_chance) / F.lit(float(BINS - by_chance)))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), estimate).otherwise((F.size(a) == F.size(b)).cast("double"))


def as_hex(bits):
    return F.array_join(F.transform(bits, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def fingerprints(docs, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, fingerprint (array of longs)."""
    return docs.select(F.col(id_col).alias("doc_id"), fingerprint(whole(F.col(text_col))).alias("fingerprint"))


def successors(keys, values):
    """Each row of `keys` with `next_` columns: key and values of the row that follows it by ascending id (nulls last;
    equal ids by key); the first follows the last.

    keys: key (unique), id and values. Keys are dealt out by ranges; what follows the last of a range is the first of the
    next, from a table with one row for each range."""
    order = [F.col("id").asc_nulls_last(), F.col("key")]
    placed = stage(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", *[v for v in values if v != "id"])
    firsts = placed.groupBy("part").agg(F.min(row).alias("first"))
    parts = W.partitionBy().orderBy("part")
    every = parts.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    firsts = firsts.select("part", F.coalesce(F.lead("first").over(parts), F.first("first").over(every)).alias("then"))
    inside = F.lead(row).over(W.partitionBy("part").orderBy(*order))
    found = placed.withColumn("next", inside).join(firsts, "part").withColumn("next", F.coalesce("next", "then"))
    return found.select(*keys.columns, *[F.col(f"next.{c}").alias(f"next_{c}") for c in ("key", *values)])


def edit_report(docs, id_col="doc_id", text_col="text"):
    """One row per document: its fingerprint, that of an edited text, and how like they are.

    The edited text has the last quarter of the characters replaced by the beginning of the next document. Columns:
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next, and next_id, which
    names the next document. Documents follow each other by ascending id (null last; equal ids by a hash of id and text);
    a repeated row is the same document, and has the same result each time. Texts are shuffled once, to their key; from
    there each sends the characters that its predecessor needs. (Both uses of `texts` take the same columns, so that
    Spark plans one exchange for them.)
    """
    text = whole(F.col(text_col))
    name = F.concat(F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit("")), F.lit(" "), sha256_hex(text))
    texts = docs.select(F.unhex(sha256_hex(name)).alias("key"), F.col(id_col).alias("id"), text.alias("text"))
    keys = texts.groupBy("key").agg(
        F.first("id").alias("id"),
        F.max(F.length("text")).cast("long").alias("n_chars"),
        F.first(fingerprint(F.col("text"))).alias("bits"),
    )
    follow = stage(successors(keys, ["id", "bits"]))
    texts = texts.select("key", "text")
    wanted = follow.select(F.col("next_key").alias("key"), F.col("key").alias("before"), F.expr("n_chars div 4").alias("give"))
    given = (
        texts.join(wanted, "key")
        .groupBy(F.col("before").alias("key"))
        .agg(F.first(F.expr("left(text, int(give))")).alias("tail"))
    )
    edited = F.concat(F.expr("left(text, int(n_chars - n_chars div 4))"), "tail")
    known = follow.drop("next_key")
    both = texts.join(given, "key").join(known, "key").select(known.columns + [edited.alias("edited")])
    both = both.withColumn("edited_bits", fingerprint(F.col("edited")))
    return both.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        sha256_hex(F.col("edited")).alias("edited_sha256"),
        as_hex(F.col("bits")).alias("fingerprint"),
        as_hex(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
        "next_id",
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    sha256(coalesce('=' || doc_id::VARCHAR, '') || ' ' || sha256(coalesce(text, ''))) AS key
  FROM documents
), k AS (
  SELECT key, any_value(doc_id) AS id, any_value(text) AS text FROM d GROUP BY key
), f AS (
  SELECT key, text, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text,
    CASE WHEN row_number() OVER o = count(*) OVER o THEN first_value(id) OVER o ELSE lead(id) OVER o END AS next_id
  FROM k WINDOW o AS (ORDER BY id NULLS LAST, key ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
  SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM f
), t AS (
  SELECT DISTINCT md5_number(text) AS tid, text FROM (SELECT text FROM e UNION ALL SELECT edited FROM e)
), listed AS (
  SELECT tid, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM t
), w AS (
  SELECT tid, unnest(words) AS word, unnest(range(len(words))) AS i, len(words) AS n FROM listed
), crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crcs
  FROM range(256) AS r(b)
), codes AS (
  SELECT word, 1 + xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(word))),
      lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) AS c
  FROM (SELECT DISTINCT word FROM w), crc_table
), coded AS (
  SELECT tid, i, n, c * 179424673 + coalesce(lead(c, 1) OVER o, 0) * 198491317 + coalesce(lead(c, 2) OVER o, 0) * 217645177
    + coalesce(lead(c, 3) OVER o, 0) * 236887691 + coalesce(lead(c, 4) OVER o, 0) * 256203161 AS x
  FROM w JOIN codes USING (word) WINDOW o AS (PARTITION BY tid ORDER BY i)
), x AS (
  SELECT tid, x % 17592186044399 AS x FROM coded WHERE i <= greatest(n - 5, 0)
), h AS (
  SELECT tid, xor(x, x >> 21) * 198733 % 17592186044399 AS h FROM x
), b AS MATERIALIZED (
  SELECT tid, h % 256 AS bin, min(h >> 8) AS value FROM h GROUP BY ALL
), n AS (
  SELECT j, ('0x' || substr(md5(j::VARCHAR), 1, 2))::BIGINT AS start, ('0x' || substr(md5(j::VARCHAR), 3, 2))::BIGINT | 1 AS step,
    ('0x' || substr(md5(j::VARCHAR), 5, 6))::BIGINT + 1 AS factor
  FROM range(256) AS r(j)
), asks AS (
  SELECT j, t, (start + step * t) % 256 AS bin FROM n, range(256) AS r(t)
), gaps AS (
  SELECT a.tid, n.j FROM (SELECT DISTINCT tid FROM b) a, n ANTI JOIN b ON b.tid = a.tid AND b.bin = n.j
), filled AS (
  SELECT tid, bin AS j, value FROM b
  UNION ALL
  SELECT gaps.tid, gaps.j, arg_min(value, t) FROM gaps JOIN asks USING (j) JOIN b ON b.tid = gaps.tid AND b.bin = asks.bin
  GROUP BY gaps.tid, gaps.j
), bits AS MATERIALIZED (
  SELECT tid, j, (xor(value, value >> 18) * factor % 2147483647) % 16 AS v FROM filled JOIN n USING (j)
), p AS MATERIALIZED (
  SELECT tid, string_agg(substr('0123456789abcdef', v::INT + 1, 1), '' ORDER BY j) AS print FROM bits GROUP BY tid
), ids AS (
  SELECT *, md5_number(text) AS tid, md5_number(edited) AS edited_tid, md5_number(next_text) AS next_tid FROM e
), pairs AS (
  SELECT tid AS a, edited_tid AS b FROM ids UNION SELECT tid, next_tid FROM ids
), agree AS (
  SELECT a, b, count(*) FILTER (x.v = y.v) AS n FROM pairs JOIN bits x ON x.tid = a JOIN bits y ON y.tid = b AND y.j = x.j
  GROUP BY a, b
), nearness AS (
  SELECT a, b, CASE WHEN n IS NOT NULL THEN greatest(0.0, (n - 16) / 240.0::DOUBLE)
    ELSE ((pa.print IS NULL) = (pb.print IS NULL))::INT::DOUBLE END AS near
  FROM pairs LEFT JOIN agree USING (a, b) LEFT JOIN p pa ON pa.tid = a LEFT JOIN p pb ON pb.tid = b
)
SELECT d.doc_id, length(d.text) AS n_chars, sha256(edited) AS edited_sha256, coalesce(p1.print, '') AS fingerprint,
  coalesce(p2.print, '') AS edited_fingerprint, l1.near AS near_edited, l2.near AS near_next, next_id
FROM d JOIN ids USING (key) LEFT JOIN p p1 ON p1.tid = ids.tid LEFT JOIN p p2 ON p2.tid = edited_tid
JOIN nearness l1 ON l1.a = ids.tid AND l1.b = edited_tid JOIN nearness l2 ON l2.a = ids.tid AND l2.b = next_tid
"""
