"""Which aliases of a gazetteer can matter for a name key: bounds in Spark expressions, before any pair is scored.

An alias matters when one of its fuzzy scores reaches the least score that is accepted (80 or more), and then its weighted
score reaches 0.95 of that: it shares a word with the name, or the two share as many letters, and as many pairs of
neighbouring letters, as their lengths ask for. Shared letters and pairs are bounded from above by 63-bit signatures, so no
alias that matters is lost; the few names for which that argument fails keep every alias.
"""

from pyspark.sql import functions as F

from .text import let

SIGNATURE_BITS = 63
LEAST_ACCEPTED = 80  # below this score of acceptance nothing is left out
WEIGHTED = 0.95 * LEAST_ACCEPTED


def _zero():
    return F.lit(0).cast("bigint")


def _bit(i):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))


def _or(bits):
    return F.aggregate(bits, _zero(), lambda a, b: a.bitwiseOR(b))


def characters(s):
    return F.filter(F.split(s, ""), lambda c: c != "")


def words(s):
    return F.filter(F.split(s, " "), lambda w: w != "")


def _joined(tokens):
    return F.array_join(F.array_sort(tokens), " ")


def _pairs_signature(s):
    """Bits of a text's pairs of neighbouring letters, the second of two equal pairs being another pair."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(2)))
    nth = lambda p: F.transform(p, lambda x, i: F.concat(x, F.size(F.filter(F.slice(p, 1, i + 1), lambda y: y == x)).cast("string")))
    return F.when(F.length(s) > 1, _signature(let(pairs, nth))).otherwise(_zero())


def _signature(strings):
    return _or(F.transform(strings, lambda x: _bit(F.pmod(F.xxhash64(x), F.lit(SIGNATURE_BITS)))))


def _letters_signature(s):
    """Bits of a text's characters, the second of two equal ones being another."""
    nth = lambda p: F.transform(p, lambda x, i: F.concat(x, F.size(F.filter(F.slice(p, 1, i + 1), lambda y: y == x)).cast("string")))
    return _signature(let(characters(s), nth))


def features(key):
    """What the bounds need to know of a key."""
    ordered = _joined(words(key))
    return F.struct(
        F.length(key).alias("size"),
        F.length(ordered).alias("sorted_size"),
        _letters_signature(key).alias("letters"),
        _pairs_signature(key).alias("pairs"),
        _pairs_signature(ordered).alias("sorted_pairs"),
        _signature(words(key)).alias("words"),
        (F.size(F.array_distinct(words(key))) < F.size(words(key))).alias("repeats"),
    )


def _in_order(short, long):
    """Whether the characters of one text stand in another in that order (an underscore may count as any character)."""
    return F.call_function("like", long, F.concat(F.lit("%"), F.array_join(characters(short), "%"), F.lit("%")))


class AliasIndex:
    """The keys of a gazetteer and their features, as literals in the expressions that use them. The gazetteer is a fixed
    dictionary, bounded and supplied by the caller."""

    NUMBERS = ("size", "sorted_size", "letters", "pairs", "sorted_pairs", "words", "repeats")

    def __init__(self, spark, keys):
        self.keys = keys
        rows = spark.createDataFrame(list(enumerate(keys)), "i int, key string").select("i", features(F.col("key")).alias("f"))
        found = {r.i: r.f for r in rows.collect()}
        column = lambda name: ",".join(str(int(found[i][name])) for i in range(len(keys)))
        self.columns = {n: F.split(F.lit(column(n)), ",").cast("array<bigint>") for n in self.NUMBERS}
        self.names = F.split(F.lit("\n".join(keys)), "\n")

    def _of(self, i):
        return {n: F.get(c, i) for n, c in self.columns.items()}

    @staticmethod
    def _shared_at_most(n, m, one, other):
        missing = lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))
        return F.least(n - missing(one, other), m - missing(other, one))

    @staticmethod
    def _matters(name, key, alias, text, score=WEIGHTED):
        """Whether the scores of a name (features, key) and an alias (features, text) can reach `score`."""
        size, other = name["size"], alias["size"]
        short, both = F.least(size, other), size + other
        spread = F.greatest(size, other) / F.greatest(short, F.lit(1))
        letters = AliasIndex._shared_at_most(size, other, name["letters"], alias["letters"])
        raw = AliasIndex._shared_at_most(size - 1, other - 1, name["pairs"], alias["pairs"])
        ordered = AliasIndex._shared_at_most(
            name["sorted_size"] - 1, alias["sorted_size"] - 1, name["sorted_pairs"], alias["sorted_pairs"]
        )
        # Of l characters in common order every one of the others parts at most one pair of neighbours.
        least = lambda r, total: F.ceil(total * (r / 200) - 1e-9)
        pairs = lambda r, total: 3 * least(r, total) - total - 1
        like = (least(score, both) <= letters) & (raw >= pairs(score, both))
        sorted_both = name["sorted_size"] + alias["sorted_size"]
        like_sorted = (spread <= 1.5) & (least(score / 0.95, sorted_both) <= letters) & (ordered >= pairs(score / 0.95, sorted_both))
        # A window that reaches r shares, with its own size, at least r / (200 - r) of the shorter text's characters.
        r = score / 0.9
        share = r / (200 - r)
        of_short = (3 * r / 200 - 1) * (1 + share)
        like_part = (
            (spread >= 1.5)
            & (spread <= 8)
            & (letters >= short * share - 1e-9)
            & (F.greatest(raw, ordered) >= short * of_short - 1 - 1e-9)
        )
        common = (name["words"].bitwiseAND(alias["words"]) != 0) & F.arrays_overlap(words(key), words(text))
        # Its weighted score may lie below that of aliases that do not matter: then all count.
        # (With lengths as 2 to 3 the token score is just 80 where the shorter key stands in the longer one in order.)
        x, y = _joined(words(key)), _joined(words(text))
        inside = F.when(size < other, _in_order(x, y)).otherwise(_in_order(y, x))
        unclear = (spread > 8) & common | (spread == 1.5) & (letters >= short) & inside
        return (alias["repeats"] != 0) | like | like_sorted | like_part | common, unclear

    def candidates(self, key, min_score=LEAST_ACCEPTED):
        """Places of the aliases that can matter for a key, in order."""
        every = F.sequence(F.lit(0), F.lit(len(self.keys) - 1))
        if min_score < LEAST_ACCEPTED:
            return every

        def of(name):
            test = lambda nth: lambda i: self._matters(name, key, self._of(i), F.get(self.names, i))[nth]
            unclear = name["repeats"] | F.exists(every, test(1))
            return F.when(unclear, every).otherwise(F.filter(every, test(0)))

        return let(features(key), of)
