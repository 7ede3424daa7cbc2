"""Quality rules as weak supervision: rules vote good, bad or abstain; expectation-maximisation weighs them.

Measures of every whole text are taken once. Votes are column expressions on them, so a text is one of at most 3^R vote
patterns; their counts over all documents (bounded by R, not by the data) go to the driver, where EM estimates the share
of good documents and each rule's accuracy. A pattern's posterior goes back by broadcast of the same bounded table. The
base rules, which fail a text outright, stand before the verdict.

Null and empty texts have no words and fail. Repeated rows are judged each and counted each. An empty table gives no rows.
"""

import numpy as np
from pyspark.sql import functions as F

from ..plans.staging import stage
from .arrays import later_copies, map_blocks, repeat_words
from .texts import pairs

# The contract's symbols and base limits.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8

STEPS = 50
PRIOR, ON_BAD, ON_GOOD = 0.85, 0.3, 0.995  # where EM starts: share of good, votes bad on bad, votes good on good
STRONG = 10  # prior votes on good texts
GUARD = 1e-3  # keeps estimates off 0 and 1, where logarithms end

_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122))

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_letters bigint, n_upper bigint, n_adjacent bigint, n_stops bigint"
)


def measure(block):
    """The columns of MEASURES, an entry per text."""
    data, n = block.data, block.n
    starts, ends = block.words()
    owner, codes = block.owner(starts), block.hashes(starts, ends)
    count = lambda of: np.bincount(of, minlength=n)
    adjacent = np.zeros(len(codes), bool)
    adjacent[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    line_starts, line_ends = block.lines()
    filled = np.concatenate([[0], np.cumsum(~block.space)])
    with_word = filled[line_ends] > filled[line_starts]
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_owner = block.owner(line_starts)
    copies = later_copies(block.hashes(line_starts, line_ends), line_owner)
    return (
        count(owner),
        block.per_text(~block.space & ((data & 0xC0) != 0x80)),
        block.per_text(_SYMBOL[data]),
        count(line_owner[copies]),
        count(owner[repeat_words(codes, owner, WINDOW)]),
        count(line_owner),
        block.per_text(_LETTER[data]),
        block.per_text(_UPPER[data]),
        count(owner[adjacent]),
        count(owner[data[ends - 1] == ord(".")]),
    )


def measures(docs, id_col="doc_id", text_col="text"):
    source = pairs(docs, id_col, text_col)
    return map_blocks(source, source.schema["doc_id"].dataType.simpleString(), measure, MEASURES)


def votes():
    """One expression per rule: 1 good, 0 bad, null where it abstains."""
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    mean = per_word("word_chars")
    upper = F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1))
    dup = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    rule = lambda good, bad: F.when(bad, 0).when(good, 1)
    return [
        rule(F.col("n_words") >= 50, F.col("n_words") < 20),
        rule((mean >= 3) & (mean <= 6.5), (mean < 2.5) | (mean > 7)),
        rule(per_word("n_symbols") < 0.03, per_word("n_symbols") > 0.15),
        rule((dup == 0) & (F.col("n_lines") >= 2), dup > 0.3),
        rule(per_word("n_repeat_words") < 0.05, per_word("n_repeat_words") > 0.3),
        rule(upper < 0.1, upper > 0.35),
        rule(per_word("n_adjacent") < 0.02, per_word("n_adjacent") > 0.2),
        rule(per_word("n_stops") > 0.03, per_word("n_stops") < 0.005),
    ]


def pattern_of(rules):
    return F.concat(*[F.coalesce(r.cast("string"), F.lit("-")) for r in rules])


def estimate(patterns, counts, steps=STEPS):
    """(posterior of good per pattern, share of good, accuracies) by EM over vote patterns and their counts.

    A rule has two accuracies, as a bad text passes most rules but a good one fails hardly any: how often it votes bad on
    a bad text, and good on a good one. Abstaining says nothing. Prior counts keep both defined when a rule never votes;
    nothing else bounds them, so a rule may turn out to fail many good texts, and the share of good may be small.
    """
    table = np.array([[{"1": 1, "0": 0, "-": -1}[v] for v in p] for p in patterns])
    weight = np.asarray(counts, float)
    said, says_bad = table >= 0, table == 0
    good, on_bad, on_good = PRIOR, np.full(table.shape[1], ON_BAD), np.full(table.shape[1], ON_GOOD)
    for _ in range(steps):
        if_good = np.where(says_bad, np.log(1 - on_good), np.log(on_good))
        if_bad = np.where(says_bad, np.log(on_bad), np.log(1 - on_bad))
        odds = np.log(good / (1 - good)) + ((if_good - if_bad) * said).sum(axis=1)
        posterior = 1 / (1 + np.exp(-odds))
        as_good, as_bad = weight * posterior, weight * (1 - posterior)
        on_bad = (as_bad @ says_bad + ON_BAD) / (as_bad @ said + 1)
        on_good = (as_good @ (said & ~says_bad) + ON_GOOD * STRONG) / (as_good @ said + STRONG)
        good = (as_good.sum() + PRIOR) / (weight.sum() + 1)
        on_bad, on_good, good = (np.clip(x, GUARD, 1 - GUARD) for x in (on_bad, on_good, good))
    return posterior, float(good), (on_bad, on_good)


def judge(docs, id_col="doc_id", text_col="text", rules=None):
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    posterior (probability of good quality)."""
    spark = docs.sparkSession
    rules = rules or votes()
    if len(rules) > 10:
        raise ValueError("vote patterns are held on the driver: at most 10 rules")
    measured = stage(measures(docs, id_col, text_col)).withColumn("_pattern", pattern_of(rules))
    seen = measured.groupBy("_pattern").count().collect()
    judged = []
    if seen:
        posterior, _, _ = estimate([r[0] for r in seen], [r[1] for r in seen])
        judged = [(r[0], float(p)) for r, p in zip(seen, posterior)]
    table = spark.createDataFrame(judged, "_pattern string, posterior double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return measured.join(F.broadcast(table), "_pattern").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= 0.5)).alias("kept"),
        "posterior",
    )
