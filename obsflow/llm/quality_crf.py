"""Document quality from a linear-chain conditional random field that labels every line good or bad.

A line with a word has features of its own (symbols, bars, capitals, repeats, sentence ends, lengths) and those of its
neighbours; a chain links the labels of adjacent lines. Forward-backward gives each line's marginal probability of good;
their mean, weighted by line length, is the document's goodness, which a fitted logistic curve turns into the score.

Fitting: at most `SAMPLE` labelled documents, the first by a hash of the id, none of the held-out fold, one row of each
(the least text of a repeated id). A document is cut into chains of `CHAIN` lines; of one with more than `SAMPLE_LINES`
lines that many are taken, in whole chains spread by hash over all of it. Line labels start as the document's; then lines
of bad documents that look good are labelled so, except each one's worst, and the field is fitted again. The curve is
fitted to the goodness of the whole texts. Labels, language, source and id are no inputs of a score.

Scoring reads whole texts, many at once. A text without a word (null, empty or blank) scores 0. Without labelled rows of
both kinds every score is 0.5. Ids without a label, repeated rows and null ids are scored like any other; null and
conflicting labels count as the lower one. An empty table gives no rows.
"""

import numpy as np
from pyspark.sql import functions as F

from ..plans.staging import stage
from .arrays import Block, blocks, filter_blocks, later_copies, map_blocks, mixed, repeat_words
from .texts import pairs

SAMPLE = 3_000
SAMPLE_LINES = 512
CHAIN = 64
STEPS, RATE, RIDGE = 150, 0.15, 1e-3
THRESHOLD = 0.7  # fixed value of the contract
FOLDS, HELD_OUT = 4, 2  # fixed values of the contract

OWN = 12
NEAR = 6  # features of the line before and after
WIDTH = OWN + 2 * NEAR + 3

_IS = {
    "symbol": np.isin(np.arange(256), list(b"#*$%&<>@^~_=+{}[]\\/")),
    "bar": np.arange(256) == ord("|"),
    "bang": np.isin(np.arange(256), list(b"!?")),
    "digit": (np.arange(256) >= 48) & (np.arange(256) <= 57),
    "upper": (np.arange(256) >= 65) & (np.arange(256) <= 90),
    "lower": (np.arange(256) >= 97) & (np.arange(256) <= 122),
}


def line_features(block):
    """(owner, length, features) of every line with a word, in order."""
    data = block.data
    starts, ends = block.lines()
    filled = np.concatenate([[0], np.cumsum(~block.space)])
    used = filled[ends] > filled[starts]
    starts, ends = starts[used], ends[used]
    n, owner = len(starts), block.owner(starts)
    if n == 0:
        return owner, np.zeros(0), np.zeros((0, WIDTH))
    length = (filled[ends] - filled[starts]).astype(float)

    def count(kind):
        sums = np.concatenate([[0], np.cumsum(_IS[kind][data])])
        return (sums[ends] - sums[starts]).astype(float)

    first, last = block.words()
    codes = block.hashes(first, last)
    line = np.searchsorted(starts, first, "right") - 1
    adjacent = np.zeros(len(codes), bool)
    adjacent[1:] = (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])
    words = np.maximum(np.bincount(line, minlength=n), 1).astype(float)
    share = lambda flags: np.bincount(line[flags], minlength=n) / words
    letters = np.maximum(count("upper") + count("lower"), 1)

    own = np.stack(
        [
            np.minimum(count("symbol") / words, 1.5),
            np.minimum(count("bar") / words, 1),
            count("upper") / letters,
            share(adjacent),
            np.minimum(count("bang") / words, 1),
            share(repeat_words(codes, line)),
            later_copies(block.hashes(starts, ends), owner).astype(float),
            share(data[last - 1] == ord(".")),
            np.minimum(length / words, 15) / 5,
            np.minimum(count("digit") / length, 1),
            np.log1p(words) / 4,
            (data[starts] == ord("|")).astype(float),
        ],
        axis=1,
    )
    zero = np.zeros((1, NEAR))
    before, after = np.vstack([zero, own[:-1, :NEAR]]), np.vstack([own[1:, :NEAR], zero])
    is_first = np.concatenate([[True], owner[1:] != owner[:-1]])
    is_last = np.concatenate([is_first[1:], [True]])
    before[is_first], after[is_last] = 0, 0
    return owner, length, np.hstack([own, before, after, is_first[:, None], is_last[:, None], np.ones((n, 1))])


def _step(x, stay):
    """Log odds passed along one link, which keeps the label with odds exp(stay[label])."""
    return np.logaddexp(x + stay[1], 0) - np.logaddexp(x, stay[0])


def forward_backward(odds, starts, sizes, stay):
    """(forward, backward) log odds of good: `odds` per line, chains given by their first line and size.

    Chains advance together, the longest first, so that those still running are a prefix.
    """
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    forward, backward = odds.copy(), np.zeros_like(odds)
    most = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(1, most + 1), "right")
    for t in range(1, most):
        at = starts[: alive[t]] + t
        forward[at] += _step(forward[at - 1], stay)
    for t in range(most - 1, 0, -1):
        at = starts[: alive[t]] + t
        backward[at - 1] = _step(odds[at] + backward[at], stay)
    return forward, backward


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_chains(x, y, starts, sizes):
    """(weights, stay) by Adam on the conditional log likelihood of the labels y."""
    theta = np.zeros(WIDTH + 2)
    theta[WIDTH:] = 0.5
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    linked = np.ones(len(y), bool)
    linked[starts] = False
    at = np.flatnonzero(linked)
    seen = np.array([((y[at] == k) & (y[at - 1] == k)).sum() for k in (0, 1)], float)
    for step in range(1, STEPS + 1):
        stay = theta[WIDTH:]
        odds = x @ theta[:WIDTH]
        forward, backward = forward_backward(odds, starts, sizes, stay)
        marginal = sigmoid(forward + backward)
        ahead = odds[at] + backward[at]
        # log weights of the four label pairs of a link, up to a constant
        pair = np.stack([np.full(len(at), stay[0]), ahead, forward[at - 1], forward[at - 1] + ahead + stay[1]])
        pair = np.exp(pair - pair.max(axis=0))
        pair /= pair.sum(axis=0)
        slope = np.concatenate([x.T @ (y - marginal), seen - [pair[0].sum(), pair[3].sum()]]) / len(y) - RIDGE * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta[:WIDTH], theta[WIDTH:]


def goodness(owner, length, x, n, model):
    """Length-weighted mean marginal of good per document, nan without lines; and the marginals."""
    weights, stay = model
    starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(owner)))
    forward, backward = forward_backward(x @ weights, starts, sizes, stay)
    marginal = sigmoid(forward + backward)
    total = np.bincount(owner, weights=length, minlength=n)
    with np.errstate(invalid="ignore"):
        return np.bincount(owner, weights=length * marginal, minlength=n) / total, marginal


def fit_curve(g, y):
    """(intercept, slope) of the logistic curve from goodness to label, by Newton steps with a little shrinking."""
    design, theta = np.stack([np.ones_like(g), g], axis=1), np.zeros(2)
    for _ in range(50):
        p = sigmoid(design @ theta)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(hessian, design.T @ (y - p) - 1e-2 * theta), -5, 5)
    return theta


def fit(examples):
    """The field, from (lines' lengths, lines' features, label) per labelled document; None without both labels."""
    examples = [e for e in examples if len(e[0])]
    if len({label for *_, label in examples}) < 2:
        return None
    x = np.vstack([f for _, f, _ in examples])
    sizes = np.array([len(length) for length, _, _ in examples])
    owner = np.repeat(np.arange(len(examples)), sizes)
    label = np.array([label for *_, label in examples], float)
    length = np.concatenate([length for length, _, _ in examples])
    first = np.cumsum(sizes) - sizes
    inside = np.arange(len(x)) - first[owner]
    starts = np.flatnonzero(inside % CHAIN == 0)
    chains = np.diff(np.append(starts, len(x)))

    y = label[owner]
    model = fit_chains(x, y, starts, chains)
    _, marginal = goodness(owner, length, x, len(label), model)
    worst = np.minimum.reduceat(marginal, first)[owner]
    y = np.where((label[owner] == 0) & (marginal > 0.5) & (marginal > worst), 1.0, y)
    return fit_chains(x, y, starts, chains)


def score_block(block, model):
    owner, length, x = line_features(block)
    if model is None:
        return (np.full(block.n, 0.5),)
    g, _ = goodness(owner, length, x, block.n, model[:2])
    return (np.where(np.isnan(g), 0.0, sigmoid(model[2][0] + model[2][1] * np.nan_to_num(g))),)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs, labels, rows=SAMPLE, id_col="doc_id", text_col="text"):
    """(label, text) of a bounded sample of labelled documents, one row per id."""
    chosen = (
        labels.select(F.col("doc_id").alias("_id"), "quality")
        .where("_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    found = pairs(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return found.groupBy("_id").agg(F.min(F.col("label").cast("int")).alias("label"), F.min("text").alias("text")).drop("_id")


def spread(n):
    """Places of the lines taken of a document's n: all, or whole chains, the first by a hash, in order."""
    if n <= SAMPLE_LINES:
        return np.arange(n)
    chains = -(-n // CHAIN)
    first = np.argsort(mixed(np.arange(chains, dtype=np.uint64) ^ np.uint64(n << 32)), kind="stable")
    places = np.sort(first[: SAMPLE_LINES // CHAIN])[:, None] * CHAIN + np.arange(CHAIN)
    return places[places < n]


def sample_lines(found):
    """Lines of the sampled documents, on the driver: (lengths, features, label)."""

    def lines(batches):
        import pyarrow as pa

        for marks, texts in blocks(batches):
            owner, length, x = line_features(Block(texts))
            firsts = np.searchsorted(owner, np.arange(len(texts) + 1))
            cut = [a + spread(int(b - a)) for a, b in zip(firsts[:-1], firsts[1:])]
            arrays = [marks, *(pa.array([part[c].astype("<f8").tobytes() for c in cut]) for part in (length, x))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "length", "x"])

    labelled = found.mapInArrow(lines, "label int, length binary, x binary")
    ordered = sorted((r.label, bytes(r.length), bytes(r.x)) for r in labelled.toLocalIterator())
    return [(np.frombuffer(n), np.frombuffer(x).reshape(-1, WIDTH), label) for label, n, x in ordered]


def whole_goodness(found, field):
    """(goodness, label) of the whole sampled texts that have lines."""

    def run(block):
        owner, length, x = line_features(block)
        return (goodness(owner, length, x, block.n, field)[0],)

    rows = map_blocks(found.select(F.col("label").alias("doc_id"), "text"), "int", run, "g double").collect()
    known = sorted((r.g, r.doc_id) for r in rows if r.g is not None and not np.isnan(r.g))
    return np.array([g for g, _ in known]), np.array([label for _, label in known], float)


def trained(docs, labels, id_col="doc_id", text_col="text"):
    found = stage(sample(docs, labels, SAMPLE, id_col, text_col))
    field = fit(sample_lines(found))
    model = None if field is None else (*field, fit_curve(*whole_goodness(found, field)))
    return docs.sparkSession.sparkContext.broadcast(model)


def keep_good(docs, labels, id_col="doc_id", text_col="text", threshold=THRESHOLD):
    """The documents, all columns, that score `threshold` or more; without labels of both kinds none does."""
    model = trained(docs, labels, id_col, text_col)
    return filter_blocks(docs, text_col, lambda block: score_block(block, model.value)[0] >= threshold)


def classify(docs, labels, id_col="doc_id", text_col="text", threshold=THRESHOLD):
    """One row per document: doc_id, held_out, score (probability of label 1), predicted."""
    model = trained(docs, labels, id_col, text_col)
    source = pairs(docs, id_col, text_col)
    id_type = source.schema["doc_id"].dataType.simpleString()
    scored = map_blocks(source, id_type, lambda block: score_block(block, model.value), "score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
