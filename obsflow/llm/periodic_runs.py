"""Runs: maximal stretches of words that repeat with one period, as loops of a generator or a broken scraper leave them.

Two positions q apart that share their next l >= q words, with no position of the same words between them, stand in a
stretch of smallest period q. Positions that share their next l words form a class; classes grow as l falls. So suffixes
are sorted, neighbours are united by decreasing common prefix (Kruskal on the path of the suffix array), every class
keeps its positions in order, and two positions that have just become neighbours in a class, at a distance within the
common prefix, are a seed. The seed at a run's first word gives the whole run: period, start, and its end exactly, as the
common prefix cannot be prolonged. Classes below the shortest prefix that a wanted run can have are never united.

Before any sorting, texts are left out that have no stretch of repeated windows long enough for the gap between them;
every wanted run has one (`candidates`). Words are compared as words, not by hashes; hashes only choose candidates.

A null text is empty, and texts without words have no runs. Null ids and repeated rows are documents like others. An
empty table gives no rows. Only the two named columns are read, so other columns cannot clash. Texts are worked whole, in
blocks of about a megabyte; a longer text is a block of its own and takes memory for its words, times the logarithm of
its longest repeat.
"""

from bisect import bisect_left, bisect_right
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .arrays import blocks, mixed, windows
from .texts import WORD, pairs, sha256_hex, whole

MIN_LENGTH = 6
MIN_EXPONENT = 4
BLOCK_PLACES = 1024


class Places:
    """Positions in order, in blocks, so that adding one does not move all others."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, position):
        self.blocks, self.firsts, self.size = [[position]], [position], 1

    def __iter__(self):
        return (p for block in self.blocks for p in block)

    def add(self, position):
        """Neighbours of the new position: (before or None, after or None)."""
        at = max(bisect_right(self.firsts, position) - 1, 0)
        block = self.blocks[at]
        k = bisect_left(block, position)
        before = block[k - 1] if k else None  # of the first block only: `at` is the last that begins before it
        if k < len(block):
            after = block[k]
        else:
            after = self.firsts[at + 1] if at + 1 < len(self.blocks) else None
        block.insert(k, position)
        if not k:
            self.firsts[at] = position
        self.size += 1
        if len(block) > BLOCK_PLACES:
            half = len(block) // 2
            self.blocks[at : at + 1] = [block[:half], block[half:]]
            self.firsts.insert(at + 1, block[half])
        return before, after


def least_prefix(min_length, min_exponent):
    """Fewest words that the first two periods of a wanted run share onward."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def candidates(codes, owner, least, min_exponent, n_texts):
    """Which texts can have a run: somewhere a stretch of windows, each found again later in its text, is no shorter than
    the smallest distance to the next copy asks for. A run of period q holds (exponent - 1) * q - least + 1 of them."""
    found = np.zeros(n_texts, bool)
    keys = windows(mixed(codes.astype(np.uint64) + np.uint64(1)), least)
    if not len(keys):
        return found
    inside = np.flatnonzero(owner[: len(keys)] == owner[least - 1 :])
    keys = mixed(keys[inside] + mixed(owner[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys, kind="stable")
    again = keys[order[1:]] == keys[order[:-1]]
    first, second = inside[order[:-1][again]], inside[order[1:][again]]
    if not len(first):
        return found
    order = np.argsort(first)
    at, gap = first[order], (second - first)[order]
    begins = np.flatnonzero(np.concatenate([[True], np.diff(at) != 1]) | np.concatenate([[True], np.diff(owner[at]) != 0]))
    stretch = np.diff(np.append(begins, len(at)))
    enough = stretch + least - 1 >= (min_exponent - 1) * np.minimum.reduceat(gap, begins)
    found[owner[at[begins[enough]]]] = True
    return found


def suffix_order(letters):
    """(suffixes in order, common prefix of each with the next), by doubling: ranks of windows of 1, 2, 4, ... letters
    are kept for the prefixes, and only windows that occur twice are sorted again. No letter may stand in two texts."""
    n = len(letters)
    order = np.argsort(letters, kind="stable")
    fresh = np.concatenate([[True], np.diff(letters[order]) != 0])
    ranks = np.empty(n + 1, np.int64)
    ranks[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    ranks[n] = -1
    levels, size = [], 1
    active = order[_grouped(ranks[order])]
    while len(active):
        levels.append((size, ranks.astype(np.int32)))
        rank, then = ranks[active], ranks[np.minimum(active + size, n)]
        sort = np.lexsort((then, rank))
        active, rank, then = active[sort], rank[sort], then[sort]
        group = np.concatenate([[True], np.diff(rank) != 0])
        part = group | np.concatenate([[True], np.diff(then) != 0])
        place = np.arange(len(active))
        into = np.maximum.accumulate(np.where(part, place, 0)) - np.maximum.accumulate(np.where(group, place, 0))
        ranks[active] = rank + into
        active = active[_grouped(rank + into)]
        size *= 2
    order = np.empty(n, np.int64)
    order[ranks[:n]] = np.arange(n)
    a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(n - 1, 0), np.int64)
    for size, rank in reversed(levels):
        step = np.where(rank[a] == rank[b], size, 0)
        common += step
        a, b = a + step, b + step
    return order, common


def _grouped(ranks):
    """Which of the ranks, in order, have a like neighbour."""
    same = np.diff(ranks) == 0
    return np.concatenate([same, [False]]) | np.concatenate([[False], same])


def find_runs(codes, owner, min_length=MIN_LENGTH, min_exponent=MIN_EXPONENT):
    """(start, length, period) of every run, by start and period. codes: words by number; owner: text of each word."""
    if len(codes) < min_length:
        return []
    least = least_prefix(min_length, min_exponent)
    order, common = suffix_order(np.unique(owner * (int(codes.max()) + 1) + codes, return_inverse=True)[1])
    edges = _useful(order, common, least, min_exponent)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    position, words, text = order.tolist(), codes.tolist(), owner.tolist()
    parent, classes, after, runs = {}, {}, {}, []

    def root(x):
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for shared, level in groupby(zip(common[edges].tolist(), edges.tolist()), lambda e: e[0]):
        earlier = {}
        for _, edge in level:
            one, other = root(edge), root(edge + 1)
            mine, theirs = classes.pop(one, None) or Places(position[one]), classes.pop(other, None) or Places(position[other])
            if mine.size < theirs.size:
                one, other, mine, theirs = other, one, theirs, mine
            parent[other], classes[one] = one, mine
            for p in theirs:
                before, later = mine.add(p)
                for a, b in ((before, p), (p, later)):
                    if a is not None and b is not None:
                        earlier.setdefault(a, after.get(a))
                        after[a] = b
        for p, was in earlier.items():  # a class may be united more than once at a level: what counts is how it ends
            period = after[p] - p
            if after[p] != was and period * (min_exponent - 1) <= shared and period + shared >= min_length:
                if not p or text[p - 1] != text[p] or words[p - 1] != words[after[p] - 1]:
                    runs.append((p, period + shared, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def _useful(order, common, least, min_exponent):
    """Neighbours to unite: those of classes (at the least prefix) where some distance fits some prefix."""
    joined = common >= least
    group = np.concatenate([[0], np.cumsum(~joined)])
    edges = np.flatnonzero(joined)
    if not len(edges):
        return edges
    longest = np.zeros(group[-1] + 1, np.int64)
    np.maximum.at(longest, group[edges], common[edges])
    sort = np.lexsort((order, group))
    gap, inside = np.diff(order[sort]), np.diff(group[sort]) == 0
    nearest = np.full(group[-1] + 1, np.iinfo(np.int64).max // 64)
    np.minimum.at(nearest, group[sort][1:][inside], gap[inside])
    return edges[(nearest * (min_exponent - 1) <= longest)[group[edges]]]


def runs_of_block(texts, min_length=MIN_LENGTH, min_exponent=MIN_EXPONENT):
    """For each text (bytes): (number of words, its runs, the text without repeats)."""
    split = [t.split() for t in texts]  # of bytes: at the six ASCII spaces only
    sizes = np.array([len(w) for w in split], np.int64)
    number = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for words in split for w in words), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    wanted = candidates(codes, owner, least_prefix(min_length, min_exponent), min_exponent, len(texts))
    chosen = wanted[owner]
    begins = np.concatenate([[0], np.cumsum(np.where(wanted, sizes, 0))])
    runs = [[] for _ in texts]
    dropped = np.zeros(int(begins[-1]) + 1, np.int64)
    texts_of = owner[chosen]
    for start, length, period in find_runs(codes[chosen], texts_of, min_length, min_exponent):
        text = texts_of[start]
        runs[text].append((int(start - begins[text]), length, period))
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.cumsum(dropped)[:-1] == 0
    for text, words in enumerate(split):
        if runs[text]:
            words = [w for w, keep in zip(words, kept[begins[text] : begins[text + 1]].tolist()) if keep]
        yield int(sizes[text]), runs[text], b" ".join(words)


def periodic_runs(docs, id_col="doc_id", text_col="text", min_length=MIN_LENGTH, min_exponent=MIN_EXPONENT):
    """One row per document: doc_id, n_words, runs (array of start, length, period, in words, by start and period),
    collapsed (the words joined by one space, without those that a run has after its first period).

    A run is at least `min_length` words and `min_exponent` (2 or more) periods long.
    """
    source = pairs(docs, id_col, text_col)
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    names = ["doc_id", "n_words", "runs", "collapsed"]

    def work(batches):
        for ids, texts in blocks(batches):
            found = list(runs_of_block(texts, min_length, min_exponent))
            ends = np.cumsum([0, *(len(runs) for _, runs, _ in found)])
            columns = zip(*(run for _, runs, _ in found for run in runs)) if ends[-1] else [[]] * 3
            flat = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(run_type))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat),
                    pa.array([text for _, _, text in found], pa.binary()).cast(pa.string()),
                ],
                names=names,
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    fields = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return source.mapInArrow(work, f"doc_id {id_type}, {fields}")


def longest_run(runs):
    """The run of greatest length / period; of equal ones that with the smallest start, then period. Null without runs."""
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(runs, none, lambda a, b: F.when(better(a, b), b).otherwise(a))


def with_loops(docs, id_col="doc_id", text_col="text"):
    """The documents with a loop put into about one in ten (by crc32 of the id; never where that is null): from some word
    on, the words repeat with some period."""
    words = F.regexp_extract_all(whole(F.col(text_col)), F.lit(WORD), F.lit(0))
    h = F.crc32(F.col(id_col).cast("string"))
    g = F.floor(h / 10)

    def looped(w):
        n = F.size(w)
        a = (g % n).cast("int")
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("int")
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        text = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i))), " ")
        return F.when(n > 0, text).otherwise(F.lit(""))

    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(h % 10 == 0, F.get(F.transform(F.array(words), looped), F.lit(0))).otherwise(whole(F.col(text_col))).alias("text"),
    )


def run_report(docs, id_col="doc_id", text_col="text"):
    """One row per document: doc_id, n_runs, the run of greatest exponent (start, length, period, exponent_milli; null
    without runs), and digests of all runs and of the text without repeats."""
    found = periodic_runs(docs, id_col, text_col).withColumn("best", longest_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start"),
        F.col("best.length"),
        F.col("best.period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        sha256_hex(F.array_join(lines, "")).alias("runs_sha256"),
        sha256_hex(F.col("collapsed")).alias("collapsed_sha256"),
    )
