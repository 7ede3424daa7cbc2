"""Similarity join on word n-grams: Jaccard of at least 75 hundredths, by rare-first prefix filtering.

Sets. Words are runs without space after lower-casing A-Z; a text's set holds its distinct 5-word shingles, or its whole
sequence where it is shorter. Texts with equal sets are one class, named by a 64-bit hash of the set (one expected clash
at six billion different sets); a text without words is in no class and linked with nothing.

Order. Shingles are ordered by the number of documents that have them, rarest first, then by hash. The counts are exact
(but for copies a task recognises, which count once; any order gives exact results as long as all sets use the same):
shingles are dealt out by hash in packed form, counted, and those that stand in two documents or more are sent back.
A shingle of one document is first in the order and cannot meet another, so it goes no further, and a document with
enough of them has no candidates at all.

Candidates. Two linked sets share one of their first n - ceil(0.75 n) + 1 shingles. These prefixes are dealt out by
shingle. Sizes (length filter) and places (positional filter) discard most pairs. A shingle that three or more classes
share gives no pairs among all of them, which would be quadratic in a group of near copies: first the class with the
fewest shingles before this one, the least altered copy, is paired with the others; links found are joined into
components, and one class per component is paired; at last all pairs across components are. So nothing is lost, and few
pairs inside a component are made. A shingle in more classes than a task should hold is dealt over all parts and treated
the same way. `Join.links` makes all pairs: of such a shingle's classes block by block, each pair of blocks a group of
its own.

Verification. Each pair is verified once, on whole sets (48-bit hashes), after a suffix filter: quartiles of one set
bound the difference between the two.

Null ids are linked like others but are never a component's id. Repeated rows are in one class. An empty table gives no
rows. Other columns of the input are not read.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

from ..plans.skew import attach
from ..plans.staging import stage
from .arrays import Block, blocks, mixed, repeated, windows
from .components import components
from .texts import pairs

WORDS = 5
PERCENT = 75
STEPS = 8  # frequency classes per doubling
PART_ENTRIES = 2_000_000  # shingles a task counts at a time
LEAST_PARTS = 12
HELD_ENTRIES = 1_500_000  # shingles a task deals out at a time
KNOWN_SETS = 1_000_000  # whose copies a task recognises
CENTRES = 4  # ways of choosing among equally good classes to pair the others of a dense group with first
TURNS = 1  # of pairing components by one class each, before all pairs across components
HOT_ROWS = 1_000
MARKS = 1 << 22  # bits that tell which sets are needed for verification

HASH = np.uint64((1 << 48) - 1)
HOT = np.uint32(1 << 31)


def shingle_sets(texts, size=WORDS):
    """Sorted distinct 48-bit shingle hashes of each text (bytes)."""
    block = Block([t.lower() for t in texts])
    starts, ends = block.words()
    codes, owner = block.hashes(starts, ends), block.owner(starts)
    grams = windows(codes, size) & HASH
    cut = np.searchsorted(owner, np.arange(block.n + 1))
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= size:
            yield np.unique(grams[a : b - size + 1])
        elif b > a:
            yield mixed(windows(codes[a:b], int(b - a)) + np.uint64(b - a)) & HASH
        else:
            yield np.zeros(0, np.uint64)


def set_hash(tokens):
    """64 bits that do not depend on the order, as a signed number."""
    with np.errstate(over="ignore"):
        total = mixed(tokens + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mixed(np.array([total]))[0].view(np.int64))


def pack(tokens):
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack(data):
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


def prefix_size(n, percent=PERCENT):
    return n - (percent * n + 99) // 100 + 1


def least_overlap(n, m, percent=PERCENT):
    """Shared shingles that sets of n and m need."""
    return (percent * (n + m) + 99 + percent) // (100 + percent)


# first pass: sizes and class names


def _summaries(source, size):
    """Per document (doc_id, d, n)."""
    from pyspark.sql.pandas.types import to_arrow_type

    def run(batches):
        for ids, texts in blocks(batches):
            found = [(set_hash(s), len(s)) for s in shingle_sets(texts, size)]
            arrays = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([ids.cast(id_type), *arrays], names=["doc_id", "d", "n"])

    kind = source.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    return source.mapInArrow(run, f"doc_id {kind.simpleString()}, d bigint, n bigint")


# second pass: shingles dealt out, counted, sent back, and prefixes dealt out

DEALT = "part bigint, batch bigint, counts binary, tokens binary, ranks binary, names binary, sizes binary"
POSTED = "part bigint, names binary, sizes binary, entries binary, tokens binary, places binary"


def _table(schema, rows):
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.table({name: pa.array(c, type=kinds[kind]) for (name, kind), c in zip(fields, columns)})


def _numbers(column, kind):
    return [np.frombuffer(data, kind) for data in column.to_pylist()]


def _splits(part):
    """(part, positions) for every part that occurs, positions in order."""
    order = np.argsort(part, kind="stable")
    used, first = np.unique(part[order], return_index=True)
    return zip(used.tolist(), np.split(order, first[1:]))


def _dealt(source, size, parts):
    """Every set's shingles, packed by part and batch of documents; and a row per batch that names its classes.

    A part is a range of hashes; 32 further bits tell its shingles apart. Batches are numbered by task, which gives the
    same numbers when a lost task runs again.
    """

    def packed(number, names, sets):
        token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        part = ((token >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        rows = []
        for p, at in _splits(part):
            counts = np.bincount(owner[at], minlength=len(sets)).astype("<u4").tobytes()
            rows.append((p, number, counts, token[at].astype("<u4").tobytes(), None, None, None))
        sizes = np.array([len(s) for s in sets], "<u4").tobytes()
        rows.append((parts + number % parts, number, None, None, None, np.array(names, "<i8").tobytes(), sizes))
        return _table(DEALT, rows).to_batches()

    def run(batches):
        number, done, names, sets, held = TaskContext.get().partitionId() << 32, set(), [], [], 0
        for _, texts in blocks(batches):
            for s in shingle_sets(texts, size):
                name = set_hash(s)
                if not len(s) or name in done:
                    continue  # a copy of a set that this task has dealt out
                if len(done) >= KNOWN_SETS:
                    done.clear()
                done.add(name)
                names.append(name)
                sets.append(s)
                held += len(s)
            if held >= HELD_ENTRIES:
                yield from packed(number, names, sets)
                number, names, sets, held = number + 1, [], [], 0
        if sets:
            yield from packed(number, names, sets)

    return source.select("doc_id", "text").mapInArrow(run, DEALT)


def _shared(table):
    """Of one part, the shingles that occur twice or more, with their frequency class, for the batches they came from."""
    if table["names"][0].is_valid:
        return table
    counts, tokens = _numbers(table["counts"], "<u4"), _numbers(table["tokens"], "<u4")
    every = np.concatenate(tokens)
    order = np.argsort(every, kind="stable")
    ordered = every[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    run = np.diff(np.append(first, len(ordered)))
    rank = np.empty(len(every), np.uint8)
    rank[order] = np.repeat(np.minimum(np.log2(run) * STEPS, 255).astype(np.uint8), run)
    rows, at = [], 0
    for part, batch, count, token in zip(table["part"].to_pylist(), table["batch"].to_pylist(), counts, tokens):
        ranks = rank[at : at + len(token)]
        at += len(token)
        keep = ranks > 0
        if keep.any():
            owner = np.repeat(np.arange(len(count)), count)
            kept = np.bincount(owner[keep], minlength=len(count)).astype("<u4")
            rows.append((part, batch, kept.tobytes(), token[keep].tobytes(), ranks[keep].tobytes(), None, None))
    return _table(DEALT, rows)


def _prefixes(table, percent, parts, hot_class):
    """Of one batch of documents, the shared shingles within the prefixes, packed by shingle."""
    named = table.filter(pc.is_valid(table["names"]))
    shared = table.filter(pc.is_null(table["names"]))
    if not shared.num_rows:
        return _table(POSTED, [])
    names, sizes = _numbers(named["names"], "<i8")[0], _numbers(named["sizes"], "<u4")[0].astype(np.int64)
    counts, tokens = _numbers(shared["counts"], "<u4"), _numbers(shared["tokens"], "<u4")
    owner = np.concatenate([np.repeat(np.arange(len(c)), c) for c in counts])
    token = np.concatenate([t | np.uint64(p << 32) for t, p in zip(tokens, shared["part"].to_pylist())])
    rank = np.concatenate(_numbers(shared["ranks"], np.uint8))
    order = np.lexsort((token, rank, owner))
    owner, token, rank = owner[order], token[order], rank[order]
    held = np.bincount(owner, minlength=len(names))
    place = np.arange(len(owner)) - (np.cumsum(held) - held)[owner] + (sizes - held)[owner]
    keep = place < prefix_size(sizes, percent)[owner]
    owner, token, rank, place = owner[keep], token[keep], rank[keep], place[keep].astype(np.uint32)
    hot = rank >= hot_class
    spread = np.where(hot, mixed(names.view(np.uint64))[owner], np.uint64(0))
    part = (mixed(token ^ spread) % np.uint64(parts)).astype(np.int64)
    place |= np.where(hot, HOT, np.uint32(0))
    rows = []
    for p, at in _splits(part):
        own, entries = np.unique(owner[at], return_counts=True)
        columns = (names[own], sizes[own].astype("<u4"), entries.astype("<u4"), token[at], place[at])
        rows.append((p, *(c.tobytes() for c in columns)))
    return _table(POSTED, rows)


def may_link(n, m, i, j, percent):
    """Length and positional filter, for sets of n and m that share the shingle at places i and j."""
    near = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    return near & (1 + np.minimum(n - i - 1, m - j - 1) >= least_overlap(n, m, percent))


def _candidates(table, percent, every):
    """Pairs of one part, and the entries of shingles that more than two classes share.

    `every`: all pairs instead, and the entries of hot shingles, whose classes stand in many parts.
    """
    column = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    entries = column("entries", "<u4")
    names, sizes = np.repeat(column("names", "<i8"), entries), np.repeat(column("sizes", "<u4").astype(np.int64), entries)
    token, place = column("tokens", "<u8"), column("places", "<u4")
    hot, place = (place & HOT) > 0, (place & ~HOT).astype(np.int64)

    order = np.flatnonzero(repeated(token) | hot)
    pick = mixed(names.view(np.uint64) ^ mixed(token % np.uint64(CENTRES)))
    order = order[np.lexsort((names[order], pick[order], place[order], token[order]))]
    token, names, sizes, place, hot = (c[order] for c in (token, names, sizes, place, hot))
    fresh = np.ones(len(token), bool)  # tasks may have dealt out the same class twice
    fresh[1:] = (token[1:] != token[:-1]) | (names[1:] != names[:-1])
    token, names, sizes, place, hot = (c[fresh] for c in (token, names, sizes, place, hot))
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, int)
    run = np.diff(np.append(first, len(token)))
    start, length = np.repeat(first, run), np.repeat(run, run)

    left, right = [], []
    if every:
        inside = np.where(hot, 1, length)
        for k in range(1, int(inside.max(initial=1))):
            at = np.flatnonzero(start + inside > np.arange(len(token)) + k)
            at = at[may_link(sizes[at], sizes[at + k], place[at], place[at + k], percent)]
            left.append(names[at])
            right.append(names[at + k])
    else:
        at = np.flatnonzero(start != np.arange(len(token)))
        to = start[at]
        ok = may_link(sizes[to], sizes[at], place[to], place[at], percent)
        left.append(names[to[ok]])
        right.append(names[at[ok]])
    left, right = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (left, right))
    both = np.unique(np.stack([left, right], axis=1), axis=0) if len(left) else np.zeros((0, 2), np.int64)
    more = np.flatnonzero(hot if every else (length > 2) | hot)
    none = lambda k, kind=pa.int64(): pa.nulls(k, kind)
    return pa.table(
        {
            "a": pa.concat_arrays([pa.array(both[:, 0]), none(len(more))]),
            "b": pa.concat_arrays([pa.array(both[:, 1]), none(len(more))]),
            "token": pa.concat_arrays([none(len(both)), pa.array(token[more].astype(np.int64))]),
            "d": pa.concat_arrays([none(len(both)), pa.array(names[more])]),
            "n": pa.concat_arrays([none(len(both)), pa.array(sizes[more])]),
            "place": pa.concat_arrays([none(len(both)), pa.array(place[more])]),
        }
    )


# third pass: whole sets of the classes in question


def _marks(names):
    """A bitmap of fixed size: which low bits of class names occur."""
    at = F.col("d").bitwiseAND(F.lit(MARKS - 1))
    words = names.select(F.shiftright(at, 5).cast("int").alias("word"), (at % 32).cast("int").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    table = np.zeros(MARKS // 32, np.uint32)
    table[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return table


def _sets(source, size, names, marks):
    """(d, tokens) of the classes in `names` (d), once each. Sets whose mark is missing never leave their task."""

    def run(batches):
        bits = marks.value
        for _, texts in blocks(batches):
            rows = {}
            for s in shingle_sets(texts, size):
                name = set_hash(s)
                at = name & (MARKS - 1)
                if len(s) and bits[at >> 5] >> np.uint32(at & 31) & np.uint32(1):
                    rows[name] = pack(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.binary())], names=["d", "tokens"]
            )

    found = source.select("doc_id", "text").mapInArrow(run, "d bigint, tokens binary")
    return found.join(names, "d", "left_semi").groupBy("d").agg(F.min("tokens").alias("tokens"))


def linked(x, y, percent=PERCENT):
    """Whether two sorted sets reach the threshold; the suffix filter first."""
    n, m = len(x), len(y)
    need = least_overlap(n, m, percent)
    if need > min(n, m):
        return False
    cuts = np.array([n // 4, n // 2, 3 * n // 4])
    at = np.searchsorted(y, x[cuts])
    apart = np.abs(np.diff(cuts, prepend=0, append=n) - np.diff(at, prepend=0, append=m)).sum()
    if apart > n + m - 2 * need:
        return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= need


def _verified(candidates, sets, percent):
    """The candidate pairs (a, b) that are linked."""
    a = sets.select(F.col("d").alias("a"), F.col("tokens").alias("x"))
    b = sets.select(F.col("d").alias("b"), F.col("tokens").alias("y"))
    both = candidates.join(a, "a").join(b, "b").select("a", "b", "x", "y")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ok = [linked(unpack(x), unpack(y), percent) for x, y in zip(*(part.column(c).to_pylist() for c in (2, 3)))]
                yield part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


def _ordered(found):
    """Distinct pairs, lower name first."""
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _labelled(entries, edges):
    """Entries of shared shingles with their class's component, where more than one component shares the shingle."""
    labels = components(edges).withColumnRenamed("node", "d")
    known = entries.join(labels, "d", "left").withColumn("label", F.coalesce("label", "d"))
    mixed_up = known.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
    return stage(known.join(mixed_up.select("token"), "token", "left_semi"))


def _between_components(known, turn):
    """One class per component and shingle, the least altered, paired with the least altered of them all."""
    pick = F.xxhash64("d", F.pmod("token", F.lit(CENTRES)), F.lit(turn)).alias("pick")
    entry = F.struct("place", pick, "n", "d")
    one = known.groupBy("token", "label").agg(F.min(entry).alias("e"))
    first = one.groupBy("token").agg(F.min("e").alias("f"))
    return one.join(first, "token").where("e <> f").select(*_sides("f", "e"))


def _across_components(known, percent):
    """All pairs of entries of one shingle that stand in different components, component by component.

    Two components meet only if their bounds leave room for a pair that `may_link`: sizes, and what follows the shingle.
    """
    rest = F.max(F.col("n") - F.col("place") - 1)
    bounds = F.struct(F.min("n").alias("least"), F.max("n").alias("most"), rest.alias("rest"))
    groups = known.groupBy("token", "label").agg(bounds.alias("x"))
    left = groups.withColumnRenamed("label", "low")
    right = groups.select("token", F.col("label").alias("high"), F.col("x").alias("y"))
    x, y = F.col("x"), F.col("y")
    near = (100 * x["most"] >= percent * y["least"]) & (100 * y["most"] >= percent * x["least"])
    room = 1 + F.least(x["rest"], y["rest"]) >= _need(x["least"], y["least"], percent)
    meet = left.join(right, "token").where((F.col("low") < F.col("high")) & near & room).drop("x")
    entry = F.struct("n", "d", "place")
    low = known.select("token", F.col("label").alias("low"), entry.alias("e"))
    high = known.select("token", F.col("label").alias("high"), entry.alias("f"))
    e = F.col("e")
    fits = (100 * e["n"] >= percent * y["least"]) & (100 * y["most"] >= percent * e["n"])
    fits &= 1 + F.least(e["n"] - e["place"] - 1, y["rest"]) >= _need(e["n"], y["least"], percent)
    some = meet.join(low, ["token", "low"]).where(fits).drop("y")
    return some.join(high, ["token", "high"]).select(*_sides("e", "f"))


def _all_pairs(entries, block):
    """All pairs of classes that share a shingle, which are dealt out by shingle and pair of blocks of about `block`."""
    sizes = entries.groupBy("token").agg(F.ceil(F.count("*") / block).alias("blocks"))
    at = F.pmod(F.xxhash64("d"), F.col("blocks"))
    entry = F.struct("n", "d", "place")
    known = entries.join(sizes, "token").select("token", "blocks", at.alias("at"), entry.alias("e"))
    low = known.select("token", F.col("at").alias("low"), F.explode(F.expr("sequence(at, blocks - 1)")).alias("high"), "e")
    high = known.select(
        "token", F.explode(F.expr("sequence(0L, at)")).alias("low"), F.col("at").alias("high"), F.col("e").alias("f")
    )
    both = low.join(high, ["token", "low", "high"]).where("low < high OR e.d < f.d")
    return both.select(*_sides("e", "f"))


def _sides(e, f):
    return (
        *(F.col(f"{e}.{c}").alias(k) for c, k in (("d", "a"), ("n", "n"), ("place", "i"))),
        *(F.col(f"{f}.{c}").alias(k) for c, k in (("d", "b"), ("n", "m"), ("place", "j"))),
    )


def _filtered(met, percent):
    """Length and positional filter as in `may_link`."""
    n, m, i, j = (F.col(c) for c in "nmij")
    near = 100 * F.least(n, m) >= percent * F.greatest(n, m)
    return met.where(near & (1 + F.least(n - i - 1, m - j - 1) >= _need(n, m, percent))).select("a", "b")


def _need(n, m, percent):
    """`least_overlap` of two columns."""
    return F.floor((percent * (n + m) + 99 + percent) / (100 + percent))


class Join:
    """The join of one table: `classes` (doc_id, d, n) and, by `links` or `edges`, what is linked."""

    def __init__(self, docs, id_col="doc_id", text_col="text", size=WORDS, percent=PERCENT, part_entries=PART_ENTRIES):
        self.spark, self.size, self.percent = docs.sparkSession, size, percent
        self.source = pairs(docs, id_col, text_col)
        self.classes = stage(_summaries(self.source, size))
        entries = self.classes.agg(F.sum("n")).first()[0] or 0
        self.parts = max(LEAST_PARTS, -(-entries // part_entries))
        self.block = max(2, part_entries // 200)
        self.hot_class = int(np.log2(max(part_entries / 10, 2)) * STEPS)

    def _shared(self, every):
        percent, hot_class, parts = self.percent, self.hot_class, max(LEAST_PARTS, self.parts // 4)
        shared = _dealt(self.source, self.size, self.parts).groupBy("part").applyInArrow(_shared, DEALT)
        posted = shared.groupBy("batch").applyInArrow(lambda t: _prefixes(t, percent, parts, hot_class), POSTED)
        found = posted.groupBy("part").applyInArrow(
            lambda t: _candidates(t, percent, every), "a bigint, b bigint, token bigint, d bigint, n bigint, place bigint"
        )
        found = stage(found)
        return stage(_ordered(found.where("a IS NOT NULL"))), found.where("d IS NOT NULL").drop("a", "b")

    def _whole(self, candidates, entries):
        names = candidates.select(F.col("a").alias("d")).union(candidates.select("b")).union(entries.select("d")).distinct()
        names = stage(names)
        marks = self.spark.sparkContext.broadcast(_marks(names))
        return stage(_sets(self.source, self.size, names, marks))

    def links(self):
        """All linked pairs of classes (a, b), a < b."""
        candidates, entries = self._shared(every=True)
        far = _filtered(_all_pairs(entries, self.block), self.percent)
        candidates = stage(_ordered(candidates.unionByName(far)))
        return stage(_verified(candidates, self._whole(candidates, entries), self.percent))

    def edges(self):
        """Linked pairs of classes that connect all that are linked, without all pairs of a dense group."""
        tried, entries = self._shared(every=False)
        sets = self._whole(tried, entries)
        edges = stage(_verified(tried, sets, self.percent))
        for turn in range(TURNS + 1):
            known = _labelled(entries, edges)
            met = _between_components(known, turn) if turn < TURNS else _across_components(known, self.percent)
            new = stage(_ordered(_filtered(met, self.percent)).join(tried, ["a", "b"], "left_anti"))
            if new.isEmpty():
                continue
            edges = stage(edges.unionByName(_verified(new, sets, self.percent)))
            tried = stage(tried.unionByName(new))
        return edges


def component_rows(docs, id_col="doc_id", text_col="text", **options):
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links, itself included)."""
    join = Join(docs, id_col, text_col, **options)
    rows = join.classes
    named = stage(rows.where("n > 0").groupBy("d").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_rows")))
    labels = components(join.edges()).withColumnRenamed("node", "d")
    known = stage(named.join(labels, "d", "left").withColumn("label", F.coalesce("label", "d")))
    lowest = known.groupBy("label").agg(F.min("least").alias("component_id"))
    found = stage(known.join(lowest, "label").select("d", "n_rows", "component_id"))
    joined = attach(rows, found, ["d"], ["doc_id"], needed=F.col("n") > 0, hot_rows=HOT_ROWS)
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
