"""Hard-negative mining: for every anchor and each of its best positives, the best rows of other labels whose scores lie
in a window below the positive's score.

Scores are inner products of whole numbers: each component becomes floor(scale * component). Both searches, for the
positives (the best rows of the anchor's label) and for the negatives (the best rows of other labels within a window),
go through a multiway hyperplane tree (`gnat`) over all rows. Its upper part is fitted to at most `SAMPLE` rows and has
at most `MAX_CELLS` cells; every row is routed to a cell, and the ranges of distances between split points and sibling
subtrees are taken over all rows. A search asks the cell that the query itself falls in first; what it finds there
narrows its annuli, and then every other cell that the ranges do not exclude is asked. A cell is searched in chunks of
bounded size: a task builds the lower tree of a chunk in memory, and queries stream past it. So results are exact: the
sample decides only how much is excluded, and rows whose directions are spread evenly, as in random data, exclude little.

Rows with a null label, a null vector, or a null or non-finite component take no part. Repeated rows (same id, vector and
label) count once. Rows of equal vector and label are one query, and as partners the first of them by id stand for all,
since no more can be wanted; so copies of one vector make no group larger. Equal scores are ordered by id, null ids last.
Shorter vectors count as followed by zeros. An anchor without positives, or a positive without negatives, gives no row;
an empty table gives none. Ids are whole numbers. Only the three named columns are read, so others cannot clash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..plans.skew import attach
from ..plans.staging import stage
from . import gnat

SAMPLE = 8_192
CELL_ROWS = 4_096
MAX_CELLS = 1_024
CHUNK_BYTES = 64 << 20  # of doubles, in a task at a time
TASK_QUERIES = 50_000
QUERY_ROWS = 512
HOT_ROWS = 1_000


def usable_rows(vectors, id_col, vector_col, label_col, scale, anchor):
    """id, label, vector (whole numbers), key (of label and vector), anchor; repeated rows once."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.when(finite, whole).alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).where("label is not null and vector is not null")
    text = F.concat(F.array_join(F.col("vector").cast("array<string>"), ","), F.lit(" "), "label")
    return rows.withColumn("key", F.unhex(F.sha2(text, 256))).groupBy("key", "id").agg(
        *[F.first(c).alias(c) for c in ("label", "vector")], F.max("anchor").alias("anchor")
    )


class Index:
    """Rows in cells: `cells` (cell, chunk count and rows), and the upper tree with its ranges."""

    def __init__(self, rows, sample=SAMPLE, cell_rows=CELL_ROWS, max_cells=MAX_CELLS):
        """rows: key, id, label, vector."""
        size = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
        largest = F.array_max(F.transform("vector", lambda v: F.abs(v.cast("double"))))
        n, dimensions, length2, largest = rows.agg(
            F.count("*"), F.max(F.size("vector")), F.max(size), F.max(largest)
        ).first()
        self.dimensions = dimensions or 0
        self.space = gnat.Space(self.dimensions, length2 or 0, largest or 0)
        some = rows.orderBy(F.xxhash64("key", "id")).limit(sample).select("vector").toArrow()
        drawn = self.space.lifted(_matrix(some.column(0).combine_chunks(), self.dimensions))
        wanted = max(1, min(max_cells, -(-n // cell_rows)))
        tree = gnat.build(drawn, np.arange(len(drawn)), max(1, -(-len(drawn) // wanted)), np.random.default_rng(1))
        self.tree, self.nodes, self.n_cells = _numbered(tree)
        self.rows = stage(self._routed(rows))
        self._take_ranges()
        chunk_rows = max(gnat.LEAF_ROWS, CHUNK_BYTES // (8 * (self.dimensions + 1)))
        counts = self.rows.groupBy("cell").count().collect()
        self.chunks = {r["cell"]: -(-r["count"] // chunk_rows) for r in counts}

    def _routed(self, rows):
        tree, space, dimensions = self.tree, self.space, self.dimensions
        place = rows.columns.index("vector")

        def work(batches):
            for batch in batches:
                cells = gnat.route(tree, space.lifted(_matrix(batch.column(place), dimensions)))
                yield batch.append_column("cell", pa.array(cells, pa.int32()))

        return rows.mapInArrow(work, StructType([*rows.schema, StructField("cell", IntegerType())]))

    def _take_ranges(self):
        tree, nodes, space, dimensions = self.tree, self.nodes, self.space, self.dimensions

        def work(batches):
            for node in nodes:  # only rows count, not the sample
                node.low[:], node.high[:] = np.inf, -np.inf
            for batch in batches:
                vectors = space.lifted(_matrix(batch.column(0), dimensions))
                gnat.route(tree, vectors, lambda node, dist, nearest: node.widen(dist, nearest))
            for k, node in enumerate(nodes):
                i, j = np.nonzero(node.high >= 0)
                if len(i):
                    columns = [np.full(len(i), k), i, j, node.low[i, j], node.high[i, j]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["k", "i", "j", "low", "high"])

        found = self.rows.select("vector").mapInArrow(work, "k long, i long, j long, low double, high double")
        for node in nodes:
            node.low[:], node.high[:] = np.inf, -np.inf
        for r in found.groupBy("k", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
            nodes[r.k].low[r.i, r.j], nodes[r.k].high[r.i, r.j] = r.low, r.high

    def search(self, queries, k, same_label):
        """The first k rows of each window, of the query's label or of others: q, w, score, id, key.

        queries: q, label, vector, windows (array of struct low, high; bounds of the score, both included)."""
        first = self._ask(self._home(queries), k, same_label)
        bounds = (
            first.groupBy("q", "w")
            .agg(F.count("*").alias("n"), F.min("score").alias("least"))
            .where(F.col("n") == k)
            .groupBy("q")
            .agg(F.map_from_entries(F.collect_list(F.struct("w", "least"))).alias("least"))
        )
        at_least = lambda w, i: F.struct(
            F.greatest(w["low"], F.element_at(F.col("least"), i + 1)).alias("low"), w["high"].alias("high")
        )
        known = queries.join(bounds, "q", "left").withColumn(
            "windows", F.when(F.col("least").isNull(), F.col("windows")).otherwise(F.transform("windows", at_least))
        )
        rest = self._ask(self._visits(known.drop("least")), k, same_label)
        rank = F.row_number().over(W.partitionBy("q", "w").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "key"))
        return first.unionByName(rest).withColumn("rank", rank).where(F.col("rank") <= k)

    def _home(self, queries):
        """Each query with the cell that it falls in itself: a query is one of the rows, so its own lifted vector counts."""
        routed = self._routed(queries.select("q", "label", "vector", "windows"))
        return stage(routed.withColumn("cells", F.array("cell")).drop("cell"))

    def _visits(self, queries):
        """Each query with all other cells that its annuli meet."""
        tree, space, dimensions, n_cells = self.tree, self.space, self.dimensions, self.n_cells

        def work(batches):
            for batch in batches:
                vectors = _matrix(batch.column(2), dimensions)
                home = gnat.route(tree, space.lifted(vectors))
                owner, low, high = _windows(batch.column(3))
                meets = np.zeros((batch.num_rows, n_cells), bool)
                inner, outer = _annuli(space, vectors, owner, low, high)
                gnat.walk(
                    tree,
                    space.of_queries(vectors),
                    owner,
                    lambda: inner,
                    lambda: outer,
                    space.slack,
                    lambda cell, windows: meets.__setitem__((owner[windows], cell), True),
                )
                meets[np.arange(len(home)), home] = False
                cells = pa.array([np.flatnonzero(m) for m in meets], pa.list_(pa.int32()))
                yield batch.append_column("cells", cells)

        queries = queries.select("q", "label", "vector", "windows")
        cells = StructField("cells", ArrayType(IntegerType()))
        return stage(queries.mapInArrow(work, StructType([*queries.schema, cells])))

    def _ask(self, visits, k, same_label):
        """Search chunks of cells; visits: queries with the cells they ask."""
        each = visits.withColumn("cell", F.explode("cells")).drop("cells")
        asked = {r["cell"]: r["count"] for r in each.groupBy("cell").count().collect()}
        plan = [(c, self.chunks[c], -(-n // TASK_QUERIES)) for c, n in asked.items() if c in self.chunks]
        spark = visits.sparkSession
        plan = F.broadcast(spark.createDataFrame(plan, "cell int, chunks int, pieces int"))  # at most MAX_CELLS rows
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        deal = lambda n, *c: F.pmod(F.xxhash64(*c), F.col(n)).cast("int")
        none = lambda kind: F.lit(None).cast(kind)
        window_type = "array<struct<low: bigint, high: bigint>>"
        rows = self.rows.join(plan, "cell").withColumn("chunk", deal("chunks", "key", "id")).withColumn("piece", upto("pieces"))
        rows = rows.select("cell", "chunk", "piece", F.lit(0).alias("kind"), "key", "id", "label", "vector", none(window_type).alias("windows"))
        asking = each.join(plan, "cell").withColumn("piece", deal("pieces", "q")).withColumn("chunk", upto("chunks"))
        asking = asking.select("cell", "chunk", "piece", F.lit(1).alias("kind"), F.col("q").alias("key"), none("bigint").alias("id"), "label", "vector", "windows")
        group = ["cell", "chunk", "piece"]
        together = rows.unionByName(asking).repartition(*group).sortWithinPartitions(*group, "kind")
        space, dimensions = self.space, self.dimensions

        def work(batches):
            chunk, held, searcher = None, [], None
            for batch in batches:
                names = [batch.column(i).to_numpy() for i in range(3)]
                edges = np.flatnonzero(np.any([np.diff(x) != 0 for x in (*names, batch.column(3).to_numpy())], axis=0)) + 1
                for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                    part, this = batch.slice(a, b - a), tuple(x[a] for x in names)
                    if this != chunk:
                        chunk, held, searcher = this, [], None
                    if part.column(3)[0].as_py() == 0:
                        held.append(part)
                    elif held or searcher:
                        searcher = searcher or _Chunk(held, space, dimensions)
                        for at in range(0, part.num_rows, QUERY_ROWS):
                            yield from searcher.answers(part.slice(at, QUERY_ROWS), k, same_label)

        return stage(together.mapInArrow(work, "q binary, w int, score long, id long, key binary"))


class _Chunk:
    """The rows of a chunk under their own tree, in memory."""

    def __init__(self, held, space, dimensions):
        table = pa.Table.from_batches(held)
        self.key, self.id, self.label = (table.column(c).combine_chunks() for c in ("key", "id", "label"))
        self.vectors = np.concatenate([_matrix(b.column(7), dimensions) for b in held])
        held.clear()
        ids = self.id.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.order = np.empty(len(ids), np.int64)
        key = self.key.to_numpy(zero_copy_only=False)
        self.order[np.lexsort((key, self.id.is_null().to_numpy(zero_copy_only=False), ids))] = np.arange(len(ids))
        self.labels = {v: i for i, v in enumerate(self.label.unique().to_pylist())}
        self.label_number = np.array([self.labels[v] for v in self.label.to_pylist()], np.int64)
        self.space, self.dimensions = space, dimensions
        if space.doubles:
            self.vectors = self.vectors.astype(float)
        everything = np.arange(len(ids))
        self.tree = gnat.build(space.lifted(self.vectors), everything, gnat.LEAF_ROWS, np.random.default_rng(1))

    def answers(self, batch, k, same_label):
        space, vectors = self.space, _matrix(batch.column(7), self.dimensions)
        owner, low, high = _windows(batch.column(8))
        if not space.doubles:
            low, high = low.astype(object), high.astype(object)
        label = np.array([self.labels.get(v, -1) for v in batch.column(6).to_pylist()], np.int64)
        best = gnat.Best(len(owner), k, low, high)
        norm2 = np.einsum("ij,ij->i", vectors.astype(float), vectors.astype(float))[owner]

        def visit(rows, windows):
            for at in range(0, len(rows), 4 * gnat.LEAF_ROWS):  # rows alike are one leaf, however many
                some = rows[at : at + 4 * gnat.LEAF_ROWS]
                asking, place = np.unique(owner[windows], return_inverse=True)
                scores = space.scores(vectors[asking], self.vectors[some])
                fits = (label[asking][:, None] == self.label_number[some]) == same_label
                best.add(windows, scores[place], fits[place], some, self.order)

        gnat.walk(
            self.tree,
            space.of_queries(vectors),
            owner,
            lambda: space.radius(norm2, high.astype(float)),
            lambda: space.radius(norm2, best.low.astype(float)),
            space.slack,
            visit,
        )
        if len(best.window):
            rows = pa.array(best.row)
            number = np.arange(len(owner)) - np.searchsorted(owner, owner)  # of the window within its query
            columns = [
                batch.column(4).take(pa.array(owner[best.window])),
                pa.array(number[best.window] + 1, pa.int32()),
                pa.array(best.score.astype(np.int64)),
                self.id.take(rows),
                self.key.take(rows),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["q", "w", "score", "id", "key"])


def _numbered(tree):
    """The tree with its leaves replaced by numbers of cells; its nodes; the number of cells."""
    nodes, cells = [], 0
    todo = [tree] if isinstance(tree, gnat.Node) else []
    while todo:
        node = todo.pop()
        nodes.append(node)
        for k, part in enumerate(node.parts):
            if isinstance(part, gnat.Node):
                todo.append(part)
            else:
                node.parts[k] = cells
                cells += 1
    return (tree, nodes, cells) if nodes else (0, nodes, 1)


def _matrix(lists, dimensions):
    """Whole numbers of a column of lists, one row each; shorter ones end with zeros."""
    flat, ends = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    if len(ends) and (ends == dimensions).all():
        return flat.reshape(len(ends), dimensions)
    out = np.zeros((len(ends), dimensions), np.int64)
    inside = np.arange(dimensions)[None, :] < ends[:, None]
    out[inside] = flat
    return out


def _windows(lists):
    """(query of each window, lowest score, highest score), as doubles; windows of a query stand together."""
    ends = lists.offsets.to_numpy()
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.diff(ends))
    return owner, *(flat.field(n).to_numpy(zero_copy_only=False).astype(float) for n in (0, 1))


def _annuli(space, vectors, owner, low, high):
    v = vectors.astype(float)
    norm2 = np.einsum("ij,ij->i", v, v)[owner]
    return space.radius(norm2, high), space.radius(norm2, low)


def mine(vectors, anchor, id_col="vec_id", vector_col="embedding", label_col="label", scale=256, positives=5, negatives=3, low=50, high=95):
    """One row for each anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    `anchor` is a condition that chooses the anchors among the rows. Of an anchor's other rows of the same label the first
    `positives` by score count; for each, the first `negatives` rows of other labels whose score is from `low` to `high`
    per cent of the positive's. `rank` counts the negatives of a positive from 1.
    """
    rows = stage(usable_rows(vectors, id_col, vector_col, label_col, scale, anchor))
    wanted = max(positives + 1, negatives)  # one of them may be the anchor itself
    nth = F.row_number().over(W.partitionBy("key").orderBy(F.col("id").asc_nulls_last()))
    partners = rows.withColumn("nth", nth).where(F.col("nth") <= wanted).select("key", "id", "label", "vector")
    index = Index(stage(partners))
    anchors = rows.where("anchor")
    queries = stage(
        anchors.groupBy(F.col("key").alias("q")).agg(
            *[F.first(c).alias(c) for c in ("label", "vector")], F.count("*").alias("n_rows")
        )
    )
    bounds = lambda a, b: F.struct(a.cast("bigint").alias("low"), b.cast("bigint").alias("high"))
    everything = F.array(bounds(F.lit(-(2**62)), F.lit(2**62)))
    found = index.search(queries.withColumn("windows", everything), positives + 1, True)
    first = F.array_sort(F.collect_list(F.struct("rank", "score", "id", "key")))
    liked = stage(found.groupBy("q").agg(first.alias("liked")).join(queries, "q"))
    window = lambda p: bounds(F.ceil(p["score"] * low / F.lit(100)), F.floor(p["score"] * high / F.lit(100)))
    asked = liked.withColumn("windows", F.transform("liked", window)).drop("liked", "n_rows")
    disliked = index.search(asked, negatives, False).groupBy("q", "w").agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "id"))).alias("rows")
    )
    by_window = disliked.groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("w", "rows"))).alias("disliked"))
    with_rows = lambda p: F.struct(
        *[p[c].alias(c) for c in ("score", "id", "key")], F.element_at(F.col("disliked"), p["rank"]).alias("rows")
    )
    results = liked.join(by_window, "q").select(
        F.col("q").alias("key"), "n_rows", F.transform("liked", with_rows).alias("found")
    )
    each = attach(anchors.select("key", "id"), stage(results), ["key"], ["id"], hot_rows=HOT_ROWS).where("found is not null")
    others = F.slice(F.filter("found", lambda p: ~(p["id"].eqNullSafe(F.col("id")) & (p["key"] == F.col("key")))), 1, positives)
    return (
        each.select(F.col("id").alias("anchor_id"), F.explode(others).alias("p"))
        .select("anchor_id", "p", F.explode("p.rows").alias("n"))
        .select(
            "anchor_id",
            F.col("p.id").alias("positive_id"),
            F.col("n.rank").cast("int").alias("rank"),
            F.col("n.id").alias("negative_id"),
            F.col("p.score").alias("positive_score"),
            F.col("n.score").alias("negative_score"),
        )
    )


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, a.v AS av, b.vec_id AS id, a.label = b.label AS same,
    list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id IS DISTINCT FROM b.vec_id OR a.v <> b.v OR a.label <> b.label
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id, av ORDER BY score DESC, id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.av, p.id, p.score ORDER BY n.score DESC, n.id NULLS LAST)::INT AS rank,
  n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND n.av = p.av AND NOT n.same
  AND 100 * n.score BETWEEN 50 * p.score AND 95 * p.score
QUALIFY rank <= 3
"""
