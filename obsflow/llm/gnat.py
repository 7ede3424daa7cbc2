"""A multiway hyperplane tree over vectors, each split point with the ranges of its distances to all sibling subtrees.

Vectors are compared by inner product. All indexed vectors get one more coordinate that brings them to the same length,
and a query gets 0 there, so that a score s stands for the distance sqrt(|query|^2 + length^2 - 2 s): a window of scores
is an annulus round the query. A node's rows go to the nearest of its split points. A subtree is passed over when, seen
from any split point of the node, the range of its distances misses the annulus. Leaves are searched exactly.
"""

import numpy as np

DEGREE = 8
LEAF_ROWS = 256
SLACK = 1e-6  # of the length, for rounding


class Space:
    """The metric: `length` is that of the longest indexed vector. Scores are exact: in doubles while all sums stay below
    2^53, in Python's integers beyond."""

    def __init__(self, dimensions, length2, largest):
        self.dimensions, self.length2 = dimensions, float(length2)
        self.slack = SLACK * (1 + self.length2**0.5)
        self.doubles = dimensions * largest * largest < 2**53

    def lifted(self, vectors):
        v = vectors.astype(float)
        rest = np.maximum(self.length2 - np.einsum("ij,ij->i", v, v), 0)
        return np.column_stack([v, np.sqrt(rest)])

    def of_queries(self, vectors):
        return np.column_stack([vectors.astype(float), np.zeros(len(vectors))])

    def scores(self, queries, vectors):
        """Integers; whole numbers as doubles where these are exact."""
        if self.doubles:
            return queries.astype(float) @ vectors.astype(float).T
        return queries.astype(object) @ vectors.astype(object).T

    def radius(self, norm2, scores):
        """Distance at which a score stands; scores are doubles, -inf for none."""
        return np.sqrt(np.maximum(norm2 + self.length2 - 2 * scores, 0))


def distances(a, b):
    square = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


class Node:
    __slots__ = ("high", "low", "parts", "points")

    def __init__(self, points, parts):
        self.points, self.parts = points, parts
        n = len(points)
        self.low, self.high = np.full((n, n), np.inf), np.full((n, n), -np.inf)

    def widen(self, dist, nearest):
        """Take rows into the ranges: dist[row, point], and the part of each row."""
        for part in np.unique(nearest):
            mine = dist[nearest == part]
            self.low[:, part] = np.minimum(self.low[:, part], mine.min(0))
            self.high[:, part] = np.maximum(self.high[:, part], mine.max(0))

    def alive(self, dist, inner, outer, slack):
        """[query, part]: whether the part may hold rows at distances between inner and outer of the query."""
        nearest = np.maximum(dist[:, :, None] - self.high, self.low - dist[:, :, None]).max(1)
        farthest = (dist[:, :, None] + self.high).min(1)
        return (nearest <= outer[:, None] + slack) & (farthest >= inner[:, None] - slack)


def split_points(vectors, degree, rng):
    """Rows far from each other: of a few random ones, always that which is farthest from those taken."""
    tried = vectors[rng.choice(len(vectors), min(len(vectors), 4 * degree), replace=False)]
    dist = distances(tried, tried)
    taken, far = [0], dist[0].copy()
    while len(taken) < degree and far.max() > 0:
        taken.append(int(far.argmax()))
        far = np.minimum(far, dist[taken[-1]])
    return tried[taken]


def build(vectors, rows, leaf_rows, rng, degree=DEGREE):
    """Node over `rows` of the lifted vectors, or the rows themselves where they are few, or all alike."""
    if len(rows) <= leaf_rows:
        return rows
    points = split_points(vectors[rows], min(degree, -(-len(rows) // leaf_rows)), rng)
    dist = distances(vectors[rows], points)
    nearest = dist.argmin(1)
    if (nearest == nearest[0]).all():
        return rows
    node = Node(points, [None] * len(points))
    node.widen(dist, nearest)
    for part in range(len(points)):
        mine = rows[nearest == part]
        node.parts[part] = build(vectors, mine, leaf_rows, rng, degree) if len(mine) else mine
    return node


def route(node, vectors, note=None):
    """The leaf (a number) that each lifted vector belongs to. note(node, dist, nearest) is called on the way."""
    out, todo = np.zeros(len(vectors), np.int64), [(node, np.arange(len(vectors)))]
    while todo:
        at, rows = todo.pop()
        if not isinstance(at, Node):
            out[rows] = at
            continue
        dist = distances(vectors[rows], at.points)
        nearest = dist.argmin(1)
        if note:
            note(at, dist, nearest)
        todo += [(at.parts[part], rows[nearest == part]) for part in np.unique(nearest)]
    return out


def walk(node, queries, owner, inner, outer, slack, visit):
    """visit(leaf, windows) for every leaf that windows (numbers) may have rows in, nearest parts first.

    queries: lifted, one a row; owner: the query of each window; inner() and outer() give the distances of all windows,
    and are asked again at each node, as outer ones shrink while rows are found."""
    todo = [(node, np.arange(len(owner)))]
    while todo:
        at, windows = todo.pop()
        if not isinstance(at, Node):
            visit(at, windows)
            continue
        mine, place = np.unique(owner[windows], return_inverse=True)
        dist = distances(queries[mine], at.points)[place]
        alive = at.alive(dist, inner()[windows], outer()[windows], slack)
        order = np.argsort(-dist.mean(0)) if len(windows) else ()
        todo += [(at.parts[part], windows[alive[:, part]]) for part in order if alive[:, part].any()]


class Best:
    """The first k rows of each window found so far: by score, largest first, then by id. Null ids come last."""

    def __init__(self, n_windows, k, low, high):
        self.k, self.low, self.high = k, low, high
        self.window = np.zeros(0, np.int64)
        self.row = np.zeros(0, np.int64)
        self.score = np.zeros(0, low.dtype)

    def add(self, windows, scores, allowed, rows, order):
        """scores and allowed: [window, row]; order[row]: rank of each id, over all rows."""
        good = allowed & (scores >= self.low[windows][:, None]) & (scores <= self.high[windows][:, None])
        if scores.shape[1] > self.k and scores.dtype == float:
            masked = np.where(good, scores, -np.inf)
            good &= scores >= np.partition(masked, -self.k, axis=1)[:, [-self.k]]
        at, row = np.nonzero(good)
        if not len(at):
            return
        self.window = np.concatenate([self.window, windows[at]])
        self.row = np.concatenate([self.row, rows[row]])
        self.score = np.concatenate([self.score, scores[at, row]])
        self._cut(order)

    def _cut(self, order):
        by_score = -self.score if self.score.dtype == float else -np.unique(self.score, return_inverse=True)[1]
        sort = np.lexsort((order[self.row], by_score, self.window))
        window = self.window[sort]
        first = np.maximum.accumulate(np.where(np.diff(window, prepend=-1) != 0, np.arange(len(window)), 0))
        rank = np.arange(len(window)) - first
        keep = sort[rank < self.k]
        full = sort[rank == self.k - 1]
        self.low[self.window[full]] = np.maximum(self.low[self.window[full]], self.score[full])
        self.window, self.row, self.score = self.window[keep], self.row[keep], self.score[keep]
