"""Connected components of an edge table, by alternating large stars and small stars."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.skew import attach
from ..plans.staging import stage

HOT_ROWS = 1_000_000


def _lowest(edges, n_edges):
    """Edges (u, v) with the lowest v of each u as `m`. Where a u may have more than HOT_ROWS of them, its rows are
    joined by broadcast of such keys (`attach`); else no task gets more than that many rows of one u."""
    if n_edges <= HOT_ROWS:
        return edges.withColumn("m", F.min("v").over(W.partitionBy("u")))
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n_rows"))
    return attach(edges, stage(low), ["u"], ["v"], hot_rows=HOT_ROWS)


def _state(edges):
    """(number of edges, whether they are stars): in stars no node has two lower ones, or both a lower and a higher."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("lower"), F.lit(0).alias("higher"))
    ends = ends.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("lower"), F.lit(1).alias("higher")))
    nodes = ends.groupBy("x").agg(F.sum("lower").alias("lower"), F.max("higher").alias("higher"))
    odd = F.count_if((F.col("lower") > 1) | (F.col("lower") * F.col("higher") > 0))
    n, odd = nodes.agg(F.coalesce(F.sum("lower"), F.lit(0)), odd).first()
    return n, not odd


def components(edges):
    """(node, label): every node of the edges (a, b), with the lowest node it is connected to.

    Every round writes its edges. They are done when they are stars: each node then has its component's lowest.
    """
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    n, done = _state(now)
    while not done:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both, 2 * n).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        below = _lowest(large, 2 * n)
        small = below.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.unionByName(below.select("u", F.col("m").alias("v"))).distinct())
        n, done = _state(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
