"""Building blocks that stay parallel when one key holds a large share of all rows."""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

HOT_KEYS = 10_000
HOT_ROWS = 1_000_000


def attach(fact, lookup, keys, spread, needed=None, hot_keys=HOT_KEYS, hot_rows=HOT_ROWS):
    """Left join of `lookup` to `fact` where a few keys may hold most fact rows.

    `lookup` is a staged table, unique on `keys`, with `n_rows`: the number of fact rows per key, which the caller's
    pre-aggregation yields anyway. A short lookup is broadcast by its file size. Otherwise a key is hot when it holds
    over 1/hot_keys of all counted rows (and over `hot_rows`), so there are fewer than `hot_keys` of them whatever the
    data size: those lookup rows are broadcast, and the fact rows they serve are spread over all tasks of the shuffled
    join that handles the rest. So are rows the caller says need no lookup. `spread` names columns that tell rows apart.
    """
    values = [c for c in lookup.columns if c not in keys and c != "n_rows"]

    def matched(left, right, tag, extra):
        renamed = right.select(*[F.col(k).alias(f"_{tag}_{k}") for k in keys], *extra[0])
        same = [F.col(k).eqNullSafe(F.col(f"_{tag}_{k}")) for k in keys]
        joined = left.join(renamed, reduce(lambda a, b: a & b, same, extra[1]), "left")
        return joined.drop(*[f"_{tag}_{k}" for k in keys])

    packed = F.struct(F.lit(True).alias("_hit"), *values)
    wanted = F.lit(True) if needed is None else F.coalesce(needed, F.lit(False))
    hot = lookup.where(F.col("n_rows") > hot_rows)
    if hot.isEmpty():
        lookup_side = [packed.alias("_cold")]
        out = fact
        found = F.col("_cold")
        served = ~wanted
    else:
        total = lookup.agg(F.sum("n_rows") / F.lit(hot_keys)).scalar()
        is_hot = (F.col("n_rows") > hot_rows) & (F.col("n_rows") > total)
        out = matched(fact, F.broadcast(lookup.where(is_hot)), "hot", ([packed.alias("_hot")], wanted))
        lookup = lookup.where(~is_hot)
        lookup_side = [packed.alias("_cold")]
        found = F.coalesce("_hot", "_cold")
        served = ~wanted | F.col("_hot").isNotNull()
    if out is not fact or needed is not None:
        salt = F.when(served, 1 + F.pmod(F.xxhash64(*spread), F.lit(1 << 20))).otherwise(F.lit(0))
        out = out.withColumn("_salt", salt)
        lookup_side.append(F.lit(0).cast("bigint").alias("_cold_salt"))
        out = matched(out, lookup, "cold", (lookup_side, F.col("_salt") == F.col("_cold_salt")))
    else:
        out = matched(out, lookup, "cold", (lookup_side, F.lit(True)))
    return out.select(*fact.columns, *[found[v].alias(v) for v in values])


def dense_index(df, key, order, out, block_rows=1_000_000):
    """0-based position of each row within `key` by integer column `order`, without one task per key.

    Rows are numbered inside blocks of the order column; block offsets come from a running sum over block counts.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / block_rows))
    running = W.partitionBy(key).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(key, "_block")
        .agg(F.count("*").alias("_n"))
        .select(key, "_block", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(W.partitionBy(key, "_block").orderBy(order)) - 1
    return (
        blocked.join(offsets.hint("shuffle_hash"), [key, "_block"])
        .withColumn(out, F.col("_offset") + local)
        .drop("_block", "_offset")
    )
