"""URL verdicts: rules by host and path, and elsewhere a logistic regression on hashed character n-grams.

The host stands after the first `://`, up to `/`, `?`, `#` or the end, with A-Z lower-cased; the path follows, up to `?`,
`#` or the end. Without `://`, or where the URL is null, both are empty. A rule fits its host and all subdomains when the
path starts with the rule's; the longest rule wins. Rules are few and written as one expression.

The model sees n-grams of 3 to 5 bytes of host and path apart, hashed into 2^14 weights. It is fitted on the driver to a
small labelled table (url, label 1 for allow) of at most `MAX_LABELLED` rows; more are refused. Without rows of both
labels it says allow. Repeated rows are judged each.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from .texts import lower_ascii, whole

# The contract's rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
WIDTH = 1 << 14
GRAMS = (3, 4, 5)
MAX_LABELLED = 2_000
STEPS, RATE, RIDGE = 300, 2.0, 1e-4
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def host_path(url):
    """(host, path) columns."""
    text = whole(url)
    first = F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)
    return lower_ascii(F.regexp_extract(first, r"^[^/?#]*", 0)), F.regexp_extract(first, r"^[^/?#]*([^?#]*)", 1)


def rule_columns(host, path, rules=RULES):
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for on, under, says in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == on) | host.endswith(f".{on}")) & path.startswith(under)
        rule = F.when(fits, F.lit(on + under)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def grams(texts, seed):
    """(row, bucket) of every n-gram of the byte strings; a string is framed by spaces."""
    framed = [b" " + t.encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(framed), np.uint8).astype(np.uint64) + np.uint64(1)
    row = np.repeat(np.arange(len(framed)), [len(f) for f in framed])
    rows, buckets = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, np.uint64(seed * 8 + n))
        for k in range(n):
            code = (code ^ data[k : len(data) - n + 1 + k]) * FACTOR
            code ^= code >> np.uint64(29)
        inside = row[: len(code)] == row[n - 1 :]
        rows.append(row[: len(code)][inside])
        buckets.append((code[inside] % np.uint64(WIDTH)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(buckets)


def features(hosts, paths):
    found = [grams(hosts, 1), grams(paths, 2)]
    return np.concatenate([r for r, _ in found]), np.concatenate([b for _, b in found])


def odds(weights, rows, buckets, n):
    """Log odds of allow; a row's n-grams share its weight evenly, so long URLs do not count more."""
    size = np.maximum(np.bincount(rows, minlength=n), 1)
    return np.bincount(rows, weights=weights[buckets], minlength=n) / np.sqrt(size) + weights[WIDTH]


def fit(hosts, paths, labels):
    """Weights of the n-gram buckets and the intercept, by gradient steps from zero."""
    weights, y = np.zeros(WIDTH + 1), np.asarray(labels, float)
    if len(set(y.tolist())) < 2:
        return weights
    rows, buckets = features(hosts, paths)
    scale = 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=len(y)), 1))
    for _ in range(STEPS):
        miss = y - 1 / (1 + np.exp(-odds(weights, rows, buckets, len(y))))
        slope = np.bincount(buckets, weights=(miss * scale)[rows], minlength=WIDTH) / len(y)
        weights[:WIDTH] += RATE * (slope - RIDGE * weights[:WIDTH])
        weights[WIDTH] += RATE * miss.mean()
    return weights


def train(labelled, max_labelled=MAX_LABELLED):
    """Fit to a DataFrame (url, label)."""
    host, path = host_path(F.col("url"))
    rows = labelled.select(host.alias("host"), path.alias("path"), "label").limit(max_labelled + 1).toPandas()
    if len(rows) > max_labelled:
        raise ValueError(f"over {max_labelled} labelled URLs")
    return fit(rows["host"], rows["path"], rows["label"])


def rule_labels(pages, url_col="url", rules=RULES, rows=MAX_LABELLED):
    """A small labelled table where none is given: different hosts and paths that rules judge, the first by their hash.

    Each label gives every other row as long as it has any, so that both are there however rare one is.
    """
    host, path = host_path(F.col(url_col))
    parts = pages.select(F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    _, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    place = F.xxhash64("host", "path")

    def first(label, says):
        found = parts.where(verdict == says).groupBy("host", "path").agg(F.min("url").alias("url"))
        return found.orderBy(place, "host", "path").limit(rows).withColumn("label", F.lit(label))

    turn = F.row_number().over(Window.partitionBy("label").orderBy(place, "host", "path"))
    both = first(1, "allow").unionByName(first(0, "block"))
    return both.withColumn("turn", turn).orderBy("turn", "label").limit(rows).select("url", "label")


def judge(pages, labelled, id_col="page_id", url_col="url", rules=RULES):
    """One row per page: page_id, host, path, rule, verdict, score (the model's probability of allow)."""
    sent = pages.sparkSession.sparkContext.broadcast(train(labelled))

    @F.pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        rows, buckets = features(hosts, paths)
        return pd.Series(1 / (1 + np.exp(-odds(sent.value, rows, buckets, len(hosts)))))

    host, path = host_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return parts.withColumn("score", score("host", "path")).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") >= 0.5, "allow").otherwise("block")).alias("verdict"),
        "score",
    )
