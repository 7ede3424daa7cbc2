"""Similarity of a name key to keys of the gazetteer.

The published definitions are used: an indel ratio from the longest common subsequence, token-sort and token-set
variants, best-window partial ratios, and their weighted combination.
"""

from bisect import insort
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEST = T.StructType([T.StructField("alias_ord", T.IntegerType()), T.StructField("score", T.DoubleType())])


def _places(a):
    """Character to the bits of its places in a."""
    where = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    return where


def _lcs(a, b, where=None):
    """Longest common subsequence length, one machine word of bits per character of a."""
    where = where or _places(a)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a, b, where=None):
    both = len(a) + len(b)
    return 100.0 * 2 * _lcs(a, b, where) / both if both else 100.0


def partial_ratio(a, b):
    """Best ratio of the shorter text against windows of the longer one, including cut windows at both ends."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    spans = {(max(0, end - n), min(end, len(long))) for end in range(1, len(long) + n)}
    where = _places(short)
    best = max(ratio(short, long[lo:hi], where) for lo, hi in spans)
    if len(a) == len(b) and best < 100:
        spans = {(max(0, end - n), min(end, n)) for end in range(1, 2 * n)}
        best = max(best, max(ratio(long, short[lo:hi]) for lo, hi in spans))
    return best


def _token_parts(a, b):
    left, right = set(a.split()), set(b.split())
    return [" ".join(sorted(s)) for s in (left & right, left - right, right - left)]


def token_set_ratio(a, b):
    if not a.split() or not b.split():
        return 0.0
    shared, only_a, only_b = _token_parts(a, b)
    if shared and (not only_a or not only_b):
        return 100.0
    best = ratio(only_a, only_b) if not shared else 0.0
    with_a, with_b = f"{shared} {only_a}".strip(), f"{shared} {only_b}".strip()
    best = max(best, ratio(with_a, with_b))
    if shared:
        best = max(best, ratio(shared, with_a), ratio(shared, with_b))
    return best


def _sorted_tokens(a):
    return " ".join(sorted(a.split()))


def weighted_ratio(a, b):
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if spread < 1.5:
        tokens = max(ratio(_sorted_tokens(a), _sorted_tokens(b)), token_set_ratio(a, b))
        return max(best, 0.95 * tokens)
    scale = 0.9 if spread <= 8 else 0.6
    shared, only_a, only_b = _token_parts(a, b)
    whole = partial_ratio(a, b)
    others = {(_sorted_tokens(a), _sorted_tokens(b)), (only_a, only_b)}  # usually one pair, and often the texts themselves
    tokens = 100.0 if shared else max(whole if pair == (a, b) else partial_ratio(*pair) for pair in others)
    return max(best, scale * whole, scale * 0.95 * tokens)


def _profile(a):
    """(character counts, words); no words where blanks or words are repeated."""
    words = a.split()
    plain = a == " ".join(words) and len(set(words)) == len(words)
    return Counter(a), frozenset(words) if plain else None


def _at_most(a, profile, b, other):
    """No weighted ratio of a and b is above this: a common subsequence, also with a window of the longer text or with
    sorted words, has no more characters than the two share in any order."""
    (counts, words), (others, other_words) = profile, other
    if not a or not b or words is None or other_words is None or words & other_words:
        return 100.0
    common = sum(min(n, others[ch]) for ch, n in counts.items() if ch in others)
    short, long = sorted((len(a), len(b)))
    best = 200.0 * common / (short + long)
    if long / short < 1.5:
        return best
    return max(best, (0.9 if long / short <= 8 else 0.6) * 200.0 * common / (short + common))


def _best_weighted(key, alias_keys, places, candidates, profiles):
    """The first `candidates` pairs (-weighted ratio, place) in order. Aliases are scored by falling bound, until no bound
    reaches the ratio of the last pair. `profiles` keeps those of the aliases by place."""
    for i in places:
        if i not in profiles:
            profiles[i] = _profile(alias_keys[i])
    top, own = [], _profile(key)
    for bound, i in sorted((-_at_most(key, own, alias_keys[i], profiles[i]), i) for i in places):
        if len(top) == candidates and bound > top[-1][0] + 1e-9:
            break
        insort(top, (-weighted_ratio(key, alias_keys[i]), i))
        del top[candidates:]
    return top


def chosen(key, alias_keys, places, candidates, profiles=None):
    """(place, score): of the aliases at `places` that with the best of three scores among the `candidates` with the best
    weighted score; ties go to the better weighted score, then to gazetteer order."""
    top = _best_weighted(key, alias_keys, places, candidates, {} if profiles is None else profiles)
    best = min((-max(ratio(key, alias_keys[i]), -w, token_set_ratio(key, alias_keys[i])), w, i) for w, i in top)
    return best[2], -best[0]


def alias_scorer(alias_keys, candidates):
    """Pandas UDF: (key, places of the aliases to score) -> (alias_ord, score); null where there are none."""

    @F.pandas_udf(BEST)
    def score(keys: pd.Series, places: pd.Series) -> pd.DataFrame:
        profiles = {}
        found = [
            (None, None) if k is None or p is None or not len(p) else chosen(k, alias_keys, p, candidates, profiles)
            for k, p in zip(keys, places)
        ]
        return pd.DataFrame(
            {"alias_ord": pd.array([i for i, _ in found], dtype="Int32"), "score": [score for _, score in found]}
        )

    return score
