"""Similarity scores in SQL, for the queries' oracle: the published definitions over a table pairs (a, b) of keys."""


def _longest_common(a, b):
    """Length of the longest common subsequence, by the same bit recurrence for each character of b."""
    full = f"((1::HUGEINT << len({a})) - 1)"
    mask = (
        f"coalesce(list_sum([CASE WHEN {a}[i] = ch THEN 1::HUGEINT << (i - 1)::INTEGER ELSE 0 END "
        f"for i in range(1, len({a}) + 1)]), 0)::HUGEINT"
    )
    return (
        f"(len({a}) - bit_count(list_reduce(list_prepend({full}, [{mask} for ch in string_split({b}, '')]), "
        f"lambda bits, hit: (((bits + (bits & hit)) | (bits - (bits & hit))) & {full})::HUGEINT)))"
    )


def ratio(a, b):
    both = f"(len({a}) + len({b}))"
    return (
        f"CASE WHEN {both} = 0 THEN 100.0::DOUBLE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE "
        f"ELSE 200.0::DOUBLE * {_longest_common(a, b)} / {both} END"
    )


def _windows(a, b):
    """Windows of b as long as a, cut ones at both ends included."""
    return (
        f"list_distinct([{b}[greatest(0, e - len({a})) + 1 : least(e, len({b}))] for e in range(1, len({b}) + len({a}))])"
    )


def _tokens(x):
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def _joined(words):
    return f"array_to_string(list_sort({words}), ' ')"


def _best_windows(name, source, a, b):
    """CTE: the best window ratio of each pair (a, b) of the source, either way round where lengths agree."""
    return f"""
{name}_ways AS (
  SELECT DISTINCT {a} AS x, {b} AS y,
    CASE WHEN len({a}) <= len({b}) THEN {a} ELSE {b} END AS s, CASE WHEN len({a}) <= len({b}) THEN {b} ELSE {a} END AS l
  FROM {source} WHERE wide),
{name}_cuts AS (
  SELECT x, y, s, unnest({_windows('s', 'l')}) AS cut FROM {name}_ways
  UNION ALL
  SELECT x, y, l, unnest({_windows('l', 's')}) AS cut FROM {name}_ways WHERE len(s) = len(l)),
{name}_scores AS (
  SELECT s, cut, {ratio('s', 'cut')} AS score FROM (SELECT DISTINCT s, cut FROM {name}_cuts)),
{name} AS (
  SELECT x, y, CASE WHEN len(x) = 0 AND len(y) = 0 THEN 100.0 WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE best END AS best
  FROM (SELECT x, y FROM {name}_ways) LEFT JOIN (
    SELECT x, y, max(score) AS best FROM {name}_cuts JOIN {name}_scores USING (s, cut) GROUP BY x, y) USING (x, y))"""


# From pairs (a, b) to scored (a, b, plain, token_set, weighted).
PAIRS = f"""
parted AS (
  SELECT a, b, greatest(len(a), len(b)) / nullif(least(len(a), len(b)), 0) AS spread,
    coalesce(greatest(len(a), len(b)) >= 1.5 * least(len(a), len(b)), FALSE) AND len(a) > 0 AND len(b) > 0 AS wide,
    {_joined(_tokens('a'))} AS sorted_a, {_joined(_tokens('b'))} AS sorted_b,
    {_joined(f"list_intersect(list_distinct({_tokens('a')}), list_distinct({_tokens('b')}))")} AS shared,
    {_joined(f"list_filter(list_distinct({_tokens('a')}), lambda w: NOT list_contains({_tokens('b')}, w))")} AS only_a,
    {_joined(f"list_filter(list_distinct({_tokens('b')}), lambda w: NOT list_contains({_tokens('a')}, w))")} AS only_b
  FROM pairs),
with_shared AS (
  SELECT *, trim(shared || ' ' || only_a) AS with_a, trim(shared || ' ' || only_b) AS with_b FROM parted),
ratios AS (
  SELECT *, {ratio('a', 'b')} AS plain, {ratio('sorted_a', 'sorted_b')} AS sorted,
    CASE WHEN sorted_a = '' OR sorted_b = '' THEN 0.0
         WHEN shared <> '' AND (only_a = '' OR only_b = '') THEN 100.0
         WHEN shared <> '' THEN greatest({ratio('with_a', 'with_b')}, {ratio('shared', 'with_a')}, {ratio('shared', 'with_b')})
         ELSE greatest({ratio('only_a', 'only_b')}, {ratio('with_a', 'with_b')}) END AS token_set
  FROM with_shared),
{_best_windows('window_plain', 'with_shared', 'a', 'b').strip()},
{_best_windows('window_sorted', 'with_shared', 'sorted_a', 'sorted_b').strip()},
{_best_windows('window_only', 'with_shared', 'only_a', 'only_b').strip()},
scored AS (
  SELECT r.a, r.b, plain, token_set,
    CASE WHEN r.a = '' OR r.b = '' THEN 0.0
         WHEN NOT wide THEN greatest(plain, 0.95::DOUBLE * greatest(sorted, token_set))
         ELSE greatest(plain, (CASE WHEN spread <= 8 THEN 0.9 ELSE 0.6 END)::DOUBLE * p.best,
           (CASE WHEN spread <= 8 THEN 0.9 ELSE 0.6 END)::DOUBLE * 0.95::DOUBLE
             * CASE WHEN shared <> '' THEN 100.0 ELSE greatest(s.best, o.best) END) END AS weighted
  FROM ratios r LEFT JOIN window_plain p ON p.x = r.a AND p.y = r.b
    LEFT JOIN window_sorted s ON s.x = r.sorted_a AND s.y = r.sorted_b
    LEFT JOIN window_only o ON o.x = r.only_a AND o.y = r.only_b)"""
