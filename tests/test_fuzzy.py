"""The alias index against scoring every alias, and accent folding against Python."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from obsflow.functions import fuzzy
from obsflow.functions.alias_index import AliasIndex
from obsflow.functions.names import fold_accents
from obsflow.operators import gazetteer as G
from obsflow.plans.staging import spread_out


def misspelt(rng, key):
    letters = list(key)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(letters) + 1)
        change = rng.randrange(4)
        if change == 0 and len(letters) > 3:
            letters.pop(min(at, len(letters) - 1))
        elif change == 1:
            letters.insert(at, rng.choice("aeiourk "))
        elif change == 2 and 0 < at < len(letters):
            letters[at - 1], letters[at] = letters[at], letters[at - 1]
        else:
            letters += rng.choice([" urban", " rural", " dk", " south taluk of the greater north", ""])
    return " ".join("".join(letters).split())


def accepted(key, aliases, places):
    """The alias chosen among those at the places, where its score is accepted."""
    if not places:
        return None
    place, score = fuzzy.chosen(key, aliases, places, 5)
    return (place, score) if score >= 80 else None


def check(spark, aliases, names, compared):
    index = AliasIndex(spark, aliases)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(8)
    found = {r.name: r.p for r in df.select("name", index.candidates(F.col("name")).alias("p")).collect()}
    for name in names[:compared]:
        assert accepted(name, aliases, found[name]) == accepted(name, aliases, range(len(aliases))), name
    return sorted(map(len, found.values()))[len(names) // 2]  # of most names; a few keep every alias


@pytest.mark.parametrize("seed", [3, 4])
def test_index_loses_nothing(spark, seed):
    """Wherever the best score is accepted, the index keeps what scoring every alias finds."""
    rng = random.Random(seed)
    aliases = [key for _, key, _ in G.alias_rows(spark)] + ["k", "north north", "a very long alias of many words that goes on and on", "dk"]
    aliases = list(dict.fromkeys(aliases))
    names = sorted({misspelt(rng, rng.choice(aliases)) for _ in range(400)} - {""})
    assert check(spark, aliases, names, len(names)) < 0.5 * len(aliases)


def test_ten_thousand_aliases(spark):
    rng = random.Random(7)
    syllables = [a + b for a in "bcdghklmnprstvy" for b in ("a", "i", "u", "an", "ar", "ur")]
    made = list(dict.fromkeys("".join(rng.choices(syllables, k=rng.randint(3, 6))) for _ in range(11_000)))[:9_990]
    assert check(spark, made, [misspelt(rng, k) for k in rng.sample(made, 40)], 3) < 1_500


def test_resolution_with_and_without_the_index(spark, monkeypatch):
    rng = random.Random(5)
    aliases = [key for _, key, _ in G.alias_rows(spark)]
    names = sorted({misspelt(rng, rng.choice(aliases)) for _ in range(60)})
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, id int")
    resolved = lambda: sorted(map(tuple, G.resolve_names(G._distinct(df, "name"), "name").collect()), key=repr)
    whole = resolved()
    monkeypatch.setattr(G, "SCORED_WHOLE", 0)
    assert resolved() == whole and any(r[3] == "fuzzy_match" for r in whole)


def test_fold_accents(spark):
    texts = ["Kodag\u016b", "Stra\u00dfe", "\ufb01ne", "\u00bd", "\u2167 x", "\ud55c\uae00 ok", "plain", "", "e\u0301", "\u0ce7", "\U0001d400b", "\u01c6"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in df.select("t", fold_accents(F.col("t")).alias("f")).collect():
        assert row.f == unicodedata.normalize("NFKD", row.t).encode("ascii", "ignore").decode()


@pytest.mark.parametrize("candidates", [1, 2, 5])
def test_bounds_leave_the_best_as_they_are(spark, candidates):
    """Aliases left out by their bound are none of the best."""
    rng = random.Random(11)
    aliases = list(dict.fromkeys([key for _, key, _ in G.alias_rows(spark)] + ["k", "north north", "dk"]))
    names = {misspelt(rng, rng.choice(aliases)) for _ in range(60)} | {f"mysuru {i}" for i in range(20)}
    for name in names | {"x  y", " ", "", "zzzz", "north  dk north"}:
        every = sorted((-fuzzy.weighted_ratio(name, a), i) for i, a in enumerate(aliases))[:candidates]
        assert fuzzy._best_weighted(name, aliases, range(len(aliases)), candidates, {}) == every, name


def test_few_names_are_spread_over_tasks(spark):
    """Also where they are partitioned by the name already, as names that were counted are."""
    names = spark.range(1000).selectExpr("concat('n', id) AS name").groupBy("name").count()
    tasks = spread_out(names, "name").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))
