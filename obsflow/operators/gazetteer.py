"""Resolving raw place spellings to canonical names: exact alias first, fuzzy only for distinct leftovers."""

from pyspark.sql import functions as F

from ..functions.alias_index import AliasIndex
from ..functions.fuzzy import alias_scorer
from ..functions.names import clean_name, fold_accents, letters_in, needs_folding, normalise_ascii
from ..functions.numbers import round2
from ..plans.skew import attach
from ..plans.staging import spread_out, stage

# Canonical district name: other spellings (fixed values).
GAZETTEER = {
    "Bagalkote": ["Bagalkot"],
    "Ballari": ["Bellary"],
    "Belagavi": ["Belgaum"],
    "Bengaluru Rural": ["Bangalore Rural", "Bengaluru Rural District", "Bangalore Rural District"],
    "Bengaluru Urban": [
        "Bangalore Urban", "BBMP", "Bengaluru Urban District", "Bengaluru (Urban)", "Bangalore (Urban)",
    ],
    "Bengaluru South": ["Bangalore South", "Bengaluru South District"],
    "Bidar": [],
    "Chamarajanagara": ["Chamarajanagar", "Chamrajnagar"],
    "Chikkaballapur": ["Chikballapur", "Chikballapura", "Chikkaballapura"],
    "Chikkamangaluru": ["Chikmagalur", "Chikkamagaluru", "Chikmangaluru"],
    "Chitradurga": [],
    "Dakshina Kannada": [
        "Dakshin Kannada", "Dakshina Kannda", "Dakshina Kanmda", "Dakshina Kannnada", "D.K.", "DK",
        "South Kanara", "South Canara",
    ],
    "Davanagere": ["Davangere"],
    "Dharwad": ["Dharwar"],
    "Gadag": [],
    "Hassan": [],
    "Haveri": [],
    "Kalaburagi": ["Kalburgi", "Gulbarga"],
    "Kodagu": ["Coorg"],
    "Kolar": [],
    "Koppal": [],
    "Mandya": [],
    "Mysuru": ["Mysore"],
    "Raichur": ["Raichuru"],
    "Ramanagara": ["Ramnagar"],
    "Shivamogga": ["Shimoga"],
    "Tumakuru": ["Tumkur"],
    "Udupi": [],
    "Uttara Kannada": [
        "Uttarkannada", "Uttar Kannada", "Uttara Kannda", "Uttara Kannnada", "North Kanara", "North Canara",
    ],
    "Vijayanagara": ["Vijayanagar"],
    "Vijayapura": ["Bijapur"],
    "Yadgiri": ["Yadgir", "Yadagiri"],
}

MIN_SCORE = 80
MIN_SCORE_SHORT = 90
SHORT_LETTERS = 6
FUZZY_LETTERS = 5
CANDIDATES = 5
MOST_SPELLINGS = 10_000
SCORED_WHOLE = 500


def spellings(gazetteer=GAZETTEER):
    """Every spelling in order: each canonical name followed by its aliases."""
    listed = [(name, canonical) for canonical, aliases in gazetteer.items() for name in (canonical, *aliases)]
    if len(listed) > MOST_SPELLINGS:
        raise ValueError(f"a gazetteer is sent to every task: at most {MOST_SPELLINGS} spellings")
    return listed


def _values(spark, rows, columns):
    """A fixed handful of rows as a literal relation."""
    quote = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    listed = ", ".join("(" + ", ".join(quote(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {listed} AS t({columns})")


_alias_rows = {}


def alias_rows(spark, gazetteer=GAZETTEER):
    """(alias_ord, alias_key, canonical) per matching key, ordered by first spelling, owned by the last one.

    The gazetteer is a fixed dictionary supplied by the caller, never data, so its keys are worked out once.
    """
    rows = [(i, name, canonical) for i, (name, canonical) in enumerate(spellings(gazetteer))]
    if tuple(rows) not in _alias_rows:
        keyed = (
            _values(spark, rows, "ord, spelling, canonical")
            .withColumn("alias_key", normalise_ascii(F.col("spelling")))
            .groupBy("alias_key")
            .agg(F.min("ord").alias("alias_ord"), F.max_by("canonical", "ord").alias("canonical"))
            .orderBy("alias_ord")
        )
        _alias_rows[tuple(rows)] = [(r.alias_ord, r.alias_key, r.canonical) for r in keyed.collect()]
    return _alias_rows[tuple(rows)]


def alias_table(spark, gazetteer=GAZETTEER):
    return _values(spark, alias_rows(spark, gazetteer), "alias_ord, alias_key, canonical")


def with_keys(names, name):
    """Adds clean_name and name_key."""
    cleaned = names.withColumn("clean_name", clean_name(F.col(name)))
    accented = F.when(needs_folding(F.col("clean_name")), F.col("clean_name"))
    folded = cleaned.withColumn("_folded", fold_accents(accented))
    return folded.withColumn("name_key", normalise_ascii(F.coalesce("_folded", "clean_name"))).drop("_folded")


def _distinct(df, name, only=None):
    rows = df if only is None else df.where(only)
    return rows.groupBy(name).agg(F.count("*").alias("n_rows"))


def normalise_names(df, name, spread):
    """Adds clean_name and name_key, worked out once per distinct name."""
    return attach(df, stage(with_keys(_distinct(df, name), name)), [name], spread)


_indexes = {}


def alias_index(spark, gazetteer=GAZETTEER):
    keys = tuple(key for _, key, _ in alias_rows(spark, gazetteer))
    if keys not in _indexes:
        _indexes[keys] = AliasIndex(spark, keys)
    return _indexes[keys]


def best_alias(keys, gazetteer=GAZETTEER, candidates=CANDIDATES, min_score=MIN_SCORE):
    """For each key: the alias with the best of three scores among the `candidates` with the best weighted score.

    The gazetteer is bounded and fixed, so no pairs are shuffled. Of a long one only the aliases are scored that can reach
    `min_score` by the bounds of the index; a short one is scored whole, as the bounds cost more to plan than they save.
    Adds alias_key and score, null where no alias can reach it.
    """
    aliases = [key for _, key, _ in alias_rows(keys.sparkSession, gazetteer)]
    if len(aliases) > SCORED_WHOLE:
        places = alias_index(keys.sparkSession, gazetteer).candidates(F.col("fuzzy_key"), min(min_score, MIN_SCORE_SHORT))
        keys = stage(keys.withColumn("_places", places))
    else:
        keys = keys.withColumn("_places", F.sequence(F.lit(0), F.lit(len(aliases) - 1)))
    return (
        keys.withColumn("_best", alias_scorer(aliases, candidates)("fuzzy_key", "_places"))
        .withColumn("alias_key", F.element_at(F.split(F.lit("\n".join(aliases)), "\n"), F.col("_best.alias_ord") + 1))
        .withColumn("score", F.col("_best.score"))
        .drop("_best", "_places")
    )


def resolve_names(names, name, gazetteer=GAZETTEER, min_score=MIN_SCORE):
    """canonical, resolution_confidence and resolution_method of distinct names: exact alias first, then fuzzy."""
    aliases = alias_table(names.sparkSession, gazetteer).select("alias_key", "canonical")
    # The alias table is a fixed dictionary supplied by the caller, never data.
    exact = F.broadcast(aliases.select(F.col("alias_key").alias("name_key"), F.col("canonical").alias("exact")))
    fuzzy = F.broadcast(aliases)
    letters = letters_in(F.col("name_key"))
    found = with_keys(spread_out(names, name), name).join(exact, "name_key", "left").withColumn("letters", letters)
    unmatched = F.col("exact").isNull() & (F.col("letters") >= FUZZY_LETTERS)
    found = found.withColumn("fuzzy_key", F.when(unmatched, F.col("name_key")))
    scored = best_alias(found, gazetteer, min_score=min_score)
    needed = F.when(F.col("letters") <= SHORT_LETTERS, MIN_SCORE_SHORT).otherwise(min_score)
    method = (
        F.when(F.col("clean_name") == "", "empty_input")
        .when(F.col("exact").isNotNull(), "exact_alias")
        .when(F.col("letters") < FUZZY_LETTERS, "unresolved_short_input")
        .when(F.col("score") >= needed, "fuzzy_match")
        .otherwise("unresolved")
    )
    is_method = lambda m: F.col("resolution_method") == m
    return (
        scored.join(fuzzy, "alias_key", "left")
        .withColumn("resolution_method", method)
        .withColumn(
            "canonical",
            F.when(is_method("exact_alias"), F.col("exact")).when(is_method("fuzzy_match"), F.col("canonical")),
        )
        .withColumn(
            "resolution_confidence",
            F.when(is_method("exact_alias"), 1.0)
            .when(is_method("fuzzy_match"), round2(F.col("score") / 100))
            .otherwise(0.0),
        )
        .select(name, "canonical", "resolution_confidence", "resolution_method", "n_rows")
    )


def resolve_districts(df, name, spread, only=None, gazetteer=GAZETTEER, min_score=MIN_SCORE):
    """Adds canonical, resolution_confidence and resolution_method for the raw names in column `name`.

    Names are counted first, so each distinct one is cleaned, looked up and scored once however many rows carry it.
    The result is staged and joined back: broadcast while short, else with hot names handled apart. `only` restricts
    which rows are resolved; `spread` names columns that tell rows apart.
    """
    names = _distinct(df, name, only)
    return attach(df, stage(resolve_names(names, name, gazetteer, min_score)), [name], spread, needed=only)
