"""Row rules and the duplicate mark; reasons are joined in a fixed order."""

from pyspark.sql import functions as F

from ..functions.numbers import format_g, is_finite
from ..functions.text import strip
from ..plans.skew import attach
from ..plans.staging import stage

# Allowed value range per indicator, for percent units, and for everything else (fixed values).
KNOWN_RANGES = {
    "pct_coverage": (0, 300),
    "pct_of_normal_coverage": (0, 300),
    "coverage_percent": (0, 300),
    "coverage_last_year_percent": (0, 300),
    "percent_of_normal_coverage": (0, 300),
}
PERCENT_RANGE = (0, 300)
GENERIC_RANGE = (0, 1_000_000)

LOW_CONFIDENCE = 0.35
WEAK_METHODS = ("unresolved", "empty_input", "unresolved_short_input")
DUPLICATE_KEYS = ["table_id", "entity_name", "year", "indicator"]


def range_table(spark, ranges=None):
    """The fixed ranges as literals: a table made from Python rows has no size that the planner knows, so observations
    would be shuffled by indicator, of which there are a handful, to meet it."""
    rows = [
        F.struct(F.lit(name).cast("string").alias("range_indicator"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"))
        for name, (lo, hi) in (ranges or KNOWN_RANGES).items()
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows)))


def _with_ranges(obs, ranges):
    unit = F.lower(strip(F.col("unit")))
    percent = F.coalesce(F.contains(unit, F.lit("%")) | F.contains(unit, F.lit("percent")), F.lit(False))

    def bound(name, i):
        other = F.when(percent, float(PERCENT_RANGE[i])).otherwise(float(GENERIC_RANGE[i]))
        return F.coalesce(F.col(name), other).alias(name)

    key = F.lower(strip(F.col("indicator")))
    # The caller may bring any table of ranges: it is staged, and Spark broadcasts it only if it is small.
    joined = obs.withColumn("_key", key).join(ranges, F.col("_key") == F.col("range_indicator"), "left")
    return joined.select(*obs.columns, bound("lo", 0), bound("hi", 1))


def row_reasons():
    """The six row rules as one array of reasons (null where a rule holds)."""
    method = F.lower(F.col("entity_resolution_method"))
    confidence = F.coalesce(F.col("confidence"), F.lit(0.0))
    value = F.col("value").cast("double")
    district = F.lower(strip(F.col("entity_type"))) == "district"
    finite = is_finite(value)
    return F.array_compact(
        F.array(
            F.when(strip(F.col("entity_type")) == "", "missing_entity_type"),
            F.when(strip(F.col("domain")) == "", "missing_domain"),
            F.when(district & F.col("entity_name").startswith("UNRESOLVED:"), "unresolved_entity"),
            F.when((confidence < LOW_CONFIDENCE) & method.isin(*WEAK_METHODS), "very_low_confidence"),
            F.when(~finite, "invalid_numeric_value"),
            F.when(
                finite & ~value.between(F.col("lo"), F.col("hi")),
                F.concat(F.lit("out_of_range("), format_g(value), F.lit(")")),
            ),
        )
    )


def duplicate_keys(obs, keys=None):
    """Keys held by more than one row, with their row count: counted before the shuffle, so hot keys stay small."""
    keys = keys or DUPLICATE_KEYS
    return obs.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def validate_observations(obs, ranges=None, keys=None, spread=("row_idx", "col_idx")):
    """Adds validation_flag (any row rule broken) and validation_reason; duplicates are marked but not flagged.

    Duplicates are sought within one table. Their keys are written to a staged table, so a short list is broadcast and
    a long one joined with hot keys handled apart.
    """
    keys = keys or DUPLICATE_KEYS
    ranges = range_table(obs.sparkSession) if ranges is None else stage(ranges)
    duplicates = stage(duplicate_keys(obs, keys)).withColumn("_duplicate", F.lit(True))
    marked = attach(_with_ranges(obs, ranges), duplicates, keys, list(spread))
    reasons = F.array_join(
        F.concat("_reasons", F.when(F.col("_duplicate"), F.array(F.lit("duplicate_entry"))).otherwise(F.array())), ";"
    )
    return (
        marked.withColumn("_reasons", row_reasons())
        .withColumn("validation_flag", F.size("_reasons") > 0)
        .withColumn("validation_reason", reasons)
        .drop("lo", "hi", "_duplicate", "_reasons")
    )
