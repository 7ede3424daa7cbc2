"""Where does a table's data start, and what are its column headers?"""

from pyspark.sql import functions as F

from ..functions.numbers import ascii_digits, is_numeric
from ..functions.text import WS, has_text, is_blank, let, strip
from ..plans.skew import attach
from ..plans.staging import stage

SAMPLE_ROWS = 5
SHALLOW_ROWS = 64
_INTEGER = rf"^[{WS}]*0*([0-9]+)[{WS}]*$"
_FRAGMENT = r"^[|\]})]*\p{Nd}+(\.\p{Nd}+)?[|\]})]*$"


def row_kind(cells):
    """blank, banner, index, header or data, tested in that order."""

    def kind(present):
        same = F.size(F.array_distinct(F.transform(present, strip))) == 1
        first_two = strip(F.get(present, F.lit(0))) == strip(F.get(present, F.lit(1)))
        numbered = F.filter(cells, lambda c, i: F.regexp_extract(ascii_digits(c), _INTEGER, 1) == (i + 1).cast("string"))
        index = let(
            F.size(F.filter(present, has_text)), lambda filled: (filled >= 2) & (F.size(numbered) >= 0.6 * filled)
        )
        return (
            F.when(F.size(present) == 0, "blank")
            .when((F.size(present) >= 2) & first_two & same, "banner")
            .when(index, "index")
            .when(F.size(F.filter(present, is_numeric)) < 0.5 * F.size(present), "header")
            .otherwise("data")
        )

    return let(F.filter(cells, lambda c: c.isNotNull()), kind)


def classify_rows(raw_rows):
    return raw_rows.withColumn("kind", row_kind(F.col("cells")))


def data_starts(raw_rows):
    """(table_id, data_start, n_cols, n_rows): first data row, else the row count. Combined before the shuffle."""
    return (
        classify_rows(raw_rows.where("row_idx >= 0"))
        .groupBy("table_id")
        .agg(
            F.min(F.when(F.col("kind") == "data", F.col("row_idx"))).alias("first_data"),
            F.max(F.size("cells")).alias("n_cols"),
            F.count("*").alias("n_rows"),
        )
        .select("table_id", F.coalesce("first_data", "n_rows").alias("data_start"), "n_cols", "n_rows")
    )


def _top_rows(raw_rows, starts, extra, shallow=SHALLOW_ROWS):
    """Rows up to `extra` rows past their table's data start.

    Tables usually start within a few rows: only the first `shallow` rows of all tables are joined. Tables that start
    deeper are few; they are written out, so that a few of them are broadcast by size and choose their own rows before
    any row of another table is shuffled.
    """
    deepest = starts.agg(F.coalesce(F.max("data_start"), F.lit(0)) + extra).first()[0]
    near = raw_rows.where((F.col("row_idx") >= 0) & (F.col("row_idx") <= min(deepest, shallow)))
    joined = attach(near, starts, ["table_id"], ["row_idx"])
    if deepest > shallow:
        deep = stage(starts.where(F.col("data_start") + extra > shallow).drop("n_rows"))
        below = raw_rows.where(F.col("row_idx") > shallow).join(deep, "table_id")
        joined = joined.unionByName(below.select(*joined.columns))
    return joined.where(F.col("row_idx") <= F.col("data_start") + extra)


def header_parts(raw_rows, starts):
    """(table_id, col_idx, first_row, text): distinct header texts per column, with where each first appears."""
    above = _top_rows(raw_rows, starts, -1)
    text = F.replace(strip(F.col("cell")), F.lit("\n"), F.lit(" "))
    return (
        # Only rows above the data are tested, not every row below the join.
        above.withColumn("cells", F.when(F.col("row_idx") < F.col("data_start"), F.col("cells")))
        .where(row_kind(F.col("cells")) == "header")
        .select("table_id", "row_idx", F.posexplode("cells").alias("col_idx", "cell"))
        .where(~is_blank(F.col("cell")))
        .select("table_id", "col_idx", "row_idx", text.alias("text"))
        .where(~is_numeric(F.col("text")) & ~F.col("text").rlike(_FRAGMENT))
        .groupBy("table_id", "col_idx", "text")
        .agg(F.min("row_idx").alias("first_row"))
    )


def combined_headers(parts):
    """(table_id, col_idx, header): the distinct texts of a column in order, joined by ' - '."""
    ordered = F.array_sort(F.collect_list(F.struct("first_row", "text")))
    return parts.groupBy("table_id", "col_idx").agg(
        F.array_join(F.transform(ordered, lambda p: p["text"]), " - ").alias("header")
    )


def detect_headers(raw_rows, starts=None):
    """(table_id, headers, data_start): one header per column (null where none was found)."""
    starts = stage(data_starts(raw_rows)) if starts is None else starts
    columns = combined_headers(header_parts(raw_rows, starts)).groupBy("table_id").agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", "header"))).alias("by_column")
    )
    # A table whose rows are all zero cells wide has no columns to name.
    positions = F.when(F.col("n_cols") > 0, F.sequence(F.lit(0), F.col("n_cols") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return starts.join(columns, "table_id", "left").select(
        "table_id",
        F.transform(positions, lambda i: F.try_element_at("by_column", i)).alias("headers"),
        "data_start",
    )


def pad_rows(raw_rows):
    """Rectangular grid: short rows are padded with nulls up to the widest row of their table."""
    widths = raw_rows.groupBy("table_id").agg(F.max(F.size("cells")).alias("n_cols"), F.count("*").alias("n_rows"))
    missing = F.col("n_cols") - F.size("cells")
    padded = F.concat("cells", F.array_repeat(F.lit(None).cast("string"), missing))
    return attach(raw_rows, stage(widths), ["table_id"], ["row_idx"]).withColumn("cells", padded).drop("n_cols")


def known_headers(raw_rows):
    """Headers of tables that carry them as row -1: blanks are named by position, repeats get a numbered suffix."""
    named = F.transform("cells", lambda c, i: F.coalesce(c, F.concat(F.lit("Unnamed: "), i.cast("string"))))
    earlier = lambda h, i: F.size(F.filter(F.slice("_names", 1, i), lambda x: x == h))
    numbered = F.transform(
        "_names",
        lambda h, i: F.when((i > 0) & (earlier(h, i) > 0), F.concat_ws(".", h, earlier(h, i))).otherwise(h),
    )
    return (
        raw_rows.where("row_idx = -1")
        .withColumn("_names", named)
        .select("table_id", numbered.alias("headers"), F.lit(0).cast("long").alias("data_start"))
    )


def table_samples(raw_rows, starts, n=SAMPLE_ROWS):
    """(table_id, sample_rows): the first n rows from the data start on, in order; at most n rows meet per table."""
    rows = _top_rows(raw_rows, starts, n - 1).where(F.col("row_idx") >= F.col("data_start"))
    ordered = F.array_sort(F.collect_list(F.struct("row_idx", "cells")))
    return rows.groupBy("table_id").agg(F.transform(ordered, lambda r: r["cells"]).alias("sample_rows"))
