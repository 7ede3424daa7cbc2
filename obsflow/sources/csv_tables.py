"""CSV files to raw tables, any mix of widths, with stable row numbers.

Files are read as lines, so a large file is split over many tasks, and a line may be part of a record: a quoted cell can
hold line breaks, commas and doubled quotes. Whether a line begins inside quotes depends on all lines above it, but what
a line does to that state does not: entered from outside and entered from inside, it leaves one or the other. These
summaries compose, so each split is reduced to what it does from either state, the splits of a file give each other their
entry states by a running composition over a few rows, and then all splits are cut into records at once. A record is
split into an array of cells by one expression; no number of columns is needed beforehand, and commas inside quotes are
characters like others.

A quote opens a quoted cell only at the cell's beginning; elsewhere it is a character. What follows a closing quote up to
the next comma belongs to the cell. Lines of nothing but spaces and tabs between records are skipped. Lines end with LF or
CR LF. An unclosed quote makes the rest of its file one cell. Files without any record give no table, nor do files with a
header only.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import let
from ..plans.staging import stage
from .files import any_case, decoded

# Cell texts read as missing (fixed values).
MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)



# Possessive throughout: no backtracking, and no recursion however many cells or quotes a line has.
_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
_CELL = f'(?:{_QUOTED}"[^,]*+|(?!")[^,]*+)'
_OPENS = rf"(?:{_CELL},)*+{_QUOTED}\z"
_REST = r'[^"]*+(?:""[^"]*+)*+'

# What a line does to the state: keeps it, leaves it outside, leaves it inside, or turns it over.
KEEPS, OUTSIDE, INSIDE, TURNS = range(4)
BLANK = r"\A[ \t\r]*\z"


def line_effect(line):
    """KEEPS, OUTSIDE, INSIDE or TURNS."""
    from_outside = line.rlike(rf"\A{_OPENS}")
    from_inside = line.rlike(rf"\A{_REST}\z") | line.rlike(rf'\A{_REST}"[^,]*+,{_OPENS}')
    effect = (
        F.when(from_outside & from_inside, INSIDE).when(from_outside, TURNS).when(from_inside, KEEPS).otherwise(OUTSIDE)
    )
    return F.when(F.contains(line, F.lit('"')), effect).otherwise(KEEPS)


def _leaves(effect, inside):
    """State after something of this effect, entered in the given state."""
    return F.when(effect == KEEPS, inside).when(effect == TURNS, ~inside).otherwise(effect == INSIDE)


def _effect(from_outside, from_inside):
    """The effect that leads from outside and from inside to these states."""
    return (
        F.when(from_outside & from_inside, INSIDE).when(from_outside, TURNS).when(from_inside, KEEPS).otherwise(OUTSIDE)
    )


def _entered(df, keys, order, out):
    """Adds the composition of all effects above a row within its keys, as an effect."""
    window = W.partitionBy(*keys).orderBy(order)
    upto = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    above = window.rowsBetween(W.unboundedPreceding, -1)
    fixes = F.col("effect").isin(OUTSIDE, INSIDE)
    turned = F.sum((F.col("effect") == TURNS).cast("long")).over(upto)
    df = df.withColumn("_turned", turned)
    df = df.withColumn("_fixed", F.when(fixes, F.struct((F.col("effect") == INSIDE).alias("inside"), "_turned")))
    df = df.withColumn("_last", F.last("_fixed", ignorenulls=True).over(above))
    df = df.withColumn("_before", F.coalesce(F.lag("_turned").over(window), F.lit(0)))
    odd = (F.col("_before") - F.coalesce("_last._turned", F.lit(0))) % 2 == 1
    fixed = F.when(F.col("_last.inside") != odd, INSIDE).otherwise(OUTSIDE)
    return df.withColumn(
        out, F.when(F.col("_last").isNotNull(), fixed).when(odd, TURNS).otherwise(KEEPS)
    ).drop("_turned", "_fixed", "_last", "_before")


def read_lines(spark, paths):
    """(path, split, position, line, effect, blank): every line of every CSV file, staged. One scan of the text; a split
    is read by one task in order, so positions within it ascend."""
    lines = (
        spark.read.option("lineSep", "\n")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", any_case(".csv"))
        .text(paths)
        .select(
            decoded(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("position"),
            F.col("value").alias("line"),
        )
    )
    return stage(lines.withColumns({"effect": line_effect(F.col("line")), "blank": F.col("line").rlike(BLANK)}))


def split_states(lines):
    """(path, split, inside, record, n): of every split the state it is entered in, the number of records that begin
    above it, and of those that begin in it. Only the lines' effects are read, not their text."""
    inside = F.lit(True)
    entered = _entered(lines.select("path", "split", "position", "effect", "blank"), ["path", "split"], "position", "entered")
    last = lambda s: F.max_by(_leaves(F.col("effect"), _leaves(F.col("entered"), s)), "position")
    count = lambda s: F.sum((~_leaves(F.col("entered"), s) & ~F.col("blank")).cast("long"))
    splits = entered.groupBy("path", "split").agg(
        _effect(last(~inside), last(inside)).alias("effect"), count(~inside).alias("outside_n"), count(inside).alias("inside_n")
    )
    stated = _entered(splits, ["path"], "split", "entered")
    stated = stated.withColumn("inside", _leaves(F.col("entered"), ~inside))
    stated = stated.withColumn("n", F.when(F.col("inside"), F.col("inside_n")).otherwise(F.col("outside_n")))
    above = W.partitionBy("path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    return stated.select("path", "split", "inside", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("record"), "n")


def records(lines, splits):
    """(path, record, text): records of every file, numbered from 0. Lines of one record meet; other lines do not move
    again once they are in the order of their split."""
    within = W.partitionBy("path", "split").orderBy("position")
    known = _entered(lines, ["path", "split"], "position", "entered").join(
        splits.select("path", "split", "record", F.col("inside").alias("split_inside")), ["path", "split"]
    )
    known = known.withColumn("inside", _leaves(F.col("entered"), F.col("split_inside")))
    known = known.withColumn("stays", _leaves(F.col("effect"), F.col("inside")))
    begins = ~F.col("inside") & ~F.col("blank")
    known = known.where(F.col("inside") | begins)
    number = F.col("record") + F.sum(begins.cast("long")).over(within.rowsBetween(W.unboundedPreceding, W.currentRow)) - 1
    known = known.select("path", "split", "position", number.alias("record"), "line", "inside", "stays")
    alone = known.where(~F.col("inside") & ~F.col("stays")).select("path", "record", F.col("line").alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("split", "position", "line")))
    joined = (
        known.where("inside or stays")
        .groupBy("path", "record")
        .agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("text"))
    )
    return alone.unionByName(joined)


def cells_of(record):
    """The cells of a record, null where the text counts as missing."""
    line = F.regexp_replace(record, r"\r\z", "")
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f',({_QUOTED}"?+[^,]*+|[^,]*+)'), F.lit(1))
    body = lambda c: F.regexp_extract(c, r'\A"([^"]*+(?:""[^"]*+)*+)', 1)
    tail = lambda c: F.regexp_extract(c, rf'\A{_QUOTED}"?+([\s\S]*+)\z', 1)
    plain = lambda c: F.concat(F.replace(body(c), F.lit('""'), F.lit('"')), tail(c))
    cell = lambda c: F.when(c.startswith('"'), plain(c)).otherwise(c)
    return F.transform(raw, lambda c: let(cell(c), lambda x: F.when(~x.isin(*MISSING), x)))


def read_csv_tables(spark, paths):
    """(raw_tables, raw_rows): one table per file; row -1 is the header row. source_document holds the full path. Rows are
    as wide as their record."""
    lines = read_lines(spark, paths)
    splits = stage(split_states(lines))
    table_id = F.concat("path", F.lit("#0")).alias("table_id")
    rows = records(lines, splits).select(table_id, (F.col("record") - 1).alias("row_idx"), cells_of(F.col("text")).alias("cells"))
    tables = (
        splits.groupBy("path")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .select(
            table_id,
            F.col("path").alias("source_document"),
            F.lit("csv").alias("source_page"),
            F.lit("csv").alias("extraction_method"),
        )
    )
    return tables, rows
