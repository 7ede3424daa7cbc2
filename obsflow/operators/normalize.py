"""From raw grids plus a column mapping to long observations, for all tables at once.

Rows are keyed by table, and by a bounded block of row numbers where tables are long. One exchange on that key serves
the join with the per-table mapping, the forward fill and the sticky period, and no table, however long, is one task.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import parse_date
from ..functions.numbers import parse_number, round2, year_or
from ..functions.text import is_blank, strip
from ..plans.staging import stage
from .gazetteer import GAZETTEER, resolve_districts

BLOCK_ROWS = 1_000_000
ENTITY_TYPE_METHOD = "groq_entity_type"  # fixed value stored for every entity that is not a district


class Grid:
    """Raw rows and, for tables longer than one block, the list of their later blocks.

    Rows are keyed by (table_id, block). The list has at most one row per `block_rows` raw rows; it follows from the
    tables' lengths (table_id, n_rows) where they are known, else it is read with the row number pushed down to the scan
    and staged. When it is empty, which is the usual case, no carrying is planned.
    """

    def __init__(self, raw_rows, block_rows=BLOCK_ROWS, lengths=None):
        self.block_rows = block_rows
        block = F.floor(F.col("row_idx") / block_rows).cast("long").alias("block")
        if lengths is None:
            later = raw_rows.where(F.col("row_idx") >= block_rows).select("table_id", block).distinct()
            self.later = stage(later)
        else:
            last = F.floor((F.col("n_rows") - 1) / block_rows).cast("long")
            blocks = F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("block")
            self.later = lengths.where(F.col("n_rows") > block_rows).select("table_id", blocks)
        self.split = not self.later.isEmpty()
        self.keys = ["table_id", "block"] if self.split else ["table_id"]
        self.rows = raw_rows.where("row_idx >= 0").select("table_id", *([block] if self.split else []), "row_idx", "cells")
        self.so_far = W.partitionBy(*self.keys).orderBy("row_idx").rowsBetween(W.unboundedPreceding, W.currentRow)

    def with_tables(self, tables):
        """Raw rows with the columns of their table (one row per table), co-partitioned for the windows to come."""
        if self.split:
            long_tables = self.later.select("table_id", F.lit(True).alias("long_table")).distinct()
            tables = tables.join(long_tables, "table_id", "left")
            first = tables.withColumn("block", F.lit(0).cast("long"))
            tables = first.unionByName(tables.where("long_table").join(self.later, "table_id"))
        return self.rows.join(tables.hint("shuffle_hash"), self.keys)

    def carry(self, rows, carried):
        """Rows with what enters their block from above; without later blocks nothing does."""
        if not self.split:
            return rows.withColumns({c: F.lit(None).cast("string") for c in ("carry_entity", "carry_period")})
        return rows.join(carried.hint("shuffle_hash"), self.keys, "left")

    def carried_entities(self, rows):
        """(table_id, block, carry_entity, carry_period): the last entity above each block of the long tables."""
        above = W.partitionBy("table_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
        last_own = F.max(F.when(F.col("own").isNotNull(), F.struct("row_idx", "own")))["own"]
        return (
            rows.where("long_table")
            .groupBy("table_id", "block")
            .agg(last_own.alias("last_own"))
            .select(
                "table_id",
                "block",
                F.last("last_own", ignorenulls=True).over(above).alias("carry_entity"),
                F.lit(None).cast("string").alias("carry_period"),
            )
        )

    def filled(self, rows, carried):
        """Entity text per row: its own, else the last one above it in the block, else the one carried in."""
        local = F.last("own", ignorenulls=True).over(self.so_far)
        return self.carry(rows, carried).withColumn("entity", F.coalesce(local, "carry_entity"))


def _usable(entity):
    return entity.isNotNull() & (F.lower(strip(entity)) != "nan")


def _own(rows):
    return rows.withColumn("own", F.when(~is_blank(F.col("entity_raw")), F.col("entity_raw")))


def forward_fill(grid, rows):
    """Fill blank entities (entity_raw) from above within each table; drop rows with none, or with the text nan."""
    rows = _own(rows)
    carried = grid.carried_entities(rows) if grid.split else None
    filled = grid.filled(rows, carried).where(_usable(F.col("entity")))
    return filled.drop("own", "carry_entity", "carry_period")


def _with_odd_dates(rows):
    """Adds `date` and `odd`: the text of a non-blank date cell that is no date, on rows that are kept."""
    odd = ~is_blank(F.col("date_raw")) & F.col("date").isNull() & _usable(F.col("entity"))
    return rows.withColumn("date", parse_date(F.col("date_raw"))).withColumn("odd", F.when(odd, strip(F.col("date_raw"))))


def _carried_all(grid, rows):
    """Entities and the first odd date text from above, for each block of the long tables."""
    entities = grid.carried_entities(rows)
    first_odd = (
        _with_odd_dates(grid.filled(rows.where("long_table"), entities))
        .where(F.col("odd").isNotNull())
        .groupBy("table_id")
        .agg(F.min(F.struct("row_idx", "odd")).alias("first_odd"))
    )
    above = F.col("first_odd.row_idx") < F.col("block") * grid.block_rows
    return entities.join(first_odd, "table_id", "left").select(
        "table_id", "block", "carry_entity", F.when(above, F.col("first_odd.odd")).alias("carry_period")
    )


def fill_and_stick(grid, rows, default_period=None):
    """Forward fill plus the sticky period: from the first unparseable date text of a table on, that text is the
    period of every row that has none of its own. Reads entity_raw and date_raw; adds entity, date and sticky.
    """
    rows = _own(rows)
    carried = _carried_all(grid, rows) if grid.split else None
    fixed = F.lit(default_period or None).cast("string")
    local = F.first("odd", ignorenulls=True).over(grid.so_far)
    return (
        _with_odd_dates(grid.filled(rows, carried))
        .withColumn("sticky", F.coalesce(fixed, "carry_period", local))
        .where(_usable(F.col("entity")))
        .drop("own", "odd", "carry_entity", "carry_period")
    )


def interpret_mapping(table_meta, column_map):
    """One row per table: entity column (with fallback), year / date / period columns and the value columns in order."""

    def chosen(pick, field):
        return pick(F.when(F.col("field") == field, F.col("col_idx")), F.when(F.col("field") == field, F.col("map_ord")))

    value = F.struct(
        "map_ord",
        "col_idx",
        F.coalesce("indicator", F.concat(F.lit("value_col_"), F.col("col_idx"))).alias("indicator"),
        "unit",
    )
    columns = column_map.groupBy("table_id").agg(
        chosen(F.max_by, "year").alias("year_column"),
        chosen(F.max_by, "date").alias("date_column"),
        chosen(F.max_by, "period").alias("period_column"),
        chosen(F.min_by, "entity_name").alias("named_entity_column"),
        F.array_sort(F.collect_list(F.when(F.col("field") == "value", value))).alias("value_columns"),
    )
    entity = F.coalesce("entity_column", "named_entity_column")
    return (
        table_meta.join(columns, "table_id")
        .withColumn("entity_column", entity)
        .where((F.col("entity_column") >= 0) & (F.size("value_columns") > 0))
        .select(
            "table_id",
            "entity_column",
            "entity_type",
            "entity_type_confidence",
            "domain",
            "year_column",
            "date_column",
            "period_column",
            "value_columns",
        )
    )


def _cell(column):
    return F.get("cells", F.col(column))


def resolve_entities(rows, gazetteer=GAZETTEER):
    """Adds entity_name, entity_resolution_method and confidence; only districts go through the gazetteer."""
    district = F.col("entity_type") == "district"
    out = resolve_districts(rows, "entity", ["table_id", "row_idx"], only=district, gazetteer=gazetteer)
    unresolved = F.concat(F.lit("UNRESOLVED:"), F.col("entity"))
    named = F.when(district, F.coalesce("canonical", unresolved)).otherwise(strip(F.col("entity")))
    method = F.when(district, F.col("resolution_method")).otherwise(ENTITY_TYPE_METHOD)
    # least skips nulls: only districts have a resolution confidence.
    confidence = round2(F.least("entity_type_confidence", "resolution_confidence", F.lit(1.0)))
    return out.withColumns(
        {"entity_name": named, "entity_resolution_method": method, "confidence": confidence}
    ).drop("canonical", "resolution_confidence", "resolution_method")


def normalize_tables(
    raw_rows,
    raw_tables,
    table_meta,
    column_map,
    default_year,
    starts=None,
    default_date=None,
    default_period=None,
    gazetteer=GAZETTEER,
    block_rows=BLOCK_ROWS,
    keep=lambda df: df,
):
    """Long observations of every table, keyed by (table_id, row_idx, col_idx).

    `starts` (table_id, data_start, and n_rows if known) skips header rows; without it every row is data. `keep` may write the filled rows
    to a table, so that they are computed once for name lookup and output. A year beyond an int comes out null: the
    sink turns such rows away with a reason rather than give them the default year.
    """
    tables = interpret_mapping(table_meta, column_map).join(raw_tables, "table_id")
    if starts is None:
        tables = tables.withColumn("data_start", F.lit(0).cast("long"))
    else:
        tables = tables.join(starts.select("table_id", "data_start"), "table_id")
    grid = Grid(raw_rows, block_rows, starts if starts is not None and "n_rows" in starts.columns else None)
    rows = (
        grid.with_tables(tables)
        .where(F.col("row_idx") >= F.col("data_start"))
        .withColumns({"entity_raw": _cell("entity_column"), "date_raw": _cell("date_column")})
    )
    own_period = _cell("period_column")
    period = F.coalesce(F.when(~is_blank(own_period), strip(own_period)), "sticky")
    filled = fill_and_stick(grid, rows, default_period).select(
        "table_id",
        "row_idx",
        "cells",
        "entity",
        "entity_type",
        "entity_type_confidence",
        "domain",
        "value_columns",
        "source_document",
        "source_page",
        "extraction_method",
        year_or(_cell("year_column"), default_year).alias("year"),
        F.coalesce("date", parse_date(F.lit(default_date).cast("string"))).alias("date"),
        period.alias("period"),
    )
    resolved = resolve_entities(keep(filled), gazetteer)
    parsed = F.transform(
        "value_columns",
        lambda v: F.struct(
            v["col_idx"].alias("col_idx"),
            v["indicator"].alias("indicator"),
            v["unit"].alias("unit"),
            parse_number(F.get("cells", v["col_idx"])).alias("value"),
        ),
    )
    # The outer form keeps Spark from parsing every cell again to test for values; rows without any drop after it.
    values = resolved.withColumn("v", F.explode_outer(F.filter(parsed, lambda v: v["value"].isNotNull())))
    return values.where("v IS NOT NULL").select(
        "table_id",
        "row_idx",
        F.col("v.col_idx").alias("col_idx"),
        "entity_name",
        "entity_type",
        "entity_resolution_method",
        "domain",
        "year",
        "date",
        "period",
        F.col("v.indicator").alias("indicator"),
        F.col("v.value").alias("value"),
        F.col("v.unit").alias("unit"),
        "source_document",
        "source_page",
        "extraction_method",
        "confidence",
        F.current_timestamp().alias("extracted_at"),
    )

