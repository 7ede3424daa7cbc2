"""Raw report tables, replies, names and paragraphs derived from the given tables, row for row.

Twenty consecutive orders make one report table: a banner, two header rows and an index row, then a data row per order
with blanks, dashes, odd dates and mixed spellings set by moduli of the order key. Ten tables make one document.
"""

from pyspark.sql import functions as F

from ..operators.gazetteer import spellings
from .staging import split_enough

SPELLINGS = (
    "1. Shimoga",
    "Bengaluru (Urban)",
    "Kolar District",
    "XY",
    "Mysore",
    "Shivamoga",
    "Koler",
    "D.K.",
    "DK",
    " belgaum ",
    "Uttara Kannda",
    "Kodagu dist.",
)
HEADER_ROWS = 4

# k: order key, t: table number, r: row number.
KEYED = ["o_orderkey AS k", "o_orderkey DIV 20 AS t", "o_orderkey % 20 AS r"]
DOCUMENT = "'report-' || t DIV 10 || '.docx'"
TABLE_ID = f"{DOCUMENT} || '#' || t % 10"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listed(values):
    return "array(" + ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values) + ")"


def _tables(spark, sf_dir):
    """(t): the table numbers of all orders."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey DIV 20 AS t").distinct()


def raw_tables(spark, sf_dir):
    return _tables(spark, sf_dir).selectExpr(
        f"{TABLE_ID} AS table_id",
        f"{DOCUMENT} AS source_document",
        "'native-table-' || t % 10 AS source_page",
        "'native_docx_table' AS extraction_method",
    )


ENTITY = f"""
CASE WHEN k % 97 = 0 THEN 'nan'
     WHEN k % 4 = 3 THEN ''
     WHEN t % 6 IN (0, 1, 5) THEN element_at({listed(SPELLINGS)}, CAST((t + k) % 12 AS INT) + 1)
     ELSE n_name END"""

YEAR = """
CASE WHEN k % 31 = 0 THEN '0' WHEN k % 37 = 0 THEN '2024-25' WHEN k % 41 = 0 THEN '99999999999'
     ELSE CAST(year(o_orderdate) AS STRING) END"""

DATE = """
CASE WHEN k % 9 = 0 AND t % 5 = 0 THEN 'Season ' || k % 5
     WHEN k % 11 = 0 THEN ''
     WHEN k % 6 = 0 THEN date_format(o_orderdate, 'dd.MM.yyyy')
     WHEN k % 6 = 1 THEN date_format(o_orderdate, 'dd-MM-yyyy')
     WHEN k % 6 = 2 THEN date_format(o_orderdate, 'yyyy-MM-dd')
     WHEN k % 6 = 3 THEN date_format(o_orderdate, 'dd/MM/yyyy')
     WHEN k % 6 = 4 THEN date_format(o_orderdate, 'dd MMMM yyyy')
     ELSE date_format(o_orderdate, 'dd MMM yyyy') END"""

AREA = """
CASE WHEN k % 13 = 0 THEN '-'
     WHEN k % 17 = 0 THEN 'n/a'
     WHEN k % 3 = 0 THEN format_number(floor(o_totalprice) * IF(k % 23 = 0, 10, 1), 0)
     ELSE CAST(floor(o_totalprice) * IF(k % 23 = 0, 10, 1) AS STRING) END"""

SHARE = "CASE WHEN k % 19 = 0 THEN '107%' ELSE CAST(o_custkey % 320 AS STRING) END"

HEADER_CELLS = """
CASE WHEN r = 0 AND t % 7 = 0 THEN array(NULL, NULL, NULL, NULL, NULL)
     WHEN r = 0 THEN array_repeat('Report ' || t, 5)
     WHEN r = 1 THEN array('District', 'Year', ' Date\nof record', 'Crop', 'Crop')
     WHEN r = 2 THEN array('District', NULL, '', 'Sown ' || t % 4, IF(t % 5 = 0, '129|', 'Percent'))
     WHEN r = 3 AND t % 2 = 0 THEN array(NULL, NULL, NULL, NULL, NULL)
     WHEN r = 3 AND t % 3 = 0 THEN array('೧', '೨', '೩', '೪', '೫')
     ELSE array('1', '2', '3', '4', '5') END"""

CELLS = f"""
CASE WHEN t % 11 = 0 THEN array(entity, 'year', dated, 'none yet', 'see ' || r)
     WHEN k % 29 = 0 THEN array(entity, {YEAR}, dated, {AREA})
     ELSE array(entity, {YEAR}, dated, {AREA}, {SHARE}) END"""


def raw_rows(spark, sf_dir):
    """(table_id, row_idx, cells, header_known). The nation table is small enough for Spark to broadcast by size."""
    orders = split_enough(table(spark, sf_dir, "orders").drop("o_orderstatus", "o_orderpriority"))
    orders = orders.selectExpr(*KEYED, "o_custkey", "o_totalprice", "o_orderdate")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    data = (
        orders.join(nation, F.expr("o_custkey % 25 = n_nationkey"))
        .selectExpr("*", f"{ENTITY} AS entity", f"{DATE} AS dated")
        .selectExpr(f"{TABLE_ID} AS table_id", f"r + {HEADER_ROWS} AS row_idx", f"{CELLS} AS cells")
    )
    above = _tables(spark, sf_dir).selectExpr("t", f"explode(sequence(0L, {HEADER_ROWS - 1}L)) AS r")
    heads = above.selectExpr(f"{TABLE_ID} AS table_id", "r AS row_idx", f"{HEADER_CELLS} AS cells")
    return data.unionByName(heads).withColumn("header_known", F.lit(False))


# What a mapping provider might answer, good and bad, by moduli of the table number.
REPLY_COLUMNS = """
CASE WHEN t % 17 = 16 THEN '"0": {"field": "ignore"}'
     ELSE '"0": {"field": "entity_name"}, "1": {"field": "year"}, "2": {"field": "'
       || IF(t % 10 = 7, 'period', 'date') || '"}, '
       || '"3": {"field": "value", "indicator": "area", "unit": "ha"}, '
       || '"4": {"field": "value", "indicator": "' || IF(t % 3 = 0, 'area', 'pct_coverage') || '"'
       || IF(t % 9 = 0, '', ', "unit": "%"') || '}, "note": {"field": "value"}' END"""

REPLY_BODY = f"""
CASE WHEN t % 13 = 12 THEN 'no mapping {{'
     ELSE '{{' || element_at(array('"_entity_column": 0, ', '', '"_entity_column": "abc", ', '"_entity_column": -1, '),
                             CAST(t % 8 % 4 AS INT) + 1)
       || '"_entity_type": "'
       || element_at(array('district', 'District ', 'hospital', 'Planet', 'state', 'district'), CAST(t % 6 AS INT) + 1)
       || '", "_entity_type_confidence": '
       || element_at(array('0.95', '1.7', '"0.5"', '"high"', '0.84'), CAST(t % 5 AS INT) + 1)
       || ', "_domain": '
       || element_at(array('"Agriculture"', 'null', '"none"', '" health "'), CAST(t % 4 AS INT) + 1)
       || ', ' || {REPLY_COLUMNS} || '}}' END"""


def replies(spark, sf_dir):
    """(table_id, reply), bare, fenced or inside other text."""
    return (
        _tables(spark, sf_dir)
        .selectExpr("t", f"{TABLE_ID} AS table_id", f"{REPLY_BODY} AS body")
        .selectExpr(
            "table_id",
            """CASE WHEN t % 4 = 0 THEN '```json\n' || body || '\n```'
                    WHEN t % 4 = 1 THEN 'Here is the mapping: ' || body || ' Done.'
                    ELSE body END AS reply""",
        )
    )


EMPTY_NAMES = ("", " nan ", "12. ", "None", "null")

NAME = f"""
CASE WHEN o_orderkey % 101 = 0 THEN element_at({listed(EMPTY_NAMES)}, CAST(o_orderkey % 5 AS INT) + 1)
     WHEN o_orderkey % 13 = 0 THEN 'Kodag\u016b ' || o_custkey % 100
     WHEN o_orderkey % 7 = 0 THEN 'Mysuru ' || o_custkey DIV 5
     ELSE element_at({listed(SPELLINGS)}, CAST(o_orderkey % 12 AS INT) + 1) END"""


def names(spark, sf_dir):
    """(id, name): one place spelling per order; empty ones, accented ones, and a fifth as many as there are customers."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", f"{NAME} AS name")


def misspelt_names(spark, sf_dir):
    """(id, name): gazetteer spellings with one letter left out."""
    known = [name for name, _ in spellings()]
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey AS id",
            f"element_at({listed(known)}, CAST(o_orderkey % {len(known)} AS INT) + 1) AS full",
            f"o_orderkey DIV {len(known)} AS at",
        )
        .selectExpr("id", "left(full, at % length(full)) || substr(full, at % length(full) + 2) AS name")
    )


def documents(spark, sf_dir):
    """(source_document, paragraphs): every line of every document, whole."""
    texts = split_enough(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return texts.selectExpr("'doc-' || doc_id AS source_document", "split(text, '\n') AS paragraphs")


def document_replies(spark, sf_dir):
    """(source_document, reply): a domain answer per document, some of them useless."""
    reply = """element_at(array('{"domain": "Health"}', '{"domain": null}', 'no idea',
      '```json\n{"domain": " ' || upper(source) || ' "}\n```', '{"domain": "None"}'), CAST(doc_id % 5 AS INT) + 1)"""
    return table(spark, sf_dir, "documents").selectExpr("'doc-' || doc_id AS source_document", f"{reply} AS reply")


def outside_observations(spark, sf_dir):
    """Observations as another system might hand them over: blank types and domains, values that are no numbers, texts
    in any case. One per line item."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'lines-' || l_orderkey DIV 50 AS table_id",
        "l_orderkey * 8 + l_linenumber AS row_idx",
        "0 AS col_idx",
        "IF(l_partkey % 5 = 0, 'UNRESOLVED:part ' || l_partkey % 9, 'part ' || l_partkey % 9) AS entity_name",
        "element_at(array(' District', 'crop', '  ', 'district', ''), l_linenumber % 5 + 1) AS entity_type",
        "element_at(array('Unresolved', 'exact_alias', 'empty_input'), CAST(l_suppkey % 3 AS INT) + 1) AS entity_resolution_method",
        "element_at(array('trade', '', CAST(NULL AS STRING), ' '), CAST(l_orderkey % 4 AS INT) + 1) AS domain",
        "year(l_shipdate) AS year",
        "element_at(array('weight', ' PCT_coverage', 'price'), CAST(l_partkey % 3 AS INT) + 1) AS indicator",
        """CASE WHEN l_partkey % 11 = 0 THEN double('NaN') WHEN l_partkey % 11 = 1 THEN double('Infinity')
           WHEN l_partkey % 11 = 2 THEN NULL WHEN l_partkey % 11 = 3 THEN -l_quantity
           WHEN l_partkey % 11 = 4 THEN l_extendedprice * 1000 ELSE l_extendedprice / 100 END AS value""",
        "IF(l_suppkey % 4 = 0, 'Percent of area', 'kg') AS unit",
        "l_linenumber / 10 AS confidence",
    )


def page_text(spark, sf_dir):
    """(doc, page, text): conversations read as paged documents."""
    return table(spark, sf_dir, "conversations").selectExpr("'conv-' || conv_id AS doc", "turn AS page", "text")


def page_grids(spark, sf_dir):
    """(doc, page, table_no, rows): the line items of each order as a two-column grid, every seventh with an empty one
    on the same page."""
    row = "struct(l_linenumber, array(CAST(l_partkey AS STRING), CAST(CAST(l_quantity AS INT) AS STRING)) AS cells)"
    grids = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.expr(f"transform(array_sort(collect_list({row})), x -> x.cells)").alias("rows")
    )
    beside = "IF(l_orderkey % 7 = 0, array(rows, CAST(array() AS ARRAY<ARRAY<STRING>>)), array(rows))"
    return grids.selectExpr("l_orderkey", f"posexplode({beside}) AS (nth, rows)").selectExpr(
        "'order-' || l_orderkey DIV 10 AS doc",
        "l_orderkey % 10 + 1 AS page",
        "l_orderkey % 10 + 10 * nth AS table_no",
        "rows",
    )
