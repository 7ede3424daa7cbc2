"""The registered queries as plain SQL over the same tables, written from the rules rather than from the plans."""

from ..functions.names import WORD_FIXES
from ..operators.gazetteer import spellings
from ..operators.mapping import DEFAULT_REASON, DOCUMENT_PROMPT, ENTITY_TYPES, NOT_SPECIFIED, TABLE_PROMPT
from ..sources.csv_tables import MISSING
from .derived import EMPTY_NAMES, SPELLINGS
from .fuzzy_sql import PAIRS


def quoted(text):
    return "'" + text.replace("'", "''") + "'"


def listed(values):
    return "[" + ", ".join(quoted(v) for v in values) + "]"


# Whitespace as a character list and as a regular-expression class.
SPACES = " || ".join(
    f"chr({c})"
    for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)
WS = (
    r"[\t\n\x0b\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(x):
    return f"trim({x}, {SPACES})"


# ---------------------------------------------------------------- raw tables

RAW = f"""
keyed AS (
  SELECT o_orderkey AS k, o_orderkey // 20 AS t, o_orderkey % 20 AS r, o_custkey, o_totalprice, o_orderdate, n_name
  FROM orders JOIN nation ON o_custkey % 25 = n_nationkey),
written AS (
  SELECT *,
    CASE WHEN k % 97 = 0 THEN 'nan' WHEN k % 4 = 3 THEN ''
         WHEN t % 6 IN (0, 1, 5) THEN {listed(SPELLINGS)}[(t + k) % 12 + 1] ELSE n_name END AS entity,
    CASE WHEN k % 31 = 0 THEN '0' WHEN k % 37 = 0 THEN '2024-25' WHEN k % 41 = 0 THEN '99999999999'
         ELSE CAST(year(o_orderdate) AS VARCHAR) END AS yeared,
    CASE WHEN k % 9 = 0 AND t % 5 = 0 THEN 'Season ' || (k % 5) WHEN k % 11 = 0 THEN ''
         ELSE [strftime(o_orderdate, '%d.%m.%Y'), strftime(o_orderdate, '%d-%m-%Y'), strftime(o_orderdate, '%Y-%m-%d'),
               strftime(o_orderdate, '%d/%m/%Y'), strftime(o_orderdate, '%d %B %Y'),
               strftime(o_orderdate, '%d %b %Y')][k % 6 + 1] END AS dated,
    CAST(floor(o_totalprice) AS BIGINT) * (CASE WHEN k % 23 = 0 THEN 10 ELSE 1 END) AS area,
    CASE WHEN k % 19 = 0 THEN '107%' ELSE CAST(o_custkey % 320 AS VARCHAR) END AS share
  FROM keyed),
raw AS (
  SELECT t, r, 'report-' || (t // 10) || '.docx#' || (t % 10) AS table_id,
    CASE WHEN r = 0 AND t % 7 = 0 THEN [NULL, NULL, NULL, NULL, NULL]
         WHEN r = 0 THEN ['Report ' || t, 'Report ' || t, 'Report ' || t, 'Report ' || t, 'Report ' || t]
         WHEN r = 1 THEN ['District', 'Year', ' Date' || chr(10) || 'of record', 'Crop', 'Crop']
         WHEN r = 2 THEN ['District', NULL, '', 'Sown ' || (t % 4), CASE WHEN t % 5 = 0 THEN '129|' ELSE 'Percent' END]
         WHEN r = 3 AND t % 2 = 0 THEN [NULL, NULL, NULL, NULL, NULL]
         WHEN r = 3 AND t % 3 = 0 THEN ['೧', '೨', '೩', '೪', '೫']
         ELSE ['1', '2', '3', '4', '5'] END AS cells
  FROM (SELECT DISTINCT o_orderkey // 20 AS t FROM orders), range(0, 4) AS u(r)
  UNION ALL
  SELECT t, r + 4, 'report-' || (t // 10) || '.docx#' || (t % 10),
    CASE WHEN t % 11 = 0 THEN [entity, 'year', dated, 'none yet', 'see ' || r]
         WHEN k % 29 = 0 THEN [entity, yeared, dated, areaed]
         ELSE [entity, yeared, dated, areaed, share] END
  FROM (SELECT *, CASE WHEN k % 13 = 0 THEN '-' WHEN k % 17 = 0 THEN 'n/a'
                       WHEN k % 3 = 0 THEN format('{{:,}}', area) ELSE CAST(area AS VARCHAR) END AS areaed
        FROM written))"""


def digits(x):
    """Native digits as ASCII ones."""
    return f"translate({x}, '೦೧೨೩೪೫೬೭೮೯', '0123456789')"


def number(x):
    """Value of a cell, null if it is no plain number."""
    bare = f"replace({digits(x)}, ',', '')"
    return (
        f"CASE WHEN regexp_matches(trim({bare}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') "
        f"THEN CAST(trim({bare}) AS DOUBLE) END"
    )


def is_number(x):
    return f"regexp_matches(trim(replace({digits(x)}, ',', '')), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$')"


DATE_FORMATS = "['%d.%m.%Y', '%d-%m-%Y', '%Y-%m-%d', '%d/%m/%Y', '%d %B %Y', '%d %b %Y']"


def date(x):
    return f"CAST(try_strptime(trim({x}), {DATE_FORMATS}) AS DATE)"


KINDS = f"""
kinds AS (
  SELECT *,
    CASE WHEN len(present) = 0 THEN 'blank'
         WHEN len(present) >= 2 AND len(list_distinct(list_transform(present, lambda c: trim(c)))) = 1 THEN 'banner'
         WHEN len(filled) >= 2 AND len(list_filter(range(1, len(cells) + 1),
                lambda i: coalesce(trim({digits('cells[i]')}) = CAST(i AS VARCHAR), FALSE))) >= 0.6 * len(filled) THEN 'index'
         WHEN len(list_filter(present, lambda c: {is_number('c')})) < 0.5 * len(present) THEN 'header'
         ELSE 'data' END AS kind
  FROM (SELECT *, list_filter(cells, lambda c: c IS NOT NULL) AS present,
               list_filter(cells, lambda c: c IS NOT NULL AND trim(c) <> '') AS filled FROM raw)),
starts AS (
  SELECT table_id, any_value(t) AS t, coalesce(min(r) FILTER (kind = 'data'), count(*)) AS data_start, max(len(cells)) AS n_cols
  FROM kinds GROUP BY table_id)"""

HEADERS = rf"""
parts AS (
  SELECT table_id, col_idx, text, min(r) AS first_row FROM (
    SELECT k.table_id, k.r, i - 1 AS col_idx, replace(trim(k.cells[i]), chr(10), ' ') AS text
    FROM kinds k JOIN starts s USING (table_id), unnest(range(1, len(k.cells) + 1)) AS u(i)
    WHERE k.kind = 'header' AND k.r < s.data_start AND trim(k.cells[i]) <> '')
  WHERE NOT regexp_matches(text, '^[|\]}})]*[0-9]+(\.[0-9]+)?[|\]}})]*$') AND NOT {is_number('text')}
  GROUP BY table_id, col_idx, text),
heads AS (
  SELECT s.table_id, s.t, s.data_start, c AS col_idx,
    (SELECT string_agg(p.text, ' - ' ORDER BY p.first_row, p.text)
     FROM parts p WHERE p.table_id = s.table_id AND p.col_idx = c) AS header
  FROM starts s, unnest(range(0, s.n_cols)) AS u(c)),
samples AS (
  SELECT table_id, CAST(to_json(list(cells ORDER BY r)) AS VARCHAR) AS sample_rows
  FROM raw JOIN starts USING (table_id) WHERE r BETWEEN data_start AND data_start + 4 GROUP BY table_id)"""

# Shared leading or trailing parts of the headers in texts (id, pos, h).
COMPACT = """
parted AS (SELECT id, pos, h, string_split(h, ' - ') AS p FROM texts),
sized AS (SELECT id, count(*) AS n, greatest(2, count(*) // 2) AS enough FROM texts GROUP BY id),
ends AS (SELECT id, trim(p[-1]) AS text, count(*) AS c FROM parted WHERE len(p) > 1 GROUP BY ALL),
fronts AS (SELECT id, trim(p[1]) AS text, count(*) AS c FROM parted WHERE len(p) > 1 GROUP BY ALL),
suffixes AS (SELECT id, first(text ORDER BY c DESC, text) AS text, max(c) AS c FROM ends GROUP BY id),
prefixes AS (SELECT id, first(text ORDER BY c DESC, text) AS text, max(c) AS c FROM fronts GROUP BY id),
compacted AS (
  SELECT q.id, CAST(to_json(list(
    CASE WHEN z.n < 3 OR len(p) = 1 THEN h
         WHEN s.c >= z.enough THEN
           CASE WHEN trim(p[-1]) = s.text THEN array_to_string(p[1:len(p) - 1], ' - ') ELSE h END
         WHEN f.c >= z.enough THEN
           CASE WHEN trim(p[1]) = f.text THEN array_to_string(p[2:], ' - ') ELSE h END
         ELSE h END ORDER BY q.pos)) AS VARCHAR) AS headers
  FROM parted q JOIN sized z USING (id) LEFT JOIN suffixes s USING (id) LEFT JOIN prefixes f USING (id)
  GROUP BY q.id)"""

# ---------------------------------------------------------------- mapping replies, as written, then parsed


def json_object(reply):
    """The JSON object inside a reply, null where there is none."""
    inside = f"regexp_extract({reply}, '(?s)\\{{.*\\}}')"
    return f"CASE WHEN json_valid({inside}) AND {inside} <> '' THEN {inside}::JSON END"


def null_like(x):
    return f"CASE WHEN lower({strip(x)}) NOT IN ('none', 'null', '') THEN lower({strip(x)}) END"


META = f"""
tables AS (
  SELECT t, 'report-' || (t // 10) || '.docx' AS source_document, 'report-' || (t // 10) || '.docx#' || (t % 10) AS table_id
  FROM (SELECT DISTINCT o_orderkey // 20 AS t FROM orders)),
bodies AS (
  SELECT *, CASE WHEN t % 13 = 12 THEN 'no mapping {{'
    ELSE '{{' || ['"_entity_column": 0, ', '', '"_entity_column": "abc", ', '"_entity_column": -1, '][t % 8 % 4 + 1]
      || '"_entity_type": "' || ['district', 'District ', 'hospital', 'Planet', 'state', 'district'][t % 6 + 1]
      || '", "_entity_type_confidence": ' || ['0.95', '1.7', '"0.5"', '"high"', '0.84'][t % 5 + 1]
      || ', "_domain": ' || ['"Agriculture"', 'null', '"none"', '" health "'][t % 4 + 1] || ', '
      || CASE WHEN t % 17 = 16 THEN '"0": {{"field": "ignore"}}'
         ELSE '"0": {{"field": "entity_name"}}, "1": {{"field": "year"}}, "2": {{"field": "'
           || CASE WHEN t % 10 = 7 THEN 'period' ELSE 'date' END
           || '"}}, "3": {{"field": "value", "indicator": "area", "unit": "ha"}}, "4": {{"field": "value", "indicator": "'
           || CASE WHEN t % 3 = 0 THEN 'area' ELSE 'pct_coverage' END || '"'
           || CASE WHEN t % 9 = 0 THEN '' ELSE ', "unit": "%"' END || '}}, "note": {{"field": "value"}}' END || '}}' END AS body
  FROM tables),
parsed AS (
  SELECT *, {json_object("reply")} AS j FROM (
    SELECT *, CASE t % 4 WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```'
      WHEN 1 THEN 'Here is the mapping: ' || body || ' Done.' ELSE body END AS reply FROM bodies)),
specs AS (
  SELECT table_id, map_ord, key::INTEGER AS col_idx, j ->> ('$."' || key || '".field') AS field,
    coalesce(j ->> ('$."' || key || '".indicator'), 'value_col_' || key) AS indicator,
    coalesce(j ->> ('$."' || key || '".unit'), '') AS unit
  FROM (SELECT table_id, j, unnest(json_keys(j)) AS key, generate_subscripts(json_keys(j), 1) AS map_ord FROM parsed
        WHERE j IS NOT NULL)
  WHERE regexp_matches(key, '^[0-9]+$')),
columns_ AS (
  SELECT * REPLACE (CASE WHEN field = 'value' AND nth > 1 THEN indicator || '_' || nth ELSE indicator END AS indicator)
  FROM (SELECT *, row_number() OVER (PARTITION BY table_id, indicator, field ORDER BY col_idx) AS nth FROM specs)),
roles AS (
  SELECT table_id, max_by(col_idx, map_ord) FILTER (field = 'year') AS year_column,
    max_by(col_idx, map_ord) FILTER (field = 'date') AS date_column,
    max_by(col_idx, map_ord) FILTER (field = 'period') AS period_column,
    min_by(col_idx, map_ord) FILTER (field = 'entity_name') AS named_column,
    string_agg(col_idx || ':' || indicator || ':' || unit, '|' ORDER BY map_ord) FILTER (field = 'value') AS value_columns
  FROM columns_ GROUP BY table_id),
meta AS (
  SELECT p.t, p.source_document, p.table_id,
    CASE WHEN TRY_CAST(j ->> '$._entity_column' AS INTEGER) >= 0 THEN (j ->> '$._entity_column')::INTEGER ELSE -1 END
      AS stated_column,
    CASE WHEN lower(trim(j ->> '$._entity_type')) IN ({", ".join(quoted(x) for x in ENTITY_TYPES)})
         THEN lower(trim(j ->> '$._entity_type')) ELSE 'other' END AS entity_type,
    round_even(least(1.0, greatest(0.0, coalesce(TRY_CAST(j ->> '$._entity_type_confidence' AS DOUBLE), 0.0))), 2)::DOUBLE
      AS entity_type_confidence,
    {null_like("(j ->> '$._domain')")} AS domain,
    coalesce(CASE WHEN TRY_CAST(j ->> '$._entity_column' AS INTEGER) >= 0 THEN (j ->> '$._entity_column')::INTEGER END,
      named_column) AS entity_column,
    r.* EXCLUDE (table_id, named_column)
  FROM parsed p LEFT JOIN roles r USING (table_id) WHERE j IS NOT NULL),
chosen AS (SELECT * FROM meta WHERE entity_column >= 0 AND value_columns IS NOT NULL)"""

# ---------------------------------------------------------------- names


def cleaned(x):
    plain = f"trim({x})"
    return (
        f"CASE WHEN lower({plain}) IN ('', 'nan', 'none', 'null') THEN '' "
        f"ELSE trim(regexp_replace({plain}, '^\\s*[0-9]+\\s*[|.\\-:\\]]\\s*', ''), ' .,:;|[]') END"
    )


def key(x):
    """Matching key of an ASCII name."""
    fixes = "MAP {" + ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in WORD_FIXES.items()) + "}"
    s = f"regexp_replace(trim(lower({x})), '^\\s*[0-9]+\\s*[|.\\-:\\]]\\s*', '')"
    s = f"regexp_replace({s}, '[^a-z0-9_\\s.&-]', ' ', 'g')"
    s = f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"
    s = f"regexp_replace({s}, '\\s+(district|dist\\.?)$', '')"
    return f"array_to_string(list_transform(string_split({s}, ' '), lambda w: coalesce({fixes}[w], w)), ' ')"


ALIASES = f"""
aliases AS (
  SELECT alias_key, max_by(canonical, ord) AS canonical, min(ord) AS alias_ord FROM (
    SELECT ord, canonical, {key('spelling')} AS alias_key
    FROM (VALUES {", ".join(f"({i}, {quoted(n)}, {quoted(c)})" for i, (n, c) in enumerate(spellings()))})
         AS v(ord, spelling, canonical))
  GROUP BY alias_key)"""


def resolved(names):
    """CTEs from a query of distinct names to resolved (name, canonical, confidence, method): exact alias first, then
    the best of three scores among the five aliases with the best weighted score."""
    return f"""
keyed_names AS (
  SELECT name, clean, key, length(regexp_replace(key, '[^a-z]', '', 'g')) AS letters
  FROM (SELECT name, clean, {key('strip_accents(clean)')} AS key FROM (SELECT name, {cleaned('name')} AS clean FROM ({names}))) ),
looked_up AS (SELECT n.*, a.canonical AS exact FROM keyed_names n LEFT JOIN aliases a ON a.alias_key = n.key),
pairs AS (
  SELECT DISTINCT l.key AS a, a.alias_key AS b FROM looked_up l, aliases a WHERE l.exact IS NULL AND l.letters >= 5),
{PAIRS.strip()},
ranked AS (
  SELECT s.a, x.canonical, x.alias_ord, weighted, greatest(plain, weighted, token_set) AS best,
    row_number() OVER (PARTITION BY s.a ORDER BY weighted DESC, x.alias_ord) AS nth
  FROM scored s JOIN aliases x ON x.alias_key = s.b),
picked AS (
  SELECT a, arg_min(canonical, place) AS canonical, max(best) AS best FROM (
    SELECT a, canonical, best, row_number() OVER (PARTITION BY a ORDER BY best DESC, weighted DESC, alias_ord) AS place
    FROM ranked WHERE nth <= 5) GROUP BY a),
judged AS (
  SELECT l.*, p.canonical AS near, p.best,
    CASE WHEN clean = '' THEN 'empty_input' WHEN exact IS NOT NULL THEN 'exact_alias'
         WHEN letters < 5 THEN 'unresolved_short_input'
         WHEN p.best >= (CASE WHEN letters <= 6 THEN 90 ELSE 80 END) THEN 'fuzzy_match' ELSE 'unresolved' END AS method
  FROM looked_up l LEFT JOIN picked p ON p.a = l.key),
resolved AS (
  SELECT name, method,
    CASE method WHEN 'exact_alias' THEN exact WHEN 'fuzzy_match' THEN near END AS canonical,
    CASE method WHEN 'exact_alias' THEN 1.0 WHEN 'fuzzy_match' THEN round_even(best / 100, 2) ELSE 0.0 END::DOUBLE
      AS confidence
  FROM judged)"""


RESOLVED = resolved(f"SELECT DISTINCT unnest({listed(SPELLINGS)}) AS name")

NAMED = f"""
named AS (
  SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 101 = 0 THEN {listed(EMPTY_NAMES)}[o_orderkey % 5 + 1]
         WHEN o_orderkey % 13 = 0 THEN 'Kodag\u016b ' || (o_custkey % 100)
         WHEN o_orderkey % 7 = 0 THEN 'Mysuru ' || (o_custkey // 5)
         ELSE {listed(SPELLINGS)}[o_orderkey % 12 + 1] END AS name
  FROM orders)"""

KNOWN = [name for name, _ in spellings()]
MISSPELT = f"""
misspelt AS (
  SELECT id, left(whole, gap) || substr(whole, gap + 2) AS name FROM (
    SELECT o_orderkey AS id, {listed(KNOWN)}[o_orderkey % {len(KNOWN)} + 1] AS whole,
      (o_orderkey // {len(KNOWN)}) % len(whole) AS gap
    FROM orders))"""

# ---------------------------------------------------------------- observations

SO_FAR = "(PARTITION BY table_id ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"



def filled(tables, date_cell, own_period="NULL", odd_default="NULL"):
    """CTEs of rows with their entity, and of data rows with date and period. `tables` joins what the two cells need."""
    return f"""
filled AS (
  SELECT * FROM (
    SELECT *, last_value(CASE WHEN trim(cells[1]) <> '' THEN cells[1] END IGNORE NULLS) OVER {SO_FAR} AS entity FROM raw)
  WHERE entity IS NOT NULL AND lower(trim(entity)) <> 'nan'),
data_filled AS (
  SELECT * FROM (
    SELECT raw.*, last_value(CASE WHEN trim(cells[1]) <> '' THEN cells[1] END IGNORE NULLS) OVER {SO_FAR} AS entity
    FROM raw JOIN starts USING (table_id) WHERE r >= data_start)
  WHERE entity IS NOT NULL AND lower(trim(entity)) <> 'nan'),
stuck AS (
  SELECT f.*, {date(date_cell)} AS date,
    coalesce(nullif(trim({own_period}), ''), {odd_default},
      first_value(CASE WHEN trim({date_cell}) <> '' AND {date(date_cell)} IS NULL THEN trim({date_cell}) END IGNORE NULLS)
        OVER {SO_FAR.replace("table_id", "f.table_id")}) AS period
  FROM data_filled f {tables})"""


BY_REPLY = ("JOIN chosen c ON c.t = f.t", "cells[c.date_column + 1]", "cells[c.period_column + 1]")
FILLED = filled(*BY_REPLY)

OBSERVATIONS = f"""
obs AS (
  SELECT s.table_id, s.r AS row_idx, c.col_idx,
    CASE WHEN m.entity_type = 'district' THEN coalesce(d.canonical, 'UNRESOLVED:' || s.entity) ELSE trim(s.entity) END
      AS entity_name,
    m.entity_type,
    CASE WHEN m.entity_type = 'district' THEN d.method ELSE 'groq_entity_type' END AS entity_resolution_method,
    m.domain,
    CASE WHEN nullif({number('s.cells[m.year_column + 1]')}, 0) IS NULL THEN 2025
         ELSE TRY_CAST({number('s.cells[m.year_column + 1]')} AS INTEGER) END AS year,
    s.date, s.period, c.indicator,
    {number('s.cells[c.col_idx + 1]')} AS value,
    c.unit,
    m.source_document,
    'native-table-' || (m.t % 10) AS source_page,
    'native_docx_table' AS extraction_method,
    CASE WHEN m.entity_type = 'district' THEN least(m.entity_type_confidence, d.confidence)
         ELSE m.entity_type_confidence END AS confidence
  FROM stuck s JOIN chosen m ON m.t = s.t JOIN columns_ c ON c.table_id = m.table_id AND c.field = 'value'
    LEFT JOIN resolved d ON d.name = s.entity
  WHERE {number('s.cells[c.col_idx + 1]')} IS NOT NULL)"""

VALIDATED = """
ruled AS (
  SELECT *, count(*) OVER (PARTITION BY table_id, entity_name, year, indicator) > 1 AS duplicate,
    concat_ws(';',
      CASE WHEN trim(entity_type) = '' THEN 'missing_entity_type' END,
      CASE WHEN trim(domain) = '' THEN 'missing_domain' END,
      CASE WHEN lower(trim(entity_type)) = 'district' AND entity_name LIKE 'UNRESOLVED:%' THEN 'unresolved_entity' END,
      CASE WHEN confidence < 0.35
             AND lower(entity_resolution_method) IN ('unresolved', 'empty_input', 'unresolved_short_input')
           THEN 'very_low_confidence' END,
      CASE WHEN value IS NULL OR NOT isfinite(value) THEN 'invalid_numeric_value' END,
      CASE WHEN isfinite(value) AND (value < 0 OR value > (
             CASE WHEN lower(trim(indicator)) = 'pct_coverage' OR contains(unit, '%') OR contains(lower(unit), 'percent')
               THEN 300 ELSE 1000000 END))
           THEN 'out_of_range(' || format('{:g}', value) || ')' END) AS reasons
  FROM obs),
validated AS (
  SELECT * EXCLUDE (reasons, duplicate), reasons <> '' AS validation_flag,
    CASE WHEN NOT duplicate THEN reasons WHEN reasons = '' THEN 'duplicate_entry'
         ELSE reasons || ';duplicate_entry' END AS validation_reason
  FROM ruled)"""

# ---------------------------------------------------------------- text

PARAGRAPHS = f"""
docs AS (
  SELECT doc_id, 'doc-' || doc_id AS source_document,
    list_filter(list_transform(string_split(text, chr(10)), lambda p: {strip('p')}), lambda p: p <> '') AS paragraphs
  FROM documents),
domains AS (
  SELECT source_document, {null_like("(j ->> '$.domain')")} AS domain FROM (
    SELECT source_document, {json_object("reply")} AS j FROM (
      SELECT 'doc-' || doc_id AS source_document, ['{{"domain": "Health"}}', '{{"domain": null}}', 'no idea',
        '```json' || chr(10) || '{{"domain": " ' || upper(source) || ' "}}' || chr(10) || '```',
        '{{"domain": "None"}}'][doc_id % 5 + 1] AS reply
      FROM documents))),
contexts AS (
  SELECT doc_id, source_document, left(array_to_string(paragraphs[1:5], ' '), 1500) AS context
  FROM docs WHERE len(paragraphs) > 0)"""

PAGES = f"""
pages_kept AS (
  SELECT 'conv-' || conv_id AS source_document, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS para_idx
  FROM conversations WHERE {strip('text')} <> ''),
docs AS (
  SELECT source_document, list({strip('text')} ORDER BY para_idx) AS paragraphs FROM pages_kept GROUP BY source_document)"""

_MERGED = "CASE WHEN a.pending = '' THEN x.pending ELSE a.pending || ' ' || x.pending END"

CHUNKS = f"""
folded AS (
  SELECT source_document, list_reduce(
    list_transform(paragraphs, lambda p: {{'chunks': []::VARCHAR[], 'pending': p}}),
    lambda a, x: CASE WHEN len(regexp_split_to_array({_MERGED}, '{WS}+')) < 5
      THEN {{'chunks': a.chunks, 'pending': {_MERGED}}}
      ELSE {{'chunks': list_append(a.chunks, {_MERGED}), 'pending': ''}} END,
    {{'chunks': []::VARCHAR[], 'pending': ''}}) AS f
  FROM docs),
pieces AS (
  SELECT source_document, CASE WHEN f.pending = '' THEN f.chunks ELSE list_append(f.chunks, f.pending) END AS c FROM folded),
chunks AS (
  SELECT source_document, CAST(i - 1 AS BIGINT) AS chunk_index, c[i] AS chunk_text
  FROM pieces, unnest(range(1, len(c) + 1)) AS u(i))"""


def template(prompt, *values):
    """A prompt with its %s places filled by SQL expressions."""
    pieces = prompt.split("%s")
    out = [quoted(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        out += [value, quoted(piece)]
    return " || ".join(out)


def query(ctes, final):
    return "WITH " + ",".join(ctes) + "\n" + final


RULES = [RAW, KINDS, META, ALIASES, RESOLVED, FILLED, OBSERVATIONS]
CHECKED = [*RULES, VALIDATED]
OBS_COLUMNS = "* REPLACE (strftime(date, '%Y-%m-%d') AS date)"
# What the store accepts and keeps.
STORED = [*CHECKED, "stored AS (SELECT * EXCLUDE (row_idx, col_idx) FROM validated WHERE year IS NOT NULL)"]


def _g(x):
    return f"format('{{:g}}', {x})"


def _oracle():
    cell = "cells[i]"
    lower = f"lower(trim({cell}))"
    report = "'report-' || substr(source_document, 5) || '.docx'"
    requests = query(
        [
            RAW,
            KINDS,
            HEADERS,
            META,
            PARAGRAPHS,
            "texts AS (SELECT table_id AS id, col_idx AS pos, coalesce(header, '') AS h FROM heads)",
            COMPACT,
        ],
        f"""SELECT h.table_id, {template(
            TABLE_PROMPT,
            "t.source_document",
            f"coalesce(c.context, {quoted(NOT_SPECIFIED)})",
            "h.headers",
            "coalesce(s.sample_rows, '[]')",
        )} AS prompt
        FROM (SELECT id AS table_id, headers FROM compacted) h
          JOIN tables t USING (table_id) LEFT JOIN samples s USING (table_id)
          LEFT JOIN (SELECT {report} AS source_document, context FROM contexts) c USING (source_document)""",
    )
    return {
        "parse_cells": query(
            [RAW],
            f"""SELECT table_id, r AS row_idx, CAST(i - 1 AS INTEGER) AS col_idx,
              coalesce({number(cell)}, -1.0) AS number,
              CASE WHEN {lower} IN ('', 'nan', 'none') THEN 0.0 WHEN regexp_matches({lower}, '[a-z]') THEN 0.2
                   WHEN {number(cell)} IS NULL THEN 0.1 ELSE 1.0 END::DOUBLE AS number_confidence,
              coalesce({_g(number(cell))}, '-') AS number_text,
              {is_number(cell)} AS numeric,
              coalesce(TRY_CAST(nullif({number(cell)}, 0) AS INTEGER), -1) AS whole,
              coalesce(strftime({date(cell)}, '%Y-%m-%d'), '-') AS date
            FROM raw, unnest(range(1, len(cells) + 1)) AS u(i) WHERE {cell} IS NOT NULL""",
        ),
        "classify_rows": query([RAW, KINDS], "SELECT table_id, r AS row_idx, kind FROM kinds"),
        "pad_rows": query(
            [RAW],
            """SELECT table_id, r AS row_idx, 5 AS width,
              CAST(to_json(CASE WHEN len(cells) = 4 THEN list_append(cells, NULL) ELSE cells END) AS VARCHAR) AS cells FROM raw""",
        ),
        "detect_headers": query([RAW, KINDS, HEADERS], "SELECT table_id, data_start, CAST(col_idx AS INTEGER) AS col_idx, header FROM heads"),
        "table_samples": query([RAW, KINDS, HEADERS], "SELECT * FROM samples"),
        "forward_fill_entities": query(
            [RAW, KINDS, filled("", "cells[3]")], "SELECT table_id, r AS row_idx, entity FROM filled"
        ),
        "sticky_period": query(
            [RAW, "starts AS (SELECT DISTINCT table_id, 4 AS data_start FROM raw)", filled("", "cells[3]")],
            "SELECT table_id, r AS row_idx, strftime(date, '%Y-%m-%d') AS date, period FROM stuck",
        ),
        "csv_documents": f"""
            SELECT {", ".join(f"CASE WHEN {c}::VARCHAR NOT IN {tuple(MISSING)} THEN {c}::VARCHAR END AS {c}" for c in
                              ("doc_id", "source", "text", "lang", "n_chars"))}, 5 AS width FROM documents""",
        "compact_headers": query(
            [
                """texts AS (
              SELECT l_orderkey AS id, row_number() OVER (PARTITION BY l_orderkey ORDER BY h) AS pos, h FROM (
                SELECT l_orderkey,
                  CASE l_orderkey % 3 WHEN 0 THEN l_partkey || ' - ' || l_returnflag || ' - ' || l_linestatus
                                      WHEN 1 THEN l_linestatus || ' - ' || l_partkey ELSE l_partkey || '' END AS h
                FROM lineitem))""",
                COMPACT,
            ],
            "SELECT id AS l_orderkey, headers FROM compacted",
        ),
        "mapping_metadata": query(
            [META],
            f"""SELECT table_id, stated_column AS entity_column, entity_type, entity_type_confidence,
              {quoted(DEFAULT_REASON)} AS entity_type_reason, domain FROM meta""",
        ),
        "map_columns": query(
            [META],
            """SELECT table_id, entity_column, coalesce(year_column, -1) AS year_column, coalesce(date_column, -1) AS date_column,
              coalesce(period_column, -1) AS period_column, value_columns
            FROM chosen""",
        ),
        "dedupe_indicators": query([META], "SELECT table_id, col_idx, field, indicator, unit FROM columns_"),
        "mapping_requests": requests,
        "pending_requests": f"""SELECT r.* FROM ({requests}) r
            WHERE split_part(table_id, '#', 2)::INTEGER % 3 = 0 OR table_id LIKE '%#5'""",
        "mapping_rejects": query(
            [META],
            """SELECT table_id, 'unreadable reply' AS reason FROM parsed WHERE j IS NULL
            UNION ALL
            SELECT table_id, CASE WHEN entity_column IS NULL THEN 'no entity column' ELSE 'no value column' END
            FROM meta WHERE entity_column IS NULL OR value_columns IS NULL""",
        ),
        "domain_requests": query(
            [PARAGRAPHS],
            f"""SELECT {report} AS source_document, {template(DOCUMENT_PROMPT, report, "context")} AS prompt
            FROM contexts""",
        ),
        "gazetteer": query(
            [ALIASES, NAMED],
            f"""SELECT a.alias_key, a.canonical, count(n.k) AS rows
            FROM aliases a LEFT JOIN (SELECT {key(f"strip_accents({cleaned('name')})")} AS k FROM named) n
              ON n.k = a.alias_key GROUP BY ALL""",
        ),
        "normalize_names": query(
            [NAMED],
            f"""SELECT id, clean_name, name_key, length(regexp_replace(name_key, '[^a-z]', '', 'g'))::INTEGER AS letters
            FROM (SELECT id, clean_name, {key('strip_accents(clean_name)')} AS name_key
                  FROM (SELECT id, {cleaned('name')} AS clean_name FROM named))""",
        ),
        "resolve_districts": query(
            [ALIASES, NAMED, resolved("SELECT DISTINCT name FROM named")],
            """SELECT id, canonical, confidence AS resolution_confidence, method AS resolution_method
            FROM named JOIN resolved USING (name)""",
        ),
        "fuzzy_resolve": query(
            [MISSPELT, ALIASES, resolved("SELECT DISTINCT name FROM misspelt")],
            """SELECT id, name, canonical, confidence AS resolution_confidence, method AS resolution_method
            FROM misspelt JOIN resolved USING (name)""",
        ),
        "normalize_observations": query(RULES, f"SELECT {OBS_COLUMNS} FROM obs"),
        "validate_observations": query(CHECKED, f"SELECT {OBS_COLUMNS} FROM validated"),
        "process_tables": query(CHECKED, f"SELECT {OBS_COLUMNS} FROM validated"),
        "validate_outside": query(
            [
                """obs AS (
              SELECT 'lines-' || (l_orderkey // 50) AS table_id, l_orderkey * 8 + l_linenumber AS row_idx, 0 AS col_idx,
                CASE WHEN l_partkey % 5 = 0 THEN 'UNRESOLVED:' ELSE '' END || 'part ' || (l_partkey % 9) AS entity_name,
                [' District', 'crop', '  ', 'district', ''][l_linenumber % 5 + 1] AS entity_type,
                ['Unresolved', 'exact_alias', 'empty_input'][l_suppkey % 3 + 1] AS entity_resolution_method,
                ['trade', '', NULL, ' '][l_orderkey % 4 + 1] AS domain, year(l_shipdate)::INTEGER AS year,
                ['weight', ' PCT_coverage', 'price'][l_partkey % 3 + 1] AS indicator,
                CASE l_partkey % 11 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN NULL
                  WHEN 3 THEN -l_quantity WHEN 4 THEN l_extendedprice * 1000 ELSE l_extendedprice / 100 END::DOUBLE AS value,
                CASE WHEN l_suppkey % 4 = 0 THEN 'Percent of area' ELSE 'kg' END AS unit,
                l_linenumber / 10 AS confidence
              FROM lineitem)""",
                VALIDATED,
            ],
            "SELECT * FROM validated",
        ),
        "default_dates": query(
            [*RULES[:-2], filled(*BY_REPLY, "'FY 2020'"), OBSERVATIONS],
            """SELECT table_id, row_idx, col_idx, strftime(coalesce(date, DATE '2020-03-01'), '%Y-%m-%d') AS date, period
            FROM obs""",
        ),
        "not_null_rejects": query(
            RULES, "SELECT table_id, row_idx, col_idx, 'missing year' AS reason FROM obs WHERE year IS NULL"
        ),
        "obs_datasets": query(
            STORED, "SELECT source_document, extraction_method, count(*) AS row_count FROM stored GROUP BY ALL"
        ),
        "obs_entity": query(
            STORED,
            f"""SELECT {OBS_COLUMNS} FROM stored
            WHERE entity_name = 'Shivamogga' AND year = 1997 AND NOT validation_flag""",
        ),
        "obs_query": query(
            STORED,
            f"""SELECT {OBS_COLUMNS} FROM stored
            WHERE indicator = 'area' AND entity_type = 'district' AND domain = 'health'
              AND value BETWEEN 0 AND 400000 AND NOT validation_flag""",
        ),
        "obs_query_count": query(STORED, "SELECT count(*) AS count FROM stored WHERE date = DATE '1997-05-28'"),
        "table_quality": query(
            STORED,
            """SELECT table_id, count(*) AS rows, count(*) FILTER (validation_flag) AS flagged
            FROM stored GROUP BY table_id""",
        ),
        "domain_consistency": query(
            STORED,
            """SELECT source_document, indicator, count(DISTINCT domain) AS domains FROM stored
            GROUP BY ALL HAVING count(DISTINCT domain) > 1""",
        ),
        "chunk_documents": query([PARAGRAPHS, CHUNKS], "SELECT * FROM chunks LEFT JOIN domains USING (source_document)"),
        "chunks_by_domain": query(
            [PARAGRAPHS, CHUNKS],
            "SELECT * FROM chunks JOIN domains USING (source_document) WHERE domain = 'health' ORDER BY 1, 2",
        ),
        "chunk_paragraphs": query([PARAGRAPHS, CHUNKS], "SELECT * FROM chunks LEFT JOIN domains USING (source_document)"),
        "chunk_pages": query([PAGES, CHUNKS], "SELECT * FROM chunks"),
        "page_paragraphs": query([PAGES], "SELECT source_document, para_idx, text FROM pages_kept"),
        "page_tables": """
            SELECT 'order-' || (l_orderkey // 10) || '#' || (l_orderkey % 10) AS table_id,
              'order-' || (l_orderkey // 10) AS source_document,
              'pdf-page-' || (l_orderkey % 10 + 1) AS source_page,
              row_number() OVER (PARTITION BY l_orderkey
                ORDER BY l_linenumber, l_partkey::VARCHAR, l_quantity::INTEGER::VARCHAR) - 1 AS row_idx,
              CAST(to_json([l_partkey::VARCHAR, l_quantity::INTEGER::VARCHAR]) AS VARCHAR) AS cells
            FROM lineitem""",
        "document_context": query([PARAGRAPHS], "SELECT source_document, context FROM contexts"),
        "document_domains": query([PARAGRAPHS], "SELECT * FROM domains"),
        "document_counts": query(
            [PAGES, CHUNKS],
            """SELECT source_document, coalesce(p, 0) AS paragraphs, coalesce(t, 0) AS tables, coalesce(c, 0) AS chunks
            FROM (SELECT source_document, count(*) AS p FROM pages_kept GROUP BY 1)
              FULL JOIN (SELECT 'conv-' || (o_orderkey // 200) AS source_document, count(DISTINCT o_orderkey // 20) AS t
                         FROM orders GROUP BY 1) USING (source_document)
              FULL JOIN (SELECT source_document, count(*) AS c FROM chunks GROUP BY 1) USING (source_document)""",
        ),
        "text_dump": query([PARAGRAPHS], "SELECT source_document, array_to_string(paragraphs, chr(10)) AS text FROM docs"),
    }


ORACLE = _oracle()
