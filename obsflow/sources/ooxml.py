"""DOCX and XLSX files to paragraphs and raw tables: one file per record, many files in parallel.

These formats are zip archives, so a file is the unit of parallelism; only this parsing step runs in Python.
"""

import datetime
import io
import posixpath
import re
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import functions as F

from .csv_tables import MISSING

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_X = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_BREAKS = {_W + "tab": "\t", _W + "br": "\n", _W + "cr": "\n", _W + "noBreakHyphen": "-"}

# Built-in number formats that show dates or times (fixed values).
_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


# ---------------------------------------------------------------- DOCX


def _paragraph_text(p):
    """Text of the paragraph's runs, those in links included; its properties and text boxes hold none of it."""
    runs = []
    for node in p:
        runs += [node] if node.tag == _W + "r" else node.findall(_W + "r") if node.tag == _W + "hyperlink" else []
    parts = []
    for node in (node for run in runs for node in run):
        if node.tag == _W + "t":
            parts.append(node.text or "")
        elif node.tag in _BREAKS:
            parts.append(_BREAKS[node.tag])
    return "".join(parts)


def _cell_text(cell):
    return "\n".join(_paragraph_text(p) for p in cell.findall(_W + "p")).strip()


def _table_rows(table):
    """Rows of cell texts; a cell merged over columns or rows repeats its text in each place it covers."""
    above = {}
    for tr in table.findall(_W + "tr"):
        row = []
        for cell in tr.findall(_W + "tc"):
            props = cell.find(_W + "tcPr")
            span = None if props is None else props.find(_W + "gridSpan")
            merge = None if props is None else props.find(_W + "vMerge")
            goes_on = merge is not None and merge.get(_W + "val", "continue") == "continue"
            text = above.get(len(row), "") if goes_on else _cell_text(cell)
            for _ in range(1 if span is None else int(span.get(_W + "val", "1"))):
                above[len(row)] = text
                row.append(text)
        yield row


def _docx_parts(content):
    """(kind, table number, position, text, cells, name, bytes) for each paragraph, table row and media file."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(_W + "body")
        texts = (_paragraph_text(p).strip() for p in body.findall(_W + "p"))
        for i, text in enumerate(t for t in texts if t):
            yield "paragraph", None, i, text, None, None, None
        for n, table in enumerate(body.findall(_W + "tbl")):
            for i, cells in enumerate(_table_rows(table)):
                yield "row", n, i, None, cells, None, None
        for name in z.namelist():
            if name.startswith("word/media/") and not name.endswith("/"):
                yield "media", None, None, None, None, posixpath.basename(name), z.read(name)


# ---------------------------------------------------------------- XLSX


def _column_number(ref):
    n = 0
    for ch in re.match("[A-Z]+", ref).group():
        n = n * 26 + ord(ch) - 64
    return n - 1


def _date_styles(z):
    """Cell style numbers whose number format shows a date."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId"))
        for f in root.iter(_X + "numFmt")
        if re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "").lower()))
    }
    styles = root.find(_X + "cellXfs")
    formats = [] if styles is None else [int(x.get("numFmtId", 0)) for x in styles.findall(_X + "xf")]
    return {i for i, f in enumerate(formats) if f in _DATE_FORMATS or f in custom}


def _as_date(number, date1904):
    start = datetime.datetime(1904, 1, 1) if date1904 else datetime.datetime(1899, 12, 30)
    moment = start + datetime.timedelta(days=float(number))
    return moment.date().isoformat() if moment.time() == datetime.time() else moment.isoformat(" ", "seconds")


def _cell_value(c, shared, date_styles, date1904):
    kind, value = c.get("t", "n"), c.find(_X + "v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in c.iter(_X + "t"))
    if value is None or value.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "True" if value.text == "1" else "False"
    if kind == "n" and int(c.get("s", 0)) in date_styles:
        return _as_date(value.text, date1904)
    return value.text


def _xlsx_parts(content):
    """(sheet name, sheet number, row position, cells) of each row that is not past the end; streamed per sheet."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in si.iter(_X + "t")) for si in root.findall(_X + "si")]
        links = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        book = ET.fromstring(z.read("xl/workbook.xml"))
        props = book.find(_X + "workbookPr")
        date1904 = props is not None and props.get("date1904") in ("1", "true")
        date_styles = _date_styles(z)
        for n, sheet in enumerate(book.iter(_X + "sheet")):
            target = links[sheet.get(_R + "id")]
            path = target.lstrip("/") if target.startswith("/") else posixpath.normpath("xl/" + target)
            with z.open(path) as stream:
                last = -1
                for _, node in ET.iterparse(stream):
                    if node.tag != _X + "row":
                        continue
                    position = int(node.get("r", last + 2)) - 1
                    cells = []
                    for c in node.findall(_X + "c"):
                        at = _column_number(c.get("r")) if c.get("r") else len(cells)
                        cells.extend([None] * (at - len(cells)))
                        text = _cell_value(c, shared, date_styles, date1904)
                        cells.append(None if text == "" else text)
                    node.clear()
                    for blank in range(last + 1, position):
                        yield sheet.get("name"), n, blank, []
                    last = position
                    yield sheet.get("name"), n, position, cells


# ---------------------------------------------------------------- Spark side

_BATCH = 4096


def _parse(parts, columns):
    """mapInPandas function over (path, content): parse each file and emit its parts in bounded batches.

    A file that cannot be read gives one row with the error, beside the parts read before it.
    """

    def safely(content):
        try:
            for part in parts(content):
                yield (*part, None)
        except Exception as broken:
            yield (*[None] * (len(columns) - 2), f"unreadable file: {broken}"[:500])

    def run(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = []
                for part in safely(content):
                    rows.append((path, *part))
                    if len(rows) == _BATCH:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=columns)

    return run


DOCX_PARTS = (
    "path string, kind string, table_no long, idx long, text string, cells array<string>, name string, content binary, "
    "error string"
)
XLSX_PARTS = "path string, sheet string, sheet_no long, idx long, cells array<string>, error string"


def _names(schema):
    return [field.split()[0] for field in schema.split(", ")]


def parse_docx(files):
    """One row per paragraph, table row or media file of each DOCX file (path, content)."""
    return files.mapInPandas(_parse(_docx_parts, _names(DOCX_PARTS)), DOCX_PARTS)


def parse_xlsx(files):
    """One row per sheet row of each XLSX file (path, content)."""
    return files.mapInPandas(_parse(_xlsx_parts, _names(XLSX_PARTS)), XLSX_PARTS)


def _table_id(number):
    return F.concat_ws("#", "path", number).alias("table_id")


def docx_paragraphs(parts):
    """(source_document, para_idx, text); source_document holds the full path."""
    return parts.where("kind = 'paragraph'").select(
        F.col("path").alias("source_document"), F.col("idx").alias("para_idx"), "text"
    )


def docx_tables(parts):
    """(raw_tables, raw_rows) of the tables inside DOCX files."""
    rows = parts.where("kind = 'row'")
    page = F.concat(F.lit("native-table-"), F.col("table_no"))
    tables = rows.where("idx = 0").select(
        _table_id("table_no"),
        F.col("path").alias("source_document"),
        page.alias("source_page"),
        F.lit("native_docx_table").alias("extraction_method"),
    )
    return tables, rows.select(_table_id("table_no"), F.col("idx").alias("row_idx"), "cells")


def broken_files(parts):
    """(path, reason) of files that could not be read to their end."""
    return parts.where("error IS NOT NULL").select("path", F.col("error").alias("reason"))


def docx_media(parts):
    """(source_document, name, content) of the files embedded in DOCX files."""
    return parts.where("kind = 'media'").select(F.col("path").alias("source_document"), "name", "content")


def xlsx_tables(parts):
    """(raw_tables, raw_rows): one table per sheet with any row under its first, which is the header (row -1)."""
    tables = parts.where("idx = 1").select(
        _table_id("sheet_no"),
        F.col("path").alias("source_document"),
        F.concat(F.lit("sheet-"), F.col("sheet")).alias("source_page"),
        F.lit("xlsx").alias("extraction_method"),
    )
    cells = F.transform("cells", lambda c: F.when(~c.isin(*MISSING), c)).alias("cells")
    read = parts.where("sheet_no IS NOT NULL")
    return tables, read.select(_table_id("sheet_no"), (F.col("idx") - 1).alias("row_idx"), cells)
