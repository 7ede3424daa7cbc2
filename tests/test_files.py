"""File readers, writers and the whole batch on files made here."""

import uuid
import zipfile

import pytest
from pyspark.sql import functions as F

from obsflow.operators.headers import known_headers
from obsflow.operators.query import get_chunks, query_observations
from obsflow.plans.batch import run_batch
from obsflow.plans.staging import scratch_mark
from obsflow.sinks import batches, store
from obsflow.sources import files as S
from obsflow.sources import ooxml
from obsflow.sources.csv_tables import read_csv_tables

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def para(*texts):
    return "<w:p>" + "".join(f"<w:r><w:t>{t}</w:t></w:r>" for t in texts) + "</w:p>"


def cell(text, props=""):
    return f"<w:tc><w:tcPr>{props}</w:tcPr>{para(text)}</w:tc>"


def write_docx(path):
    rows = [
        cell("Area report", '<w:gridSpan w:val="2"/>'),
        cell("District", '<w:vMerge w:val="restart"/>') + cell("Sown"),
        cell("", "<w:vMerge/>") + cell(" Total "),
        cell("Shimoga") + cell("1,000"),
        cell("Mysore") + cell("800"),
    ]
    table = "<w:tbl>" + "".join(f"<w:tr>{r}</w:tr>" for r in rows) + "</w:tbl>"
    body = para("Kharif ", "report") + para("  ") + para("a b c d e f") + table + para("tail")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        z.writestr("word/media/chart.png", b"\x89PNG")


def write_xlsx(path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sheet = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="inlineStr"><is><t>When</t></is></c></row>'
        '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>0.00001</v></c><c r="C2" s="1"><v>45863</v></c></row>'
        '<row r="4"><c r="B4"><v>7</v></c></row>'
    )
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook {main} {rel}><sheets><sheet name="S1" sheetId="1" r:id="rId1"/>'
            '<sheet name="Empty" sheetId="2" r:id="rId2"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId2" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        )
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>District</t></si><si><t>Rain</t></si><si><r><t>Ko</t></r><r><t>lar</t></r></si></sst>")
        z.writestr("xl/styles.xml", f'<styleSheet {main}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>{sheet}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {main}><sheetData/></worksheet>")


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("in")
    (base / "sub").mkdir()
    write_docx(base / "Kharif 26.docx")
    write_xlsx(base / "sub" / "rain.XLSX")
    (base / "a b+c.csv").write_text('District,Beds,,Beds\nKolar,"1,200",NA,3\n"Two\nlines",5,"say ""hi""",\n')
    (base / "wide.csv").write_text("h1,h2,h3,h4,h5,h6\n1,2,3,4,5,6\n")
    (base / "header-only.csv").write_text("x,y\n")
    (base / "notes.txt").write_text("no")
    return str(base)


def test_dispatch(spark, folder):
    files = S.list_files(spark, [folder])
    assert sorted(r.extension for r in files.where("supported").collect()) == [".csv"] * 3 + [".docx", ".xlsx"]
    assert [r.reason for r in S.rejects(files).collect()] == ["Unsupported file format: .txt"]


def test_docx(spark, folder):
    parts = ooxml.parse_docx(S.binary_files(spark, [folder], ".docx"))
    paragraphs = ooxml.docx_paragraphs(parts).orderBy("para_idx").collect()
    assert [(r.para_idx, r.text) for r in paragraphs] == [(0, "Kharif report"), (1, "a b c d e f"), (2, "tail")]
    tables, rows = ooxml.docx_tables(parts)
    assert [r.source_page for r in tables.collect()] == ["native-table-0"]
    assert [r.cells for r in rows.orderBy("row_idx").collect()] == [
        ["Area report", "Area report"],
        ["District", "Sown"],
        ["District", "Total"],
        ["Shimoga", "1,000"],
        ["Mysore", "800"],
    ]
    assert [(r.name, bytes(r.content)) for r in ooxml.docx_media(parts).collect()] == [("chart.png", b"\x89PNG")]


def test_xlsx(spark, folder):
    tables, rows = ooxml.xlsx_tables(ooxml.parse_xlsx(S.binary_files(spark, [folder], ".xlsx")))
    assert [r.source_page for r in tables.collect()] == ["sheet-S1"]
    assert [(r.row_idx, r.cells) for r in rows.orderBy("row_idx").collect()] == [
        (-1, ["District", "Rain", "When"]),
        (0, ["Kolar", "0.00001", "2025-07-25"]),
        (1, []),
        (2, [None, "7"]),
    ]


def test_csv(spark, folder):
    tables, rows = read_csv_tables(spark, [folder])
    assert sorted(r.source_document.split("/")[-1] for r in tables.collect()) == ["a b+c.csv", "wide.csv"]
    mine = rows.where(F.col("table_id").contains("a b+c")).orderBy("row_idx").collect()
    assert [(r.row_idx, r.cells[:4]) for r in mine] == [
        (-1, ["District", "Beds", None, "Beds"]),
        (0, ["Kolar", "1,200", None, "3"]),
        (1, ["Two\nlines", "5", 'say "hi"', None]),
    ]
    headers = {r.table_id.split("/")[-1]: r.headers for r in known_headers(rows).collect()}
    assert headers["a b+c.csv#0"] == ["District", "Beds", "Unnamed: 2", "Beds.1"]


def answering():
    def provider(prompt):
        if "Rain" in prompt:
            value, more = "rain", ', "2": {"field": "date"}'
        else:
            value, more = "sown", ""
        return (
            '{"_entity_column": 0, "_entity_type": "district", "_entity_type_confidence": 0.9, '
            '"_domain": "agriculture", "0": {"field": "entity_name"}, '
            f'"1": {{"field": "value", "indicator": "{value}"}}{more}}}'
        )

    return provider


def test_batch(spark, folder, tmp_path):
    out, before = str(tmp_path / "out"), scratch_mark(spark)
    obs, chunks = run_batch(spark, [folder], out, 2025, answering(), lambda p: '{"domain": "Agriculture"}')
    got = {(r.source_document, r.entity_name, r.indicator, r.value) for r in obs.collect()}
    assert ("Kharif 26.docx", "Shivamogga", "sown", 1000.0) in got
    assert ("Kharif 26.docx", "Mysuru", "sown", 800.0) in got
    assert ("rain.XLSX", "Kolar", "rain", 0.00001) in got and ("rain.XLSX", "Kolar", "rain", 7.0) in got
    assert ("a b+c.csv", "Kolar", "sown", 1200.0) in got
    rain = obs.where("indicator = 'rain' AND value < 1").first()
    assert rain.date.isoformat() == "2025-07-25" and rain.source_page == "sheet-S1" and rain.extraction_method == "xlsx"
    read = get_chunks(chunks, "Kharif 26.docx", "agriculture").collect()
    assert [(r.chunk_index, r.chunk_text) for r in read] == [(0, "Kharif report a b c d e f"), (1, "tail")]
    text = batches.read_table(spark, out, "text").orderBy("source_document", "para_idx").collect()
    assert [r.text for r in text] == ["Kharif report", "a b c d e f", "tail"]
    assert spark.read.parquet(f"{out}/staging/media").count() == 1
    assert scratch_mark(spark) == before
    plan = query_observations(obs, domain="agriculture", indicator="sown")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(domain" in plan and "EqualTo(indicator,sown)" in plan


def test_widths_do_not_meet(spark, tmp_path):
    (tmp_path / "two.csv").write_text("District,Beds\nKolar,1\n")
    alone = [r.cells for r in read_csv_tables(spark, [str(tmp_path)])[1].orderBy("row_idx").collect()]
    (tmp_path / "six.csv").write_text("a,b,c,d,e,f\n1,2,3,4,5,6\n")
    _, rows = read_csv_tables(spark, [str(tmp_path)])
    beside = rows.where(F.col("table_id").contains("two.csv")).orderBy("row_idx").collect()
    assert [r.cells for r in beside] == alone == [["District", "Beds"], ["Kolar", "1"]]


def test_docx_runs_only():
    tabs = '<w:pPr><w:tabs><w:tab w:val="left" w:pos="720"/></w:tabs></w:pPr>'
    link = "<w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink>"
    p = ooxml.ET.fromstring(f"<w:p {W}>{tabs}<w:r><w:t>a</w:t><w:tab/><w:t>b</w:t></w:r>{link}</w:p>")
    assert ooxml._paragraph_text(p) == "a\tblink"


def rejected(spark, out):
    rows = batches.read_table(spark, out, "rejects").collect()
    return {(r.item.split("/")[-1], r.step, r.reason) for r in rows}


def test_nothing_is_lost(spark, tmp_path):
    """A PDF without pages, a broken archive, an unreadable reply, a failing provider, a year beyond any calendar."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "a.pdf").write_bytes(b"%PDF")
    (source / "broken.docx").write_bytes(b"no archive")
    (source / "odd.csv").write_text("District,Rain\nKolar,NA\n")
    (source / "fails.csv").write_text("District,Hail\nKolar,3\n")
    (source / "years.csv").write_text("District,Year,Sown\nKolar,99999999999,1\nKolar,2024,2\nKolar,,3\n")

    def provider(prompt):
        if "Rain" in prompt:
            return "no json here"
        if "Hail" in prompt:
            raise ValueError("quota")
        return (
            '{"_entity_column": 0, "_entity_type": "district", "_domain": "agriculture", "0": {"field": "entity_name"}, '
            '"1": {"field": "year"}, "2": {"field": "value", "indicator": "sown"}}'
        )

    obs, _ = run_batch(spark, [str(source)], out, 2025, provider, lambda p: "{}")
    found = rejected(spark, out)
    assert ("a.pdf", "reading", "PDF pages were not supplied as page tables") in found
    assert any(item == "broken.docx" and reason.startswith("unreadable file") for item, _, reason in found)
    assert ("odd.csv#0", "mapping", "unreadable reply") in found
    assert ("fails.csv#0", "mapping", "provider failed: quota") in found and len(found) == 4
    lost = batches.read_table(spark, out, "observations_rejected").collect()
    assert [(r.value, r.reason) for r in lost] == [(1.0, "missing year")]
    assert sorted((r.value, r.year) for r in obs.collect()) == [(2.0, 2024), (3.0, 2025)]


def test_supplied_pdf_is_no_reject(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    files = S.list_files(spark, [str(tmp_path)])
    paged = spark.createDataFrame([("a.pdf",)], "doc string")
    assert S.rejects(files).count() == 1 and S.rejects(files, paged).count() == 0


def test_second_run_asks_nothing(spark, folder, tmp_path):
    out, calls = str(tmp_path / "out"), tmp_path / "calls"
    calls.mkdir()
    answer = answering()

    def provider(prompt):
        (calls / uuid.uuid4().hex).write_text("")
        return answer(prompt)

    first, _ = run_batch(spark, [folder], out, 2025, provider, lambda p: "{}")
    n, asked = first.count(), len(list(calls.iterdir()))
    assert asked == 4
    again, _ = run_batch(spark, [folder], out, 2025, provider, lambda p: "{}")
    assert len(list(calls.iterdir())) == asked and again.count() == 2 * n
    assert batches.newest_text(spark, out).count() == 3  # replaced, not doubled
    skipped, _ = run_batch(spark, [folder], out, 2025, provider, lambda p: "{}", skip_loaded=True)
    assert skipped.count() == 2 * n and len(list(calls.iterdir())) == asked


def test_equal_names_stay_apart(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / "in" / name).mkdir(parents=True)
        write_docx(tmp_path / "in" / name / "report.docx")
    out = str(tmp_path / "out")
    obs, chunks = run_batch(spark, [str(tmp_path / "in")], out, 2025, answering(), lambda p: "{}")
    read = get_chunks(chunks, "report.docx").collect()
    assert [(r.document_id.split("/")[-2], r.chunk_index) for r in read] == [("x", 0), ("x", 1), ("y", 0), ("y", 1)]
    assert obs.select("document_id").distinct().count() == obs.select("table_id").distinct().count() == 2
    assert batches.read_table(spark, out, "documents").count() == 2


def test_store(spark, tmp_path):
    rows = [("KIMS", "hospital", None, 2025, "beds", 500.0), ("Q", "hospital", "health", 2025, "beds", float("nan"))]
    rows.append((None, "hospital", "health", 2025, "beds", 1.0))
    df = spark.createDataFrame(
        rows, "entity_name string, entity_type string, domain string, year int, indicator string, value double"
    )
    _, bad = store.split_not_null(store.conform(df))
    assert bad.count() == 1
    path = str(tmp_path / "obs")
    store.append_observations(df, path)
    store.append_observations(df.where("entity_name = 'KIMS'"), path)
    back = store.read_observations(spark, path)
    assert sorted((r.entity_name, r.domain, r.value, r.validation_flag) for r in back.collect()) == [
        ("KIMS", None, 500.0, False),
        ("KIMS", None, 500.0, False),
        ("Q", "health", None, False),
    ]
    assert [r.reason for r in spark.read.parquet(f"{path}_rejected").collect()] == ["missing entity_name"]
    old = df.drop("domain")
    assert store.merge_versions(old, df).where("domain IS NULL").count() == 4
