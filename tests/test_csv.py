"""The CSV reader against Spark's multi-line reader, pandas, and Python's csv module, whole and split over many tasks."""

import csv
import io
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsflow.sources import csv_tables
from obsflow.sources.csv_tables import MISSING, read_csv_tables, read_lines, split_states


def random_cell(rng):
    kind = rng.randrange(8)
    if kind == 0:
        return rng.choice(["", "NA", "n/a", "x", "12", " padded ", "\u00e9\u4e2d"])
    return "".join(rng.choice('ab ,"\n,"') for _ in range(rng.randrange(12)))


def write_random(path, seed, rows=400, ending="\n"):
    rng = random.Random(seed)
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=ending, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]))
    table = [[random_cell(rng) for _ in range(rng.randrange(1, 6))] for _ in range(rows)]
    table = [r if any(r) and "".join(r).strip() else ["kept", *r] for r in table]
    for r in table:
        writer.writerow(r)
    path.write_bytes(out.getvalue().encode())
    return table


def cells_by_file(rows):
    out = {}
    for r in rows.select("table_id", "row_idx", "cells").collect():
        out.setdefault(r.table_id.split("/")[-1].removesuffix("#0"), {})[r.row_idx] = r.cells
    return {name: [found[i] for i in sorted(found)] for name, found in out.items()}


def missing(table):
    return [[None if c in MISSING else c for c in r] for r in table]


@pytest.mark.parametrize("split", ["128MB", "1KB"])
def test_random_files(spark, tmp_path, split):
    """Quoted commas, line breaks and quotes, any widths; each file in one split or in many."""
    tables = {}
    for seed in range(6):
        tables[f"t{seed}.csv"] = write_random(tmp_path / f"t{seed}.csv", seed, ending="\r\n" if seed == 5 else "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "4MB" if split == "128MB" else "1")
    try:
        lines = read_lines(spark, [str(tmp_path)])
        n_splits = lines.select("path", "split").distinct().count()
        assert n_splits == 6 if split == "128MB" else n_splits > 30
        if split == "1KB":
            assert split_states(lines).where("inside").count() > 3  # some splits begin inside quotes
        got = cells_by_file(read_csv_tables(spark, [str(tmp_path)])[1])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {name: missing(t) for name, t in tables.items()}


def test_against_the_multi_line_reader(spark, tmp_path):
    table = write_random(tmp_path / "one.csv", 11, 300)
    wide = ", ".join(f"c{i} string" for i in range(6))
    reader = spark.read.option("multiLine", "true").option("escape", '"').schema(wide)
    want = [[c or None for c in r] for r in reader.csv(str(tmp_path)).collect()]
    want = [[None if c in MISSING else c for c in r] for r in want]
    got = cells_by_file(read_csv_tables(spark, [str(tmp_path)])[1])["one.csv"]
    assert [r + [None] * (6 - len(r)) for r in got] == want and len(got) == len(table)


ODD_TEXTS = [
    'a,b\n1,"x"y"z\n',  # text after a closing quote, quotes inside plain cells
    'a,b\n1,5" pipe\n"q",2\n',
    'a,b\n\n  \t\n1,2\n\n',  # blank lines
    'a,b\n"",NA\n" ",x\n',
    'a,b\n"two\n\n  \nlines",2\n',  # blank lines inside quotes stay
    'a,b\n1,2',
    'a,b\r\n"x\r\ny",2\r\n',
    'a,b\n"""q""",""""\n',
]


def test_odd_texts_against_pandas(spark, tmp_path):
    for i, text in enumerate(ODD_TEXTS):
        (tmp_path / f"f{i}.csv").write_bytes(text.encode())
    got = cells_by_file(read_csv_tables(spark, [str(tmp_path)])[1])
    for i, text in enumerate(ODD_TEXTS):
        frame = pd.read_csv(io.BytesIO(text.encode()), header=None, dtype=str)
        want = [[None if pd.isna(c) else c for c in r] for r in frame.values.tolist()]
        assert got[f"f{i}.csv"] == want, text


def test_unclosed_quote_and_empty_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"rest, of\nthe file\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n \n")
    (tmp_path / "header.csv").write_text("a,b\n")
    tables, rows = read_csv_tables(spark, [str(tmp_path)])
    assert [r.source_document.split("/")[-1] for r in tables.collect()] == ["open.csv"]
    assert cells_by_file(rows)["open.csv"] == [["a", "b"], ["1", "rest, of\nthe file"]]


def test_many_commas_and_quotes_in_a_cell(spark, tmp_path):
    words = ",".join(f"w{i}" for i in range(25_000))
    quotes = '""' * 20_000
    (tmp_path / "a.csv").write_text(f'id,text,more\n1,"{words}",x\n2,"{quotes}",y\n' + "3" + ",z" * 20_000 + "\n")
    began = time.time()
    got = cells_by_file(read_csv_tables(spark, [str(tmp_path)])[1])["a.csv"]
    assert got[1] == ["1", words, "x"] and got[2] == ["2", '"' * 20_000, "y"] and got[3] == ["3"] + ["z"] * 20_000
    assert time.time() - began < 20


def test_one_scan_and_row_order(spark, tmp_path):
    (tmp_path / "big.csv").write_text("n,text\n" + "".join(f'{i},"{"x" * (i % 50)}\ny"\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        _, rows = read_csv_tables(spark, [str(tmp_path)])
        data = rows.where("row_idx >= 0")
        assert data.where(F.get("cells", F.lit(0)).cast("long") != F.col("row_idx")).count() == 0
        assert data.count() == 20_000
        assert "big.csv" not in rows._jdf.queryExecution().toString()  # the file was read once, into the staged lines
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_effects(spark):
    """What a line does to the state, against walking along its characters."""

    def walk(line, inside):
        at_start, closing = True, False
        state = "quoted" if inside else "start"
        i = 0
        while i < len(line):
            ch = line[i]
            if state == "quoted":
                if ch == '"':
                    if line[i + 1 : i + 2] == '"':
                        i += 1
                    else:
                        state = "plain"
            elif ch == ",":
                state = "start"
            elif state == "start" and ch == '"':
                state = "quoted"
            else:
                state = "plain"
            i += 1
        return state == "quoted"

    rng = random.Random(2)
    lines = ["".join(rng.choice('a,"') for _ in range(rng.randrange(14))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for r in df.select("line", csv_tables.line_effect(F.col("line")).alias("e")).collect():
        leaves = {
            csv_tables.KEEPS: (False, True), csv_tables.OUTSIDE: (False, False),
            csv_tables.INSIDE: (True, True), csv_tables.TURNS: (True, False),
        }[r.e]
        assert leaves == (walk(r.line, False), walk(r.line, True)), r.line
