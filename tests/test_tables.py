"""Headers, mapping, filling, normalisation and validation on hand-made tables."""

import datetime
import random
import time

import pytest
from pyspark.sql import functions as F

from obsflow.operators import gazetteer as G
from obsflow.operators import headers as H
from obsflow.operators import mapping as M
from obsflow.operators import normalize as N
from obsflow.operators import query as Q
from obsflow.operators import validate as V
from obsflow.plans import batch
from obsflow.plans.batch import process_tables
from obsflow.plans.skew import attach, dense_index
from obsflow.plans.staging import stage
from obsflow.schemas import COLUMN_MAP, RAW_ROWS, RAW_TABLES, REPLIES, TABLE_META


def raw(spark, grids):
    rows = [(t, i, cells, False) for t, grid in grids.items() for i, cells in enumerate(grid)]
    tables = [(t, "doc.docx", f"page-{t}", "test") for t in grids]
    return spark.createDataFrame(rows, RAW_ROWS), spark.createDataFrame(tables, RAW_TABLES)


@pytest.mark.parametrize(
    "cells,kind",
    [
        (["T", "T", "T"], "banner"),
        ([None, None, None], "blank"),
        (["1", "2", "3"], "index"),
        (["5", "5", "5"], "banner"),
        (["District", "Area", "Area"], "header"),
        (["1", "Kolar", "20", "30"], "data"),
        (["", "", ""], "banner"),
        (["", "x", "", ""], "header"),
        ([None, "2"], "data"),
        (["01", None, "3"], "index"),
    ],
)
def test_row_kinds(spark, cells, kind):
    rows, _ = raw(spark, {"a": [cells]})
    assert H.classify_rows(rows).first().kind == kind


def test_headers(spark):
    rows, _ = raw(
        spark,
        {
            "a": [
                ["Report"] * 3,
                ["District", "Area", "Area"],
                ["District", "Irrigated", "Total"],
                ["1", "2", "3"],
                ["Kolar", "1,200", "30"],
                ["x", "y", "z"],
            ],
            "b": [[None] * 3, ["5", "5", "5"], ["Name", "Sown", "129|"], ["1", "Kolar", "20"]],
            "c": [["only"], ["text"]],
        },
    )
    found = {r.table_id: (r.headers, r.data_start) for r in H.detect_headers(rows).collect()}
    assert found["a"] == (["District", "Area - Irrigated", "Area - Total"], 4)
    assert found["b"] == (["Name", "Sown", None], 3)
    assert found["c"] == (["only - text"], 2)
    samples = H.table_samples(rows, stage(H.data_starts(rows)))
    assert {r.table_id: r.sample_rows for r in samples.collect()} == {
        "a": [["Kolar", "1,200", "30"], ["x", "y", "z"]],
        "b": [["1", "Kolar", "20"]],
    }


def test_padding(spark):
    rows, _ = raw(spark, {"a": [["x"], ["y", "z", "w"]]})
    assert sorted(r.cells for r in H.pad_rows(rows).collect()) == [["x", None, None], ["y", "z", "w"]]


@pytest.mark.parametrize(
    "headers,want",
    [
        (["School", "2010 - Enrol", "2011 - Enrol", "2012 - Enrol"], ["School", "2010", "2011", "2012"]),
        (["Crop - Sown", "Crop - Total", "Name"], ["Sown", "Total", "Name"]),
        (["a - x", "b - x"], ["a - x", "b - x"]),
        ([None, "a - x", "b - y"], ["", "a - x", "b - y"]),
        (["p - q - x", "r - q - x", None, "s"], ["p - q", "r - q", "", "s"]),
    ],
)
def test_compact_headers(spark, headers, want):
    df = spark.createDataFrame([("a", headers)], "table_id string, headers array<string>")
    assert M.compact_headers(df).first().headers == want


def plain_compact(headers):
    texts = [h or "" for h in headers]
    if len(headers) < 3:
        return headers
    for at in (-1, 0):
        parts = [t.split(" - ") for t in texts]
        ends = [p[at].strip() for p in parts if len(p) > 1]
        best = min(((-ends.count(e), e) for e in set(ends)), default=(0, ""))
        if -best[0] >= max(2, len(headers) // 2):
            cut = lambda p: " - ".join(p[:-1] if at else p[1:]).strip()  # noqa: E731, B023
            return [cut(p) if len(p) > 1 and p[at].strip() == best[1] else t for t, p in zip(texts, parts)]
    return texts


def test_compact_random_headers(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        n = rng.randrange(3, 12)
        rows.append((str(i), [" - ".join(rng.choices("ab ", k=rng.randrange(1, 4))) if rng.random() < 0.9 else None for _ in range(n)]))
    df = spark.createDataFrame(rows, "table_id string, headers array<string>")
    got = {r.table_id: r.headers for r in M.compact_headers(df).collect()}
    assert got == {i: plain_compact(h) for i, h in rows}


def test_compact_wide_table(spark):
    """20,000 columns, all different but for the last part of most: time in proportion to the columns."""
    headers = [f"c{i} - {'share' if i % 3 else i}" for i in range(20_000)]
    df = spark.createDataFrame([("a", headers)], "table_id string, headers array<string>")
    began = time.time()
    assert M.compact_headers(df).first().headers == plain_compact(headers)
    assert time.time() - began < 20


def test_a_deep_header_moves_only_its_own_rows(spark):
    """One table with a long header: what is read of the others does not grow, and every table keeps its headers."""
    deep = [("deep", i, ["name" if i < 500 else "x", f"part {i}" if i < 500 else "1"]) for i in range(600)]
    rest = [(f"t{n}", i, ["Name" if not i else "x", "Value" if not i else "5"]) for n in range(20) for i in range(300)]
    rows = spark.createDataFrame(deep + rest, "table_id string, row_idx long, cells array<string>")
    starts = stage(H.data_starts(rows))
    top = H._top_rows(rows, starts, -1)
    assert top.where("table_id = 'deep'").count() == 500 and top.where("table_id <> 'deep'").count() == 20
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "(row_idx" in plan and " > 64" in plan and "BroadcastHashJoin" in plan
    assert sorted(map(tuple, top.select("table_id", "row_idx").collect())) == sorted(
        map(tuple, H._top_rows(rows, starts, -1, shallow=10_000).select("table_id", "row_idx").collect())
    )
    headers = {r.table_id: r.headers for r in H.detect_headers(rows).collect()}
    assert headers["t3"] == ["Name", "Value"] and headers["deep"][0] == "name" and headers["deep"][1].count(" - ") == 499


def test_replies(spark):
    spec = '"0": {"field": "entity_name"}, "1": {"field": "value", "indicator": "a"}'
    more = '"2": {"field": "value", "indicator": "b"}, "3": {"field": "value", "indicator": "a", "unit": null}'
    last = '"4": {"field": "value", "indicator": "a"}, "x": {"field": "value"}, "10": {"field": "value"}'
    replies = spark.createDataFrame(
        [
            ("fenced", '```json\n{"_entity_type": "Planet", "_entity_type_confidence": 1.7, "_domain": "NULL"}\n```'),
            ("around", f'Sure: {{"_entity_column": 0, "domain": " Health ", {spec}, {more}, {last}}} bye'),
            ("broken", "{nothing"),
        ],
        REPLIES,
    )
    meta, columns = M.read_replies(replies)
    got = {r.table_id: r for r in meta.collect()}
    assert set(got) == {"fenced", "around"}
    assert got["fenced"][1:] == (None, "other", 1.0, M.DEFAULT_REASON, None)
    assert got["around"][1:] == (0, "other", 0.0, M.DEFAULT_REASON, "health")
    named = {r.col_idx: (r.field, r.indicator, r.unit) for r in columns.where("table_id = 'around'").collect()}
    assert named[1] == ("value", "a", "")
    assert named[2] == ("value", "b", "")
    assert named[3] == ("value", "a_2", None)
    assert named[4] == ("value", "a_3", "")
    assert named[10] == ("value", "value_col_10", "")
    assert len(named) == 6


def entities(spark, column, block_rows):
    rows, tables = raw(spark, {"a": [[c] for c in column], "b": [["only"], [None]]})
    grid = N.Grid(rows, block_rows)
    named = grid.with_tables(tables.select("table_id")).withColumn("entity_raw", F.get("cells", F.lit(0)))
    out = N.forward_fill(grid, named)
    return [(r.row_idx, r.entity) for r in out.where("table_id = 'a'").orderBy("row_idx").collect()]


@pytest.mark.parametrize("block_rows", [1, 2, 3, 100])
def test_forward_fill_any_block(spark, block_rows):
    assert entities(spark, ["A", None, "", "nan", None, "B", " ", None, None], block_rows) == [
        (0, "A"), (1, "A"), (2, "A"), (5, "B"), (6, "B"), (7, "B"), (8, "B"),
    ]


@pytest.mark.parametrize("block_rows", [1, 2, 100])
def test_sticky_period_any_block(spark, block_rows):
    column = ["01.06.2025", "Kharif", "", "02.06.2025", "Rabi", "03.06.2025"]
    # The first row has no entity yet, so its odd date does not count.
    rows, tables = raw(spark, {"a": [["", "Early"]] + [["A" if i == 0 else "", d] for i, d in enumerate(column)]})
    grid = N.Grid(rows, block_rows)
    cells = {"entity_raw": F.get("cells", F.lit(0)), "date_raw": F.get("cells", F.lit(1))}
    out = N.fill_and_stick(grid, grid.with_tables(tables.select("table_id")).withColumns(cells))
    got = [(r.date and r.date.day, r.sticky) for r in out.orderBy("row_idx").collect()]
    assert got == [(1, None), (None, "Kharif"), (None, "Kharif"), (2, "Kharif"), (None, "Kharif"), (3, "Kharif")]


def district_case(spark):
    rows, tables = raw(spark, {"a": [["Shimoga", "1000"], ["Mysore", "800"]]})
    meta = spark.createDataFrame([("a", 0, "district", 0.95, "District names", "agriculture")], TABLE_META)
    columns = spark.createDataFrame(
        [("a", 0, 0, "entity_name", None, None), ("a", 1, 1, "value", "sown_area", "ha")], COLUMN_MAP
    )
    return rows, tables, meta, columns


def test_domain_flows_through(spark):
    obs = N.normalize_tables(*district_case(spark), 2025)
    done = V.validate_observations(obs).orderBy("row_idx").collect()
    assert [(r.entity_name, r.value, r.confidence, r.entity_resolution_method) for r in done] == [
        ("Shivamogga", 1000.0, 0.95, "exact_alias"),
        ("Mysuru", 800.0, 0.95, "exact_alias"),
    ]
    assert {(r.domain, r.year, r.date, r.period, r.validation_flag, r.validation_reason) for r in done} == {
        ("agriculture", 2025, None, None, False, "")
    }


def test_normalize_columns_and_defaults(spark):
    grid = [
        ["Name", "Year", "When", "Season", "V", "W"],
        ["KIMS", "2024", "5.7.2025", " K1 ", "1,000", "x"],
        ["", "0", "soon", "", "5", "2"],
        ["Bowring", "2023.7", "", None, "-", "7"],
        ["short"],
    ]
    rows, tables = raw(spark, {"a": grid, "none": [["x", "1"]]})
    meta = spark.createDataFrame(
        [("a", None, "hospital", 0.5, "r", None), ("none", None, "hospital", 0.5, "r", None)], TABLE_META
    )
    fields = ["entity_name", "year", "date", "period", "value", "value"]
    names = [None, None, None, None, "beds", None]
    columns = spark.createDataFrame(
        [("a", i, i, f, n, "") for i, (f, n) in enumerate(zip(fields, names))] + [("none", 0, 1, "value", "v", "")],
        COLUMN_MAP,
    )
    starts = spark.createDataFrame([("a", 1), ("none", 0)], "table_id string, data_start long")
    for block_rows in (1, 2, 100):
        obs = N.normalize_tables(
            rows, tables, meta, columns, 2025, starts=starts, default_date="2020-01-01", block_rows=block_rows
        )
        got = [
            (r.row_idx, r.entity_name, r.year, r.date.isoformat(), r.period, r.indicator, r.value)
            for r in obs.orderBy("row_idx", "col_idx").collect()
        ]
        assert got == [
            (1, "KIMS", 2024, "2025-07-05", "K1", "beds", 1000.0),
            (2, "KIMS", 2025, "2020-01-01", "soon", "beds", 5.0),
            (2, "KIMS", 2025, "2020-01-01", "soon", "value_col_5", 2.0),
            (3, "Bowring", 2023, "2020-01-01", "soon", "value_col_5", 7.0),
        ]
    fixed = N.normalize_tables(rows, tables, meta, columns, 2025, starts=starts, default_period="FY")
    assert {r.period for r in fixed.collect()} == {"K1", "FY"}


def test_gazetteer(spark):
    want = {
        "1. Shimoga": ("Shivamogga", 1.0, "exact_alias"),
        "Bengaluru (Urban)": ("Bengaluru Urban", 1.0, "exact_alias"),
        "Kolar District": ("Kolar", 1.0, "exact_alias"),
        "Kodagū": ("Kodagu", 1.0, "exact_alias"),
        "XY": (None, 0.0, "unresolved_short_input"),
        "nan": (None, 0.0, "empty_input"),
        "Shivamoga": ("Shivamogga", 0.95, "fuzzy_match"),
        "Koler": (None, 0.0, "unresolved"),
        "D.K.": (None, 0.0, "unresolved_short_input"),
        "DK": ("Dakshina Kannada", 1.0, "exact_alias"),
        "bengaluru": ("Bengaluru Rural", 1.0, "fuzzy_match"),
    }
    df = spark.createDataFrame([(i, n) for i, n in enumerate([*want, *want])], "id int, name string")
    got = G.resolve_districts(df, "name", ["id"]).collect()
    assert len(got) == 2 * len(want)
    assert {r.name: (r.canonical, r.resolution_confidence, r.resolution_method) for r in got} == want


def observation(**changes):
    base = dict(
        table_id="a", row_idx=0, col_idx=1, entity_name="X", entity_type="hospital",
        entity_resolution_method="groq_entity_type", domain="health", year=2025, indicator="n", value=5.0, unit="",
        confidence=1.0,
    )
    return {**base, **changes}


RULE_CASES = [
    (dict(), ""),
    (dict(entity_type=" "), "missing_entity_type"),
    (dict(domain=""), "missing_domain"),
    (dict(domain=None), ""),
    (dict(entity_type="district", entity_name="UNRESOLVED:q"), "unresolved_entity"),
    (dict(entity_name="UNRESOLVED:q"), ""),
    (dict(confidence=0.34, entity_resolution_method="Unresolved"), "very_low_confidence"),
    (dict(confidence=0.34), ""),
    (dict(value=float("nan")), "invalid_numeric_value"),
    (dict(value=float("inf")), "invalid_numeric_value"),
    (dict(indicator="PCT_coverage ", value=301.0), "out_of_range(301)"),
    (dict(unit="Percentage", value=300.0), ""),
    (dict(unit="%", value=300.5), "out_of_range(300.5)"),
    (dict(value=-5.0), "out_of_range(-5)"),
    (dict(value=1500000.0), "out_of_range(1.5e+06)"),
    (dict(entity_type="", domain="", value=-1.0), "missing_entity_type;missing_domain;out_of_range(-1)"),
]


def test_rules(spark):
    rows = [observation(table_id=str(i), **change) for i, (change, _) in enumerate(RULE_CASES)]
    schema = (
        "table_id string, row_idx long, col_idx int, entity_name string, entity_type string, "
        "entity_resolution_method string, domain string, year int, indicator string, value double, unit string, "
        "confidence double"
    )
    got = {r.table_id: r for r in V.validate_observations(spark.createDataFrame(rows, schema)).collect()}
    for i, (_, reason) in enumerate(RULE_CASES):
        assert (got[str(i)].validation_reason, got[str(i)].validation_flag) == (reason, bool(reason))
    twice = [observation(), observation(row_idx=1, value=-2.0), observation(row_idx=2, year=2024), observation(table_id="b")]
    got = V.validate_observations(spark.createDataFrame(twice, schema)).orderBy("table_id", "row_idx").collect()
    assert [(r.validation_reason, r.validation_flag) for r in got] == [
        ("duplicate_entry", False), ("out_of_range(-2);duplicate_entry", True), ("", False), ("", False),
    ]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_attach_hot_and_cold(spark, hot_rows):
    fact = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 10}", i % 3 > 0) for i in range(300)], "id int, k string, w boolean")
    fact = fact.union(spark.createDataFrame([(999, None, True)], "id int, k string, w boolean"))
    lookup = fact.groupBy("k").agg(F.count("*").alias("n_rows"), F.concat(F.lit("v"), F.coalesce("k", F.lit("?"))).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = attach(fact, stage(lookup), ["k"], ["id"], needed=F.col("w"), hot_keys=5, hot_rows=hot_rows).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(out) == 301
    assert all(r.v == (f"v{r.k or '?'}" if r.w else None) for r in out)


def test_dense_index(spark):
    df = spark.createDataFrame([("a", p) for p in (0, 3, 4, 9, 11, 12)] + [("b", 7)], "doc string, page int")
    for block in (1, 4, 100):
        got = dense_index(df, "doc", "page", "n", block).orderBy("doc", "page").collect()
        assert [r.n for r in got] == [0, 1, 2, 3, 4, 5, 0]


def mapper(domain):
    def provider(prompt):
        assert "District" in prompt or "Col_A" in prompt
        return (
            f'{{"_entity_column": 0, "_entity_type": "district", "_entity_type_confidence": 0.9, "_domain": {domain}, '
            '"0": {"field": "entity_name"}, "1": {"field": "value", "indicator": "fully_immunized_children"}}'
        )

    return provider


def test_same_domain_over_years(spark):
    years = {
        "2021": [["District", "Fully Immunized"], ["Belagavi", "45200"], ["Mysuru", "38900"]],
        "2022": [["District", "fully_immunized"], ["Belagavi", "46100"], ["Mysuru", "39500"]],
        "2023": [["District", "fully_immunized"], ["Belagavi", "47300"], ["Mysuru", "40200"]],
    }
    rows, tables = raw(spark, years)
    contexts = spark.createDataFrame([("doc.docx", "Child immunization")], "source_document string, context string")
    done = stage(process_tables(rows, tables, contexts, mapper('"Health"'), 2025))
    assert done.count() == 6
    assert {r.domain for r in done.collect()} == {"health"}
    assert Q.domain_consistency(done).count() == 0
    mixed = done.withColumn("domain", F.when(F.col("table_id") == "2022", "welfare").otherwise(F.col("domain")))
    assert [tuple(r) for r in Q.domain_consistency(mixed).collect()] == [("doc.docx", "fully_immunized_children", 2)]


def test_ambiguous_domain_is_null(spark):
    rows, tables = raw(spark, {"a": [["Col_A", "Col_B"], ["X123", "99"]]})
    contexts = spark.createDataFrame([], "source_document string, context string")
    done = process_tables(rows, tables, contexts, mapper("null"), 2025).collect()
    assert [(r.domain, r.entity_name, r.validation_reason) for r in done] == [
        (None, "UNRESOLVED:X123", "unresolved_entity;very_low_confidence")
    ]


def test_retry_rounds(spark, tmp_path, monkeypatch):
    """A provider that turns two calls in three away: nobody sleeps but the job, between rounds."""
    pauses = []
    monkeypatch.setattr(M, "_pause", pauses.append)

    def provider(prompt):
        tried = len(list(tmp_path.glob(f"{prompt}-*")))
        (tmp_path / f"{prompt}-{tried}").write_text("")
        if prompt == "fails":
            raise ValueError("no")
        if prompt == "never" or tried < 2:
            raise M.RateLimited("later")
        return f"reply to {prompt}"

    rows = [(f"t{i}", f"p{i}") for i in range(20)] + [("f", "fails"), ("n", "never")]
    requests = spark.createDataFrame(rows, "table_id string, prompt string")
    kept = []
    replies = M.map_tables(requests, provider, wait=7, tries=4, calls=3, keep=lambda df: kept.append(df.count()))
    got = {r.table_id: (r.reply, r.error) for r in replies.collect()}
    assert got == {
        **{f"t{i}": (f"reply to p{i}", None) for i in range(20)},
        "f": (None, "provider failed: no"),
        "n": (None, "provider failed: later"),
    }
    assert pauses == [7, 14, 21] and kept == [1, 0, 20, 1]
    assert len(list(tmp_path.glob("p3-*"))) == 3 and len(list(tmp_path.glob("fails-*"))) == 1


def test_document_domains(spark):
    contexts = spark.createDataFrame(
        [("a", "soil"), ("b", "fails"), ("c", None)], "source_document string, context string"
    )

    def provider(prompt):
        if "fails" in prompt:
            raise ValueError
        return '{"domain": "Agriculture "}'

    got = {r.source_document: r.domain for r in M.map_documents(M.domain_requests(contexts), provider).collect()}
    assert got == {"a": "agriculture", "b": None}


def test_query_filters(spark):
    rows = [
        ("A", "district", "health", 2024, datetime.date(2024, 5, 1), "K", "x", 0.0, False),
        ("A", "district", "health", 2025, None, None, "x", 10.0, True),
        ("B", "school", None, 2025, None, "K", "y", -3.0, False),
    ]
    df = spark.createDataFrame(
        rows,
        "entity_name string, entity_type string, domain string, year int, date date, period string, indicator string, "
        "value double, validation_flag boolean",
    )
    count = lambda **kw: Q.query_observations(df, **kw).count()
    assert count() == 2 and count(include_flagged=True) == 3
    assert count(year=0, indicator="", domain="", include_flagged=True) == 3
    assert count(min_value=0, include_flagged=True) == 2 and count(max_value=0) == 2
    assert count(date="2024-05-01", period="K", indicator="x", entity_type="district", domain="health") == 1
    assert Q.get_entity(df, "A").count() == 1 and Q.get_entity(df, "A", 2025, True).count() == 1
    assert Q.get_entity(df, "nobody").count() == 0


def test_ranges_do_not_move_observations(spark, capsys):
    """There are a handful of indicators: observations shuffled by them to meet their ranges would be a task each."""
    obs = spark.range(1000).selectExpr("concat('indicator ', id % 2) AS indicator", "'%' AS unit")
    brought = stage(spark.createDataFrame([("indicator 1", 5.0, 6.0)], "range_indicator string, lo double, hi double"))
    for ranges in (V.range_table(spark), brought):
        V._with_ranges(obs, ranges).explain()
        plan = capsys.readouterr().out
        assert "Broadcast" in plan and "hashpartitioning" not in plan
    got = {r.range_indicator: (r.lo, r.hi) for r in V.range_table(spark).collect()}
    assert got == V.KNOWN_RANGES


def test_replies_at_hand_are_written_before_they_are_parsed(spark, monkeypatch):
    """Else Spark parses each reply again for every row of what the replies are made from."""
    rows = spark.createDataFrame(
        [("a", 0, ["x", "1"], False), ("a", 1, ["y", "2"], False)],
        "table_id string, row_idx long, cells array<string>, header_known boolean",
    )
    tables = spark.createDataFrame(
        [("a", "d", "p", "m")], "table_id string, source_document string, source_page string, extraction_method string"
    )
    reply = '{"_entity_type": "crop", "0": {"field": "entity_name"}, "1": {"field": "value", "indicator": "n"}}'
    replies = spark.range(100).select(F.lit("a").alias("table_id"), F.lit(reply).alias("reply")).distinct()
    parsed, read = [], batch.read_replies
    monkeypatch.setattr(batch, "read_replies", lambda given: parsed.append(given) or read(given))
    done = batch.process_tables(rows, tables, None, replies, 2025)
    assert sorted((r.entity_name, r.value) for r in done.collect()) == [("x", 1.0), ("y", 2.0)]
    assert parsed[0].inputFiles()


def test_replies_at_hand_are_parsed_by_all_tasks(spark, monkeypatch):
    """Small size alone would leave them to one task."""
    replies = spark.range(500).selectExpr("concat('t', id) AS table_id", "'{}' AS reply").distinct()
    parsed, read = [], batch.read_replies
    monkeypatch.setattr(batch, "read_replies", lambda given: parsed.append(given) or read(given))
    rows, tables = raw(spark, {"t1": [["x", "1"]]})
    assert batch.process_tables(rows, tables, None, replies, 2025).count() == 0
    assert len(parsed[0].inputFiles()) == int(spark.conf.get("spark.sql.shuffle.partitions"))
