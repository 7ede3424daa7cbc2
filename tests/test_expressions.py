"""Cell expressions against small Python functions written from the rules."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from obsflow.functions import dates, names, numbers, text
from obsflow.functions.fuzzy import partial_ratio, ratio, token_set_ratio, weighted_ratio

RNG = random.Random(7)


def applied(spark, values, expression, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    rows = df.select("i", expression(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.i)]


def some_strings(alphabet, n=3000, longest=9):
    return ["".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, longest))) for _ in range(n)]


def as_number(s):
    s = s.strip()
    if s.lower() in ("", "nan", "none") or re.search("[a-zA-Z]", s):
        return None
    try:
        return float(s.replace(",", ""))
    except ValueError:
        return None


def looks_numeric(s):
    s = s.replace(",", "").strip()
    if s == "" or s.lower() == "nan":
        return False
    try:
        float(s)
        return True
    except ValueError:
        return False


def as_date(s):
    for f in ("%d.%m.%Y", "%d-%m-%Y", "%Y-%m-%d", "%d/%m/%Y", "%d %B %Y", "%d %b %Y"):
        try:
            return datetime.datetime.strptime(s.strip(), f).date()
        except ValueError:
            pass


def test_number_goldens(spark):
    given = ["1,234.5", "107%", "5d", "n/a", "1_000", "", None, "1 ,", "१२", "9" * 400]
    want = [1234.5, None, None, None, 1000.0, None, None, 1.0, 12.0, float("inf")]
    assert applied(spark, given, numbers.parse_number) == want


def test_number_random(spark):
    given = some_strings("0123456789.,+-_ \t\xa0") + some_strings("12.eEinfad_, १")
    assert applied(spark, given, numbers.parse_number) == [as_number(s) for s in given]
    assert applied(spark, given, numbers.is_numeric) == [looks_numeric(s) for s in given]


def test_number_confidence(spark):
    given = ["12", "5d", "1-2", "", "nan", None]
    assert applied(spark, given, numbers.number_confidence) == [1.0, 0.2, 0.1, 0.0, 0.0, 0.0]


def test_year(spark):
    given = ["2024", "2023.7", "0", "2024-25", "99999999999", "-3.5", "0.5"]
    assert applied(spark, given, numbers.parse_year) == [2024, 2023, None, None, None, -3, 0]


def test_date_goldens(spark):
    given = ["5.7.2025", "2025-07-25", "25 july 2025", "30.02.2025", "5.7.25", "2025-07-25 00:00:00", None, " 1\t Feb  2020 "]
    d = datetime.date
    want = [d(2025, 7, 5), d(2025, 7, 25), d(2025, 7, 25), None, None, None, None, d(2020, 2, 1)]
    assert applied(spark, given, dates.parse_date) == want


def test_date_random(spark):
    months = ["January", "feb", "MAR", "Sept", "sep", "May", "Decembe", "december"]
    given = [
        f"{RNG.randint(0, 32)}{a}{RNG.choice([str(RNG.randint(0, 13)), RNG.choice(months)])}{b}{RNG.choice([0, 19, 1999, 2024])}"
        for a, b in RNG.choices([(".", "."), ("/", "/"), ("-", "-"), (" ", " "), (".", "/")], k=1500)
    ]
    given += [f"{RNG.randint(1990, 2030)}-{RNG.randint(0, 13):02}-{RNG.randint(0, 32)}" for _ in range(500)]
    assert applied(spark, given, dates.parse_date) == [as_date(s) for s in given]


def test_format_g(spark):
    given = [301.0, -5.0, 1500000.0, 1000005.0, 1000015.0, 123456.5, 1e20, 1e-5, 0.0001234, 0.0, 999999.5]
    given += [RNG.uniform(-2e6, 2e6) for _ in range(1000)] + [float(RNG.randint(0, 10**8)) for _ in range(1000)]
    assert applied(spark, given, numbers.format_g, "double") == [f"{x:g}" for x in given]


def test_round2_is_half_even(spark):
    assert applied(spark, [0.125, 0.375, 0.94737], numbers.round2, "double") == [0.12, 0.38, 0.95]


def test_strip_follows_unicode(spark):
    given = some_strings(" \t\n\xa0　 ab\x1c", 500) + [None]
    want = [None if s is None else s.strip() for s in given]
    assert applied(spark, given, text.strip) == want
    assert applied(spark, given, text.strip_long) == want
    assert applied(spark, given, text.is_blank) == [s is None or not s.strip() for s in given]


def test_word_count(spark):
    given = some_strings(" \n\xa0ab", 500, 14)
    assert applied(spark, given, text.word_count) == [len(s.split()) for s in given]
    assert applied(spark, given, lambda c: text.word_count_upto(c, 5)) == [min(5, len(s.split())) for s in given]


@pytest.mark.parametrize(
    "raw,clean,key",
    [
        ("1. Shimoga", "Shimoga", "shivamogga"),
        (" 12] Bengaluru (Urban).", "Bengaluru (Urban)", "bengaluru urban"),
        ("Kolar District", "Kolar District", "kolar"),
        ("Mysore dist.", "Mysore dist", "mysuru"),
        ("NaN", "", ""),
        ("Uttar/Kannda", "Uttar/Kannda", "uttar kannada"),
    ],
)
def test_names(spark, raw, clean, key):
    assert applied(spark, [raw], names.clean_name) == [clean]
    assert applied(spark, [raw], lambda c: names.normalise_ascii(names.clean_name(c))) == [key]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_ratios():
    assert round(ratio("shivamoga", "shivamogga"), 4) == 94.7368
    assert ratio("koler", "kolar") == 80.0
    for _ in range(500):
        a, b = some_strings("abc ", 2, 8)
        if a or b:
            assert ratio(a, b) == pytest.approx(200.0 * plain_lcs(a, b) / (len(a) + len(b)))
    assert token_set_ratio("bengaluru", "bengaluru rural") == 100.0
    assert partial_ratio("kannada", "uttara kannada") == 100.0
    assert weighted_ratio("bengaluru", "bengaluru rural") == pytest.approx(90.0)
    assert weighted_ratio("kannada uttara", "uttara kannada") == pytest.approx(95.0)


def test_whole_and_float_of_replies(spark):
    assert applied(spark, ["3", " -1 ", "1.5", "0.5d", "x", None, "99999999999"], numbers.parse_whole) == [
        3, -1, None, None, None, None, None,
    ]
    assert applied(spark, ["0.5", "0.5d", "1e-1", "nan", "high", None], numbers.parse_float) == [
        0.5, None, 0.1, None, None, None,
    ]


def test_year_or_default(spark):
    given = ["2024", "0", "2024-25", None, "99999999999"]
    assert applied(spark, given, lambda c: numbers.year_or(c, 2025)) == [2024, 2025, 2025, 2025, None]


def test_general_format_rounds_ties_to_even(spark):
    ties = [12345.25, 123456.5, 123457.5, 1234565.0, 1.015625, 0.5, 100000.5, 1e15 + 0.5, 2.5e-5, 999999.5]
    values = ties + [RNG.uniform(-1, 1) * 10 ** RNG.randint(-12, 18) for _ in range(2000)]
    assert applied(spark, values, numbers.format_g, "double") == [f"{v:g}" for v in values]


def test_serials_in_native_digits(spark):
    assert applied(spark, ["೧. Kolar", "12| Kolar", "٣: Kolar"], names.clean_name) == ["Kolar"] * 3
