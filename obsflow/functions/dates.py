"""Six calendar-date spellings. Numeric ones are rewritten to ISO by one regular expression and then cast."""

from pyspark.sql import functions as F

from .text import WS, collapse_ws, strip

_DAY = r"(?:3[01]|[12][0-9]|0[1-9]|[1-9])"
_MONTH = r"(?:1[0-2]|0[1-9]|[1-9])"
_YEAR = r"(?!0000)[0-9]{4}"


def parse_date(c):
    """d.m.Y, d-m-Y, d/m/Y, Y-m-d, '5 July 2025' or '5 Jul 2025' (any case) to a date, else null."""
    iso = F.regexp_replace(c, rf"^[{WS}]*({_DAY})([./-])({_MONTH})\2({_YEAR})[{WS}]*$", "$4-$3-$1")
    # No match extracts as empty text, which casts to null.
    numeric = F.regexp_extract(iso, rf"^[{WS}]*({_YEAR}-{_MONTH}-{_DAY})[{WS}]*$", 1).try_cast("date")
    words = collapse_ws(strip(c))
    spelled = F.when(
        c.rlike(rf"^[{WS}]*{_DAY}[{WS}]+[A-Za-z]{{3,9}}[{WS}]+{_YEAR}[{WS}]*$"),
        F.coalesce(F.try_to_date(words, "d MMMM yyyy"), F.try_to_date(words, "d MMM yyyy")),
    )
    return F.coalesce(numeric, spelled)
