"""Numbers out of dirty text, half-even rounding, and the %g form."""

import sys
import unicodedata

from pyspark.sql import functions as F

from .text import WS, is_ascii, let, strip

# Decimal digits of every script map to 0-9; built from the Unicode database rather than listed.
_DIGITS = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
_DIGIT_VALUES = "".join(str(unicodedata.digit(d)) for d in _DIGITS)

_RUN = r"[0-9](?:_?[0-9])*+"
_PLAIN = rf"^[{WS}]*([+-]?(?:{_RUN}\.?(?:{_RUN})?|\.{_RUN}))[{WS}]*$"
_D = r"\p{Nd}(?:_?\p{Nd})*+"
_FLOAT = rf"(?i)^[{WS}]*(?!nan[{WS}]*$)[+-]?(?:(?:{_D}(?:\.(?:{_D})?)?|\.{_D})(?:e[+-]?{_D})?|inf(?:inity)?|nan)[{WS}]*$"


def _no_commas(c):
    return F.replace(c, F.lit(","), F.lit(""))


def _plain_number(c):
    # No match extracts as empty text; a cast would reject that only by way of an exception.
    digits = F.replace(F.regexp_extract(_no_commas(c), _PLAIN, 1), F.lit("_"), F.lit(""))
    return let(digits, lambda d: F.when(d != "", d.try_cast("double")))


def ascii_digits(c):
    """Decimal digits of any script as 0-9."""
    return F.when(is_ascii(c), c).otherwise(F.translate(c, "".join(_DIGITS), _DIGIT_VALUES))


def parse_number(c):
    """Plain decimal text to double; anything with a letter, or not a number, is null."""
    return _plain_number(ascii_digits(c))


def parse_float(c):
    """Text of a whole cell as a double where is_numeric holds; a trailing type letter, as in 0.5d, is no number."""
    return F.when(is_numeric(c), ascii_digits(strip(c)).try_cast("double"))


def parse_whole(c):
    """Text of a whole number as an int; 1.5 is none."""
    return F.when(c.rlike(rf"^[{WS}]*[+-]?[0-9]+[{WS}]*$"), strip(c).try_cast("int"))


def number_confidence(c):
    """How far parse_number trusts the cell: 1 parsed, 0.2 has letters, 0.1 not a number, 0 empty."""
    s = F.lower(strip(c))
    return (
        F.when(s.isNull() | s.isin("", "nan", "none"), 0.0)
        .when(s.rlike("[a-z]"), 0.2)
        .when(parse_number(c).isNull(), 0.1)
        .otherwise(1.0)
    )


def is_numeric(c):
    """Looser test used on header rows: scientific notation and infinities count, a bare nan does not."""
    return F.coalesce(_no_commas(c).rlike(_FLOAT), F.lit(False))


def parse_year(c):
    """Whole part of a parsed non-zero number; anything else, or beyond an int, is null."""
    return F.nullif(parse_number(c), F.lit(0.0)).try_cast("int")


def year_or(c, default):
    """The year of a cell, else the default; null where the cell holds a number beyond an int, which no year is."""
    number = F.nullif(parse_number(c), F.lit(0.0))
    return let(number, lambda n: F.when(n.isNull(), F.lit(default)).otherwise(n.try_cast("int")))


def round2(c):
    return F.bround(c, 2)


def clamp01(c):
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))


def is_finite(c):
    return c.isNotNull() & ~F.isnan(c) & ~c.isin(float("inf"), float("-inf"))


def _exponent(text):
    return F.regexp_extract(text, r"e([+-][0-9]+)$", 1).try_cast("int")


def _halves(x):
    """A double as the sum of two with half as many digits each."""
    high = x * 134217729.0 - (x * 134217729.0 - x)
    return high, x - high


def _lost(a, b, product):
    """What rounding took from the product of two doubles, exactly."""
    (ah, al), (bh, bl) = _halves(a), _halves(b)
    return ((ah * bh - product) + ah * bl + al * bh) + al * bl


def _rounded(x, rest):
    """x + rest as a whole number: only where x lies half way between two does the rest decide, and then the even one."""
    half = x - F.floor(x) == 0.5
    return F.when(half & (rest > 0), F.floor(x) + 1.0).when(half & (rest < 0), F.floor(x).cast("double")).otherwise(F.rint(x))


def format_g(c):
    """Six significant digits, trailing zeros dropped, as C's %g prints a finite double."""

    def shown(text):
        mantissa = F.regexp_replace(F.regexp_extract(text, r"^(.*)e", 1), r"\.?0+$", "")
        fixed = F.regexp_replace(text.try_cast("decimal(20,10)").cast("string"), r"\.?0+$", "")
        scientific = F.concat(mantissa, F.regexp_extract(text, r"(e.*)$", 1))
        return F.when(_exponent(text).between(-4, 5), fixed).otherwise(scientific)

    # The formatter rounds the shortest decimal form, halves up: round the double itself first, exact halves to even.
    # Powers of ten up to the 22nd are exact doubles.
    places = (5 - _exponent(F.format_string("%.5e", c))).cast("double")
    power = F.pow(F.lit(10.0), F.abs(places))

    def rounded(s):
        up = _rounded(c * s, _lost(c, s, c * s))
        below = F.floor(c / s) + 0.5
        down = _rounded(c / s, (c - below * s) - _lost(below, s, below * s))
        return F.when(places >= 0, up / s).otherwise(down * s)

    even = let(power, rounded)
    settled = F.when((F.abs(c) >= 1e-17) & (F.abs(c) < 1e27), even).otherwise(c)
    return F.when(c == 0, "0").when(c.isNotNull(), let(F.format_string("%.5e", settled), shown))
