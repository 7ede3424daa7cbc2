"""Whitespace handling that follows Unicode, where Spark's trim knows only the space."""

from pyspark.sql import functions as F

# Every character that counts as whitespace (fixed values).
WHITESPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a regular-expression class body.
WS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value, body):
    """body(value) with `value` worked out once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c):
    return F.btrim(c, F.lit(WHITESPACE))


def strip_long(c):
    """As strip, for longer texts: trimming a set of characters walks the whole text, so look at both ends first."""
    edges = F.left(c, F.lit(1)).isin(*WHITESPACE) | F.right(c, F.lit(1)).isin(*WHITESPACE)
    return F.when(edges, strip(c)).otherwise(c)


def has_text(c):
    """Any character that is not whitespace; null for null."""
    return c.rlike(f"[^{WS}]")


def is_blank(c):
    return ~F.coalesce(has_text(c), F.lit(False))


def collapse_ws(c):
    return F.regexp_replace(c, f"[{WS}]+", " ")


def word_count(c):
    return F.size(F.filter(F.split(c, f"[{WS}]+"), lambda w: w != ""))


def word_count_upto(c, limit):
    """Number of words, capped; counting stops at the cap, so long texts are not split to the end."""
    enough = c.rlike(rf"^[{WS}]*(?:[^{WS}]+[{WS}]+){{{limit - 1}}}[^{WS}]")
    return F.when(enough, limit).otherwise(word_count(c))


def is_ascii(c):
    return F.octet_length(c) == F.length(c)


def null_like(c):
    """Lower-cased, stripped text with none / null / blank as null."""
    s = F.lower(strip(c))
    return F.when(~s.isin("none", "null", ""), s)
