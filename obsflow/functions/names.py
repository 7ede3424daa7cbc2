"""Cleaning and normalising place names."""

import unicodedata
from functools import cache

from pyspark.sql import functions as F

from .text import collapse_ws, is_ascii, strip

# Single-word spelling repairs (fixed values).
WORD_FIXES = {
    "kanmda": "kannada",
    "kannda": "kannada",
    "kannnada": "kannada",
    "uttarkannada": "uttara kannada",
    "chikkamagaluru": "chikkamangaluru",
    "chikmagalur": "chikkamangaluru",
    "chikballapur": "chikkaballapur",
    "chikballapura": "chikkaballapur",
    "kalburgi": "kalaburagi",
    "gulbarga": "kalaburagi",
    "bellary": "ballari",
    "belgaum": "belagavi",
    "davangere": "davanagere",
    "dharwar": "dharwad",
    "mysore": "mysuru",
    "shimoga": "shivamogga",
    "tumkur": "tumakuru",
    "ramnagar": "ramanagara",
    "yadgir": "yadgiri",
    "yadagiri": "yadgiri",
    "coorg": "kodagu",
    "bijapur": "vijayapura",
    "vijayanagar": "vijayanagara",
}

# Fixed value: a serial number before a name, in digits of any script.
_SERIAL = r"^\s*\p{Nd}+\s*[|.\-:\]]\s*"
# Characters that a key does not keep, and the word that a name may end with.
_OUTSIDE = r"[^\w\s.&-]"
_ENDING = r"\s+(district|dist\.?)$"


def clean_name(c):
    """Drop a leading serial number and edge punctuation; null-like text becomes empty."""
    text = strip(F.coalesce(c, F.lit("")))
    return F.btrim(F.regexp_replace(text, rf"(?i)^(?:nan|none|null)$|{_SERIAL}", ""), F.lit(" .,:;|[]"))


@cache
def _ascii_forms():
    """Characters and their closest ASCII forms by Unicode's compatibility decomposition: those with a form of one
    character, as two strings, and those with a longer one, as pairs."""
    forms = {}
    for code in range(0x80, 0x20000):
        form = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if form:
            forms[chr(code)] = form
    one = {c: f for c, f in forms.items() if len(f) == 1}
    return "".join(one), "".join(one.values()), [(c, f) for c, f in forms.items() if len(f) > 1]


def fold_accents(c):
    """Closest ASCII form of a text: accents go, ligatures are written out, other characters are left out."""
    plain, form, long = _ascii_forms()
    expanded = "".join(x for x, _ in long)
    forms = F.split(F.lit("\n".join(f for _, f in long)), "\n")  # two literals plan faster than a map of them
    at = lambda x: F.instr(F.lit(expanded), x)
    written = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(at(x) > 0, F.get(forms, at(x) - 1)).otherwise(x)), "")
    some = F.length(F.translate(c, expanded, "")) < F.length(c)
    return F.regexp_replace(F.translate(F.when(some, written).otherwise(c), plain, form), r"[^\x00-\x7F]+", "")


def normalise_ascii(c):
    """Matching key of an ASCII name: lower case, no serial, punctuation, brackets or 'district', words repaired."""
    s = strip(F.lower(c))
    s = F.regexp_replace(s, _SERIAL, "")
    s = F.regexp_replace(s, _OUTSIDE, " ")
    s = strip(collapse_ws(s))
    s = F.regexp_replace(s, _ENDING, "")
    fixes = F.create_map(*[F.lit(x) for pair in WORD_FIXES.items() for x in pair])
    words = F.transform(F.split(s, " "), lambda w: F.coalesce(F.try_element_at(fixes, w), w))
    return F.array_join(words, " ")


def letters_in(key):
    return F.length(F.regexp_replace(key, "[^a-z]", ""))


def needs_folding(c):
    return ~is_ascii(c)
