"""Secrets, and weak credential parts that complement each other within a scope.

Strong kinds are reported wherever they stand: assign (a secret given to a name), access (an access identifier), hex (a
long hexadecimal string). Weak kinds are `key` (a long random-looking token), `login` (a user or client name given to a
field) and `endpoint` (an address). Weak ones are joined with all parts of the same text whose interval comes within
`SCOPE` characters: a key is reported near an identifier or an endpoint, a login near a secret, an endpoint near an
identifier or a secret. A weak part that overlaps a strong one still complements others in its own role; it is not
reported itself where it lies wholly within a strong one, as that span is reported already. The join is a sweep over
starts kept in order; only the nearest part of each role on either side matters, so its cost is that of sorting,
whatever the number of parts.

Offsets are code points, ends exclusive. Null and empty texts have no parts; repeated rows are scanned each.
"""

import re
from bisect import bisect_right
from hashlib import sha256
from itertools import accumulate

from .texts import map_texts

SCOPE = 200

# The base patterns and least lengths, in the order kinds are listed.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

KEY = re.compile(
    r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{32,}={0,2}"
)
LOGIN = re.compile(
    r"\b(?:user(?:name)?|login|account|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?[\w.@-]{3,}",
    re.IGNORECASE | re.ASCII,
)
ENDPOINT = re.compile(
    r"\b[a-z][a-z0-9+.-]{0,20}://[^\s\"'<>]+|(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])", re.ASCII
)
LONG = re.compile(r"[A-Za-z0-9+/]{32}")

KINDS = ("assign", "access", "hex", "key", "login", "endpoint")
ROLE = {"assign": "secret", "hex": "secret", "key": "secret", "access": "name", "login": "name", "endpoint": "place"}
COMPLEMENTS = {"key": ("name", "place"), "login": ("secret",), "endpoint": ("name", "secret")}
NAMES = ("password", "passwd", "secret", "token", "api")
FIELDS = ("user", "login", "account", "client", "access")


def strong_parts(text):
    """(start, end, kind) of the base patterns, leftmost and non-overlapping per kind."""
    parts = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found = ASSIGN.finditer(text)
        parts += [(*m.span(), "assign") for m in found if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        parts += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    parts += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return parts


def weak_parts(text):
    """(start, end, kind) of the weak patterns, also where they overlap a strong part."""
    found = []
    if LONG.search(text):
        found += [(*m.span(), "key") for m in KEY.finditer(text)]
    low = text.lower()
    if any(field in low for field in FIELDS):
        found += [(*m.span(), "login") for m in LOGIN.finditer(text)]
    if "://" in text or "." in text:
        found += [(*m.span(), "endpoint") for m in ENDPOINT.finditer(text)]
    return found


def outside(weak, strong):
    """The weak parts that do not lie wholly within one strong part."""
    spans = sorted(strong)
    starts, ends = [start for start, _, _ in spans], list(accumulate((end for _, end, _ in spans), max, initial=-1))
    return [p for p in weak if ends[bisect_right(starts, p[0])] < p[1]]


def linked(weak, strong, scope=SCOPE):
    """The weak parts that have a complementary part within `scope` characters, by an interval join."""
    by_role = {}
    for part in sorted([*weak, *strong]):
        by_role.setdefault(ROLE[part[2]], []).append(part)
    joins = {}
    for role, parts in by_role.items():
        reach, ends = -1, []
        for _, end, _ in parts:  # the furthest end of any part that starts no later
            reach = max(reach, end)
            ends.append(reach)
        joins[role] = ([start for start, _, _ in parts], ends)

    def near(part, role):
        starts, ends = joins.get(role, ((), ()))
        n = bisect_right(starts, part[1] + scope)
        return n > 0 and ends[n - 1] >= part[0] - scope

    return [p for p in weak if any(near(p, role) for role in COMPLEMENTS[p[2]])]


def spans_text(parts):
    ordered = sorted(parts, key=lambda p: (p[0], KINDS.index(p[2]), p[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def summary(text, scope=SCOPE):
    strong = strong_parts(text)
    weak = weak_parts(text)
    kept = outside(linked(weak, strong, scope), strong) if weak else []
    kinds = [kind for _, _, kind in strong]
    digest = sha256(spans_text(strong).encode()).hexdigest()
    return *(kinds.count(k) for k in KINDS[:3]), digest, spans_text([*strong, *kept])


def scan_secrets(docs, id_col="doc_id", text_col="text", scope=SCOPE):
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined)."""
    fields = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_texts(docs, id_col, text_col, lambda: lambda text: summary(text, scope), fields)
