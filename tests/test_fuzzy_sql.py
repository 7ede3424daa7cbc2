"""The SQL form of the fuzzy scores against the Python one."""

import random

import duckdb
import pytest

from obsflow.functions import fuzzy
from obsflow.plans.fuzzy_sql import PAIRS


def test_scores_agree():
    rng = random.Random(1)
    words = ["mysuru", "kolar", "bengaluru urban", "dakshina kannada", "koda gu", "a", "ab cd ef", "kannada uttara"]
    texts = [("".join(rng.choice("abc ") for _ in range(rng.randint(1, 25)))) for _ in range(120)]
    words += [" ".join(t.split()) for t in texts if t.strip()]
    pairs = [(x, y) for x in words[:40] for y in words[::4]]
    con = duckdb.connect()
    con.execute("CREATE TABLE pairs (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO pairs VALUES (?, ?)", sorted(set(pairs)))
    rows = con.execute(f"WITH {PAIRS} SELECT a, b, plain, token_set, weighted FROM scored").fetchall()
    assert len(rows) == len(set(pairs))
    for a, b, *scores in rows:
        assert scores == pytest.approx([fuzzy.ratio(a, b), fuzzy.token_set_ratio(a, b), fuzzy.weighted_ratio(a, b)])
