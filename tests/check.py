"""Compare registered queries with their SQL in DuckDB: python tests/check.py SF_DIR [names...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_plain(r[i]) for i in order] for r in rows), key=repr)


def compare(spark, con, name, sf_dir):
    """(same, message) for one query."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return bool(got), f"{len(got)} rows, no SQL"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} / {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows"
    odd = [(g, w) for g, w in zip(got, want) if g != w][:3]
    return False, f"{len(got)} / {len(want)} rows; first differences {odd}"


if __name__ == "__main__":
    from obsflow.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    folder = sys.argv[1]
    db = connect(folder)
    from obsflow.plans.queries import QUERIES

    for query in sys.argv[2:] or QUERIES:
        began = time.time()
        try:
            same, message = compare(session, db, query, folder)
        except Exception as e:  # report and go on
            same, message = False, str(e)[:1500]
        print(f"{'ok  ' if same else 'DIFF'} {query:24s} {time.time() - began:6.2f}s {message[:1200]}", flush=True)
