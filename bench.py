"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and is then timed once, written to the noop sink so that all columns are computed.
Queries over stored tables write them in the warm-up of the first one; that time is reported apart, as "build".
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obsflow.plans.queries import QUERIES  # noqa: E402
from obsflow.session import local_session  # noqa: E402

HEADLINE = (
    "process_tables",
    "normalize_observations",
    "validate_observations",
    "detect_headers",
    "resolve_districts",
    "forward_fill_entities",
    "sticky_period",
    "classify_rows",
    "table_samples",
    "map_columns",
    "obs_datasets",
    "obs_query",
    "table_quality",
    "domain_consistency",
    "fuzzy_resolve",
    "chunk_documents",
    "chunks_by_domain",
    "chunk_paragraphs",
    "page_paragraphs",
    "document_context",
)
# The first queries that read the stored observations and the stored chunks.
STORES = ("obs_datasets", "chunks_by_domain")


def run(spark, name, sf_dir):
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    times, build = {}, {}
    for name in HEADLINE:
        first = run(spark, name, sf_dir)
        times[name] = round(run(spark, name, sf_dir), 3)
        if name in STORES:
            build[name] = round(first, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "build": build,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": "1 warm-up, 1 timed",
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
