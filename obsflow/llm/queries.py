"""The operators applied to whole tables, and their SQL where SQL can express them."""

from pyspark.sql import functions as F

from . import (
    byte_bpe,
    exact_dedup,
    fingerprints,
    hard_negatives,
    license_scan,
    mixing,
    ngram_join,
    periodic_runs,
    quality_crf,
    quality_rules,
    secret_scan,
    token_counts,
    url_filter,
)


def _documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.deduplicate(_documents(spark, sf_dir))


def op2_ngram_join(spark, sf_dir):
    return ngram_join.component_rows(_documents(spark, sf_dir))


def op3_quality_classifier(spark, sf_dir):
    return quality_crf.classify(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_license_scans(spark, sf_dir):
    return license_scan.scan_licenses(_documents(spark, sf_dir))


def op5_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_documents(spark, sf_dir))


def op6_quality_rules(spark, sf_dir):
    return quality_rules.judge(_documents(spark, sf_dir))


def op7_url_filters(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return url_filter.judge(pages, url_filter.rule_labels(pages))


def op8_secret_scans(spark, sf_dir):
    return secret_scan.scan_secrets(_documents(spark, sf_dir))


def op9_mixing(spark, sf_dir):
    return mixing.mix(_documents(spark, sf_dir))


def op10_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(_documents(spark, sf_dir))


def op11_hard_negatives(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_fingerprints(spark, sf_dir):
    return fingerprints.edit_report(_documents(spark, sf_dir))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.run_report(periodic_runs.with_loops(_documents(spark, sf_dir)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_ngram_join,
        op3_quality_classifier,
        op4_license_scans,
        op5_token_counts,
        op6_quality_rules,
        op7_url_filters,
        op8_secret_scans,
        op9_mixing,
        op10_byte_bpe,
        op11_hard_negatives,
        op12_fingerprints,
        op13_periodic_runs,
    )
}

ORACLE = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op12_fingerprints": fingerprints.ORACLE,
}
