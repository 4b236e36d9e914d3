"""Queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from corpuslens.llm import exact_dedup, filter_audit, langid, lexical_search, license_scan, mixing, ngram_join, packing, quality_mcd, secret_scan, sstable, token_rollup, toxicity


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _with(operator: Callable[[DataFrame, DataFrame], DataFrame], other: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/{other}.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": _documents(ngram_join.ngram_components),
    "op2_secret_scan": _documents(secret_scan.scan_secrets),
    "op3_license_scan": _documents(license_scan.scan_licenses),
    "op4_source_mixing": _documents(mixing.mix),
    "op5_language_id": _documents(langid.identify),
    "op6_token_rollup": _documents(token_rollup.rollup_documents),
    "op7_quality_rules": _documents(quality_mcd.judge),
    "op8_exact_dedup": _documents(exact_dedup.exact_dedup),
    "op9_token_shards": _documents(sstable.token_shards),
    "op10_sequence_packing": _documents(packing.pack),
    "op11_lexical_search": _with(lexical_search.search, "benchmark"),
    "op12_toxicity": _with(toxicity.score_toxicity, "labels"),
    "op13_filter_audit": _with(filter_audit.audit_filters, "labels"),
    "pipeline": lambda spark, sf_dir: corpus_pipeline.run(spark, sf_dir),
}

_OP8 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLES: dict[str, str] = {
    "op3_license_scan": license_scan.oracle(),
    "op4_source_mixing": mixing.ORACLE,
    "op8_exact_dedup": _OP8,
    "op11_lexical_search": lexical_search.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
