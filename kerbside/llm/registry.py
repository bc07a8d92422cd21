"""One query per operator, over the whole tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kerbside.llm import decontamination, fingerprints, html_text, jaccard_join, licenses, oracle, packing, periodic_runs, quality_rules, repeats, resampling, token_counts, toxicity, wavelet

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_documents(spark, sf_dir))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, sf_dir))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_documents(spark, sf_dir))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_documents(spark, sf_dir))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contamination(_documents(spark, sf_dir), benchmark).drop("items")


def op7_token_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.written_and_read(_documents(spark, sf_dir))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digest(_documents(spark, sf_dir))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resampled(_documents(spark, sf_dir), target).drop("n_words")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_documents(spark, sf_dir), periodic_runs.with_planted_runs)
    return found.drop("n_words", "n_dropped")


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_edited(_documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_html_extraction": op3_html_extraction,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_jaccard_join": op5_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_token_id_shards": op7_token_id_shards,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_token_counts": op9_token_counts,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_document_fingerprints": op13_document_fingerprints,
}
ORACLE: dict[str, str] = {
    "op5_jaccard_join": oracle.JACCARD_JOIN,
    "op6_benchmark_decontamination": oracle.DECONTAMINATION,
}
