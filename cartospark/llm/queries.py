"""The contract queries: each applies one operator to its whole table and derives the asked columns."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression_classifier, license_scan, outliers
from .decontamination import benchmark_matches
from .feistel import sharded
from .mixing import mixed
from .ngram_join import ngram_join
from .oracles import ORACLES  # noqa: F401  read by the entry point
from .pitman_yor import language_model_scores
from .substring_dedup import substring_dedup
from .url_trust import judged

#: The rules of the URL query, (verdict, host and path).
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity 0.75 on 5-word shingles over all documents."""
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), Fraction(3, 4), 5)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words over all documents."""
    cut = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), min_words=50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hierarchical Pitman-Yor bigram model over all documents; remainder 2 modulo 7 is held out."""
    return language_model_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), modulus=7, held=2)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first, then trust and distrust over host links, for all pages."""
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards; law `rows`."""
    placed = sharded(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and robust outliers per language and source over all documents."""
    found = outliers.judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return license_scan.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 1, 2, 3, with at most three copies each."""
    found = mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"), (1, 2, 3), 3)
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items: matches of similarity 0.75 on 5-word shingles."""
    return benchmark_matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Fraction(3, 4), 5)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on labels of remainders other than 0 modulo 5; all documents scored."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = compression_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), modulus=5, held=0)
    return compression_classifier.scored(docs, model, modulus=5, held=0).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


QUERIES = {
    f.__name__: f
    for f in (op1_ngram_jaccard_join, op2_url_filters, op3_sharding, op4_quality_rules, op5_license_scans, op6_source_mixing, op7_benchmark_decontamination, op8_quality_classifier, op9_substring_dedup, op10_lm_scoring)
}
