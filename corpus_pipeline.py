"""From raw documents to a sharded training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next one's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from cartospark.llm import compression_classifier
from cartospark.llm.decontamination import decontaminated
from cartospark.llm.feistel import sharded
from cartospark.llm.mixing import mixed_documents
from cartospark.llm.ngram_join import one_of_each_group
from cartospark.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject (score of 0.3 or more)."""
    model = compression_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression_classifier.accepted(docs, model, 0.3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.75 on 5-word shingles: the smallest id."""
    return one_of_each_group(docs, Fraction(3, 4), 5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Fraction(3, 4), 5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their targets; documents of scarce sources up to three times."""
    return mixed_documents(docs, (1, 2, 3), 3)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns with size, checksum, shard and slot."""
    return sharded(docs, shards=16, keep=[c for c in docs.columns if c != "doc_id"]).drop("position")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: Compression, clustering and the fingerprint search are beyond SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents, written between one another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
