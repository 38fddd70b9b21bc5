"""Corpus pipeline: good documents, one of each near-duplicate group, without live secrets, packed.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but
the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, quality, secrets, simhash
from tidemark.llm.common import ship, stored, table, unused

# No SQL engine fits the classifier or encodes the texts; tests compare with brute force.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject."""
    ship(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    name = unused(docs.columns, "_quality")
    scored = quality.score(docs, model, docs.columns, name=name)
    return scored.where(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at three or fewer bits."""
    ship(spark)
    return simhash.without_near_duplicates(docs, words=3, distance=3)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, credentials that look live replaced by a mark."""
    redacted = secrets.redact(docs, owner_column="source")
    if "n_chars" not in docs.columns:
        return redacted
    count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", F.coalesce(count, F.col("n_chars"))).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 4096 ids."""
    ship(spark)
    return packing.pack(docs, end_id=1, capacity=4096).placements.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("bigint").alias("length"),
        "ids_crc32",
        "sequence_id",
        "offset",
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage_{number}")
    return docs
