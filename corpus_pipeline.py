"""A training corpus from raw documents: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and all rows its predecessor kept; all
but the last return the columns of ``documents``.  ``run`` writes each stage's
result to the shared checkpoint folder as Parquet and reads it back.

Defined results, for every stage: an empty table gives an empty one; a null text is
an empty one that stays null; a null or repeated doc_id is a document like any
other; further columns are kept, whatever their names, up to packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.llm import decontam, packing, pii, simhash_dedup, toxicity
from shelfspark.llm._common import cut
from shelfspark.session import apply_defaults
from shelfspark.sources.tables import load


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; without labels none does."""
    apply_defaults(spark)
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints one row stays: of the smallest doc_id (a null
    one last), then of the smallest text hash, then any of equal rows.  Documents
    without words are one group."""
    apply_defaults(spark)
    return simhash_dedup.keep_one(docs, shingle=3, max_distance=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; items without words are in none."""
    apply_defaults(spark)
    return decontam.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to placeholders; n_chars follows the text, and stays
    where the text is null."""
    apply_defaults(spark)
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in its sequence; an empty text is its end id alone."""
    apply_defaults(spark)
    return packing.pack(docs)


STAGES = [("toxicity", reject_toxic), ("near_duplicates", drop_near_duplicates), ("decontamination", decontaminate),
          ("personal_data", sanitise), ("packing", pack)]

# the stages hold trained and iterative operators: no SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
