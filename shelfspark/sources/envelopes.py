"""File sources: scrape envelopes and arbitrary JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("pages_processed", T.IntegerType()),
    T.StructField("total_items", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
])


def read_envelopes(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Scrape envelopes with a fixed schema (no inference pass).  The
    reference writes one indented document per file (``multiLine``); JSON
    lines (one envelope per line) are read with ``multiline=False``.  A
    malformed document fails the read."""
    return (spark.read.schema(ENVELOPE_SCHEMA).option("multiLine", multiline).option("mode", "FAILFAST").json(path)
            .withColumn("source_file", F.col("_metadata.file_path")))


def read_json_docs(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """S3: arbitrary JSON documents, one per file (or per line), as VARIANT plus a
    source label (the file name without extension)."""
    raw = spark.read.text(path, wholetext=not one_per_line).select(
        F.col("value"), F.col("_metadata.file_path").alias("source_file"))
    name = F.regexp_extract(F.col("source_file"), r"([^/]+?)(\.json)?$", 1)
    return raw.select(F.parse_json(F.col("value")).alias("doc"), name.alias("source"), "source_file")
