"""Incremental ingest of landed scrape envelopes.

``ingest_new_envelopes`` is the plain form, in which a malformed file fails the
run.  ``ingest_checked`` writes through the checked append (K1, K3) and sets
documents aside that cannot become rows, so one bad file does not block the rest.

Each new envelope file becomes raw price rows exactly once: the file source
tracks processed files in the checkpoint, the sink is append-only parquet
with its own commit log, and ``trigger(availableNow=True)`` drains whatever
has landed and stops, so a scheduled run costs nothing when no file is new.
The query is stateless (explode + projection), so it needs no watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import patterns as P
from ..operators.models import envelope_items, raw_price_rows
from ..sinks.writers import append_prices
from ..sources.envelopes import ENVELOPE_SCHEMA


def envelope_stream(spark: SparkSession, landing: str, multiline: bool = True,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed envelopes: whole (indented) documents, or JSON lines with
    ``multiline=False``.  A malformed file fails the run and is not committed."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA).option("multiLine", multiline).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing).withColumn("source_file", F.col("_metadata.file_path"))


def envelope_rows(envelopes: DataFrame, store_name: str | Column, category: str = P.PRICE_CATEGORY) -> DataFrame:
    items = envelope_items(envelopes, keep=["source_file"])
    scraped_at = F.to_timestamp(F.col("timestamp"))
    return raw_price_rows(items.withColumn("_store", store_name if isinstance(store_name, Column)
                                           else F.lit(store_name)),
                          F.col("_store"), category, scraped_at)


def ingest_new_envelopes(spark: SparkSession, landing: str, table_path: str, checkpoint: str,
                         store_name: str | Column, multiline: bool = True,
                         max_files_per_trigger: int | None = None) -> None:
    """Run one ``availableNow`` pass: every file not yet seen by this
    checkpoint is appended to ``table_path``; blocks until done.  With
    ``max_files_per_trigger`` the backlog is drained in several bounded
    micro-batches (each committed on its own), not one large one."""
    rows = envelope_rows(envelope_stream(spark, landing, multiline, max_files_per_trigger), store_name)
    q = (rows.writeStream.format("parquet").outputMode("append")
         .option("path", table_path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


RAW_PRICE_REQUIRED = ["raw_data", "scraped_date", "scraped_datetime", "store_name", "category"]
REJECT_SCHEMA = "source_file string, document string, reason string, batch_id string"


def documents(texts: DataFrame) -> DataFrame:
    """Whole documents (value, source_file) as envelopes, with the ``reason`` why one
    cannot become rows; NULL for a good one.  (A file of no bytes is no document: the
    file source gives no row for it.)"""
    schema = T.StructType([*ENVELOPE_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    parsed = texts.withColumn("_e", F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    reason = (F.when(F.col("_e").isNull() | F.col("_e._bad").isNotNull(), "malformed")
              .when(F.col("_e.items").isNull(), "no items")
              .when(F.exists("_e.items", lambda x: x.isNull()), "null item")
              .when(F.try_to_timestamp(F.col("_e.timestamp")).isNull(), "no timestamp"))
    return parsed.select("value", "source_file", "_e.items", "_e.pages_processed", "_e.total_items", "_e.timestamp", reason.alias("reason"))


def write_batch(batch: DataFrame, batch_id: int, table_path: str, rejects_path: str, store_name: str | Column,
                category: str = P.PRICE_CATEGORY) -> None:
    """One micro-batch: good documents through the checked append, under the batch's
    id as its run, the others with their reason into ``rejects_path``.  Both
    replace what an earlier attempt at the same batch left, so a replay adds nothing."""
    run = f"batch-{batch_id}"
    seen = documents(batch).persist()
    try:
        append_prices(envelope_rows(seen.where("reason IS NULL"), store_name, category), table_path, run_id=run, required=RAW_PRICE_REQUIRED)
        bad = seen.where("reason IS NOT NULL").select("source_file", F.col("value").alias("document"), "reason", F.lit(run).alias("batch_id"))
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(rejects_path)
    finally:
        seen.unpersist()


def ingest_checked(spark: SparkSession, landing: str, table_path: str, rejects_path: str, checkpoint: str,
                   store_name: str | Column, max_files_per_trigger: int | None = None) -> None:
    """T1 into K1 with K3: one ``availableNow`` pass over the landed documents."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    texts = reader.load(landing).select("value", F.col("_metadata.file_path").alias("source_file"))
    q = (texts.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, table_path, rejects_path, store_name))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
