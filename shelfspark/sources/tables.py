"""Table scans.

Parquet scans: Catalyst prunes columns (``ReadSchema``) and pushes filters
(``PushedFilters``) into the reader, so callers should select what they need
right after ``load``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(rows: DataFrame, per_task: int) -> DataFrame:
    """``rows`` dealt evenly over one partition per ``per_task`` of them, where a step
    costs far more per row than the scan: a small file is one split or few however
    much work its rows make.  Rows that fit one task stay as they are scanned."""
    tasks = -(-rows.count() // per_task)
    return rows.repartition(tasks) if tasks > 1 else rows
