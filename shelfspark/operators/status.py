"""Run status: classification, expected-vs-observed spine, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from .joins import bounded_broadcast


def status_class(state: Column, lookup_failed: Column | None = None) -> Column:
    """A5: success/failed/up_for_retry/running -> COMPLETED/FAILED/RETRYING/
    RUNNING; a lookup that failed -> ERROR; anything else, or no state, ->
    UNKNOWN."""
    expr = None if lookup_failed is None else F.when(F.coalesce(lookup_failed, F.lit(False)), F.lit(P.STATE_ERROR))
    for raw, cls in P.STATE_CLASSES:
        expr = F.when(state == raw, F.lit(cls)) if expr is None else expr.when(state == raw, F.lit(cls))
    return expr.otherwise(F.lit(P.STATE_UNKNOWN))


def expected_vs_observed(expected: DataFrame, observed: DataFrame, keys: list[str],
                         state: str = "state", lookup_failed: str | None = None) -> DataFrame:
    """Every expected task keeps a row; missing observations get a NULL
    state (classified UNKNOWN).  Keys are unique on both sides, so a plain
    left join has no skew; the planner broadcasts ``observed`` if small."""
    more = [lookup_failed] if lookup_failed else []
    return expected.join(observed.select(*keys, state, *more), keys, "left").withColumn(
        "status", status_class(F.col(state), F.col(lookup_failed) if lookup_failed else None))


def names_table(spark: SparkSession, names: dict[str, str], key: str, label: str) -> DataFrame:
    return spark.createDataFrame(sorted(names.items()), f"{key} string, {label} string")


def with_display_name(df: DataFrame, names: DataFrame, key: str, label: str,
                      known_rows: int | None = None) -> DataFrame:
    """Key -> label, the key itself when missing.  ``names`` is a lookup
    table of bounded size; it is broadcast only after that bound is proven
    (``known_rows`` for a table built from a driver-side dict)."""
    joined = df.join(bounded_broadcast(names, max_rows=100_000, known_rows=known_rows), key, "left")
    return joined.withColumn(label, F.coalesce(F.col(label), F.col(key).cast("string")))


def run_status_summary(status: DataFrame, ds: str, cls: str = "status") -> DataFrame:
    """A4 per run date: totals by class, other, success rate (0 when no
    tasks) and the verdict ALL / PARTIAL / NONE.  The detail by flow is rows of
    its own, see ``run_status_detail``."""
    c = F.col(cls)
    agg = status.groupBy(ds).agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(c == "COMPLETED").cast("bigint").alias("completed"),
        F.count_if(c == "FAILED").cast("bigint").alias("failed"),
        F.count_if(c == "RETRYING").cast("bigint").alias("retrying"),
        F.count_if(c == "RUNNING").cast("bigint").alias("running"),
        F.count_if(c == P.STATE_ERROR).cast("bigint").alias("error"),
        F.count_if(c == P.STATE_UNKNOWN).cast("bigint").alias("unknown"),
    )
    total, done = F.col("total"), F.col("completed")
    return agg.select(
        "*",
        (total - done - F.col("failed")).alias("other"),
        F.when(total > 0, done / total * 100).otherwise(F.lit(0.0)).alias("success_rate"),
        F.when(done == total, F.lit(P.VERDICT_ALL))
         .when(done > 0, F.lit(P.VERDICT_PARTIAL))
         .otherwise(F.lit(P.VERDICT_NONE)).alias("verdict"),
    )


def run_status_detail(status: DataFrame, ds: str, flow: str, cls: str = "status") -> DataFrame:
    """A4 detail: per run date and flow the number of tasks in each class, as rows
    ``(ds, flow, status, tasks)``."""
    return status.groupBy(ds, flow, cls).agg(F.count(F.lit(1)).cast("bigint").alias("tasks"))
