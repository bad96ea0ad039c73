"""Coverage counts and not-null audits.

All are single aggregations: Spark computes partial aggregates map-side and
shuffles one small row per partition (and group), so a hot key or a huge
table costs one scan, never a skewed task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def branch_coverage(model: DataFrame, by_province: bool = True) -> DataFrame:
    """A6 on the P15 flags: branches, with address, with both hours, with
    phone.  With ``by_province`` the result is ``ROLLUP(provincia)`` (one row
    per province plus a grand total with ``provincia`` NULL)."""
    aggs = [
        F.count(F.lit(1)).alias("total_sucursales"),
        F.sum("tiene_direccion").cast("bigint").alias("con_direccion"),
        F.sum("tiene_horarios").cast("bigint").alias("con_horarios"),
        F.sum("tiene_telefono").cast("bigint").alias("con_telefono"),
    ]
    if by_province:
        return model.rollup("provincia").agg(*aggs)
    return model.agg(*aggs)


def not_null_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows violating NOT NULL per column, as ``(column_name, null_rows)``.

    One pass with ``count_if`` per column, unpivoted with ``stack``."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"_n{i}")
                      for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(columns))
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_rows)")


class RequiredColumnViolation(ValueError):
    pass


def enforce_required(df: DataFrame, columns: list[str]) -> DataFrame:
    """K3: REQUIRED columns.  Runs the audit (one aggregation job) and raises
    before any write if a column holds NULLs; returns ``df`` unchanged."""
    bad = [r for r in not_null_audit(df, columns).collect() if r["null_rows"] > 0]
    if bad:
        detail = ", ".join(f"{r['column_name']}={r['null_rows']}" for r in bad)
        raise RequiredColumnViolation(f"NULL in required columns: {detail}")
    return df


def counts_per(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Rows per key (cards per page, items per branch, ...); a partial
    aggregation, so a hot key costs no more than any other."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias(name))


def required_inline(df: DataFrame, columns: list[str]) -> DataFrame:
    """K3 in one pass: every REQUIRED column raises on its first NULL while
    the rows are being written, so the write job fails and commits nothing."""
    return df.withColumns({
        c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in required column {c}")))
            .otherwise(F.col(c))
        for c in columns})
