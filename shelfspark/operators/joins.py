"""Join helpers with explicit size and skew handling.

* ``bounded_broadcast`` broadcasts a side only after proving that its rows and
  bytes are under a bound -- by an aggregate over ``limit(bound+1)``, which stops
  early, or by a count known by construction; otherwise the side is returned as
  is and the planner/AQE choose the strategy.
* ``skew_safe_left_join`` computes ``left LEFT JOIN right`` as
  ``(left INNER JOIN right) UNION ALL (left ANTI JOIN distinct(right.keys))``.
  AQE can split a skewed partition on either side of an inner join, but on a
  left outer join it may only split the *left* side; when one key holds a
  third of the right side, the plain outer join leaves that key in one task.
  The anti join probes the *distinct* right keys (partially aggregated before
  the shuffle), which has no skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import python_json_quote
from .facts import ordered_listagg


MAX_BROADCAST_BYTES = 32 << 20


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most so many rows and bytes (of its rows as JSON text)."""
    size = F.octet_length(F.to_json(F.struct("*")))
    n, held = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= max_rows and held <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int, known_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and
    ``MAX_BROADCAST_BYTES``.  A caller that built ``df`` from a driver-side literal
    passes ``known_rows`` (the bound is then proven without running a job)."""
    small = known_rows <= max_rows if known_rows is not None else fits(df, max_rows)
    return F.broadcast(df) if small else df


def skew_safe_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` with a skew-proof
    plan; output has all columns of both sides (right ones NULL when
    unmatched).  The same rows, as a multiset, as the plain left join."""
    matched = left.join(right, left[left_key] == right[right_key], "inner")
    keys = right.select(F.col(right_key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    unmatched = left.join(keys, left[left_key] == keys["__k"], "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(unmatched.select("*", *nulls))


def province_spine(provinces: DataFrame, branches: DataFrame, prov_key: str, branch_prov_key: str) -> DataFrame:
    """Province -> its branches.  A province without branches yields no
    rows downstream (the reference explodes, not explode_outer), so this is
    an inner join; the province side is a small dimension the planner
    broadcasts by size."""
    return provinces.join(branches, provinces[prov_key] == branches[branch_prov_key], "inner")


def branch_spine(branches: DataFrame, facts: DataFrame, branch_key: str, fact_key: str) -> DataFrame:
    """J2 in long form: every listed branch keeps at least one row; a branch
    without detail facts gets NULL fact columns.  Skew-safe: a branch with a
    third of all facts does not land in one task."""
    return skew_safe_left_join(branches, facts, branch_key, fact_key)


def branch_documents(branches: DataFrame, facts: DataFrame, branch_key: str, fact_key: str, order: str, item: str) -> DataFrame:
    """One row per listed branch with ``raw_data``, the JSON array of its
    facts in order, ``[]`` when the details failed.  The facts of a branch are put
    together in blocks of the order (a number), so a branch with a large share of
    all facts is many tasks; only its row itself holds them all."""
    listed = facts.select(F.col(fact_key).alias("_key"), order, python_json_quote(F.col(item)).alias("_item"))
    listed = listed.withColumn("_item", F.coalesce("_item", F.lit("null")))
    joined = branches.join(ordered_listagg(listed, ["_key"], order, {"_items": "_item"}, ", "),
                           branches[branch_key] == F.col("_key"), "left")
    return joined.select(*[branches[c] for c in branches.columns],
                         F.concat(F.lit("["), F.coalesce("_items", F.lit("")), F.lit("]")).alias("raw_data"))
