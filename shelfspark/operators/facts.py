"""Classified facts over an array of raw items.

The warehouse model runs six correlated sub-queries over ``UNNEST(array)`` per
row.  Here every one is a higher-order function over the row's own array, so
the whole model is narrow: no explode, no join, no shuffle.

Items are carried as ``struct(v, j)``: ``v`` the decoded string, ``j`` its
JSON encoding.  Predicates test ``j`` (the warehouse matches the JSON text of
each element), extraction uses ``v`` (trap #6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import java_flags, json_quote, nullif_empty, regexp_extract_or_null, ustrip


def encoded_items(arr: Column) -> Column:
    """P12 + F13/F14: drop NULL elements; pair each item with its JSON text."""
    return F.transform(F.filter(arr, lambda x: x.isNotNull()),
                       lambda x: F.struct(x.alias("v"), json_quote(x).alias("j")))


FLAGS = {  # item flag -> (pattern, case-insensitive)
    "a": (P.ADDRESS_RE, True),      # P8
    "s": (P.SCHEDULE_RE, True),     # P9
    "p": (P.PHONE_RE, True),        # P10
    "t": (P.TIME_RE, False),        # P11
    "r": (P.TIME_RANGE_RE, False),  # P11
}


def tagged_items(items: Column) -> Column:
    """Evaluate every classification regex once per item: ``struct(v, a, s,
    p, t, r)`` with one boolean per predicate (on the JSON text ``j``)."""
    return F.transform(items, lambda e: F.struct(
        e["v"].alias("v"),
        *[e["j"].rlike(java_flags(rx, ci)).alias(k) for k, (rx, ci) in FLAGS.items()]))


def flagged(tagged: Column, flag: str) -> Column:
    return F.filter(tagged, lambda e: e[flag])


def joined_matches(matched: Column, sep: str = P.FACT_JOIN_SEP) -> Column:
    """A1 STRING_AGG of trimmed matches, array order; NULL when none."""
    return nullif_empty(F.array_join(F.transform(matched, lambda e: ustrip(e["v"])), sep))


def first_match(matched: Column) -> Column:
    """W2 ``LIMIT 1`` pinned to array order; NULL when none."""
    return ustrip(F.get(matched, 0)["v"])


def item_count(arr: Column) -> Column:
    """A2 ARRAY_LENGTH: NULL for a NULL array (``size`` may give -1)."""
    return F.when(arr.isNull(), F.lit(None)).otherwise(F.size(arr)).cast("bigint")


def non_blank(arr: Column) -> Column:
    """Drop NULL and blank texts; strip the rest (order kept)."""
    return F.transform(F.filter(arr, lambda x: x.isNotNull() & (ustrip(x) != "")), lambda x: ustrip(x))


# ---------------------------------------------------------- long form ----
BLOCK = 1024  # places of a key that are put together first


def _listed(value: str, order: str, sep: str, name: str) -> Column:
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg(`{value}`, '{quoted}') WITHIN GROUP (ORDER BY `{order}`)").alias(name)


def ordered_listagg(rows: DataFrame, keys: list[str], order: str, lists: dict[str, str], sep: str,
                    others: list[tuple[Column, Column]] | None = None, block: int = BLOCK) -> DataFrame:
    """A1 in grouped form (``STRING_AGG ... ORDER BY``) without a key's rows in one
    task: texts are joined per (key, block of the order), then the blocks in order.

    ``lists``: result name -> text column (NULLs skipped; NULL when none is left).
    ``others``: pairs of named aggregates, for a block and then over the blocks.
    ``order`` is a number, unique within a key."""
    others = others or []
    blocked = rows.withColumn("_block", F.floor(F.col(order) / block))
    first = blocked.groupBy(*keys, "_block").agg(*[_listed(v, order, sep, k) for k, v in lists.items()], *[a for a, _ in others])
    return first.groupBy(*keys).agg(*[_listed(k, "_block", sep, k) for k in lists], *[b for _, b in others])


def grouped_facts(rows: DataFrame, keys: list[str], pos: str, item: str) -> DataFrame:
    """J4 over facts in long form, a row for each key with facts: the three joined
    lists (A1), the first address, time and time range (W2) and the number of
    items (A2, NULL ones included).  Each item's patterns are matched once."""
    paired = F.struct(F.col(item).alias("v"), json_quote(F.col(item)).alias("j"))
    tagged = rows.select(*keys, pos, F.when(F.col(item).isNotNull(), F.get(tagged_items(F.array(paired)), 0)).alias("_t"))
    text = ustrip(F.col("_t.v"))
    flat = tagged.select(*keys, pos, *[F.when(F.col(f"_t.{flag}"), text).alias(f"_{flag}") for flag in FLAGS])
    lists = {"direcciones_encontradas": "_a", "horarios_encontrados": "_s", "telefonos_encontrados": "_p"}

    def first(flag: str, name: str) -> tuple[Column, Column]:
        """min_by skips rows whose order is NULL, so only matches compete."""
        return (F.min_by(f"_{flag}", F.when(F.col(f"_{flag}").isNotNull(), F.col(pos))).alias(name),
                F.min_by(name, F.when(F.col(name).isNotNull(), F.col("_block"))).alias(name))

    found = ordered_listagg(flat, keys, pos, lists, P.FACT_JOIN_SEP, [
        first("a", "_first_a"), first("t", "_first_t"), first("r", "_first_r"),
        (F.count(F.lit(1)).alias("_n"), F.sum("_n").cast("bigint").alias("cantidad_datos_crudos"))])
    return found.select(*keys, *[nullif_empty(F.col(name)).alias(name) for name in lists],
                        F.col("_first_a").alias("direccion_principal"),
                        regexp_extract_or_null(F.col("_first_t"), P.OPEN_EXTRACT_RE).alias("hora_apertura"),
                        regexp_extract_or_null(F.col("_first_r"), P.CLOSE_EXTRACT_RE).alias("hora_cierre"),
                        "cantidad_datos_crudos")
