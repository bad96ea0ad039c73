"""Drop-down option lists.

Options arrive as rows ``(page_id, select_idx, pos, codigo, nombre)`` (from
``pages.extract_options`` or any table of that shape).  Choosing a group is
an aggregation over groups, never a collect of their options.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import ustrip


def valid_option(value: Column, text: Column, placeholder: str = P.PROVINCE_PLACEHOLDER,
                 case_insensitive: bool = False) -> Column:
    """Value and text non-empty and value is not the placeholder (tested
    on the unstripped value)."""
    is_placeholder = (F.lower(value) == placeholder.lower()) if case_insensitive else (value == placeholder)
    return (value.isNotNull() & (value != "") & text.isNotNull() & (text != "")
            & ~is_placeholder)


def clean_options(options: DataFrame, placeholder: str = P.PROVINCE_PLACEHOLDER,
                  case_insensitive: bool = False) -> DataFrame:
    """P6 filter, then strip value and text."""
    ok = valid_option(F.col("codigo"), F.col("nombre"), placeholder, case_insensitive)
    return options.where(ok).withColumn("codigo", ustrip(F.col("codigo"))).withColumn(
        "nombre", ustrip(F.col("nombre")))


def pick_option_group(options: DataFrame, min_options: int = P.OPTION_GROUP_MIN) -> DataFrame:
    """Per page, the first ``<select>`` (document order) holding more
    than ``min_options`` options (placeholder included); returns its options.

    Plan: partial count per (page, select) -> first qualifying select per
    page -> semi join back.  The chosen-group table has one row per page."""
    counts = options.groupBy("page_id", "select_idx").agg(F.count(F.lit(1)).alias("_n"))
    chosen = counts.where(F.col("_n") > min_options).groupBy("page_id").agg(
        F.min("select_idx").alias("select_idx"))
    return options.join(chosen, ["page_id", "select_idx"], "left_semi")


def nth_option_group(options: DataFrame, n: int) -> DataFrame:
    """O3: the n-th ``<select>`` of each page (0 = first), by document order.
    The rank runs over the distinct (page, select) pairs, not over options."""
    groups = options.select("page_id", "select_idx").distinct()
    ranked = groups.withColumn(
        "_r", F.row_number().over(Window.partitionBy("page_id").orderBy("select_idx")) - 1)
    return options.join(ranked.where(F.col("_r") == n).drop("_r"), ["page_id", "select_idx"], "left_semi")
