"""Crawl log operators: empty-page verdict, cut-off, per-run summary.

The reference walks result pages one by one and stops after ``max_empty``
empty pages in a row.  With the pages already stored, the walk becomes a
gaps-and-islands window over the crawl log::

    page_num = row_number() over (run order by page)
    last_ne  = max(page_num if non-empty) over (run order by page, running)
    streak   = page_num - coalesce(last_ne, 0)        (for empty pages)
    stop     = min(page_num where empty and streak >= max(max_empty, 1)) over (run)

``crawl_cutoff`` computes the same in ranges of a run, so that a run with a
large share of all pages is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P


def page_is_empty(status: Column, load_error: Column, has_products: Column, cards: Column) -> Column:
    """P5: HTTP status other than 200 (a missing status counts as fine), a
    load error, no product evidence, or zero valid cards."""
    return ((status.isNotNull() & (status != 200))
            | F.coalesce(load_error, F.lit(False))
            | ~F.coalesce(has_products, F.lit(False))
            | (F.coalesce(cards, F.lit(0)) == 0))


def crawl_cutoff(log: DataFrame, run: str, order: list[str], empty: str,
                 max_empty: int | Column = P.DEFAULT_MAX_EMPTY_PAGES, num_partitions: int | None = None) -> DataFrame:
    """Annotate every page with ``page_num``, ``streak``, ``stop_page``
    and ``kept`` (non-empty page before the stop).  ``max_empty`` may be a
    column (per-chain settings, constant within a run) or a constant; 0
    behaves as 1.  ``order`` must be unique within a run (add a tie-breaker
    such as an event id).  ``run`` may be of any type; NULL runs are one run.

    One run may hold a large share of all pages, so the log is range-
    partitioned on ``(run, order)`` and windows run over (range, run):

    1. per page: position and streak within its range of the run;
    2. per (range, run): pages, leading and trailing empty pages, first stop
       behind a non-empty page -- one pre-aggregated row;
    3. windows over those rows give each range its page offset and the streak
       carried in, hence the run's stop page; joined back on the same keys.

    The ranged log is checkpointed once (shared checkpoint folder), so both
    uses see the same ranges."""
    m = max_empty if isinstance(max_empty, Column) else F.lit(max_empty)
    n = num_partitions or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (log.withColumn("_m", F.greatest(m, F.lit(1))).repartitionByRange(n, run, *order)
              .withColumn("_part", F.spark_partition_id()).checkpoint(eager=True))
    e = F.col(empty)
    w = Window.partitionBy("_part", run).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (ranged.withColumn("_at", F.row_number().over(w))
             .withColumn("_last", F.max(F.when(~e, F.col("_at"))).over(running)))
    hit = e & F.col("_last").isNotNull() & (F.col("_at") - F.col("_last") >= F.col("_m"))
    parts = local.groupBy("_part", run).agg(
        F.max("_m").alias("_m"), F.count(F.lit(1)).alias("_n"), F.min(F.when(~e, F.col("_at"))).alias("_first"),
        F.max(F.when(~e, F.col("_at"))).alias("_end"), F.min(F.when(hit, F.col("_at"))).alias("_hit"))
    of_run = Window.partitionBy(run).orderBy("_part")
    before = of_run.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # streak carried in: pages since the last non-empty one of any earlier range
    parts = parts.withColumn("_carry", F.col("_off") - F.coalesce(F.max(F.col("_off") + F.col("_end")).over(before), F.lit(0)))
    lead = F.coalesce(F.col("_first") - 1, F.col("_n"))
    early = F.greatest(F.col("_m") - F.col("_carry"), F.lit(1))
    stop = F.when(early <= lead, early).otherwise(F.col("_hit"))
    carried = parts.withColumn("stop_page", F.min(F.col("_off") + stop).over(Window.partitionBy(run))).select(
        F.col("_part").alias("_p"), F.col(run).alias("_r"), "_off", "_carry", "stop_page")
    joined = local.join(carried, (F.col("_part") == F.col("_p")) & F.col(run).eqNullSafe(F.col("_r")))
    page = F.col("_off") + F.col("_at")
    streak = F.when(~e, F.lit(0)).otherwise(F.col("_at") - F.coalesce(F.col("_last"), -F.col("_carry")))
    return joined.select(
        *log.columns, page.alias("page_num"), streak.cast("bigint").alias("streak"), "stop_page",
        (~e & (F.col("stop_page").isNull() | (page < F.col("stop_page")))).alias("kept"))


def kept_cards(annotated: DataFrame) -> DataFrame:
    """Cards of non-empty pages before the stop (U2: in page order)."""
    return annotated.where(F.col("kept"))


def crawl_summary(annotated: DataFrame, run: str, cards: str = "cards", at: str | None = None) -> DataFrame:
    """A3 per run: ``total_items``, ``pages_processed`` = stop page - 1 (NULL
    when the log ends before a stop), ``last_page`` seen, ``pages_with_cards``
    and, with ``at``, the run's timestamp (its last page's).  Partial
    aggregation, one row per run."""
    return annotated.groupBy(run).agg(
        F.sum(F.when(F.col("kept"), F.col(cards)).otherwise(F.lit(0))).cast("bigint").alias("total_items"),
        (F.min("stop_page") - 1).cast("bigint").alias("pages_processed"),
        F.max("page_num").cast("bigint").alias("last_page"),
        F.count_if(F.col("kept")).cast("bigint").alias("pages_with_cards"),
        *([F.max(at).alias("timestamp")] if at else []),
    )
