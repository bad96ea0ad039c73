"""End-to-end flows of the reference, composed from the operators.

Each flow is what the reference's scheduled job does, as one Spark job graph
over tables: no browser, no hand-offs of row lists between task processes,
nothing gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import crawl, models, pages
from ..sinks import writers

RAW_PRICE_REQUIRED = ["raw_data", "scraped_date", "scraped_datetime", "store_name", "category"]
RAW_STORE_REQUIRED = ["id", "ubicacion_texto", "fecha_extraccion", "fuente"]
RAW_BRANCH_REQUIRED = ["sucursal_id", "nombre", "provincia", "raw_data", "fecha_extraccion", "fuente"]
MODEL_NOT_NULL = ["sucursal_id", "nombre_sucursal", "provincia"]


Selectors = list[pages.Selector] | dict[str, list[pages.Selector]]


def _of(selectors: Selectors, build: Callable[[list], Column]) -> Column:
    """``build`` of the selectors; with a list per chain, of those of the row's ``chain``."""
    return pages.by_chain(F.col("chain"), selectors, build) if isinstance(selectors, dict) else build(selectors)


def crawl_pages(result_pages: DataFrame, selectors: Selectors, max_empty: int | Column) -> tuple[DataFrame, DataFrame]:
    """§3.1 stages 5-8 over stored result pages (page_id, url, html, run,
    page_order; chain, if ``selectors`` has a list for each): primary-selector cards
    (H2 + P1), evidence over all selectors (P2), verdict (P3, P4), empty-page rule
    (P5) and the cut-off (W1).

    Returns ``(walked, cards)``: one row per page with the walk columns, and
    the valid cards in long form ``(page_id, pos, item)``."""
    cards = _of(selectors, lambda some: pages.valid_cards(F.col("html"), some[0]))
    seen = _of(selectors, lambda some: pages.cards_and_evidence(F.col("html"), some))
    per_page = result_pages.withColumn("_seen", seen).drop("html").withColumn("n_cards", F.coalesce("_seen.n_cards", F.lit(0)))
    has = F.coalesce("_seen.evidence", F.lit(0)) > 0
    per_page = per_page.withColumn("has_products", has & ~pages.url_is_invalid(F.col("url"))).drop("_seen")
    log = per_page.withColumn("empty", crawl.page_is_empty(F.lit(200), F.lit(False), F.col("has_products"), F.col("n_cards")))
    walked = crawl.crawl_cutoff(log, "run", ["page_order", "page_id"], "empty", max_empty)
    return walked, result_pages.select("page_id", F.explode(cards).alias("_c")).select("page_id", "_c.pos", "_c.item")


def product_price_flow(result_pages: DataFrame, selectors: Selectors, max_empty: int | Column,
                       store_name: Column, table_path: str, load_ts: Column,
                       category: str = P.PRICE_CATEGORY) -> tuple[bool, DataFrame]:
    """§3.1: stored result pages -> kept cards -> raw price rows (M3, P16) with
    their place (U2: run, page_num, pos) -> REQUIRED check (K3) -> append (K1).
    Returns (written?, per-run summary A3)."""
    walked, cards = crawl_pages(result_pages, selectors, max_empty)
    kept = crawl.kept_cards(walked).select("page_id", "run", "page_num", store_name.alias("_store"))
    rows = models.raw_price_rows(cards.join(kept, "page_id"), F.col("_store"), category, load_ts, keep=["run", "page_num", "pos"])
    written = writers.append_prices(rows, table_path, required=RAW_PRICE_REQUIRED)
    return written, crawl.crawl_summary(walked, "run", cards="n_cards")


def store_text_flow(list_pages: DataFrame, table_path: str, load_ts: Column) -> DataFrame:
    """§3.2 text variant: store-list page -> texts (H3) -> numbered rows (M5)
    -> guarded full refresh (K2, K3) -> model view (M1, K8)."""
    items = pages.extract_store_list(list_pages)
    raw = items.select("page_id", (F.col("pos") + 1).cast("bigint").alias("id"), F.col("text").alias("ubicacion_texto"),
                       load_ts.alias("fecha_extraccion"), F.lit(P.SOURCE_STORE_TEXT).alias("fuente"))
    writers.replace_snapshot(raw, table_path, required=RAW_STORE_REQUIRED)
    current = writers.read_snapshot(list_pages.sparkSession, table_path)
    return writers.publish_view(models.parse_store_text(current, keep=["page_id", "id"]), "int_store_text")


def branch_flow(nested: DataFrame, map_col: str, table_path: str, load_ts: Column) -> DataFrame:
    """§3.2 JSON variant: nested province -> branches document -> raw rows
    (M4) -> guarded full refresh (K2, K3) -> model (M2), published as a snapshot
    beside the raw table (``<table>_model``).  The model's declared not-null tests
    (A9) are counted while it is written, so it is evaluated once; a NULL fails the
    flow and leaves the model published before."""
    spark = nested.sparkSession
    raw = models.flatten_branches(nested, map_col, load_ts)
    writers.replace_snapshot(raw, table_path, required=RAW_BRANCH_REQUIRED)
    published = f"{table_path.rstrip('/')}_model"
    writers.replace_snapshot(models.parse_branch_json(writers.read_snapshot(spark, table_path)), published, not_null=MODEL_NOT_NULL)
    return writers.publish_view(writers.read_snapshot(spark, published), "int_branches")
