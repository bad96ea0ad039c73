"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder reads the driver's tables from ``sf_dir`` (whole tables, no
sampling) and returns a lazy DataFrame; column names equal the oracle's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import clean_product_name as clean
from ..functions.text import json_array_text
from ..operators import crawl, facts, joins, markup, models, options, pages, prices, quality, status
from ..session import shared_dir
from ..sinks import writers
from ..sources.envelopes import read_envelopes, read_json_docs
from ..sources.tables import load
from ..streaming import ingest
from . import flows, inputs
from . import oracle_sql as O

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, Callable[[], str] | None]] = {}


def register(name: str, oracle: Callable[[], str] | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


@register("store_text_parse", O.store_text_parse)
def store_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.parse_store_text(inputs.raw_store_text(spark, sf_dir))


@register("branch_facts", O.branch_facts)
def branch_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.parse_branch_json_ordered(inputs.raw_branches(spark, sf_dir))


@register("branch_facts_long", O.branch_facts_long)
def branch_facts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2, W2, J4 in grouped form: M2 over facts in long form."""
    return models.parse_branch_long(inputs.raw_branches(spark, sf_dir), inputs.branch_items(spark, sf_dir), "sucursal_id", "pos", "item")


@register("store_text_strict", O.store_text_strict)
def store_text_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the model with ``[OFFSET(i)]``, over texts of three lines and more."""
    raw = inputs.raw_store_text(spark, sf_dir)
    return models.parse_store_text(raw.where(F.size(F.split("ubicacion_texto", "\n", -1)) >= 3), strict=True, keep=["id"])


@register("branch_facts_documents", O.branch_facts_documents)
def branch_facts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.parse_branch_json(inputs.raw_doc_branches(spark, sf_dir))


@register("branch_coverage", O.branch_coverage)
def branch_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.branch_coverage(models.parse_branch_json(inputs.raw_branches(spark, sf_dir)))


# ------------------------------------------------------------ crawl (W1) ----
def _crawl_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = inputs.crawl_log(spark, sf_dir)
    log = log.withColumn("empty", crawl.page_is_empty(F.col("status"), F.col("load_error"), F.col("has_products"), F.col("cards")))
    return crawl.crawl_cutoff(log, "run", ["ts", "event_id"], "empty", F.col("max_empty"))


@register("crawl_cutoff", O.crawl_cutoff)
def crawl_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = crawl.kept_cards(_crawl_annotated(spark, sf_dir))
    return kept.select("run", "event_id", F.col("page_num").cast("bigint").alias("page_num"),
                       F.col("cards").cast("bigint").alias("cards"))


@register("crawl_summary", O.crawl_summary)
def crawl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = crawl.crawl_summary(_crawl_annotated(spark, sf_dir), "run", at="ts")
    return summary.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# ------------------------------------------------------- status (A4 A5 J5) ----
def _status_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate",
                                                  "o_orderpriority")
    expected = orders.selectExpr("o_orderkey", f"{inputs.RUN_DATE_SQL} AS ds", "o_orderpriority")
    observed = orders.selectExpr("o_orderkey", f"{inputs.ORDER_STATE_SQL} AS state",
                                 f"{inputs.LOOKUP_FAILED_SQL} AS lookup_failed").where(F.col("state").isNotNull())
    return status.expected_vs_observed(expected, observed, ["o_orderkey"], lookup_failed="lookup_failed")


@register("status_summary", O.status_summary)
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.run_status_summary(_status_rows(spark, sf_dir), "ds")


@register("status_by_flow", O.status_by_flow)
def status_by_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _status_rows(spark, sf_dir).withColumnRenamed("o_orderpriority", "flow")
    return status.run_status_detail(rows, "ds", "flow")


@register("status_detail", O.status_detail)
def status_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _status_rows(spark, sf_dir)
    names = status.names_table(spark, inputs.PRIORITY_LABELS, "o_orderpriority", "priority_label")
    return status.with_display_name(rows, names, "o_orderpriority", "priority_label",
                                    known_rows=len(inputs.PRIORITY_LABELS)).select(
        "o_orderkey", "ds", "status", "priority_label")


# ---------------------------------------------------------------- prices ----
@register("price_change_pct", O.price_change_pct)
def price_change_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    obs = li.groupBy("l_partkey", "l_shipdate").agg(
        F.min(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))).alias("price"))
    prev = prices.with_previous_price(obs, ["l_partkey"], "l_shipdate")
    return prev.select("l_partkey", F.to_date("l_shipdate").alias("ship_date"), "price", "prev_price",
                       prices.price_change_pct(F.col("price"), F.col("prev_price")).alias("price_change_pct"))


@register("clean_product_name", O.clean_product_name)
def clean_product_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    srcs = [("part", "p_partkey", "p_name"), ("customer", "c_custkey", "c_name"),
            ("documents", "doc_id", "text")]
    frames = [load(spark, sf_dir, t).select(k, c).select(
        F.lit(t).alias("source"), F.col(k).cast("bigint").alias("key"), clean(F.col(c)).alias("clean_name"))
        for t, k, c in srcs]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@register("union_prices", O.union_prices)
def union_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_type", "p_size")
    slices = [part.where(F.expr(cond)).selectExpr(*[f"{v} AS {k}" for k, v in inputs.part_slice_exprs(s).items()])
              for s, cond in inputs.PART_SLICES]
    at = F.timestamp_micros(F.lit(inputs.BASE_MICROS)).cast("timestamp_ntz")
    return prices.union_price_feeds([prices.sample_prices(spark, at), *slices])


@register("raw_price_rows", O.raw_price_rows)
def raw_price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _raw_price_rows_ltz(spark, sf_dir)
    return rows.withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


# ----------------------------------------------------- flatten / numbering ----
@register("flatten_branches", O.flatten_branches)
def flatten_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = inputs.nested_branches(spark, sf_dir)
    flat = models.flatten_branches(nested, "branches_by_province", F.col("fecha"))
    return flat.withColumn("fecha_extraccion", F.col("fecha_extraccion").cast("timestamp_ntz"))


@register("numbered_locations", O.numbered_locations)
def numbered_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", F.split(F.col("text"), "\n", -1).alias("lines"))
    return models.number_locations(docs, "lines", ["doc_id"], F.lit(None).cast("timestamp")).drop(
        "fecha_extraccion")


# ------------------------------------------------------------------ pages ----
@register("card_filter", O.card_filter)
def card_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.posexplode(F.split(F.col("text"), "\n", -1)).alias("pos", "card"))
    return lines.where(pages.valid_card(F.col("card"))).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "card")


@register("page_frontier", O.page_frontier)
def page_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_frontier(load(spark, sf_dir, "pages").select("page_id", "url"), "url", 3, ["page_id"])


@register("article_cards", O.article_cards)
def article_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    el = pages.extract_tag(load(spark, sf_dir, "pages").select("page_id", "html"), "article")
    return el.select("page_id", "pos", "text", pages.valid_card(F.col("text")).alias("is_card"))


@register("list_items", O.list_items)
def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    el = pages.extract_tag(load(spark, sf_dir, "pages").select("page_id", "html"), "li")
    return el.select("page_id", "pos", "text")


SELECTORS = [("article", ""), ("li", ""), ("a", ""), ("div", pages.class_test("ad")), ("p", ""), ("h1", ""), ("footer", "")]


@register("css_elements", O.tag_elements)
def css_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 for several selectors in one pass, each text in one line."""
    return pages.extract_elements(load(spark, sf_dir, "pages").select("page_id", "html"), SELECTORS, markup.flat_text)


# ---------------------------------------------------------------- options ----
@register("option_group", O.option_group)
def option_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return options.clean_options(options.pick_option_group(inputs.option_rows(spark, sf_dir)))


@register("option_second_group", O.option_second_group)
def option_second_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return options.clean_options(options.nth_option_group(inputs.option_rows(spark, sf_dir), 1),
                                 placeholder="provincia", case_insensitive=True)


@register("option_pages", O.option_pages)
def option_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4 -> A8 -> P6 over pages with a select per nation."""
    return options.clean_options(options.pick_option_group(pages.extract_options(inputs.option_pages(spark, sf_dir))))


# ------------------------------------------------------------------ spine ----
def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    nat = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    ords = load(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey",
        F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("raw_item"))
    branches = joins.province_spine(nat, cust, "n_nationkey", "c_nationkey")
    spine = joins.branch_spine(branches, ords, "c_custkey", "o_custkey")
    return spine.select(F.col("n_name").alias("provincia"), F.col("c_custkey").cast("string").alias("sucursal_id"),
                        F.col("c_name").alias("nombre"), "o_orderkey", "raw_item")


@register("branch_spine", O.branch_spine)
def branch_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spine(spark, sf_dir)


@register("not_null_audit", O.not_null_audit)
def not_null_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null_audit(_spine(spark, sf_dir),
                                  ["provincia", "sucursal_id", "nombre", "o_orderkey", "raw_item"])


@register("branch_documents", O.branch_documents)
def branch_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per listed branch with its raw facts, ``[]`` without any."""
    nat = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    ords = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("raw_item"))
    listed = joins.province_spine(nat, cust, "n_nationkey", "c_nationkey").select(
        F.col("n_name").alias("provincia"), F.col("c_custkey"), F.col("c_name").alias("nombre"))
    found = joins.branch_documents(listed, ords, "c_custkey", "o_custkey", "o_orderkey", "raw_item")
    return found.select("provincia", F.col("c_custkey").cast("string").alias("sucursal_id"), "nombre", "raw_data")


@register("items_per_branch", O.items_per_branch)
def items_per_branch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw items per branch."""
    return quality.counts_per(load(spark, sf_dir, "orders").select("o_custkey"), ["o_custkey"])


@register("model_audit", O.model_audit)
def model_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared not-null tests over the branch model, published as a table (K8)."""
    name = f"branches_{uuid.uuid4().hex[:12]}"
    writers.publish_table(models.parse_branch_json(inputs.raw_doc_branches(spark, sf_dir)), name, shared_dir(spark, "tables", name))
    return quality.not_null_audit(spark.table(name), flows.MODEL_NOT_NULL)


@register("page_verdict", O.page_verdict)
def page_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.verdict(load(spark, sf_dir, "pages"), [("article", ""), ("p", "")])


CARD_SELECTORS = [("article", pages.class_test(inputs.CARD_CLASS)), ("article", "")]


@register("page_verdict_css", O.card_page_verdict)
def page_verdict_css(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2-P4 and the no-results marker (H6) over result pages of every part."""
    pg = inputs.card_pages(spark, sf_dir)
    marker = pages.no_results_marker(F.col("html"), ["titleNotFound", "not-found", "no-results", "empty"])
    return pages.verdict(pg, CARD_SELECTORS).join(pg.select("page_id", marker.alias("marker")), "page_id")


@register("branch_facts_pages", O.branch_facts_pages)
def branch_facts_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5 -> raw branches -> M2: branch detail pages straight to the model."""
    raw = inputs.branch_pages(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("sucursal_id"), F.col("c_name").alias("nombre"), F.col("n_name").alias("provincia"),
        json_array_text(pages.branch_facts_of(F.col("html"))).alias("raw_data"), "fecha_extraccion", F.lit("pages").alias("fuente"))
    return models.parse_branch_json(raw)


@register("branch_facts_nested", O.branch_facts_pages)
def branch_facts_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5 -> M2 over pages with lists in lists, ``ol`` lists, comments and info blocks of any element."""
    raw = inputs.nested_branch_pages(spark, sf_dir).select(
        F.col("c_custkey").cast("string").alias("sucursal_id"), F.col("c_name").alias("nombre"), F.col("n_name").alias("provincia"),
        json_array_text(pages.branch_facts_of(F.col("html"))).alias("raw_data"), "fecha_extraccion", F.lit("pages").alias("fuente"))
    return models.parse_branch_json(raw)


@register("chain_cards", O.chain_cards)
def chain_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, H2, P1 with each chain's own primary selector over cards of nested blocks."""
    cards = pages.by_chain(F.col("chain"), P.CHAIN_CONFIGS, lambda config: pages.valid_cards(F.col("html"), config[0][0]))
    return inputs.chain_pages(spark, sf_dir).select("page_id", "chain", F.explode(cards).alias("c")).select("page_id", "chain", "c.pos", "c.item")


@register("chain_verdict", O.chain_verdict)
def chain_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6 and P2-P4 with each chain's own selectors and no-results markers, quoted texts included."""
    evidence = pages.by_chain(F.col("chain"), P.CHAIN_CONFIGS, lambda config: pages.evidence_count(F.col("html"), config[0]))
    marker = pages.by_chain(F.col("chain"), P.CHAIN_CONFIGS, lambda config: pages.no_results_marker(F.col("html"), config[1]))
    seen = inputs.chain_pages(spark, sf_dir).select("page_id", "url", evidence.alias("evidence"), marker.alias("marker"))
    return seen.select("page_id", "evidence", "marker", ((F.col("evidence") > 0) & ~pages.url_is_invalid(F.col("url"))).alias("has_products"))


RENDERED = ["article", "nav li", "div.ad", "nav", "footer", "body"]


@register("rendered_elements", O.rendered_elements)
def rendered_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 with rendered text: lines end at block elements."""
    return pages.extract_elements(load(spark, sf_dir, "pages").select("page_id", "html"), RENDERED)


# ------------------------------------------------------------------ sinks ----
RAW_PRICE_SCHEMA = ("raw_data string, scraped_date date, scraped_datetime timestamp, store_name string, "
                    "category string")


def _raw_price_rows_ltz(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = load(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    items = conv.selectExpr(*[f"{v} AS {k}" for k, v in inputs.conversation_price_exprs("spark").items()])
    return models.raw_price_rows(items, F.col("store_name"), "dulce_de_leche", F.col("scraped_at"))


@register("price_append", O.price_append)
def price_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the same run appended twice doubles the rows (no dedup)."""
    path = shared_dir(spark, "tables", "raw_prices")
    rows = _raw_price_rows_ltz(spark, sf_dir)
    required = ["raw_data", "scraped_date", "scraped_datetime", "store_name", "category"]
    writers.append_prices(rows, path, required=required)
    writers.append_prices(rows, path, required=required)
    back = spark.read.schema(RAW_PRICE_SCHEMA).parquet(path)
    return back.withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


@register("snapshot_replace", O.snapshot_replace)
def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: replaced twice, then an empty refresh that the guard ignores."""
    path = shared_dir(spark, "tables", "raw_store_text")
    snap = inputs.raw_store_text(spark, sf_dir)
    required = ["id", "ubicacion_texto", "fecha_extraccion", "fuente"]
    writers.replace_snapshot(snap, path, required=required)
    writers.replace_snapshot(snap, path, required=required)
    writers.replace_snapshot(snap.where(F.lit(False)), path)
    back = writers.read_snapshot(spark, path)
    return back.withColumn("fecha_extraccion", F.col("fecha_extraccion").cast("timestamp_ntz"))


@register("surrogate_ids", O.surrogate_ids)
def surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: a seed batch (parts) appended twice gets ids 1..n, n+1..2n."""
    path = shared_dir(spark, "tables", "seed_rows")
    batch = load(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("nombre"),
        F.concat(F.lit("Descripción de "), F.col("p_name")).alias("descripcion"))
    ts = F.timestamp_micros(F.lit(inputs.BASE_MICROS))
    writers.append_with_surrogate_id(batch, path, ["p_partkey"], load_ts=ts)
    writers.append_with_surrogate_id(batch, path, ["p_partkey"], load_ts=ts)
    return spark.read.parquet(path).select("id", "p_partkey", "nombre", "descripcion")


@register("json_archive", O.json_archive)
def json_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: page records archived as JSON by load run; on read the object key
    ``<yyyymmdd_hhmmss>_<last url segment>`` is rebuilt per record."""
    root = shared_dir(spark, "archive", "json_data")
    pg = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    # a day of hourly load runs
    load_ts = F.timestamp_micros(F.lit(inputs.BASE_MICROS) + F.col("page_id") % 24 * 3600000000)
    writers.archive_timestamped(pg, root, load_ts, F.col("url"))
    return writers.archived_objects(spark, root, "page_id bigint, url string, html string").select(
        "page_id", "url", "html", "object_key")


@register("stream_ingest", O.stream_ingest)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes land in two waves (two chains, then the third); three
    ``availableNow`` runs; every item is ingested exactly once."""
    base = shared_dir(spark, "stream")
    landing, table, ckpt = f"{base}/landing", f"{base}/raw_prices", f"{base}/_checkpoint"
    env = inputs.conversation_envelopes(spark, sf_dir)
    store = F.regexp_extract(F.col("source_file"), r"store=([^/]+)", 1)
    wave = inputs.envelope_wave(F.col("store"))
    env.where(wave == 0).write.partitionBy("store").option("maxRecordsPerFile", 1).text(landing)
    ingest.ingest_new_envelopes(spark, landing, table, ckpt, store, max_files_per_trigger=1000)
    env.where(wave == 1).write.mode("append").partitionBy("store").option("maxRecordsPerFile", 1).text(landing)
    ingest.ingest_new_envelopes(spark, landing, table, ckpt, store, max_files_per_trigger=1000)
    ingest.ingest_new_envelopes(spark, landing, table, ckpt, store)  # nothing new
    back = spark.read.schema(RAW_PRICE_SCHEMA).parquet(table)
    return back.withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Good and broken envelopes through the checked ingest: the table and the rejects."""
    base = shared_dir(spark, "stream")
    landing, table, rejects, ckpt = f"{base}/landing", f"{base}/raw_prices", f"{base}/rejects", f"{base}/_checkpoint"
    store = F.regexp_extract(F.col("source_file"), r"store=([^/]+)", 1)
    every = inputs.conversation_envelopes(spark, sf_dir).unionByName(inputs.broken_envelopes(spark, sf_dir))
    every.write.partitionBy("store").option("maxRecordsPerFile", 1).text(landing)
    ingest.ingest_checked(spark, landing, table, rejects, ckpt, store, max_files_per_trigger=1000)
    ingest.ingest_checked(spark, landing, table, rejects, ckpt, store)  # nothing new
    return table, rejects


@register("stream_checked", O.stream_ingest)
def stream_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 into K1 with K3: what arrives although broken documents land beside."""
    back = spark.read.schema(RAW_PRICE_SCHEMA).parquet(_landed(spark, sf_dir)[0]).drop("run_id")
    return back.withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


@register("stream_rejects", O.stream_rejects)
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents set aside, by chain and reason."""
    back = spark.read.schema(ingest.REJECT_SCHEMA).parquet(_landed(spark, sf_dir)[1])
    return quality.counts_per(back.withColumn("store", F.regexp_extract("source_file", r"store=([^/]+)", 1)), ["store", "reason"])


@register("envelope_items", O.envelope_items)
def envelope_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + U2: envelopes as documents, read back; every item with its place."""
    path = shared_dir(spark, "envelopes")
    inputs.conversation_envelopes(spark, sf_dir).write.partitionBy("store").option("maxRecordsPerFile", 1).text(path)
    items = models.envelope_items(read_envelopes(spark, path), keep=["store", "pages_processed", "total_items"])
    return items.select("store", "timestamp", "pages_processed", "total_items", F.col("item_pos").cast("bigint").alias("item_pos"), "item")


@register("chain_feed", O.chain_feed)
def chain_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed partitioned by chain; the view of one chain."""
    path = shared_dir(spark, "tables", "feed")
    writers.append_prices(_raw_price_rows_ltz(spark, sf_dir), path, partition_cols=("store_name", "scraped_date"))
    views = writers.partitioned_feed(spark, path, RAW_PRICE_SCHEMA, list(P.CHAIN_CONFIGS), f"raw_prices_{uuid.uuid4().hex[:12]}")
    return views["JUMBO"].withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


@register("daily_archive", O.daily_archive)
def daily_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: raw price rows archived by chain/category/day; a second same-day
    run for one chain replaces only that chain's partitions."""
    root = shared_dir(spark, "archive", "daily")
    rows = _raw_price_rows_ltz(spark, sf_dir).select(
        "raw_data", "scraped_datetime", F.col("store_name").alias("chain"), "category",
        F.date_format("scraped_date", "yyyy-MM-dd").alias("dt"))
    writers.archive_json(rows, root)
    writers.archive_json(rows.where(F.col("chain") == "JUMBO"), root)   # same-day re-run of one chain
    back = writers.read_archive(spark, root, "raw_data string, scraped_datetime timestamp, chain string, "
                                             "category string, dt string")
    return back.withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


@register("daily_last_value", O.daily_last_value)
def daily_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 + W4 + W3: last observation per key and day (``max_by`` on a unique
    time), previous day's value and % change.  Aggregating to one row per
    key and day before the window bounds every window partition by the
    number of days."""
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "value")
    daily = prices.daily_price(ev.withColumnRenamed("value", "price"), ["user_id"], F.to_date("ts"), "ts")
    prev = prices.with_previous_price(daily, ["user_id"], "day")
    return prev.select("user_id", "day", "price", "prev_price",
                       prices.price_change_pct(F.col("price"), F.col("prev_price")).alias("price_change_pct"))


@register("store_list_pages", O.store_list_pages)
def store_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§3.2 text variant over store-list pages: H3 -> M5 -> K2 -> M1."""
    return flows.store_text_flow(inputs.store_list_pages(spark, sf_dir), shared_dir(spark, "tables", "store_list"),
                                 F.timestamp_micros(F.lit(inputs.BASE_MICROS)))


@register("store_list_blocks", O.store_list_pages)
def store_list_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from pages whose lines are block elements, without ``<br>``."""
    return flows.store_text_flow(inputs.store_block_pages(spark, sf_dir), shared_dir(spark, "tables", "store_blocks"),
                                 F.timestamp_micros(F.lit(inputs.BASE_MICROS)))


@register("stores_per_province", O.stores_per_province)
def stores_per_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches and raw items per province of the raw branch table."""
    raw = inputs.raw_branches(spark, sf_dir)
    items = raw.select("provincia", facts.item_count(F.from_json("raw_data", "array<string>")).alias("k"))
    return items.groupBy("provincia").agg(F.count(F.lit(1)).cast("bigint").alias("sucursales"),
                                          F.sum("k").cast("bigint").alias("datos_crudos"))


@register("previous_event_value", O.previous_event_value)
def previous_event_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 on unaggregated observations, whose keys may be hot: windows per
    (user, thousand events)."""
    ev = load(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return prices.with_previous_price_bucketed(ev, ["user_id"], "event_id", F.floor(F.col("event_id") / 1000), price="value")


@register("previous_value_null_keys", O.previous_value_null_keys)
def previous_value_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where a fifth of all rows have a NULL key, in one of two key columns."""
    ev = load(spark, sf_dir, "events").selectExpr("CASE WHEN user_id % 5 > 0 THEN user_id END AS user_id", "event_type", "event_id", "value")
    return prices.with_previous_price_bucketed(ev, ["user_id", "event_type"], "event_id", F.floor(F.col("event_id") / 1000), price="value")


# ------------------------------------------------------------------ flows ----
def _product_flow(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    path = shared_dir(spark, "tables", "flow_prices")
    _, summary = flows.product_price_flow(inputs.card_pages(spark, sf_dir), CARD_SELECTORS, F.col("max_empty"), F.col("chain"), path,
                                          F.timestamp_micros(F.lit(inputs.BASE_MICROS)))
    return path, summary


@register("product_flow_pages", O.product_flow_pages)
def product_flow_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§3.1 over result pages of every part: cards -> verdict -> cut-off -> raw
    rows -> required check -> append; the appended rows with run, page and place."""
    path, _ = _product_flow(spark, sf_dir)
    back = spark.read.schema(RAW_PRICE_SCHEMA + ", run string, page_num bigint, pos bigint").parquet(path)
    return back.withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


@register("chain_flow", O.product_flow_pages)
def chain_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§3.1 over every chain's own markup with its own selectors and stop limit."""
    path = shared_dir(spark, "tables", "chain_prices")
    flows.product_price_flow(inputs.chain_pages(spark, sf_dir), {c: config[0] for c, config in P.CHAIN_CONFIGS.items()}, F.col("max_empty"),
                             F.col("chain"), path, F.timestamp_micros(F.lit(inputs.BASE_MICROS)))
    back = spark.read.schema(RAW_PRICE_SCHEMA + ", run string, page_num bigint, pos bigint").parquet(path)
    return back.withColumn("scraped_datetime", F.col("scraped_datetime").cast("timestamp_ntz"))


@register("product_flow_summary", O.product_flow_summary)
def product_flow_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _product_flow(spark, sf_dir)[1]


@register("cards_per_page", O.cards_per_page)
def cards_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid cards per result page."""
    return quality.counts_per(pages.extract_primary(inputs.card_pages(spark, sf_dir), CARD_SELECTORS[0]), ["page_id"])


@register("branch_flow", O.branch_flow)
def branch_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """§3.2 JSON variant: nested document -> flatten -> guarded replace ->
    branch model."""
    nested = inputs.nested_branches(spark, sf_dir)
    return flows.branch_flow(nested, "branches_by_province", shared_dir(spark, "tables", "flow_branches"), F.col("fecha"))


@register("card_prices", O.card_prices)
def card_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: product cards (built from ``part``) parsed back into product name
    and price."""
    cards = load(spark, sf_dir, "part").selectExpr("p_partkey", f"{inputs.card_text_sql('spark')} AS card")
    name, price = prices.parse_card(F.col("card"))
    return cards.select("p_partkey", name, price.cast("double").alias("price"))


@register("sample_prices_table", O.union_prices)
def sample_prices_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + K8: the price feed published as a catalog table with CREATE OR
    REPLACE semantics (first the literal sample rows, then the full feed),
    read back through the catalog."""
    name = f"scraped_prices_{uuid.uuid4().hex[:12]}"
    path = shared_dir(spark, "tables", name)
    at = F.timestamp_micros(F.lit(inputs.BASE_MICROS)).cast("timestamp_ntz")
    writers.create_or_replace(prices.sample_prices(spark, at), name, path)
    writers.create_or_replace(union_prices(spark, sf_dir), name, path)
    return spark.table(name)


@register("json_docs_roundtrip", O.json_docs_roundtrip)
def json_docs_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: arbitrary JSON documents, one per line, read back as VARIANT and
    unpacked.  A document holds 50 page records (a bounded group)."""
    root = shared_dir(spark, "archive", "docs")
    pg = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    docs = pg.groupBy(F.floor(F.col("page_id") / inputs.DOC_CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("page_id", "url", "html"))).alias("pages"))
    docs.write.json(root)
    back = read_json_docs(spark, root, one_per_line=True)
    typed = back.select(
        F.expr("variant_get(doc, '$.chunk', 'bigint')").alias("chunk"),
        F.explode(F.expr("variant_get(doc, '$.pages', 'array<struct<page_id bigint, url string, html string>>')")).alias("p"))
    return typed.select("chunk", "p.page_id", "p.url", "p.html")
