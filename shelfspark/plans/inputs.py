"""Raw inputs derived from the driver's tables.

The reference's raw tables come from a browser; here they are built from the
given tables with deterministic SQL expressions.  The *same* expression text
is used by Spark (``selectExpr``) and by the DuckDB oracle, so both engines
parse identical raw text.  Only two spellings differ per engine and are
templated: timestamps from microseconds and NULL-free array literals.

Every builder is a narrow projection over a scan (plus joins to the tiny
``nation``/``region`` dimensions, which the planner broadcasts by size); branch
pages are dealt over more tasks than the scan has (``spread``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..sources.tables import load, spread

# microseconds since epoch of 2025-06-16 06:00:00 UTC (a Monday 06:00 run)
BASE_MICROS = 1750053600000000


def ts_expr(engine: str, micros_sql: str) -> str:
    fn = "timestamp_micros" if engine == "spark" else "make_timestamp"
    return f"{fn}({BASE_MICROS} + {micros_sql})"


def compact_array(engine: str, items: list[str]) -> str:
    body = ", ".join(items)
    if engine == "spark":
        return f"array_compact(array({body}))"
    return f"list_filter([{body}], lambda x: x IS NOT NULL)"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


# ------------------------------------------------------------ store text ----
def store_text_exprs(engine: str) -> dict[str, str]:
    k = "c_custkey"
    line0 = (f"CASE {k} % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'HIPER-' || c_mktsegment "
             f"ELSE 'express/' || lower(c_mktsegment) || ' 24hs' END")
    line1 = (f"CASE WHEN {k} % 5 = 0 THEN chr(9) || c_name ELSE c_name END || ', ' || n_name"
             f" || CASE WHEN {k} % 7 = 0 THEN '' ELSE ', ' || r_name END"
             f" || CASE WHEN {k} % 13 = 0 THEN ', Centro' ELSE '' END")
    line2 = (f"CASE WHEN {k} % 11 = 0 THEN 'Abierto ' || {_s(f'{k} % 9 + 1')} || ':00 a ' || "
             f"{_s(f'{k} % 12 + 12')} || ':30' "
             f"ELSE 'Abierto ' || lpad({_s(f'{k} % 12')}, 2, '0') || ':00 a ' || "
             f"{_s(f'{k} % 12 + 12')} || ':30' END")
    text = (f"{line0} || chr(10) || {line1} || "
            f"CASE WHEN {k} % 17 = 0 THEN '' ELSE chr(10) || {line2} END")
    return {
        "id": f"CAST({k} AS BIGINT)",
        "ubicacion_texto": text,
        "fecha_extraccion": ts_expr(engine, f"{k} * 37250001"),
        "fuente": "'carrefour.com.ar/sucursales'",
    }


def raw_store_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nat = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    joined = (cust.join(nat, cust.c_nationkey == nat.n_nationkey, "inner")
              .join(reg, nat.n_regionkey == reg.r_regionkey, "left"))
    return joined.selectExpr(*[f"{v} AS {k}" for k, v in store_text_exprs("spark").items()])


def raw_store_text_sql() -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in store_text_exprs("duckdb").items())
    return (f"SELECT {cols} FROM customer JOIN nation ON c_nationkey = n_nationkey "
            f"LEFT JOIN region ON n_regionkey = r_regionkey")


# -------------------------------------------------------------- branches ----
def branch_item_exprs() -> list[str]:
    k = "c_custkey"
    addr = (f"CASE WHEN {k} % 5 = 0 THEN NULL "
            f"WHEN {k} % 4 = 0 THEN 'Av. San Martín ' || {_s(k)} "
            f"WHEN {k} % 4 = 1 THEN 'Calle ' || {_s(f'{k} % 300')} || ' N° ' || {_s(f'{k} % 77')} "
            f"WHEN {k} % 4 = 2 THEN 'Ruta ' || {_s(f'{k} % 40')} || ' KM ' || {_s(f'{k} % 97')} "
            f"ELSE 'Boulevard Oroño ' || {_s(k)} END")
    hours = (f"CASE WHEN {k} % 3 = 0 THEN NULL "
             f"WHEN {k} % 8 = 1 THEN 'MIÉRCOLES cerrado' "
             f"WHEN {k} % 8 = 2 THEN 'desde ' || {_s(f'{k} % 10')} || ':00' "
             f"WHEN {k} % 8 = 5 THEN lpad({_s(f'{k} % 24')}, 2, '0') || ':00' || chr(10) || '21:00' "
             f"ELSE 'Lunes a Sábado ' || {_s(f'{k} % 12')} || ':00 a ' || {_s(f'12 + {k} % 10')} "
             f"|| ':30' END")
    phone = (f"CASE WHEN {k} % 2 = 1 THEN NULL "
             f"WHEN {k} % 7 = 0 THEN 'Hotel central' "
             f"WHEN {k} % 10 = 4 THEN '4444' || chr(10) || '5555' || chr(10) || '6666' "
             f"ELSE 'Tel: ' || lpad({_s(f'{k} % 10000')}, 4, '0') || '-' || "
             f"lpad({_s(f'{k} % 9000')}, 4, '0') END")
    extra = (f"CASE WHEN {k} % 6 = 1 THEN 'EXTRA: Calle ' || {_s(f'{k} % 50')} || ' esquina' "
             f"ELSE NULL END")
    blank = (f"CASE WHEN {k} % 10 = 3 THEN chr(9) || '  Sucursal ' || c_name || '  ' "
             f"ELSE NULL END")
    return [addr, hours, phone, extra, blank]


def branch_exprs(engine: str) -> dict[str, str]:
    k = "c_custkey"
    arr = compact_array(engine, branch_item_exprs())
    raw = (f"CASE WHEN {k} % 37 = 0 THEN 'not json' WHEN {k} % 31 = 0 THEN '[]' "
           f"ELSE CAST(to_json({arr}) AS STRING) END")
    return {
        "sucursal_id": _s(k),
        "nombre": f"CASE WHEN {k} % 9 = 0 THEN ' ' || c_name || chr(9) ELSE c_name END",
        "provincia": "n_name",
        "raw_data": raw,
        "fecha_extraccion": ts_expr(engine, f"{k} * 53000017"),
        "fuente": "'vea.com.ar/sucursales'",
    }


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nat = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = cust.join(nat, cust.c_nationkey == nat.n_nationkey, "inner")
    return joined.selectExpr(*[f"{v} AS {k}" for k, v in branch_exprs("spark").items()])


def raw_branches_sql() -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in branch_exprs("duckdb").items())
    return f"SELECT {cols} FROM customer JOIN nation ON c_nationkey = n_nationkey"


# ------------------------------------------------ branches from documents ----
def doc_branch_exprs(engine: str) -> dict[str, str]:
    split = "split(text, chr(10), -1)" if engine == "spark" else "string_split(text, chr(10))"
    return {
        "sucursal_id": _s("doc_id"),
        "nombre": "source",
        "provincia": "lang",
        "raw_data": f"CAST(to_json({split}) AS STRING)",
        "fecha_extraccion": ts_expr(engine, "doc_id * 1000003"),
        "fuente": "'documents'",
    }


def raw_doc_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return docs.selectExpr(*[f"{v} AS {k}" for k, v in doc_branch_exprs("spark").items()])


def branch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw branches' items in long form: (sucursal_id, pos, item)."""
    return raw_branches(spark, sf_dir).select("sucursal_id", F.posexplode(F.from_json("raw_data", "array<string>")).alias("pos", "item"))


def raw_doc_branches_sql() -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in doc_branch_exprs("duckdb").items())
    return f"SELECT {cols} FROM documents"


# ------------------------------------------------------------- crawl log ----
def crawl_log_exprs() -> dict[str, str]:
    """events as a crawl log: run = user, page order = (ts, event_id); error
    events are HTTP 500 pages or failed loads, some signups are pages without
    evidence or without a card; users belong to the three chains in turn, whose
    stop limits are 0, 2 and 0."""
    return {
        "run": "user_id",
        "ts": "ts",
        "event_id": "event_id",
        "status": "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 500 WHEN event_id % 7 = 0 THEN NULL ELSE 200 END",
        "load_error": "event_type = 'error' AND event_id % 2 = 1",
        "has_products": "NOT (event_type = 'signup' AND value < 2)",
        "cards": "CASE WHEN event_type = 'signup' AND value < 5 THEN 0 ELSE 1 END",
        "max_empty": "CASE user_id % 3 WHEN 1 THEN 2 ELSE 0 END",
    }


def crawl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return ev.selectExpr(*[f"{v} AS {k}" for k, v in crawl_log_exprs().items()])


def crawl_log_sql() -> str:
    cols = ", ".join(f"{v} AS {k}" for k, v in crawl_log_exprs().items())
    return f"SELECT {cols} FROM events"


# ------------------------------------------------------------ run status ----
ORDER_STATE_SQL = ("CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' "
                   "ELSE CASE o_orderkey % 4 WHEN 0 THEN 'up_for_retry' WHEN 1 THEN 'running' "
                   "WHEN 2 THEN 'queued' ELSE NULL END END")
LOOKUP_FAILED_SQL = "o_orderkey % 29 = 0"
RUN_DATE_SQL = "CAST(date_trunc('month', o_orderdate) AS DATE)"
PRIORITY_LABELS = {"1-URGENT": "URGENTE", "2-HIGH": "ALTA"}


# ---------------------------------------------------------- price sources ----
def conversation_price_exprs(engine: str) -> dict[str, str]:
    return {
        "item": "text",
        "store_name": "CASE conv_id % 3 WHEN 0 THEN 'CARREFOUR' WHEN 1 THEN 'JUMBO' ELSE 'VEA' END",
        # thirty daily runs, each with one load time
        "scraped_at": ts_expr(engine, "conv_id % 30 * 86400000000"),
    }


def part_slice_exprs(store: str, engine: str = "spark") -> dict[str, str]:
    return {
        "product_name": "p_name",
        "price": "p_retailprice",
        "currency": "'ARS'",
        "store_name": f"'{store}'",
        "category": "p_type",
        "url": "'https://example.com/p/' || CAST(p_partkey AS STRING)",
        "scraped_at": f"CAST({ts_expr(engine, '0')} AS {'TIMESTAMP_NTZ' if engine == 'spark' else 'TIMESTAMP'})",
    }


# three chains' feeds = three package-size ranges of the part table (together: every part)
PART_SLICES = [("CARREFOUR", "p_size <= 17"), ("JUMBO", "p_size BETWEEN 18 AND 34"),
               ("VEA", "p_size >= 35 OR p_size IS NULL")]


# ------------------------------------------------------------ nested doc ----
def nested_branch_exprs(engine: str) -> dict[str, str]:
    """Per branch ``i`` of customer ``c_custkey`` (1 to 3 branches each)."""
    i, k = "i", "c_custkey"
    raw = [f"'Calle ' || {_s(i)}", f"'Tel ' || {_s(k)}", "'Ñandú \"x\"'"]
    return {
        "id": f"CASE WHEN {k} % 11 = 0 AND {i} = 0 THEN NULL ELSE {_s(k)} || '-' || {_s(i)} END",
        "nombre": f"CASE WHEN ({k} + {i}) % 13 = 0 THEN NULL ELSE c_name || ' #' || {_s(i)} END",
        "provincia": "n_name",
        "raw_data_cond": f"({k} + {i}) % 4 = 0",
        "raw_items": ", ".join(raw),
        "fecha": ts_expr(engine, f"{k} * 1000001"),
    }


def nested_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> one nested document per customer: ``map(province ->
    array<branch struct>)`` with 1-3 branches and some missing keys."""
    e = nested_branch_exprs("spark")
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nat = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = cust.join(nat, cust.c_nationkey == nat.n_nationkey, "inner")
    branch = (f"named_struct('id', {e['id']}, 'nombre', {e['nombre']}, 'provincia', {e['provincia']}, "
              f"'raw_data', CASE WHEN {e['raw_data_cond']} THEN NULL ELSE array({e['raw_items']}) END)")
    return j.selectExpr("c_custkey", f"{e['fecha']} AS fecha",
                        f"map(n_name, transform(sequence(CAST(0 AS BIGINT), c_custkey % 3), i -> {branch})) "
                        f"AS branches_by_province")


# --------------------------------------------------------------- options ----
SEGMENT_NO = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 "
              "WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END")


def options_sql() -> str:
    """Every customer is an option; a select is a nation's market segment, whose
    sizes lie on both sides of the limit of A8."""
    return f"""
SELECT n_regionkey AS page_id, n_nationkey * 5 + {SEGMENT_NO} AS select_idx, c_custkey AS pos,
       CAST(c_custkey AS STRING) AS codigo, c_name AS nombre
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT n_regionkey, n_nationkey * 5, CAST(-1 AS BIGINT), 'Provincia', 'Provincia' FROM nation
UNION ALL SELECT n_regionkey, n_nationkey * 5, CAST(-2 AS BIGINT), 'provincia', ' provincia ' FROM nation
          WHERE n_nationkey % 2 = 0"""


def option_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nat = load(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    opts = cust.join(nat, cust.c_nationkey == nat.n_nationkey).selectExpr(
        "n_regionkey AS page_id", f"n_nationkey * 5 + {SEGMENT_NO} AS select_idx", "c_custkey AS pos",
        "CAST(c_custkey AS STRING) AS codigo", "c_name AS nombre")
    ph = nat.selectExpr("n_regionkey AS page_id", "n_nationkey * 5 AS select_idx", "CAST(-1 AS BIGINT) AS pos",
                        "'Provincia' AS codigo", "'Provincia' AS nombre")
    ph2 = nat.where(F.col("n_nationkey") % 2 == 0).selectExpr(
        "n_regionkey AS page_id", "n_nationkey * 5 AS select_idx", "CAST(-2 AS BIGINT) AS pos",
        "'provincia' AS codigo", "' provincia ' AS nombre")
    return opts.unionByName(ph).unionByName(ph2)


# ------------------------------------------------------------ built pages ----
# Pages in the markup that the collectors read, built from the tables: a page
# holds a fixed number of keys, so no page grows with the data.
def _page(rows: DataFrame, keys: list[str], order: str, part: str, before: str, after: str) -> DataFrame:
    parts = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, part))).alias("_p"))
    return parts.withColumn("html", F.concat(F.lit(f"<!DOCTYPE html><html><body>{before}"), F.array_join(f"_p.{part}", "\n"),
                                             F.lit(f"{after}</body></html>"))).drop("_p")


def _html(text: str, line_end: str = "<br>") -> Column:
    """A text as markup; its line ends as ``line_end`` (text content keeps only a plain one)."""
    escaped = F.replace(F.replace(F.replace(F.col(text), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("ñ"), F.lit("&ntilde;"))
    return F.replace(F.replace(escaped, F.lit("í"), F.lit("&#237;")), F.lit("\n"), F.lit(line_end))


OPTION_PAGE = 400


def option_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for 400 customers; a ``<select>`` per nation."""
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    opts = cust.select((F.floor(F.col("c_custkey") / OPTION_PAGE)).cast("bigint").alias("page_id"), "c_nationkey", "c_custkey",
                       F.concat(F.lit('<option class="o" value="'), F.col("c_custkey").cast("string"), F.lit('">'), _html("c_name"),
                                F.lit("</option>")).alias("o"))
    selects = opts.groupBy("page_id", "c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", "o"))).alias("_o")).select(
        "page_id", "c_nationkey", F.concat(F.lit('<select name="s"><option value="Provincia">Provincia'), F.array_join("_o.o", ""),
                                           F.lit("</select>")).alias("s"))
    return _page(selects, ["page_id"], "c_nationkey", "s", "<form>", "</form>")


CARD_PAGE = 20
CARD_CHAIN = "CASE WHEN p_size <= 17 THEN 'CARREFOUR' WHEN p_size <= 34 THEN 'JUMBO' ELSE 'VEA' END"
CARD_BLOCK = f"CAST(floor(p_partkey / {CARD_PAGE}) AS BIGINT)"
CARD_EMPTY = "block % 16 IN (5, 9, 10)"   # pages without a result
CARD_URL = ("'https://example.com/' || lower(chain) || CASE WHEN block % 23 = 3 THEN '/error?page=' ELSE '/dulce?page=' END "
            "|| CAST(block AS STRING)")
CARD_RUN = "chain || '-' || CAST(CAST(floor(block / 16) AS BIGINT) AS STRING)"
CARD_LIMIT = "CASE chain " + " ".join(f"WHEN '{c}' THEN {limit}" for c, (_, _, limit) in P.CHAIN_CONFIGS.items()) + " END"
CARD_CLASS = "galleryItem"


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of every part: ``(page_id, url, html, chain, run, page_order,
    max_empty)``, a page per chain and 20 part keys."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    cards = part.selectExpr("p_partkey", f"{CARD_CHAIN} AS chain", f"{CARD_BLOCK} AS block", f"{card_text_sql('spark')} AS card")
    primary = F.when(F.col("chain") == "CARREFOUR", P.CHAIN_CONFIGS["CARREFOUR"][0][0][1:]).when(
        F.col("chain") == "JUMBO", P.CHAIN_CONFIGS["JUMBO"][0][0][1:]).otherwise(P.CHAIN_CONFIGS["VEA"][0][0][1:])
    article = F.concat(F.lit('<article class="x '), primary, F.lit(' y"><b>'), _html("card"), F.lit("</b></article>"))
    none = F.lit('<div class="shop titleNotFound"><p>Sin resultados</p></div>')
    cards = cards.withColumn("part", F.when(F.expr(CARD_EMPTY), none).otherwise(article))
    pg = _page(cards, ["chain", "block"], "p_partkey", "part", "<main>", "</main>")
    return _as_crawled(pg)


def _as_crawled(pg: DataFrame) -> DataFrame:
    return pg.selectExpr("block * 3 + CASE chain WHEN 'CARREFOUR' THEN 0 WHEN 'JUMBO' THEN 1 ELSE 2 END AS page_id",
                         f"{CARD_URL} AS url", "html", "chain", f"{CARD_RUN} AS run", "block AS page_order", f"{CARD_LIMIT} AS max_empty")


def chain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of every part in each chain's own markup: cards of nested blocks
    without ``<br>``, unclosed paragraphs and items, single and no quotes; fake cards
    in comments and under look-alike classes; pages without a result say so by
    text or by class, or only seem to.  Columns as in ``card_pages``."""
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    cards = part.selectExpr("p_partkey", f"{CARD_CHAIN} AS chain", f"{CARD_BLOCK} AS block", f"split({card_text_sql('spark')}, '\n') AS line")
    for i in range(3):
        cards = cards.withColumn(f"l{i}", F.get("line", i))
    l0, l1, l2 = _html("l0"), _html("l1"), _html("l2")
    primary = {c: config[0][0][1:] for c, config in P.CHAIN_CONFIGS.items()}
    name = F.col("chain")
    card = F.when(name == "CARREFOUR", F.concat(
        F.lit(f'<div data-x="class=\'no\'" class="w {primary["CARREFOUR"]} z"><section><a href="/p"><div><h3><b>'), l0, F.lit("</b></h3><div>"),
        l1, F.lit("</div></div></a><div class=price><!-- $ 1 -->"), l2, F.lit("</div></section></div>"))).when(name == "JUMBO", F.concat(
            F.lit("<section aria-label='Producto "), F.col("p_partkey").cast("string"),
            F.lit(f"' class='vtex-product-summary-2-x-container'><div class={primary['JUMBO']}><p>"), l0, F.lit("<p>"), l1, F.lit("<p>"), l2,
            F.lit("</div></section>"))).otherwise(F.concat(
                F.lit(f'<article class="x\tvtex-product-summary-2-x-element"><div class="{primary["VEA"]}"><ul><li>'), l0, F.lit("<li>"), l1,
                F.lit("<li><span>"), l2, F.lit("</span></ul></div></article>")))
    even = F.col("block") % 2 == 0
    none = F.when(name == "CARREFOUR", F.when(even, F.lit("<div><span>Sin\n resultados</span></div>")).otherwise(
        F.lit("<div class='shop titleNotFound'>x</div>"))).when(name == "JUMBO", F.when(even, F.lit("<h2> Error <b>404</b></h2>")).otherwise(
            F.lit("<p class=search-not-found-term>x"))).otherwise(F.when(even, F.lit('<div class="a gallery--empty">x</div>')).otherwise(
                F.lit('<div class="x-gallery--empty-y">Error 404, dice</div>')))
    cards = cards.withColumn("part", F.when(F.expr(CARD_EMPTY), none).otherwise(card))
    fake = "".join(f'<!-- <div class="{c}">$ comentario, no es una tarjeta</div> --><i class="x{c}y">$ tampoco</i>' for c in primary.values())
    pg = _page(cards, ["chain", "block"], "p_partkey", "part", f"<main><div>{fake}", "</div></main>")
    return _as_crawled(pg)


STORE_PAGE = 50


def store_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store-list pages of 50 customers each."""
    rows = raw_store_text(spark, sf_dir).select((F.floor(F.col("id") / STORE_PAGE)).cast("bigint").alias("page_id"), "id", F.concat(
        F.lit(f'<li class="{P.STORE_ITEM_CLASS} z"><span>'), _html("ubicacion_texto"), F.lit("</span></li>")).alias("li"))
    return _page(rows, ["page_id"], "id", "li", f'<ul class="nav"><li>inicio</li></ul><ul class="{P.STORE_LIST_CLASSES}">', "</ul>")


def store_block_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store lists with a block element for every line, in nested lists."""
    rows = raw_store_text(spark, sf_dir).withColumn("text", _html("ubicacion_texto", "\n")).select(
        (F.floor(F.col("id") / STORE_PAGE)).cast("bigint").alias("page_id"), "id", F.concat(
            F.lit(f"<li class='{P.STORE_ITEM_CLASS}'><div><p>"), F.array_join(F.split("text", "\n", -1), "</p></div><div><p>"),
            F.lit("</p></div>")).alias("li"))
    classes = " ".join(reversed(P.STORE_LIST_CLASSES.split()))
    return _page(rows, ["page_id"], "id", "li", f'<ul><li class="{P.STORE_ITEM_CLASS}">otra lista</ul><!-- {P.STORE_LIST_CLASSES} --><ul class="{classes} q">',
                 f'</ul><div class="{P.STORE_ITEM_CLASS}">no</div>')


PAGES_PER_TASK = 4000  # a detail page takes a millisecond or more to read, its customer a few bytes


def _branch_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of every customer's branch, a column each; dealt out, as a page of each is read."""
    cust = spread(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), PAGES_PER_TASK)
    nat = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    addr, hours, phone, extra, blank = branch_item_exprs()
    return cust.join(nat, cust.c_nationkey == nat.n_nationkey).selectExpr(
        "c_custkey", "c_name", "n_name", f"{addr} AS i0", f"{hours} AS i1", f"{phone} AS i2", f"{blank} AS i3", f"{extra} AS extra",
        f"{ts_expr('spark', 'c_custkey * 53000017')} AS fecha_extraccion")


def branch_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detail page per customer: facts as ``ul li p``, the extra one as an info block."""
    rows = _branch_items(spark, sf_dir)
    facts = [F.when(F.col(c).isNotNull(), F.concat(F.lit("<li><p class='f'>"), _html(c, "\n"), F.lit("</p></li>"))) for c in ("i0", "i1", "i2", "i3")]
    info = F.when(F.col("extra").isNotNull(), F.concat(
        F.lit('<div class="a store-info">'), F.regexp_replace("extra", f"^{P.EXTRA_PREFIX}", ""), F.lit("</div>")))
    return rows.select("c_custkey", "c_name", "n_name", "fecha_extraccion", F.concat_ws(
        "", F.lit("<html><body><p>intro</p><ul>"), *facts, F.lit("<li><p> </p></li></ul>"), info, F.lit("</body></html>")).alias("html"))


def nested_branch_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same facts on pages with lists in lists, unclosed items, ``ol`` lists and
    comments that hold no fact, and info blocks of other elements."""
    def fact(name: str, before: str, after: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.concat(F.lit(before), _html(name, "\n"), F.lit(after)))

    info = F.when(F.col("extra").isNotNull(), F.concat(
        F.lit("<section class='z\tbranch-details'>"), F.regexp_replace(F.regexp_replace("extra", f"^{P.EXTRA_PREFIX}", ""), " ", " <i>"),
        F.lit("</i></section>")))
    return _branch_items(spark, sf_dir).select("c_custkey", "c_name", "n_name", "fecha_extraccion", F.concat_ws(
        "", F.lit("<html><body><p>intro</p><!-- <ul><li><p>comentario</p></li></ul> --><ol><li><p>Calle 1</p></ol><ul class='o'><li>"),
        fact("i0", "<p>", "</p>"), F.lit("<ul><li>"), fact("i1", "<div><p class=f>", "</div>"), F.lit("<li>"), fact("i2", "<p title='</p>'>", ""),
        F.lit("</ul>Ruta 2"), fact("i3", "<p>", "</p>"), F.lit("</li><li><p> <br></p></ul><div class='my-store-info-icon'>Ruta 3</div>"), info,
        F.lit("<div class='otra sucursal-info'> </div></body></html>")).alias("html"))


def branch_page_items() -> str:
    """The same facts as SQL: stripped items, the extra one last."""
    addr, hours, phone, extra, blank = branch_item_exprs()
    return ", ".join(f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')" for x in (addr, hours, phone, blank, extra))


# ------------------------------------------------------------- envelopes ----
ENVELOPE_CHUNK = 8    # turns and
ENVELOPE_BLOCK = 192  # conversations (a third of them per chain) of one envelope: a bounded group


def envelope_ts_sql(engine: str) -> str:
    return ts_expr(engine, f"CAST(floor(conv_id / {ENVELOPE_BLOCK}) AS BIGINT) * 3600000000 + "
                           f"CAST(floor(turn / {ENVELOPE_CHUNK}) AS BIGINT) * 1000001")


def conversation_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> one scrape envelope per chain, block of conversations
    and eight turns, as the indented JSON document a run leaves (``value``);
    ``store`` is the landing partition."""
    conv = load(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "text", "CASE conv_id % 3 WHEN 0 THEN 'CARREFOUR' WHEN 1 THEN 'JUMBO' ELSE 'VEA' END AS store",
        f"CAST(floor(conv_id / {ENVELOPE_BLOCK}) AS BIGINT) AS block", f"CAST(floor(turn / {ENVELOPE_CHUNK}) AS BIGINT) AS chunk",
        f"{envelope_ts_sql('spark')} AS ts")
    env = conv.groupBy("store", "block", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("conv_id", "turn", "text"))).alias("_s"), F.first("ts").alias("ts"))
    document = F.struct(
        F.col("_s.text").alias("items"),
        F.size("_s").cast("int").alias("pages_processed"),
        F.size("_s").cast("int").alias("total_items"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))
    return env.select(F.to_json(document, {"pretty": "true"}).alias("value"), "store")


# what is wrong with the broken ones that are made of every envelope
BROKEN = ["malformed", "no items", "null item", "no timestamp"]


def broken_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that cannot become rows (``value``, ``store``): every envelope in four broken ways."""
    env = conversation_envelopes(spark, sf_dir).withColumn("kind", F.explode(F.array(*map(F.lit, BROKEN))))
    kind, value = F.col("kind"), F.col("value")
    broken = F.when(kind == "malformed", F.substring(value, F.lit(1), F.length(value) - 5)).when(
        kind == "no items", F.replace(value, F.lit('"items" :'), F.lit('"otros" :'))).when(
            kind == "null item", F.regexp_replace(value, r'"items" : \[', '"items" : [ null,')).otherwise(
                F.regexp_replace(value, r'"timestamp" : "[^"]*"', '"timestamp" : "ayer"'))
    return env.select(broken.alias("value"), "store")


def envelope_wave(store: Column) -> Column:
    """Arrival wave of an envelope: two chains' runs land first, the third later."""
    return F.when(store == "VEA", F.lit(1)).otherwise(F.lit(0))


# ------------------------------------------------------------ card texts ----
CARD_PRICE = "p_retailprice + p_partkey % 7 * 1000"


def card_text_sql(engine: str) -> str:
    """A product card as collected: name, then the price in Argentine format
    (``.`` thousands, ``,`` decimals), e.g. ``$ 1.234,50``; every third card
    leaves the thousands points out."""
    us = f"format_number({CARD_PRICE}, 2)" if engine == "spark" else f"format('{{:,.2f}}', {CARD_PRICE})"
    ar = f"replace(replace(replace({us}, ',', CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '#' END), '.', ','), '#', '.')"
    return f"p_name || chr(10) || 'Precio final' || chr(10) || '$ ' || {ar}"


DOC_CHUNK = 50  # page records per JSON document (bounded group)
