"""DuckDB renderings of the same queries, used as the correctness oracle.

DuckDB uses RE2 like the reference's warehouse, so patterns appear here
exactly as in the reference; the Spark side adds the Java flags.
"""

from __future__ import annotations

import re

from ..functions import patterns as P
from . import inputs


def trim_(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_DELIMITERS = "\\s" + re.escape(P.INITCAP_DELIMITERS)
_TOK = f"[^{_DELIMITERS}]+|[{_DELIMITERS}]"


def title_case(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), {_q(_TOK)}), "
            f"lambda t: upper(t[1]) || t[2:]), '')")


def time_of_day(x: str) -> str:
    return f"strftime({x}, '%H:%M:%S.%f')"


def _store_model(raw_sql: str, keep: str = "") -> str:
    return f"""
WITH raw AS ({raw_sql}),
l AS (SELECT *, string_split(ubicacion_texto, chr(10)) AS lines FROM raw),
p AS (SELECT *, lines[1] AS l0, lines[3] AS l2, string_split(lines[2], ',') AS parts FROM l)
SELECT {keep} {title_case('l0')} AS tipo,
       {trim_('parts[1]')} AS direccion,
       {trim_('parts[2]')} AS localidad,
       {trim_('parts[3]')} AS provincia,
       nullif(regexp_extract(l2, {_q(P.STORE_OPEN_RE)}, 1), '') AS hora_apertura,
       nullif(regexp_extract(l2, {_q(P.STORE_CLOSE_RE)}, 1), '') AS hora_cierre,
       {trim_('parts[1]')} || ' , ' || {trim_('parts[3]')} || ' , Argentina' AS direccion_con_provincia,
       {time_of_day('fecha_extraccion')} AS hora_extraccion
FROM p"""


def store_text_parse() -> str:
    return _store_model(inputs.raw_store_text_sql())


def store_list_pages() -> str:
    page = f"CAST(floor(id / {inputs.STORE_PAGE}) AS BIGINT)"
    return _store_model(f"""SELECT {page} AS page_id, row_number() OVER (PARTITION BY {page} ORDER BY id) AS id,
       ubicacion_texto, {inputs.ts_expr('duckdb', '0')} AS fecha_extraccion FROM ({inputs.raw_store_text_sql()})""", "page_id, id,")


def _first(pattern: str, ci: bool) -> str:
    rx = ("(?i)" if ci else "") + pattern
    return f"{trim_(f'struct_extract(list_filter(it, lambda e: regexp_matches(e.j, {_q(rx)}))[1], ' + _q('v') + ')')}"


def _joined(pattern: str) -> str:
    rx = "(?i)" + pattern
    return (f"nullif(array_to_string(list_transform(list_filter(it, lambda e: regexp_matches(e.j, {_q(rx)})), "
            f"lambda e: {trim_('e.v')}), ' | '), '')")


def branch_model(raw_sql: str, order: bool = True) -> str:
    """The warehouse's branch model over any raw-branches SELECT."""
    sql = f"""
WITH raw AS ({raw_sql}),
parsed AS (
  SELECT sucursal_id, {trim_('nombre')} AS nombre_sucursal, {trim_('provincia')} AS provincia,
         CASE WHEN json_valid(raw_data) THEN from_json(raw_data, '["VARCHAR"]') END AS arr,
         fecha_extraccion, fuente
  FROM raw),
items AS (
  SELECT *, list_transform(list_filter(arr, lambda x: x IS NOT NULL),
                           lambda x: {{'v': x, 'j': CAST(to_json(x) AS VARCHAR)}}) AS it
  FROM parsed),
ex AS (
  SELECT sucursal_id, nombre_sucursal, provincia,
         {_joined(P.ADDRESS_RE)} AS direcciones_encontradas,
         {_joined(P.SCHEDULE_RE)} AS horarios_encontrados,
         {_joined(P.PHONE_RE)} AS telefonos_encontrados,
         {_first(P.ADDRESS_RE, True)} AS direccion_principal,
         nullif(regexp_extract({_first(P.TIME_RE, False)}, {_q(P.OPEN_EXTRACT_RE)}, 1), '') AS hora_apertura,
         nullif(regexp_extract({_first(P.TIME_RANGE_RE, False)}, {_q(P.CLOSE_EXTRACT_RE)}, 1), '') AS hora_cierre,
         CAST(len(arr) AS BIGINT) AS cantidad_datos_crudos,
         fecha_extraccion, fuente
  FROM items)
SELECT sucursal_id, nombre_sucursal, provincia, direccion_principal,
       CASE WHEN direccion_principal IS NOT NULL
            THEN direccion_principal || ', ' || provincia || ', Argentina' END AS direccion_completa,
       hora_apertura, hora_cierre,
       CASE WHEN hora_apertura IS NOT NULL AND hora_cierre IS NOT NULL
            THEN hora_apertura || ' - ' || hora_cierre END AS horario_completo,
       direcciones_encontradas, horarios_encontrados, telefonos_encontrados,
       cantidad_datos_crudos,
       CAST(fecha_extraccion AS DATE) AS fecha_extraccion_date,
       {time_of_day('fecha_extraccion')} AS hora_extraccion,
       fuente,
       CAST(CASE WHEN direccion_principal IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS tiene_direccion,
       CAST(CASE WHEN hora_apertura IS NOT NULL AND hora_cierre IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS tiene_horarios,
       CAST(CASE WHEN telefonos_encontrados IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS tiene_telefono
FROM ex"""
    if order:
        sql += "\nORDER BY provincia NULLS FIRST, nombre_sucursal NULLS FIRST"
    return sql


def branch_facts() -> str:
    return branch_model(inputs.raw_branches_sql())


def branch_facts_long() -> str:
    """In long form a branch whose document is no JSON is one without facts."""
    raw = inputs.raw_branches_sql()
    return branch_model(f"SELECT * REPLACE (CASE WHEN raw_data = 'not json' THEN '[]' ELSE raw_data END AS raw_data) FROM ({raw})", order=False)


def store_text_strict() -> str:
    return _store_model(f"SELECT * FROM ({inputs.raw_store_text_sql()}) WHERE len(string_split(ubicacion_texto, chr(10))) >= 3", "id,")


def branch_facts_documents() -> str:
    return branch_model(inputs.raw_doc_branches_sql(), order=False)


def branch_coverage() -> str:
    return f"""
WITH m AS ({branch_model(inputs.raw_branches_sql(), order=False)})
SELECT provincia,
       CAST(count(*) AS BIGINT) AS total_sucursales,
       CAST(sum(tiene_direccion) AS BIGINT) AS con_direccion,
       CAST(sum(tiene_horarios) AS BIGINT) AS con_horarios,
       CAST(sum(tiene_telefono) AS BIGINT) AS con_telefono
FROM m GROUP BY ROLLUP (provincia)"""


# ------------------------------------------------------------------ crawl ----
def _walk(run: str, order: str) -> str:
    """n(..., empty, max_empty) -> a(..., page_num, stop_page, kept)."""
    w = f"PARTITION BY {run} ORDER BY {order}"
    return f"""
n AS (SELECT *, row_number() OVER ({w}) AS page_num FROM e),
s AS (SELECT *, CASE WHEN empty THEN page_num - coalesce(max(CASE WHEN NOT empty THEN page_num END)
         OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) ELSE 0 END AS streak FROM n),
t AS (SELECT *, min(CASE WHEN empty AND streak >= greatest(max_empty, 1) THEN page_num END) OVER (PARTITION BY {run}) AS stop_page
      FROM s),
a AS (SELECT *, NOT empty AND (stop_page IS NULL OR page_num < stop_page) AS kept FROM t)"""


def _crawl_annotated() -> str:
    return f"""
log AS ({inputs.crawl_log_sql()}),
e AS (SELECT *, coalesce(status, 200) <> 200 OR load_error OR NOT has_products OR cards = 0 AS empty FROM log),
{_walk('run', 'ts, event_id')}"""


def crawl_cutoff() -> str:
    return f"""WITH {_crawl_annotated()}
SELECT run, event_id, CAST(page_num AS BIGINT) AS page_num, CAST(cards AS BIGINT) AS cards
FROM a WHERE kept"""


def _summary(cards: str, at: str = "") -> str:
    return f"""SELECT run,
       CAST(sum(CASE WHEN kept THEN {cards} ELSE 0 END) AS BIGINT) AS total_items,
       CAST(min(stop_page) - 1 AS BIGINT) AS pages_processed,
       CAST(max(page_num) AS BIGINT) AS last_page,
       CAST(count_if(kept) AS BIGINT) AS pages_with_cards {at}
FROM a GROUP BY run"""


def crawl_summary() -> str:
    return f"WITH {_crawl_annotated()} {_summary('cards', ', CAST(max(ts) AS TIMESTAMP) AS timestamp')}"


# ----------------------------------------------------------------- status ----
def _status_rows() -> str:
    cases = " ".join(f"WHEN {_q(raw)} THEN {_q(cls)}" for raw, cls in P.STATE_CLASSES)
    return f"""
exp AS (SELECT o_orderkey, {inputs.RUN_DATE_SQL} AS ds, o_orderpriority FROM orders),
obs AS (SELECT o_orderkey, {inputs.ORDER_STATE_SQL} AS state, {inputs.LOOKUP_FAILED_SQL} AS lookup_failed FROM orders
        WHERE {inputs.ORDER_STATE_SQL} IS NOT NULL),
j AS (SELECT exp.*, obs.state, CASE WHEN lookup_failed THEN 'ERROR' ELSE CASE obs.state {cases} ELSE 'UNKNOWN' END END AS status
      FROM exp LEFT JOIN obs USING (o_orderkey))"""


def status_summary() -> str:
    return f"""WITH {_status_rows()},
g AS (SELECT ds, CAST(count(*) AS BIGINT) AS total,
             CAST(count_if(status = 'COMPLETED') AS BIGINT) AS completed,
             CAST(count_if(status = 'FAILED') AS BIGINT) AS failed,
             CAST(count_if(status = 'RETRYING') AS BIGINT) AS retrying,
             CAST(count_if(status = 'RUNNING') AS BIGINT) AS running,
             CAST(count_if(status = 'ERROR') AS BIGINT) AS error,
             CAST(count_if(status = 'UNKNOWN') AS BIGINT) AS unknown
      FROM j GROUP BY ds)
SELECT *, total - completed - failed AS other,
       CASE WHEN total > 0 THEN completed / total * 100 ELSE 0.0 END AS success_rate,
       CASE WHEN completed = total THEN 'ALL' WHEN completed > 0 THEN 'PARTIAL' ELSE 'NONE' END AS verdict
FROM g"""


def status_by_flow() -> str:
    return f"""WITH {_status_rows()}
SELECT ds, o_orderpriority AS flow, status, CAST(count(*) AS BIGINT) AS tasks FROM j GROUP BY ALL"""


def status_detail() -> str:
    vals = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in sorted(inputs.PRIORITY_LABELS.items()))
    return f"""WITH {_status_rows()},
names(o_orderpriority, priority_label) AS (VALUES {vals})
SELECT o_orderkey, ds, status, coalesce(names.priority_label, j.o_orderpriority) AS priority_label
FROM j LEFT JOIN names USING (o_orderpriority)"""


# ----------------------------------------------------------------- prices ----
def price_change_pct() -> str:
    return """
WITH obs AS (SELECT l_partkey, l_shipdate, min(l_extendedprice / l_quantity) AS price
             FROM lineitem GROUP BY l_partkey, l_shipdate),
p AS (SELECT *, lag(price) OVER (PARTITION BY l_partkey ORDER BY l_shipdate) AS prev_price FROM obs)
SELECT l_partkey, CAST(l_shipdate AS DATE) AS ship_date, price, prev_price,
       CASE WHEN prev_price IS NOT NULL AND prev_price > 0
            THEN round((price - prev_price) / prev_price * 100, 2) + 0.0
       END AS price_change_pct
FROM p"""


def clean_name(x: str) -> str:
    return trim_(f"upper(regexp_replace({x}, {_q(P.NON_WORD_RE)}, '', 'g'))")


def clean_product_name() -> str:
    return f"""
SELECT 'part' AS source, CAST(p_partkey AS BIGINT) AS key, {clean_name('p_name')} AS clean_name FROM part
UNION ALL
SELECT 'customer', CAST(c_custkey AS BIGINT), {clean_name('c_name')} FROM customer
UNION ALL
SELECT 'documents', CAST(doc_id AS BIGINT), {clean_name('text')} FROM documents"""


def union_prices() -> str:
    lit = " UNION ALL ".join(
        f"SELECT {_q(n)} AS product_name, CAST({p} AS DOUBLE) AS price, {_q(c)} AS currency, "
        f"{_q(s)} AS store_name, {_q(cat)} AS category, {_q(u)} AS url, {inputs.ts_expr('duckdb', '0')} AS scraped_at"
        for n, p, c, s, cat, u in P.SAMPLE_PRICES)
    slices = " UNION ALL ".join(
        "SELECT " + ", ".join(f"{v} AS {k}" for k, v in inputs.part_slice_exprs(s, 'duckdb').items())
        + f" FROM part WHERE {cond}" for s, cond in inputs.PART_SLICES)
    return f"{lit} UNION ALL {slices}"


def raw_price_rows() -> str:
    e = inputs.conversation_price_exprs("duckdb")
    return f"""
WITH items AS (SELECT {e['item']} AS item, {e['store_name']} AS store_name, {e['scraped_at']} AS scraped_at
               FROM conversations)
SELECT CAST(to_json(item) AS VARCHAR) AS raw_data, CAST(scraped_at AS DATE) AS scraped_date,
       scraped_at AS scraped_datetime, store_name, 'dulce_de_leche' AS category
FROM items"""


# ---------------------------------------------------- flatten / numbering ----
def flatten_branches() -> str:
    e = inputs.nested_branch_exprs("duckdb")
    items = f"[{e['raw_items']}]"
    return f"""
WITH b AS (SELECT c_custkey, c_name, n_name, unnest(range(0, c_custkey % 3 + 1)) AS i
           FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT coalesce({e['id']}, '') AS sucursal_id,
       coalesce({e['nombre']}, '') AS nombre,
       n_name AS provincia,
       CASE WHEN {e['raw_data_cond']} THEN '[]'
            ELSE '[' || array_to_string(list_transform({items}, lambda x: CAST(to_json(x) AS VARCHAR)), ', ') || ']'
       END AS raw_data,
       {e['fecha']} AS fecha_extraccion,
       '{P.SOURCE_BRANCHES}' AS fuente
FROM b"""


def _doc_lines() -> str:
    return ("SELECT doc_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, unnest(arr) AS line "
            "FROM (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents)")


def numbered_locations() -> str:
    return f"""SELECT doc_id, pos + 1 AS id, line AS ubicacion_texto, '{P.SOURCE_STORE_TEXT}' AS fuente
FROM ({_doc_lines()})"""


# ------------------------------------------------------------------ pages ----
def card_filter() -> str:
    return f"""SELECT doc_id, pos, line AS card FROM ({_doc_lines()})
WHERE contains(line, '$') AND length({trim_('line')}) > {P.CARD_MIN_LEN}"""


def page_frontier() -> str:
    return """
WITH f AS (SELECT page_id, url AS base_url, unnest(range(1, 4)) AS page FROM pages)
SELECT page_id, base_url, CAST(page AS BIGINT) AS page,
       CASE WHEN contains(base_url, '?') THEN base_url || '&page=' || CAST(page AS STRING)
            ELSE base_url || '?page=' || CAST(page AS STRING) END AS page_url
FROM f"""


def flat_text(x: str) -> str:
    for rx in ("(?is)<script\\b.*?</script\\s*>", "(?is)<style\\b.*?</style\\s*>", "(?s)<!--.*?-->", "<[^>]*>"):
        x = f"regexp_replace({x}, '{rx}', ' ', 'g')"
    for ent, ch in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, {_q(ent)}, {_q(ch)})"
    x = f"regexp_replace({x}, '\\s+', ' ', 'g')"
    return f"regexp_replace({x}, '^ | $', '', 'g')"


def _inner(tag: str, attributes: str = "(?:\\s[^>]*)?") -> str:
    """List of the inner HTML of every element of a tag, over column html."""
    if tag == "p":  # up to the first tag that ends the paragraph
        blocks = "address|article|aside|blockquote|div|dl|fieldset|footer|form|h[1-6]|header|hr|main|nav|ol|section|table|ul"
        holders = "address|article|aside|blockquote|body|div|footer|form|header|html|li|main|nav|ol|section|td|ul"
        ends = f"(?is)^(.*?)(?:</p\\b|<(?:{blocks})\\b|</(?:{holders})\\b|$)"
        return (f"list_transform(string_split_regex(html, '(?i)<p(?:\\s[^>]*)?>')[2:], "
                f"lambda x: regexp_extract(x, '{ends}', 1))")
    return f"regexp_extract_all(html, '(?is)<{tag}{attributes}>(.*?)</{tag}\\s*>', 1)"


def _tag_elements(tag: str, attributes: str = "(?:\\s[^>]*)?") -> str:
    return (f"SELECT page_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, unnest(arr) AS inner_html "
            f"FROM (SELECT page_id, {_inner(tag, attributes)} AS arr FROM pages)")


def article_cards() -> str:
    return f"""WITH el AS (SELECT page_id, pos, {flat_text('inner_html')} AS text FROM ({_tag_elements('article')}))
SELECT page_id, pos, text, contains(text, '$') AND length({trim_('text')}) > {P.CARD_MIN_LEN} AS is_card FROM el"""


def list_items() -> str:
    return f"SELECT page_id, pos, {flat_text('inner_html')} AS text FROM ({_tag_elements('li')})"


def tag_elements() -> str:
    every = [("article", None), ("li", None), ("a", None), ("div", '[^>]*class="[^"]*ad[^"]*"[^>]*'), ("p", None), ("h1", None), ("footer", None)]
    return " UNION ALL ".join(
        f"SELECT page_id, {i} AS selector_idx, pos, {flat_text('inner_html')} AS text FROM ("
        + (_tag_elements(tag, attrs) if attrs else _tag_elements(tag)) + ")" for i, (tag, attrs) in enumerate(every))


def option_pages() -> str:
    page = f"CAST(floor(c_custkey / {inputs.OPTION_PAGE}) AS BIGINT)"
    return f"""
WITH o AS (SELECT {page} AS page_id, c_nationkey, c_custkey, c_name FROM customer),
g AS (SELECT page_id, c_nationkey, row_number() OVER (PARTITION BY page_id ORDER BY c_nationkey) - 1 AS select_idx, count(*) AS n
      FROM o GROUP BY page_id, c_nationkey),
first AS (SELECT page_id, min(select_idx) AS select_idx FROM g WHERE n + 1 > {P.OPTION_GROUP_MIN} GROUP BY page_id)
SELECT o.page_id, CAST(g.select_idx AS INTEGER) AS select_idx,
       CAST(row_number() OVER (PARTITION BY o.page_id, o.c_nationkey ORDER BY c_custkey) AS INTEGER) AS pos,
       CAST(c_custkey AS STRING) AS codigo, c_name AS nombre
FROM o JOIN g USING (page_id, c_nationkey) JOIN first ON first.page_id = g.page_id AND first.select_idx = g.select_idx"""


def branch_facts_pages() -> str:
    items = f"list_filter([{inputs.branch_page_items()}], lambda x: x IS NOT NULL AND x <> '')"
    return branch_model(f"""SELECT CAST(c_custkey AS STRING) AS sucursal_id, c_name AS nombre, n_name AS provincia,
       CAST(to_json({items}) AS VARCHAR) AS raw_data, {inputs.ts_expr('duckdb', 'c_custkey * 53000017')} AS fecha_extraccion,
       'pages' AS fuente FROM customer JOIN nation ON c_nationkey = n_nationkey""", order=False)


# ------------------------------------------------------------ built cards ----
def _card_log() -> str:
    return f"""
cards AS (SELECT {inputs.CARD_CHAIN} AS chain, {inputs.CARD_BLOCK} AS block, p_partkey, {inputs.card_text_sql('duckdb')} AS card FROM part),
pg AS (SELECT chain, block, count(*) AS parts FROM cards GROUP BY chain, block),
e AS (SELECT chain, block, {inputs.CARD_RUN} AS run, {inputs.CARD_LIMIT} AS max_empty, {inputs.CARD_EMPTY} AS nothing,
             block % 23 = 3 OR contains(CAST(block AS STRING), '404') AS url_invalid, {inputs.CARD_EMPTY} OR url_invalid AS empty,
             CASE WHEN {inputs.CARD_EMPTY} THEN 0 ELSE parts END AS n_cards, parts FROM pg)"""


def card_page_verdict() -> str:
    return f"""WITH {_card_log()}
SELECT block * 3 + CASE chain WHEN 'CARREFOUR' THEN 0 WHEN 'JUMBO' THEN 1 ELSE 2 END AS page_id, {inputs.CARD_URL} AS url,
       CAST(2 * least(n_cards, {P.EVIDENCE_FIRST_N}) AS BIGINT) AS evidence, url_invalid, n_cards > 0 AND NOT url_invalid AS has_products,
       CASE WHEN nothing THEN 'titleNotFound' END AS marker
FROM e"""


def product_flow_pages() -> str:
    return f"""WITH {_card_log()}, {_walk('run', 'block')},
c AS (SELECT *, row_number() OVER (PARTITION BY chain, block ORDER BY p_partkey) - 1 AS pos FROM cards)
SELECT CAST(to_json(card) AS VARCHAR) AS raw_data, CAST({inputs.ts_expr('duckdb', '0')} AS DATE) AS scraped_date,
       {inputs.ts_expr('duckdb', '0')} AS scraped_datetime, a.chain AS store_name, '{P.PRICE_CATEGORY}' AS category,
       a.run, CAST(a.page_num AS BIGINT) AS page_num, CAST(pos AS BIGINT) AS pos
FROM a JOIN c ON a.chain = c.chain AND a.block = c.block WHERE a.kept"""


def product_flow_summary() -> str:
    return f"WITH {_card_log()}, {_walk('run', 'block')} {_summary('n_cards')}"


def cards_per_page() -> str:
    return f"""WITH {_card_log()}
SELECT block * 3 + CASE chain WHEN 'CARREFOUR' THEN 0 WHEN 'JUMBO' THEN 1 ELSE 2 END AS page_id, CAST(n_cards AS BIGINT) AS n FROM e WHERE n_cards > 0"""


def chain_cards() -> str:
    return f"""WITH {_card_log()}
SELECT block * 3 + CASE chain WHEN 'CARREFOUR' THEN 0 WHEN 'JUMBO' THEN 1 ELSE 2 END AS page_id, chain,
       row_number() OVER (PARTITION BY chain, block ORDER BY p_partkey) - 1 AS pos, card AS item
FROM cards WHERE NOT ({inputs.CARD_EMPTY})"""


def chain_verdict() -> str:
    """An element that two selectors match is evidence twice; a card is matched by 2, 3 and 2 of its chain's."""
    return f"""WITH {_card_log()}
SELECT block * 3 + CASE chain WHEN 'CARREFOUR' THEN 0 WHEN 'JUMBO' THEN 1 ELSE 2 END AS page_id,
       CAST(CASE chain WHEN 'JUMBO' THEN 3 ELSE 2 END * least(n_cards, {P.EVIDENCE_FIRST_N}) AS BIGINT) AS evidence,
       CASE WHEN NOT nothing THEN NULL
            WHEN chain = 'CARREFOUR' THEN CASE WHEN block % 2 = 0 THEN 'text="Sin resultados"' ELSE '[class*="titleNotFound"]' END
            WHEN chain = 'JUMBO' THEN CASE WHEN block % 2 = 0 THEN 'text="Error 404"' ELSE '.search-not-found-term' END
            WHEN block % 2 = 0 THEN '.gallery--empty' END AS marker,
       n_cards > 0 AND NOT url_invalid AS has_products
FROM e"""


_BLOCK_TAGS = ("address|article|aside|blockquote|details|div|dl|fieldset|figcaption|figure|footer|form|h[1-6]|header|hgroup|hr|main|menu|nav|ol|p|pre|"
               "section|table|ul|body|caption|center|dd|dt|html|li|optgroup|option|summary|tbody|tfoot|thead|tr")


def rendered_text(x: str) -> str:
    """Lines end at ``br`` (chr 3) and at the edges of blocks (chr 2)."""
    for rx, to in [("(?is)<script\\b.*?</script\\s*>", ""), ("(?is)<style\\b.*?</style\\s*>", ""), ("(?s)<!--.*?-->", ""),
                   ("(?i)<br\\s*/?>", "\x03"), (f"(?i)</?(?:{_BLOCK_TAGS})(?:\\s[^>]*)?>", "\x02"), ("<[^>]*>", "")]:
        x = f"regexp_replace({x}, '{rx}', '{to}', 'g')"
    for ent, ch in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, {_q(ent)}, {_q(ch)})"
    for rx, to in [("\\s+", " "), (" ?([\x02\x03]) ?", "\\1"), ("^\x02+", ""), ("([\x02\x03])\x02+", "\\1"), ("\x02$", "")]:
        x = f"regexp_replace({x}, '{rx}', '{to}', 'g')"
    return f"trim(translate({x}, '\x02\x03', chr(10) || chr(10)), ' ')"


def rendered_elements() -> str:
    def numbered(i: int, arr: str) -> str:
        return (f"SELECT page_id, {i} AS selector_idx, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, unnest(arr) AS inner_html "
                f"FROM (SELECT page_id, {arr} AS arr FROM pages)")
    nav = "regexp_extract(html, '(?is)<nav>(.*?)</nav>', 1)"
    every = [_inner("article"), f"regexp_extract_all({nav}, '(?is)<li>(.*?)</li>', 1)", _inner("div", '[^>]*class="ad"[^>]*'), _inner("nav"),
             _inner("footer"), "regexp_extract_all(html, '(?is)<body>(.*?)(?:</body\\s*>|$)', 1)"]
    rows = " UNION ALL ".join(numbered(i, arr) for i, arr in enumerate(every))
    return f"SELECT page_id, selector_idx, pos, {rendered_text('inner_html')} AS text FROM ({rows})"


# ---------------------------------------------------------------- options ----
def option_group() -> str:
    return f"""
WITH opts AS ({inputs.options_sql()}),
cnt AS (SELECT page_id, select_idx, count(*) AS n FROM opts GROUP BY page_id, select_idx),
chosen AS (SELECT page_id, min(select_idx) AS select_idx FROM cnt WHERE n > {P.OPTION_GROUP_MIN} GROUP BY page_id)
SELECT o.page_id, o.select_idx, o.pos, {trim_('o.codigo')} AS codigo, {trim_('o.nombre')} AS nombre
FROM opts o
WHERE EXISTS (SELECT 1 FROM chosen c WHERE c.page_id = o.page_id AND c.select_idx = o.select_idx)
  AND o.codigo IS NOT NULL AND o.codigo <> '' AND o.nombre IS NOT NULL AND o.nombre <> ''
  AND o.codigo <> 'Provincia'"""


def option_second_group() -> str:
    return f"""
WITH opts AS ({inputs.options_sql()}),
g AS (SELECT DISTINCT page_id, select_idx FROM opts),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY select_idx) - 1 AS rk FROM g)
SELECT o.page_id, o.select_idx, o.pos, {trim_('o.codigo')} AS codigo, {trim_('o.nombre')} AS nombre
FROM opts o
WHERE EXISTS (SELECT 1 FROM r WHERE r.rk = 1 AND r.page_id = o.page_id AND r.select_idx = o.select_idx)
  AND o.codigo IS NOT NULL AND o.codigo <> '' AND o.nombre IS NOT NULL AND o.nombre <> ''
  AND lower(o.codigo) <> 'provincia'"""


# ------------------------------------------------------------------ spine ----
def _spine() -> str:
    return """SELECT n_name AS provincia, CAST(c_custkey AS STRING) AS sucursal_id, c_name AS nombre,
       o_orderkey, concat_ws(' ', o_orderstatus, o_orderpriority) AS raw_item
FROM nation JOIN customer ON n_nationkey = c_nationkey LEFT JOIN orders ON c_custkey = o_custkey"""


def branch_spine() -> str:
    return _spine()


def branch_documents() -> str:
    return """SELECT n_name AS provincia, CAST(c_custkey AS STRING) AS sucursal_id, c_name AS nombre,
       '[' || coalesce(string_agg('"' || o_orderstatus || ' ' || o_orderpriority || '"', ', ' ORDER BY o_orderkey), '') || ']' AS raw_data
FROM nation JOIN customer ON n_nationkey = c_nationkey LEFT JOIN orders ON c_custkey = o_custkey
GROUP BY n_name, c_custkey, c_name"""


def items_per_branch() -> str:
    return "SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey"


def model_audit() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_rows FROM m"
        for c in ("sucursal_id", "nombre_sucursal", "provincia"))
    return f"WITH m AS ({branch_facts_documents()}) {parts}"


def not_null_audit() -> str:
    cols = ["provincia", "sucursal_id", "nombre", "o_orderkey", "raw_item"]
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_rows FROM s" for c in cols)
    return f"WITH s AS ({_spine()}) {parts}"


def _url_invalid(x: str) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {_q(m)})" for m in P.INVALID_URL_MARKERS) + ")"


def page_verdict() -> str:
    return f"""
WITH el AS (
  SELECT page_id, pos, {flat_text('inner_html')} AS text FROM ({_tag_elements('article')})
  UNION ALL
  SELECT page_id, pos, {flat_text('inner_html')} AS text FROM ({_tag_elements('p')})),
ev AS (SELECT page_id,
              CAST(count_if(contains(text, '$') AND length({trim_('text')}) > {P.EVIDENCE_MIN_LEN}) AS BIGINT) AS evidence
       FROM el WHERE pos < {P.EVIDENCE_FIRST_N} GROUP BY page_id)
SELECT p.page_id, p.url, CAST(coalesce(ev.evidence, 0) AS BIGINT) AS evidence,
       {_url_invalid('p.url')} AS url_invalid,
       coalesce(ev.evidence, 0) > 0 AND NOT {_url_invalid('p.url')} AS has_products
FROM pages p LEFT JOIN ev USING (page_id)"""


# ------------------------------------------------------------------ sinks ----
def price_append() -> str:
    return f"SELECT * FROM ({raw_price_rows()}) UNION ALL SELECT * FROM ({raw_price_rows()})"


def snapshot_replace() -> str:
    return inputs.raw_store_text_sql()


def surrogate_ids() -> str:
    return """
WITH b AS (SELECT p_partkey, p_name AS nombre, 'Descripción de ' || p_name AS descripcion,
                  row_number() OVER (ORDER BY p_partkey) AS rn, count(*) OVER () AS n FROM part)
SELECT CAST(rn AS BIGINT) AS id, p_partkey, nombre, descripcion FROM b
UNION ALL
SELECT CAST(rn + n AS BIGINT), p_partkey, nombre, descripcion FROM b"""


def json_archive() -> str:
    ts = inputs.ts_expr("duckdb", "page_id % 24 * 3600000000")
    return f"""SELECT page_id, url, html, strftime({ts}, '%Y%m%d_%H%M%S') || '_' || string_split(url, '/')[-1] AS object_key
FROM pages"""


def previous_event_value() -> str:
    return """SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_price FROM events"""


def stream_ingest() -> str:
    return f"""
WITH items AS (
  SELECT text AS item,
         CASE conv_id % 3 WHEN 0 THEN 'CARREFOUR' WHEN 1 THEN 'JUMBO' ELSE 'VEA' END AS store_name,
         {inputs.envelope_ts_sql('duckdb')} AS scraped_at
  FROM conversations)
SELECT CAST(to_json(item) AS VARCHAR) AS raw_data, CAST(scraped_at AS DATE) AS scraped_date,
       scraped_at AS scraped_datetime, store_name, 'dulce_de_leche' AS category
FROM items"""


def _envelopes() -> str:
    return f"""c AS (SELECT conv_id, turn, text, CASE conv_id % 3 WHEN 0 THEN 'CARREFOUR' WHEN 1 THEN 'JUMBO' ELSE 'VEA' END AS store,
             CAST(floor(conv_id / {inputs.ENVELOPE_BLOCK}) AS BIGINT) AS block, CAST(floor(turn / {inputs.ENVELOPE_CHUNK}) AS BIGINT) AS chunk,
             {inputs.envelope_ts_sql('duckdb')} AS ts FROM conversations)"""


def envelope_items() -> str:
    return f"""WITH {_envelopes()}
SELECT store, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, CAST(count(*) OVER e AS INTEGER) AS pages_processed,
       CAST(count(*) OVER e AS INTEGER) AS total_items, row_number() OVER (e ORDER BY conv_id, turn, text) - 1 AS item_pos, text AS item
FROM c WINDOW e AS (PARTITION BY store, block, chunk)"""


def stream_rejects() -> str:
    return f"""WITH {_envelopes()}
SELECT store, reason, CAST(count(*) AS BIGINT) AS n
FROM (SELECT DISTINCT store, block, chunk FROM c), (SELECT unnest([{', '.join(map(_q, inputs.BROKEN))}]) AS reason) GROUP BY store, reason"""


def chain_feed() -> str:
    return f"SELECT * FROM ({raw_price_rows()}) WHERE store_name = 'JUMBO'"


def previous_value_null_keys() -> str:
    return """SELECT user_id, event_type, event_id, value, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS prev_price
FROM (SELECT CASE WHEN user_id % 5 > 0 THEN user_id END AS user_id, event_type, event_id, value FROM events)"""


def daily_archive() -> str:
    return f"""SELECT raw_data, scraped_datetime, store_name AS chain, category,
       strftime(scraped_date, '%Y-%m-%d') AS dt FROM ({raw_price_rows()})"""


def daily_last_value() -> str:
    return """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(value, ts) AS price FROM events GROUP BY ALL),
p AS (SELECT *, lag(price) OVER (PARTITION BY user_id ORDER BY day) AS prev_price FROM d)
SELECT user_id, day, price, prev_price,
       CASE WHEN prev_price IS NOT NULL AND prev_price > 0
            THEN round((price - prev_price) / prev_price * 100, 2) + 0.0
       END AS price_change_pct
FROM p"""


def stores_per_province() -> str:
    return f"""SELECT provincia, CAST(count(*) AS BIGINT) AS sucursales,
       CAST(sum(CASE WHEN json_valid(raw_data) THEN len(from_json(raw_data, '["VARCHAR"]')) END) AS BIGINT) AS datos_crudos
FROM ({inputs.raw_branches_sql()}) GROUP BY provincia"""


def branch_flow() -> str:
    return branch_model(flatten_branches(), order=False)


def card_prices() -> str:
    return f"SELECT p_partkey, p_name AS product_name, round({inputs.CARD_PRICE}, 2) AS price FROM part"


def json_docs_roundtrip() -> str:
    return f"SELECT CAST(floor(page_id / {inputs.DOC_CHUNK}) AS BIGINT) AS chunk, page_id, url, html FROM pages"
