"""Page-level operators over a ``pages(page_id, url, html)`` table
(S5, P1-P4, W5, H1-H6).

Elements come from ``markup`` by CSS selector; the work stays in Catalyst and is
narrow.  A selector is CSS text; a pair (tag, attribute selectors) is taken too.
Texts follow the browser: H1-H3 read rendered text (lines end at block elements
and ``br``), H4-H5 the text content as it stands.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import ustrip
from . import markup
from .facts import non_blank

Selector = str | tuple[str, str]


def page_frontier(bases: DataFrame, url_col: str, n_pages: int, keep: list[str] | None = None) -> DataFrame:
    """Base URL -> page URLs ``base&page=k`` (base holds ``?``) or
    ``base?page=k``, k = 1..n."""
    keep = keep or []
    k = F.col("page")
    base = F.col(url_col)
    return bases.select(*keep, base.alias("base_url"),
                        F.explode(F.sequence(F.lit(1), F.lit(n_pages))).alias("page")).select(
        *keep, "base_url", k.cast("bigint").alias("page"),
        F.when(F.col("base_url").contains("?"), F.concat(F.col("base_url"), F.lit("&page="), k.cast("string")))
         .otherwise(F.concat(F.col("base_url"), F.lit("?page="), k.cast("string"))).alias("page_url"))


def valid_card(text: Column) -> Column:
    """Contains ``$`` and stripped length > 10."""
    return text.contains(P.CARD_MARKER) & (F.length(ustrip(text)) > P.CARD_MIN_LEN)


def evidence_element(text: Column) -> Column:
    """P2 per element: contains ``$`` and stripped length > 20."""
    return text.contains(P.CARD_MARKER) & (F.length(ustrip(text)) > P.EVIDENCE_MIN_LEN)


def url_is_invalid(url: Column) -> Column:
    """Lower-cased URL contains one of the invalid markers."""
    low = F.lower(url)
    out = None
    for m in P.INVALID_URL_MARKERS:
        out = low.contains(m) if out is None else (out | low.contains(m))
    return out


# ------------------------------------------------------------- extraction ----
def class_test(classes: str) -> str:
    """Selector part: the class attribute holds every one of ``classes`` as a part of it."""
    return "".join(f'[class*="{c}"]' for c in classes.split())


def css(selector: Selector) -> str:
    return selector if isinstance(selector, str) else "".join(selector)


def by_chain(chain: Column, configs: dict, build: Callable[[tuple], Column]) -> Column:
    """``build`` of the chain's configuration; only that one is evaluated for a row."""
    out = None
    for name, config in configs.items():
        out = F.when(chain == name, build(config)) if out is None else out.when(chain == name, build(config))
    return out


def extract_elements(pages: DataFrame, selectors: list[Selector],
                     text: Callable[[Column, Column], Column] = markup.rendered_text) -> DataFrame:
    """H1: ``(page_id, selector_idx, pos, text)`` of every element that a selector
    matches, in document order; all selectors in one pass over the page."""
    found = markup.elements(F.col("html"), [css(x) for x in selectors], text)
    each = pages.select("page_id", F.posexplode_outer(found).alias("selector_idx", "_texts"))
    return each.select("page_id", "selector_idx", F.posexplode_outer("_texts").alias("pos", "text")).where("pos is not null").select(
        "page_id", "selector_idx", F.col("pos").cast("bigint").alias("pos"), "text")


def extract_tag(pages: DataFrame, tag: str, selector_idx: int = 0, attributes: str = "") -> DataFrame:
    """H1 for one selector, each text in one line: ``(page_id, selector_idx, pos, text)``."""
    found = extract_elements(pages, [(tag, attributes)], markup.flat_text)
    return found.withColumn("selector_idx", F.lit(selector_idx))


def evidence_count(html: Column, selectors: list[Selector]) -> Column:
    """P2 without rows: over all selectors the number of elements with evidence
    among the first five of each (an element that two selectors match counts twice)."""
    found = markup.elements(html, [css(x) for x in selectors], markup.rendered_text, first=P.EVIDENCE_FIRST_N)
    return F.coalesce(F.size(F.filter(F.flatten(found), evidence_element)), F.lit(0)).cast("bigint")


def verdict(pages: DataFrame, selectors: list[Selector]) -> DataFrame:
    """P2 to P4 in one narrow pass over the pages: ``(page_id, url, evidence,
    url_invalid, has_products)``."""
    rows = pages.select("page_id", "url", evidence_count(F.col("html"), selectors).alias("evidence"))
    invalid = url_is_invalid(F.col("url"))
    return rows.select("page_id", "url", "evidence", invalid.alias("url_invalid"),
                       ((F.col("evidence") > 0) & ~invalid).alias("has_products"))


def valid_cards(html: Column, primary: Selector) -> Column:
    """H2 + P1: ``(pos, item)`` of the valid cards of the primary selector, as an array."""
    found = F.element_at(markup.elements(html, [css(primary)], markup.rendered_text), 1)
    placed = F.transform(found, lambda x, i: F.struct(i.cast("bigint").alias("pos"), x.alias("item")))
    return F.filter(placed, lambda c: valid_card(c["item"]))


def cards_and_evidence(html: Column, selectors: list[Selector]) -> Column:
    """``(n_cards, evidence)`` of a page from one pass: valid cards of the primary
    selector (H2, P1) and evidence over all of them (P2)."""
    def counted(found: Column) -> Column:
        firsts = F.flatten(F.transform(found, lambda texts: F.slice(texts, 1, P.EVIDENCE_FIRST_N)))
        return F.struct(F.size(F.filter(F.get(found, 0), valid_card)).alias("n_cards"),
                        F.size(F.filter(firsts, evidence_element)).cast("bigint").alias("evidence"))
    found = markup.elements(F.coalesce(html, F.lit("")), [css(x) for x in selectors], markup.rendered_text)
    return markup.let(found, counted)


def extract_primary(pages: DataFrame, selector: Selector) -> DataFrame:
    """H2 + P1: valid cards ``(page_id, pos, item)`` of the first selector only; a
    card's lines are kept."""
    return pages.select("page_id", F.explode(valid_cards(F.col("html"), selector)).alias("_c")).select("page_id", "_c.pos", "_c.item")


def extract_store_list(pages: DataFrame, list_classes: str = P.STORE_LIST_CLASSES,
                       item_class: str = P.STORE_ITEM_CLASS) -> DataFrame:
    """H3: if the container class string occurs in the page, the stripped texts of
    ``ul.<classes> li.<item>``, in order; else nothing."""
    selector = f"ul.{'.'.join(list_classes.split())} li.{item_class}"
    held = pages.where(F.col("html").contains(list_classes))
    return extract_elements(held, [selector]).select("page_id", "pos", ustrip(F.col("text")).alias("text"))


def extract_options(pages: DataFrame) -> DataFrame:
    """H4: every ``<option>`` of every ``<select>``: value attribute (null without one)
    and text, ``(page_id, select_idx, pos, codigo, nombre)``."""
    def options(toks: Column) -> Column:
        def of_selects(found: Column) -> Column:
            selects = F.filter(found, lambda s: s["hits"].bitwiseAND(F.lit(1).cast("long")) != 0)
            return F.transform(selects, lambda s: F.transform(
                F.filter(found, lambda o: (o["hits"].bitwiseAND(F.lit(2).cast("long")) != 0) & (o["at"] > s["at"]) & (o["at"] < s["end"])),
                lambda o: F.struct(markup.attribute(F.get(toks, o["at"]), "value").alias("codigo"),
                                   markup.content_text(toks, o).alias("nombre"))))
        return markup.let(markup.spans(toks, ["select", "select option"]), of_selects)

    selects = pages.select("page_id", F.posexplode_outer(markup.let(markup.tokens(F.col("html")), options)).alias("select_idx", "_o"))
    rows = selects.select("page_id", "select_idx", F.posexplode_outer("_o").alias("pos", "_o")).where("pos is not null")
    return rows.select("page_id", "select_idx", "pos", "_o.codigo", "_o.nombre")


def branch_facts_of(html: Column) -> Column:
    """H5 + P7: the non-blank stripped texts of ``ul li p``, then ``EXTRA: `` and the
    texts of the extra-info blocks, order kept; an array, no shuffle."""
    def facts(found: Column) -> Column:
        more = F.transform(non_blank(F.get(found, 1)), lambda x: F.concat(F.lit(P.EXTRA_PREFIX), x))
        return F.concat(non_blank(F.get(found, 0)), more)
    return markup.let(markup.elements(html, P.BRANCH_SELECTORS, markup.content_text), facts)


TEXT_MARKER = re.compile(r'text="(.*)"')


def no_results_marker(html: Column, markers: list[str]) -> Column:
    """H6 (diagnostic only): the first of ``markers`` present on the page.  A marker is
    a selector, ``text="..."`` (an element whose whole text is that, white space
    aside) or a bare word (a part of a class attribute)."""
    texts = [m[1] for m in map(TEXT_MARKER.fullmatch, markers) if m]
    selectors = [m if re.search(r"[.\[#*]", m) else f'[class*="{m}"]' for m in markers if not TEXT_MARKER.fullmatch(m)]

    def squeezed(text: Column) -> Column:
        return ustrip(F.regexp_replace(text, r"\s+", " "))

    def on_page(toks: Column) -> Column:
        def first_of(seen: Column) -> Column:
            out, bit = None, 0
            for marker in markers:
                text = TEXT_MARKER.fullmatch(marker)
                if text:
                    hit = F.array_contains(seen["texts"], text[1])
                else:
                    hit = seen["bits"].bitwiseAND(F.lit(1 << bit).cast("long")) != 0
                    bit += 1
                out = F.when(hit, F.lit(marker)) if out is None else out.when(hit, F.lit(marker))
            return out

        bits = F.aggregate(markup.spans(toks, selectors), F.lit(0).cast("long"), lambda a, s: a.bitwiseOR(s["hits"])) if selectors else F.lit(
            0).cast("long")
        whole = squeezed(markup.content_text(toks, F.struct(F.lit(-1).alias("at"), F.size(toks).alias("end"))))
        mentioned = F.lit(False)
        for text in texts:
            mentioned = mentioned | whole.contains(text)
        # elements are looked at one by one only where their page says such a text at all
        every = F.transform(markup.spans(toks, ["*"]), lambda s: squeezed(markup.content_text(toks, s)))
        found = F.when(mentioned, every).otherwise(F.array().cast("array<string>"))
        return markup.let(F.struct(bits.alias("bits"), found.alias("texts")), first_of)

    return markup.let(markup.tokens(html), on_page)
