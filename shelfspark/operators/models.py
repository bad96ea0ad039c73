"""The two warehouse models and the raw-row builders.

Every function here is narrow (a projection per row), so they fuse into
the scan's whole-stage-codegen stage; the only exchange is the optional
presentation sort (O1: ``parse_branch_json_ordered``, which sorts the raw rows
before the model).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import (json_array_text, python_json_quote, regexp_extract_or_null, time_of_day,
                              title_case, ustrip)
from . import facts


# ---------------------------------------------------------------- M1 ------
def parse_store_text(raw: DataFrame, strict: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Store text (``type⏎address, locality, province⏎hours``) -> typed columns.

    ``strict=True`` keeps the warehouse's ``[OFFSET(i)]``: a text with fewer
    than three lines fails the query (ANSI index error).  The default is the
    lenient ``SAFE_OFFSET`` reading (NULLs), audited with ``not_null_audit``.
    ``keep`` columns (e.g. keys) are passed through in front.
    """
    keep = list(keep or [])
    lines = F.split(F.col("ubicacion_texto"), P.STORE_LINE_SEP, -1)
    pick = (lambda arr, i: arr[i]) if strict else (lambda arr, i: F.get(arr, i))
    # split once per row; CollapseProject keeps non-cheap shared expressions
    step = raw.select(
        *keep,
        pick(lines, 0).alias("_l0"), pick(lines, 1).alias("_l1"), pick(lines, 2).alias("_l2"),
        F.col("fecha_extraccion"))
    step = step.select("*", F.split(F.col("_l1"), P.STORE_PART_SEP, -1).alias("_parts"))
    direccion = ustrip(F.get(F.col("_parts"), 0))
    provincia = ustrip(F.get(F.col("_parts"), 2))
    return step.select(
        *keep,
        title_case(F.col("_l0")).alias("tipo"),
        direccion.alias("direccion"),
        ustrip(F.get(F.col("_parts"), 1)).alias("localidad"),
        provincia.alias("provincia"),
        regexp_extract_or_null(F.col("_l2"), P.STORE_OPEN_RE).alias("hora_apertura"),
        regexp_extract_or_null(F.col("_l2"), P.STORE_CLOSE_RE).alias("hora_cierre"),
        F.concat(direccion, F.lit(P.STORE_ADDRESS_SEP), provincia,
                 F.lit(P.STORE_COUNTRY_SUFFIX)).alias("direccion_con_provincia"),
        time_of_day(F.col("fecha_extraccion")).alias("hora_extraccion"),
    )


# ---------------------------------------------------------------- M2 ------
BRANCH_COLUMNS = [
    "sucursal_id", "nombre_sucursal", "provincia", "direccion_principal", "direccion_completa",
    "hora_apertura", "hora_cierre", "horario_completo", "direcciones_encontradas",
    "horarios_encontrados", "telefonos_encontrados", "cantidad_datos_crudos",
    "fecha_extraccion_date", "hora_extraccion", "fuente", "tiene_direccion", "tiene_horarios",
    "tiene_telefono",
]


def parse_branch_json(raw: DataFrame) -> DataFrame:
    """raw branches (raw_data = JSON array text) -> 18 classified columns."""
    arr = F.from_json(F.col("raw_data"), "array<string>")
    # decode + encode each element once per row (lambdas are not deduplicated)
    parsed = raw.select(
        F.col("sucursal_id"),
        ustrip(F.col("nombre")).alias("nombre_sucursal"),
        ustrip(F.col("provincia")).alias("provincia"),
        arr.alias("_arr"),
        F.col("fecha_extraccion"),
        F.col("fuente"),
    )
    parsed = parsed.select("*", facts.tagged_items(facts.encoded_items(F.col("_arr"))).alias("_tagged"))
    t = F.col("_tagged")
    addr = facts.flagged(t, "a")
    extracted = parsed.select(
        "sucursal_id", "nombre_sucursal", "provincia",
        facts.joined_matches(addr).alias("direcciones_encontradas"),
        facts.joined_matches(facts.flagged(t, "s")).alias("horarios_encontrados"),
        facts.joined_matches(facts.flagged(t, "p")).alias("telefonos_encontrados"),
        facts.first_match(addr).alias("direccion_principal"),
        regexp_extract_or_null(facts.first_match(facts.flagged(t, "t")), P.OPEN_EXTRACT_RE).alias("hora_apertura"),
        regexp_extract_or_null(facts.first_match(facts.flagged(t, "r")), P.CLOSE_EXTRACT_RE).alias("hora_cierre"),
        facts.item_count(F.col("_arr")).alias("cantidad_datos_crudos"),
        "fecha_extraccion", "fuente",
    )
    return with_branch_derived(extracted)


def full_address(principal: Column, provincia: Column) -> Column:
    """``principal, provincia, Argentina`` (NULL-propagating concat)."""
    return F.when(principal.isNotNull(),
                  F.concat(principal, F.lit(", "), provincia, F.lit(P.ADDRESS_SUFFIX)))


def full_schedule(opening: Column, closing: Column) -> Column:
    """``apertura - cierre`` when both exist."""
    return F.when(opening.isNotNull() & closing.isNotNull(),
                  F.concat(opening, F.lit(P.SCHEDULE_SEP), closing))


def quality_flags(principal: Column, opening: Column, closing: Column, phones: Column) -> list[Column]:
    """0/1 BIGINT flags."""
    return [
        principal.isNotNull().cast("bigint").alias("tiene_direccion"),
        (opening.isNotNull() & closing.isNotNull()).cast("bigint").alias("tiene_horarios"),
        phones.isNotNull().cast("bigint").alias("tiene_telefono"),
    ]


def with_branch_derived(ex: DataFrame) -> DataFrame:
    principal, prov = F.col("direccion_principal"), F.col("provincia")
    op, cl = F.col("hora_apertura"), F.col("hora_cierre")
    return ex.select(
        "sucursal_id", "nombre_sucursal", "provincia", "direccion_principal",
        full_address(principal, prov).alias("direccion_completa"),
        "hora_apertura", "hora_cierre",
        full_schedule(op, cl).alias("horario_completo"),
        "direcciones_encontradas", "horarios_encontrados", "telefonos_encontrados",
        "cantidad_datos_crudos",
        F.to_date(F.col("fecha_extraccion")).alias("fecha_extraccion_date"),
        time_of_day(F.col("fecha_extraccion")).alias("hora_extraccion"),
        "fuente",
        *quality_flags(principal, op, cl, F.col("telefonos_encontrados")),
    )


def parse_branch_long(branches: DataFrame, items: DataFrame, key: str, pos: str, item: str) -> DataFrame:
    """M2 from branches (sucursal_id, nombre, provincia, fecha_extraccion, fuente) and
    their facts in long form, a row for each (``key``, ``pos``, ``item``): the facts are
    grouped by position blocks first, so a branch with many facts is many tasks.
    A branch without facts has none found and a count of 0 (J2)."""
    found = facts.grouped_facts(items, [key], pos, item).withColumnRenamed(key, "_key")
    joined = branches.join(found, branches["sucursal_id"] == F.col("_key"), "left")
    return with_branch_derived(joined.select(
        "sucursal_id", ustrip(F.col("nombre")).alias("nombre_sucursal"), ustrip(F.col("provincia")).alias("provincia"),
        "direcciones_encontradas", "horarios_encontrados", "telefonos_encontrados", "direccion_principal", "hora_apertura", "hora_cierre",
        F.coalesce("cantidad_datos_crudos", F.lit(0)).cast("bigint").alias("cantidad_datos_crudos"), "fecha_extraccion", "fuente"))


def parse_branch_json_ordered(raw: DataFrame) -> DataFrame:
    """M2 + O1 with the sort placed *before* the model.  The sort keys are
    the trimmed province and name, which are cheap and known on the raw rows;
    the range partitioner's sampling pass and the exchange then carry raw
    rows only, and the (narrow, order-preserving) model runs once per row
    after the sort instead of twice (sampling + final pass)."""
    keyed = raw.withColumn("_sp", ustrip(F.col("provincia"))).withColumn("_sn", ustrip(F.col("nombre")))
    ordered = keyed.orderBy(F.col("_sp").asc_nulls_first(), F.col("_sn").asc_nulls_first())
    return parse_branch_json(ordered.drop("_sp", "_sn"))


# ---------------------------------------------------------------- P16 -----
# ---------------------------------------------------------------- M3 ------
def raw_price_rows(items: DataFrame, store_name: str | Column, category: str | Column,
                   scraped_at: Column, item_col: str = "item", keep: list[str] | None = None) -> DataFrame:
    """One raw row per card: ``raw_data`` is the JSON string literal of the
    card text; P16 labels.  ``scraped_at`` is the load time (a job parameter,
    one value per run, or the envelope's own timestamp)."""
    lab = lambda v: v if isinstance(v, Column) else F.lit(v)
    return items.select(
        python_json_quote(F.col(item_col)).alias("raw_data"),
        F.to_date(scraped_at).alias("scraped_date"),
        scraped_at.cast("timestamp").alias("scraped_datetime"),
        lab(store_name).alias("store_name"),
        lab(category).alias("category"),
        *(keep or []),
    )


def envelope_items(envelopes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Explode envelope ``items`` keeping their position (U2: cards of all
    pages concatenated in order)."""
    keep = keep or []
    return envelopes.select(*keep, F.col("timestamp"),
                            F.posexplode(F.col("items")).alias("item_pos", "item"))


# ---------------------------------------------------------------- M4 ------
def flatten_branches(nested: DataFrame, map_col: str, fecha: Column,
                     fuente: str = P.SOURCE_BRANCHES) -> DataFrame:
    """province -> [branch] map -> one raw row per branch.  Missing keys
    become ``''`` / ``[]``; the province is the map key; raw_data is
    re-encoded as JSON array text (Python ``json.dumps`` layout)."""
    per_prov = nested.select(F.col("*"), F.explode(F.col(map_col)).alias("_prov", "_branches"))
    per_branch = per_prov.select(F.col("*"), F.explode(F.col("_branches")).alias("_b"))
    b = F.col("_b")
    return per_branch.select(
        F.coalesce(b["id"], F.lit("")).alias("sucursal_id"),
        F.coalesce(b["nombre"], F.lit("")).alias("nombre"),
        F.col("_prov").alias("provincia"),
        json_array_text(F.coalesce(b["raw_data"], F.array().cast("array<string>"))).alias("raw_data"),
        fecha.alias("fecha_extraccion"),
        F.lit(fuente).alias("fuente"),
    )


# ---------------------------------------------------------------- M5 ------
def number_locations(lists: DataFrame, list_col: str, keep: list[str],
                     fecha: Column, fuente: str = P.SOURCE_STORE_TEXT) -> DataFrame:
    """A list of location texts per page -> rows with ``id`` = position + 1
    within its list (``posexplode``; no global row_number)."""
    return lists.select(*keep, F.posexplode(F.col(list_col)).alias("_pos", "ubicacion_texto")).select(
        *keep, (F.col("_pos") + 1).cast("bigint").alias("id"), "ubicacion_texto",
        fecha.alias("fecha_extraccion"), F.lit(fuente).alias("fuente"))
