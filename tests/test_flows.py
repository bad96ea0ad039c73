import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfspark.operators import pages, quality
from shelfspark.plans import flows
from shelfspark.sinks import writers

CARD = ('<article class="jumboargentinaio-cmedia-integration-cencosud-1-x-galleryItem">'
        'Dulce de leche {n} 400 g precio $ 1.{n}00,50</article>')
NESTED = "m map<string, array<struct<id string, nombre string, provincia string, raw_data array<string>>>>"


def page(n_cards, k):
    return "<html><body>" + "".join(CARD.format(n=f"{k}{i}") for i in range(n_cards)) + "</body></html>"


def test_product_price_flow_end_to_end(spark, tmp_dir):
    # site a: n e n e -> JUMBO (max 2 empty) keeps pages 1 and 3
    # site b: e e n   -> stops at page 2, nothing kept
    rows = [(1, "https://a/x?page=1", page(2, 1)), (2, "https://a/x?page=2", page(0, 2)),
            (3, "https://a/x?page=3", page(3, 3)), (4, "https://a/x?page=4", page(0, 4)),
            (5, "https://b/y?page=1", page(0, 5)), (6, "https://b/y?page=2", page(0, 6)),
            (7, "https://b/y?page=3", page(1, 7))]
    pg = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pg = pg.withColumn("run", F.regexp_extract(F.col("url"), r"^https?://([^/]+)", 1)).withColumn("page_order", F.col("page_id"))
    path = os.path.join(tmp_dir, "prices")
    sels = [("article", pages.class_test("galleryItem")), ("article", "")]
    written, summary = flows.product_price_flow(pg, sels, 2, F.lit("JUMBO"), path, F.lit(dt.datetime(2025, 6, 16, 8, 0)))
    assert written
    got = {r.run: (r.total_items, r.pages_processed, r.pages_with_cards) for r in summary.collect()}
    assert got == {"a": (5, None, 2), "b": (0, 1, 0)}
    back = spark.read.parquet(path).collect()
    assert sorted((r.run, r.page_num, r.pos) for r in back) == [("a", 1, 0), ("a", 1, 1), ("a", 3, 0), ("a", 3, 1), ("a", 3, 2)]
    assert {r.store_name for r in back} == {"JUMBO"}


def test_branch_flow(spark, tmp_dir):
    nested = spark.createDataFrame(
        [({"BA": [{"id": "1", "nombre": "A", "provincia": "BA", "raw_data": ["Calle 1", "Lunes 9:00 a 18:00"]}]},)], NESTED)
    r = flows.branch_flow(nested, "m", os.path.join(tmp_dir, "branches"), F.lit(dt.datetime(2025, 6, 16, 8, 0))).first()
    assert (r.direccion_principal, r.hora_apertura, r.hora_cierre) == ("Calle 1", "9:00", "18:00")


def test_branch_flow_fails_on_a_violated_model_test(spark, tmp_dir, monkeypatch):
    nested = spark.createDataFrame([({"BA": [{"id": "1", "nombre": "A", "provincia": "BA", "raw_data": ["x"]}]},)], NESTED)
    parse = flows.models.parse_branch_json
    monkeypatch.setattr(flows.models, "parse_branch_json", lambda raw: parse(raw).withColumn("provincia", F.lit(None).cast("string")))
    with pytest.raises(quality.RequiredColumnViolation):
        flows.branch_flow(nested, "m", os.path.join(tmp_dir, "branches"), F.lit(dt.datetime(2025, 6, 16, 8, 0)))


def test_store_text_flow(spark, tmp_dir):
    from shelfspark.functions import patterns as P
    li = f'<li class="{P.STORE_ITEM_CLASS}">'
    html = (f'<ul class="{P.STORE_LIST_CLASSES}">'
            f'{li}HIPERMERCADO<br>Av. Mitre 100, Avellaneda, Buenos Aires<br>Abierto 08:00 a 21:30</li>'
            f'{li}EXPRESS<br>Calle 1, La Plata<br>Cerrado</li></ul>')
    pg = spark.createDataFrame([(1, "https://x/sucursales", html)], "page_id bigint, url string, html string")
    path = os.path.join(tmp_dir, "stores")
    out = flows.store_text_flow(pg, path, F.lit(dt.datetime(2025, 6, 16, 6, 0)))
    got = sorted((r.tipo, r.provincia, r.hora_apertura, r.hora_cierre) for r in out.collect())
    assert got == [("Express", None, None, None), ("Hipermercado", "Buenos Aires", "08:00", "21:30")]
    empty = spark.createDataFrame([(2, "u", "<ul></ul>")], "page_id bigint, url string, html string")
    flows.store_text_flow(empty, path, F.lit(dt.datetime(2025, 6, 17, 6, 0)))   # guard keeps snapshot
    assert writers.read_snapshot(spark, path).count() == 2


def test_flows_accept_current_datetime(spark, tmp_dir):
    from shelfspark.functions.text import current_datetime
    nested = spark.createDataFrame(
        [({"BA": [{"id": "1", "nombre": "A", "provincia": "BA", "raw_data": ["Ruta 3 km 5"]}]},)],
        NESTED)
    model = flows.branch_flow(nested, "m", os.path.join(tmp_dir, "b"), current_datetime())
    r = model.first()
    assert r.direccion_principal == "Ruta 3 km 5" and r.fecha_extraccion_date is not None
