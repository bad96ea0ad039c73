import datetime as dt

import pytest

from shelfspark.operators import models

TS = dt.datetime(2025, 6, 16, 6, 30, 15, 123456)


def store_rows(spark, texts):
    return spark.createDataFrame([(i + 1, t, TS, "x") for i, t in enumerate(texts)],
                                 "id bigint, ubicacion_texto string, fecha_extraccion timestamp, fuente string")


def test_store_text_edge_rows(spark):
    texts = ["HIPERMERCADO\nAv. Mitre 100, Avellaneda, Buenos Aires\nAbierto 08:00 a 21:30",
             "EXPRESS\nCalle 1, La Plata\nCerrado",
             "MAXI-EXPRESS\nA, B, C, D\n9:00 a 13:00",
             "EXPRESS\nSolo dos lineas"]
    out = models.parse_store_text(store_rows(spark, texts)).collect()
    r = out[0]
    assert (r.tipo, r.direccion, r.localidad, r.provincia, r.hora_apertura, r.hora_cierre) == \
        ("Hipermercado", "Av. Mitre 100", "Avellaneda", "Buenos Aires", "08:00", "21:30")
    assert r.direccion_con_provincia == "Av. Mitre 100 , Buenos Aires , Argentina"
    assert r.hora_extraccion == "06:30:15.123456"
    r = out[1]
    assert (r.tipo, r.provincia, r.hora_apertura, r.direccion_con_provincia) == ("Express", None, None, None)
    r = out[2]
    assert (r.tipo, r.provincia, r.hora_apertura, r.hora_cierre) == ("Maxi-Express", "C", "13:00", None)
    assert r.direccion_con_provincia == "A , C , Argentina"
    r = out[3]
    assert (r.tipo, r.direccion, r.localidad, r.hora_apertura) == ("Express", "Solo dos lineas", None, None)


def test_store_text_strict_fails_on_short_text(spark):
    with pytest.raises(Exception):
        models.parse_store_text(store_rows(spark, ["EXPRESS\nSolo dos lineas"]), strict=True).collect()


BRANCH_CASES = [
    ('["Av. San Martín 55","Lunes a Sábado 9:00 a 21:00","Tel: 4444-5555"]',
     "Av. San Martín 55", "9:00", "21:00", "Tel: 4444-5555", 3, (1, 1, 1)),
    ("[]", None, None, None, None, 0, (0, 0, 0)),
    ('["Ruta 8 KM 60","EXTRA: Calle 2"]', "Ruta 8 KM 60", None, None, None, 2, (1, 0, 0)),
    ('["09:00\\n21:00"]', None, "09:00", None, None, 1, (0, 0, 0)),
    ('["desde 8:00","de 9:00 a 20:00"]', None, "8:00", "20:00", None, 2, (0, 1, 0)),
    ('["MIÉRCOLES cerrado","Hotel central"]', None, None, None, "Hotel central", 2, (0, 0, 1)),
    ('["4444\\n4444\\n4444"]', None, None, None, None, 1, (0, 0, 0)),
    ("not json", None, None, None, None, None, (0, 0, 0)),
]


def test_branch_json_edge_rows(spark):
    rows = [(str(i), " Suc\t", "Prov", raw, TS, "x") for i, (raw, *_) in enumerate(BRANCH_CASES)]
    df = spark.createDataFrame(rows, "sucursal_id string, nombre string, provincia string, raw_data string, "
                                     "fecha_extraccion timestamp, fuente string")
    out = {r.sucursal_id: r for r in models.parse_branch_json(df).collect()}
    for i, (_, principal, op, cl, phones, n, flags) in enumerate(BRANCH_CASES):
        r = out[str(i)]
        assert r.nombre_sucursal == "Suc"
        assert (r.direccion_principal, r.hora_apertura, r.hora_cierre, r.telefonos_encontrados) == \
            (principal, op, cl, phones), i
        assert r.cantidad_datos_crudos == n, i
        assert (r.tiene_direccion, r.tiene_horarios, r.tiene_telefono) == flags, i
    assert out["5"].horarios_encontrados == "MIÉRCOLES cerrado"
    assert out["2"].direcciones_encontradas == "Ruta 8 KM 60 | EXTRA: Calle 2"
    assert out["0"].direccion_completa == "Av. San Martín 55, Prov, Argentina"
    assert out["0"].horario_completo == "9:00 - 21:00"
    assert out["0"].fecha_extraccion_date == dt.date(2025, 6, 16)


def test_raw_price_rows_and_flatten(spark):
    from pyspark.sql import functions as F
    items = spark.createDataFrame([("Dulce 400g\n$ 1.234,50",)], "item string")
    r = models.raw_price_rows(items, "CARREFOUR", "dulce_de_leche", F.lit(TS)).first()
    assert r.raw_data == '"Dulce 400g\\n$ 1.234,50"' and r.scraped_date == dt.date(2025, 6, 16)
    nested = spark.createDataFrame(
        [({"BA": [{"id": "1", "nombre": "A", "provincia": "BA", "raw_data": ["x", "y"]},
                  {"id": None, "nombre": None, "provincia": "BA", "raw_data": None}]},)],
        "m map<string, array<struct<id string, nombre string, provincia string, raw_data array<string>>>>")
    flat = models.flatten_branches(nested, "m", F.lit(TS)).orderBy("sucursal_id").collect()
    assert [(r.sucursal_id, r.nombre, r.provincia, r.raw_data) for r in flat] == \
        [("", "", "BA", "[]"), ("1", "A", "BA", '["x", "y"]')]


def test_number_locations_positions(spark):
    from pyspark.sql import functions as F
    lists = spark.createDataFrame([(7, ["a", "b", "c"])], "page bigint, locs array<string>")
    out = models.number_locations(lists, "locs", ["page"], F.lit(TS)).collect()
    assert [(r.id, r.ubicacion_texto) for r in out] == [(1, "a"), (2, "b"), (3, "c")]
