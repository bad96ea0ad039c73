"""Property checks (hypothesis) against plain-Python models of the semantics."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfspark.functions import patterns as P
from shelfspark.functions import text as T

from .conftest import SF

WS = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
      "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\u200b\ufeff\u180e")


def spark_map(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(list(WS) + list("ab é$,.-/")), max_size=12),
                min_size=1, max_size=40))
def test_ustrip_equals_python_strip(spark, values):
    assert spark_map(spark, T.ustrip, values) == [v.strip() for v in values]


def initcap_model(s: str) -> str:
    delims = set(P.INITCAP_DELIMITERS) | set(" \t\n\r\x0b\x0c")
    out, start = [], True
    for ch in s.lower():
        out.append(ch.upper() if start else ch)
        start = ch in delims
    return "".join(out)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(list("aBcÉñü xyZ") + list(P.INITCAP_DELIMITERS) + ["\t"]),
                        max_size=15), min_size=1, max_size=40))
def test_title_case_equals_model(spark, values):
    assert spark_map(spark, T.title_case, values) == [initcap_model(v) for v in values]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from(list("aZ09 _-!?ñÉ,./\t")), max_size=15), min_size=1, max_size=40))
def test_clean_product_name_equals_model(spark, values):
    model = [re.sub(r"[^0-9A-Za-z_ \t\n\r\x0b\x0c]", "", v).upper().strip() for v in values]
    assert spark_map(spark, T.clean_product_name, values) == model


def test_quality_flags_consistent_with_columns(spark):
    for name in ("branch_facts", "branch_facts_documents"):
        df = E.queries()[name](spark, SF)
        bad = df.where(
            (F.col("tiene_direccion") != F.col("direccion_principal").isNotNull().cast("bigint"))
            | (F.col("tiene_horarios") != (F.col("hora_apertura").isNotNull()
                                           & F.col("hora_cierre").isNotNull()).cast("bigint"))
            | (F.col("tiene_telefono") != F.col("telefonos_encontrados").isNotNull().cast("bigint"))
            | (F.col("direccion_completa").isNotNull() != F.col("direccion_principal").isNotNull()))
        assert bad.count() == 0, name
