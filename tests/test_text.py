from pyspark.sql import functions as F

from shelfspark.functions import text as T


def one(spark, col, value):
    return spark.createDataFrame([(value,)], "s string").select(col(F.col("s")).alias("o")).first()["o"]


def test_ustrip_unicode_whitespace(spark):
    assert one(spark, T.ustrip, "\t x y\n ") == "x y"
    assert one(spark, T.ustrip, "   ") == ""


def test_title_case_splits_on_punctuation(spark):
    assert one(spark, T.title_case, "HIPER-MERCADO express/24hs") == "Hiper-Mercado Express/24hs"
    assert one(spark, T.title_case, "MAXI-EXPRESS") == "Maxi-Express"


def test_json_quote_matches_python(spark):
    import json
    for s in ['a"b', "tab\tnl\n", "ñandú \\ x", "[x]", ""]:
        assert one(spark, T.json_quote, s) == json.dumps(s, ensure_ascii=False)


def test_clean_product_name_ascii_word(spark):
    assert one(spark, T.clean_product_name, "Dulce de Leche 1/2 kg, Niño!") == "DULCE DE LECHE 12 KG NIO"


def test_last_path_segment(spark):
    assert one(spark, T.last_path_segment, "https://httpbin.org/json") == "json"


def test_regexp_extract_or_null(spark):
    f = lambda c: T.regexp_extract_or_null(c, r"(\d{2}:\d{2})")
    assert one(spark, f, "Abierto 08:00 a 21:30") == "08:00"
    assert one(spark, f, "Cerrado") is None


def test_non_blank(spark):
    from shelfspark.operators import facts
    df = spark.createDataFrame([([" a ", None, "  ", "\tb"],)], "arr array<string>")
    assert df.select(facts.non_blank(F.col("arr")).alias("o")).first()["o"] == ["a", "b"]


def test_python_json_quote_keeps_line_separators(spark):
    import json
    cases = ["a\u2028b\u2029c", "lit \\u2028 kept", "both \\\u2028", 'q"\\ ', "\\"]
    assert "\u2028" in cases[0] and len(cases[1]) == len("lit ") + 6 + len(" kept")
    for s in cases:
        assert one(spark, T.python_json_quote, s) == json.dumps(s, ensure_ascii=False), repr(s)
