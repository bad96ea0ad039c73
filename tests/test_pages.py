from pyspark.sql import functions as F

from shelfspark.functions import patterns as P
from shelfspark.operators import options, pages

HTML = """<html><head><title>t</title><script>var t="</p>";</script></head><body>
<ul class="list ph3 mt0 valtech-carrefourar-store-locator-0-x-addressList">
 <li class="valtech-carrefourar-store-locator-0-x-addressListItem"> HIPERMERCADO<br>Av. Mitre 100, Avellaneda </li>
 <li class="valtech-carrefourar-store-locator-0-x-addressListItem">EXPRESS</li></ul>
<div class="galleryItem-x">Dulce de leche La Serenísima 400 g $ 1.234,50</div>
<article>short $1</article>
<ul><li><p> Av. San Martín 55 </p><p>  </p><p>Tel: 4444-5555</p></li></ul>
<div class="store-info">Estacionamiento</div>
<select><option value="Provincia">Provincia</option><option value="BA">Buenos Aires</option></select>
<div class="empty">Sin resultados</div>
</body></html>"""


def pages_df(spark, url="https://x/a"):
    return spark.createDataFrame([(1, url, HTML)], "page_id bigint, url string, html string")


def test_valid_card_and_evidence_bounds(spark):
    df = spark.createDataFrame([("$ 1.234,50",), ("  $ 1.234,500  ",)], "t string")
    assert [r.v for r in df.select(pages.valid_card(F.col("t")).alias("v")).collect()] == [False, True]
    t20 = "$" + "x" * 19
    df = spark.createDataFrame([(t20,), (t20 + "y",)], "t string")
    assert [r.v for r in df.select(pages.evidence_element(F.col("t")).alias("v")).collect()] == [False, True]


def test_url_is_invalid(spark):
    df = spark.createDataFrame([("https://x/ERROR-page",), ("https://x/ok",)], "u string")
    assert [r.v for r in df.select(pages.url_is_invalid(F.col("u")).alias("v")).collect()] == [True, False]


def test_page_frontier(spark):
    df = spark.createDataFrame([(1, "https://x/a"), (2, "https://x/a?b=1")], "id bigint, url string")
    got = {r.page_url for r in pages.page_frontier(df, "url", 2, ["id"]).where("page = 2").collect()}
    assert got == {"https://x/a?page=2", "https://x/a?b=1&page=2"}


def test_elements_and_verdict(spark):
    sels = [("div", pages.class_test("galleryItem")), ("article", "")]
    got = [(i, r.text) for i, (tag, attrs) in enumerate(sels) for r in pages.extract_tag(pages_df(spark), tag, i, attrs).collect()]
    assert got == [(0, "Dulce de leche La Serenísima 400 g $ 1.234,50"), (1, "short $1")]
    v = pages.verdict(pages_df(spark), sels).first()
    assert (v.evidence, v.has_products) == (1, True)
    v = pages.verdict(pages_df(spark, "https://x/404"), sels).first()
    assert v.has_products is False
    m = pages_df(spark).select(pages.no_results_marker(F.col("html"), ["titleNotFound", "empty"]).alias("m")).first()
    assert m.m == "empty"


def test_unclosed_paragraphs_end_where_the_next_starts(spark):
    html = "<body><article><p>a<b>1</b><p class='x'>b</p> tail<p>c</article><p>d<div>e</div>f<pre>g</pre></body>"
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    assert [r.text for r in pages.extract_tag(df, "p").orderBy("pos").collect()] == ["a 1", "b", "c", "d"]


def test_entities(spark):
    html = "<h1>Pa&#241;al &ntilde;and&uacute; &#8364;5 &amp;#65; &#x; &lt;b&gt; &amp;&amp; 1&nbsp;kg &eacute;</h1>"
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    assert pages.extract_tag(df, "h1").first().text == "Pañal ñandú €5 &#65; &#x; <b> && 1 kg é"


def test_store_list_guard_and_text(spark):
    got = [r.text for r in pages.extract_store_list(pages_df(spark)).orderBy("pos").collect()]
    assert got == ["HIPERMERCADO\nAv. Mitre 100, Avellaneda", "EXPRESS"]
    other = spark.createDataFrame([(2, "u", "<ul><li class='x'>a</li></ul>")], "page_id bigint, url string, html string")
    assert pages.extract_store_list(other).count() == 0


def test_branch_facts_from_page(spark):
    r = pages_df(spark).select(pages.branch_facts_of(F.col("html")).alias("raw_data")).first()
    assert r.raw_data == ["Av. San Martín 55", "Tel: 4444-5555", "EXTRA: Estacionamiento"]


def test_options_and_groups(spark):
    opts = pages.extract_options(pages_df(spark)).orderBy("pos").collect()
    assert [(o.codigo, o.nombre) for o in opts] == [("Provincia", "Provincia"), ("BA", "Buenos Aires")]
    rows = [(1, 0, i, str(i), f"n{i}") for i in range(5)] + [(1, 1, i, str(i), f"m{i}") for i in range(12)]
    rows += [(1, 1, 99, "Provincia", "Provincia"), (1, 1, 98, "provincia", "x")]
    df = spark.createDataFrame(rows, "page_id bigint, select_idx int, pos int, codigo string, nombre string")
    picked = options.clean_options(options.pick_option_group(df)).collect()
    assert {r.select_idx for r in picked} == {1} and len(picked) == 13
    ci = options.clean_options(options.nth_option_group(df, 1), "tienda", True)
    assert ci.count() == 14
    ci = options.clean_options(options.nth_option_group(df, 1), "provincia", True)
    assert ci.count() == 12


def test_province_and_store_selects_from_a_page(spark):
    provs = ["Buenos Aires", "Córdoba", "Santa Fe", "Mendoza", "Tucumán", "Salta", "Chaco", "Neuquén",
             "Misiones", "San Juan", "Jujuy", "Río Negro"]
    html = ('<select id="p"><option value="Provincia">Provincia</option>'
            + "".join(f'<option value=" {p} ">{p}</option>' for p in provs)
            + '<option value="">vacía</option></select>'
            + '<select id="t"><option value="TIENDA">Tienda</option><option value="101"> Vea Centro </option>'
            + '<option value="102">Vea Norte</option><option>sin valor</option></select>')
    pg = spark.createDataFrame([(9, "https://x/sucursales", html)], "page_id bigint, url string, html string")
    opts = pages.extract_options(pg)
    prov = options.clean_options(options.pick_option_group(opts)).orderBy("pos").collect()
    assert [(r.codigo, r.nombre) for r in prov] == [(p, p) for p in provs]      # stripped, placeholder out
    stores = options.clean_options(options.nth_option_group(opts, 1), P.STORE_PLACEHOLDER, True)
    assert sorted((r.codigo, r.nombre) for r in stores.collect()) == [("101", "Vea Centro"), ("102", "Vea Norte")]
