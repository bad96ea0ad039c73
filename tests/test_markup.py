"""Selectors, spans and texts of markup, against hand-made pages and a plain tree."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import patterns as P
from shelfspark.operators import markup, models, pages


def read(spark, html, selectors, text=markup.content_text):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(markup.elements(F.col("html"), selectors, text).alias("x")).first().x


CASES = [
    # nested elements of one name; text on both sides
    ("<ul><li><p>a</p><ul><li><p>x</p></li></ul><p>b</p></li></ul>", ["ul li p", "li", "ul ul p"], [["a", "x", "b"], ["axb", "x"], ["x"]]),
    ("<div class='store-info'><div>Tel 1</div>Lunes 9:00</div>", ["div.store-info"], [["Tel 1Lunes 9:00"]]),
    # not in a list of that kind, in a comment, in a script, in a quoted attribute
    ("<ol><li><p>n</p></li></ol><!-- <ul><li><p>n</p></li></ul> --><script>'<ul><li><p>n'</script><i title='<ul><li><p>n'>i</i>", ["ul li p", "i"],
     [[], ["i"]]),
    ("<ul><li>a<!-- <li>b</li> --></ul>", ["li"], [["a"]]),
    # whole class names, parts of attributes, quotes and none
    ("<b class=\"my-store-info-icon\">n</b><b class='x store-info'>1</b><b class=store-info>2</b><b CLASS=\"a\tstore-info\nb\">3</b>", [".store-info"],
     [["1", "2", "3"]]),
    ("<i class=nonempty>1</i><i class='x-gallery--empty-y'>2</i><i class='b gallery--empty'>3</i>", ['[class*="empty"]', ".gallery--empty"],
     [["1", "2", "3"], ["3"]]),
    ("<section aria-label='Producto 7'>1</section><section aria-label=otro>2</section><div aria-label='Producto'>3</div>",
     ['section[aria-label*="Producto"]', "[aria-label]", "section[aria-label='otro']"], [["1"], ["1", "2", "3"], ["2"]]),
    ("<i data-a=\"class='c'\">1</i><i class='a' class='c'>2</i><i class>3</i><i class=''>4</i>", [".c", "[class]", '[class=""]', '[class*=""]'],
     [[], ["2", "3", "4"], ["3", "4"], []]),
    ("<i id=k class='b a'>1</i><i class='a b c'>2</i><b class='a b'>3</b>", ["i.a.b", "#k", "i.a, b.b", "*"], [["1", "2"], ["1"], ["1", "2", "3"], ["1", "2", "3"]]),
    ("<i class='Gall&#101;ry&amp;x'>1</i>", ['[class="Gallery&x"]'], [["1"]]),
    # end tags that are left out or have no start
    ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul><p>5<p>6<div>7</p>8</div>9", ["li", "p", "div"], [["1", "23", "3", "4"], ["5", "6"], ["78"]]),
    ("<table><tr><td>1<td>2<table><tr><th>3</table><tr><td>4</table>", ["td", "tr", "th"], [["1", "23", "4"], ["123", "3", "4"], ["3"]]),
    ("<dl><dt>1<dd>2<dt>3</dl><select><option>4<option>5</select>", ["dt", "dd", "option"], [["1", "3"], ["2"], ["4", "5"]]),
    ("</div><div>1</span></b>2</div></div><div>3", ["div"], [["12", "3"]]),
    ("<div><b>1</div>2</b><div>3</div>", ["b", "div"], [["1"], ["1", "3"]]),
    ("<main><div class=a>1</main>2", ["div.a", "main"], [["1"], ["1"]]),
    ("<p>1<br>2<img class=z>3</p>", ["p", "br", "img.z"], [["123"], [""], [""]]),
    # broken markup and references
    ("a < b <i>x &lt; y &amp;lt; &#x41;&#65;&#0;&#xD800;&nope; &eacute;&</i", ["i"], [["x < y &lt; AA&#0;&#xD800;&nope; é&</i"]]),
    ("<i title='it&apos;s' it's>1</i><i it's>2</i>", ["i"], [["1", "2"]]),
    ("<!-- never ends <i>1</i>", ["i"], [[]]),
    ("<DIV Class='A'><P>1</DIV>", ["div.A", "p", "div.a"], [["1"], ["1"], []]),
    ("", ["i"], [[]]),
]


@pytest.mark.parametrize("html,selectors,want", CASES)
def test_content(spark, html, selectors, want):
    assert read(spark, html, selectors) == want


def test_null_page(spark):
    assert read(spark, None, ["i"]) is None


@pytest.mark.parametrize("html,want", [
    ("<div>Hiper</div><div>Av 1, <b>La</b> Plata</div>08:00", "Hiper\nAv 1, La Plata\n08:00"),
    ("<p>a</p>\n <p>b<p>c", "a\nb\nc"),
    ("a<br>b<br/><br>c<br><div>d</div><br><div>e</div>", "a\nb\n\nc\nd\n\ne"),
    ("<div><div> <section>a</section></div></div> b <i>c</i>d", "a\nb cd"),
    ("a<script>x</script><style>y</style><!-- z -->b", "ab"),
    ("<ul><li>a<li> b\n c </ul>", "a\nb c"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
    ("&nbsp;a&#10;b&lt;br&gt;", "a b<br>"),
    ("", ""),
])
def test_rendered(spark, html, want):
    assert read(spark, f"<main>{html}</main>", ["main"], markup.rendered_text) == [[want]]


def test_first_ones_of_each_selector(spark):
    df = spark.createDataFrame([("<i>1</i><b>2</b><i>3</i><i>4</i><b>5</b>",)], "html string")
    got = df.select(markup.elements(F.col("html"), ["i", "b, i"], markup.content_text, first=2).alias("x")).first().x
    assert got == [["1", "3"], ["1", "2"]]


@pytest.mark.parametrize("selector", ["", "a >b", "a:hover", "a,,b", "[x"])
def test_unknown_selectors_are_refused(selector):
    with pytest.raises(ValueError):
        markup.parse_selector(selector)


def test_every_configured_selector_is_read():
    for selectors, markers, *_ in P.CHAIN_CONFIGS.values():
        for selector in [*selectors, *(m for m in markers if not m.startswith("text="))]:
            assert markup.parse_selector(selector)


# ------------------------------------------------------- against a plain tree ----
NAMES, CLASSES = ["div", "ul", "section", "span", "h2", "main"], ["a", "b", "a-b", "ab"]


def grow(rnd, depth=0):
    """(name, classes, children): a well-formed tree; texts are leaves."""
    kids = [f"t{rnd.randrange(99)} " if rnd.random() < 0.4 or depth > 5 else grow(rnd, depth + 1) for _ in range(rnd.randrange(4))]
    return rnd.choice(NAMES), rnd.sample(CLASSES, rnd.randrange(3)), kids


def write(node, rnd):
    if isinstance(node, str):
        return node + rnd.choice(["", "<!-- </div><ul> -->", "<br>", "<img x='a b'/>"])
    name, classes, kids = node
    attributes = f" class={rnd.choice(['%s', chr(39) + '%s' + chr(39), chr(34) + ' %s ' + chr(34)]) % ' '.join(classes)}" if len(classes) == 1 else \
        f' x="<ul>" class="{" ".join(classes)}"' if classes else ""
    return f"<{name}{attributes}>{''.join(write(k, rnd) for k in kids)}</{name}>"


def text_of(node):
    return node if isinstance(node, str) else "".join(map(text_of, node[2]))


def plain(roots, selector):
    def meets(node, compound):
        return (compound.tag in (None, node[0]) and set(compound.classes) <= set(node[1])
                and all(value in " ".join(node[1]) and node[1] for _, _, value in compound.attributes))

    def chain_holds(path, chain):
        if not meets(path[-1], chain[-1]):
            return False
        rest = list(chain[:-1])
        for node in reversed(path[:-1]):
            if rest and meets(node, rest[-1]):
                rest.pop()
        return not rest

    found = []

    def walk(node, path):
        if isinstance(node, str):
            return
        path = [*path, node]
        if any(chain_holds(path, chain) for chain in markup.parse_selector(selector)):
            found.append(text_of(node))
        for kid in node[2]:
            walk(kid, path)
    for root in roots:
        walk(root, [])
    return found


def test_random_trees(spark):
    selectors = ["div", ".a", "div.a.b", "ul div", "ul .a span", "div, ul ul", 'section[class*="a-"]', "main .b, .b .b", '[class*="b"] h2']
    pages_of = []
    for seed in range(80):
        rnd = random.Random(seed)
        roots = [grow(rnd) for _ in range(1 + seed % 12)]
        pages_of.append((seed, "".join(write(r, rnd) for r in roots), [plain(roots, s) for s in selectors]))
    df = spark.createDataFrame([p[:2] for p in pages_of], "seed int, html string")
    got = dict(df.select("seed", markup.elements(F.col("html"), selectors, markup.content_text).alias("x")).collect())
    assert all(got[seed] == want for seed, _, want in pages_of)
    assert sum(len(texts) for _, _, want in pages_of for texts in want) > 500


def test_large_page(spark):
    """More tags than one block holds, elements open across blocks, deep nesting."""
    df = spark.createDataFrame([("<ul class=z>" + "<li><p>abc</p>" * 3000 + "</ul>" + "<div>" * 300 + "x" + "</div>" * 300,)], "html string")
    got = df.select(markup.elements(F.col("html"), ["li", "ul.z", "div div", "p"], markup.content_text).alias("x")).first().x
    assert [len(x) for x in got] == [3000, 1, 299, 3000]
    assert set(got[0]) == {"abc"} and got[1] == ["abc" * 3000]


# ------------------------------------------------------------------ operators ----
def test_branch_facts_of_nested_pages(spark):
    html = ("<ul><li><p>a</p><ul><li><p>x</p></li></ul><p>b</p></li></ul><ol><li><p>no</p></li></ol><div class='store-info'><div>Tel 1</div>Lunes 9:00</div>"
            "<p class='branch-details'> &#x41;v. 2\n 3</p><span class='my-store-info-icon'>no</span><!-- <ul><li><p>no</p></li></ul> -->")
    df = spark.createDataFrame([(html,), (None,)], "html string")
    got = [r.f for r in df.select(pages.branch_facts_of(F.col("html")).alias("f")).collect()]
    assert got == [["a", "x", "b", "EXTRA: Tel 1Lunes 9:00", "EXTRA: Av. 2\n 3"], None]


def test_store_text_gets_its_lines_from_blocks(spark):
    item = P.STORE_ITEM_CLASS
    html = (f"<ul class='{P.STORE_LIST_CLASSES}'><li class='{item}'><div>HIPER</div><p>Mitre 1, <b>Avellaneda</b>, Buenos Aires</p>"
            f"<div><span>08:00 a 22:00</span></div></li></ul>")
    df = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    raw = pages.extract_store_list(df).select(F.lit(1).alias("id"), F.col("text").alias("ubicacion_texto"),
                                              F.lit("2025-06-16 06:00:00").cast("timestamp").alias("fecha_extraccion"), F.lit("f").alias("fuente"))
    r = models.parse_store_text(raw).first()
    assert (r.tipo, r.direccion, r.localidad, r.provincia, r.hora_apertura, r.hora_cierre) == (
        "Hiper", "Mitre 1", "Avellaneda", "Buenos Aires", "08:00", "22:00")


@pytest.mark.parametrize("html,want", [
    ("<div><span>Sin\n resultados</span></div>", 'text="Sin resultados"'),
    ("<div>Sin <b>resultados</b></div>", 'text="Sin resultados"'),
    ("<p>Sin resultados para hoy</p>", None),
    ("<p>sin resultados</p>", None),
    ("<!-- <p>Sin resultados</p> --><script>'Sin resultados'</script>", None),
    ("<i class='x titleNotFoundy'>404</i>", 'text="404"'),
    ("<i class='x titleNotFoundy'>a404</i>", '[class*="titleNotFound"]'),
    ("<i class='my-no-results'></i><i class='nonempty'></i>", '[class*="no-results"]'),
    ("<i>x</i>", None),
])
def test_no_results_markers(spark, html, want):
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(pages.no_results_marker(F.col("html"), P.CHAIN_CONFIGS["CARREFOUR"][1]).alias("m")).first().m == want


def test_options_with_any_quotes(spark):
    html = ("<select><option value='1'>a<option value=2 selected>b &amp; c<optgroup label=x><option value=\"it's\">d</option></optgroup>"
            "<option>e</select><!-- <select><option>no</select> --><select></select><select><option value=''>f</select>")
    df = spark.createDataFrame([(7, html)], "page_id bigint, html string")
    got = [(r.select_idx, r.pos, r.codigo, r.nombre) for r in pages.extract_options(df).orderBy("select_idx", "pos").collect()]
    assert got == [(0, 0, "1", "a"), (0, 1, "2", "b & c"), (0, 2, "it's", "d"), (0, 3, None, "e"), (2, 0, "", "f")]


def test_extraction_stays_in_catalyst(spark):
    df = spark.createDataFrame([(1, "<i>x</i>")], "page_id bigint, html string")
    plan = pages.extract_elements(df, ["i", "ul li p"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|Exchange|Join", plan)
