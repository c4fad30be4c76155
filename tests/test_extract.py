"""Extraction on hand-made pages with unclosed tags, incomplete blocks and both layouts of the third source."""

from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newszones import schemas
from newszones.operators import extract
from newszones.operators.html_tree import Tree, compile_selector, select
from newszones.operators.rules import collect_rules, default_rules
from newszones.plans.zones import quarantine_counts
from newszones.sources.pages import scan_pages

FIRST = """<html><body><ul><li><p>x<br>
<article><div class="titulo-teaser-2col big"><a href="/a/1"><h2> Uno &amp; dos </h2></a></div>
<div class="entradilla-teaser-2col"><p>Hola <b>mundo</b><p>otra<br>mas</div>
<div class="fecha-teaser-2col"><div><time> 2025-04-01 </time></div></div></article>
<article><div class="titulo-teaser-2col"><a href="/a/2"><h2> </h2></a></div></article>
<article><div class="titulo-teaser-2col"><a><h2>sin link</h2></a></div></article>
<article><div class="titulo-teaser-2col"><a href="b/3"><h2>Tres</h2></a></div></article></body></html>"""
SECOND = """<section class="x pane-views-panes"><div class="views-row first">
<div class="views-field-title term"><a href="/n/1">T1</a></div>
<div class="views-field-field-noticia-sumario"><span>S1<br>S2</span></div>
<span class="views-field-field-noticia-fecha"><span>12/04/2025</span></span>
<span class="views-field-seccion"><span><a>Pais</a></span></span></div>
<div class="views-row"><div class="views-field-title term"><a href="/n/2">T2</a></div></div></section>
<ul><li class="pager-next last"><a href="?page=1">sig</a></li></ul>"""
THIRD = """<div class="article-list"><div itemprop="blogPost"><h2 itemprop="name"><a href="/p/1">Tp1</a></h2>
<div itemprop="description"> <p>D1</p> fin</div><time itemprop="datePublished" datetime="2025-04-01T08:30:00-04:00">x</time></div>
<div itemprop="blogPost"><h2 itemprop="name"><a href="/p/2"> </a></h2><div></div>
<div><div><h2><a href="/p/9">No se usa</a></h2></div></div></div></div>"""
POSITIONAL = """<div id="sp-component"><div><div></div><div><div></div><div><div><div>
<div class="block"><div>imagen</div><div><div><h2><a href="/q/1">Por lugar</a></h2></div><div><span><a>sec</a></span></div></div>
<div class="article-introtext">intro</div><time datetime="2025-05-01"></time></div>
</div></div></div></div></div></div>"""
AT = datetime(2025, 4, 1, 12)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        ("eldeber", "pais", 1, "https://eldeber.com.bo/pais/1/", 200, FIRST, AT),
        ("lostiempos", None, 1, "https://www.lostiempos.com/ultimas-noticias", 200, SECOND, AT),
        ("ahoraelpueblo", "sociedad", 1, "https://ahoraelpueblo.bo/index.php", 200, THIRD, AT),
        ("ahoraelpueblo", "sociedad", 2, "https://ahoraelpueblo.bo/index.php", 200, POSITIONAL, AT),
        ("otro", "x", 1, "https://otro.bo/", 200, FIRST, AT),
        ("eldeber", "pais", 2, "https://eldeber.com.bo/pais/2/", 404, FIRST, AT),
        ("eldeber", "pais", 3, "https://eldeber.com.bo/pais/3/", 200, "<p>nada", AT),
        ("eldeber", "pais", 4, "https://eldeber.com.bo/pais/4/", 200, None, AT),
    ]
    return spark.createDataFrame(rows, schemas.PAGES)


def test_articles(spark, pages):
    rows = extract.extract_articles(scan_pages(pages), default_rules(spark)).orderBy("url").collect()
    got = [(r.source, r.titulo, r.descripcion, r.fecha, r.seccion, r.url, r.date_saved[-9:]) for r in rows]
    assert got == [
        ("ahoraelpueblo", "Tp1", "D1  fin", "2025-04-01T08:30:00-04:00", "sociedad", "https://ahoraelpueblo.bo/p/1",
         "T12:00:00"),
        ("ahoraelpueblo", "Por lugar", "intro", "2025-05-01", "sociedad", "https://ahoraelpueblo.bo/q/1", "T12:00:00"),
        ("eldeber", "Uno & dos", "Hola  mundo otra mas", "2025-04-01", "pais", "https://eldeber.com.bo/a/1",
         "T12:00:00"),
        ("eldeber", "Tres", "", "", "pais", "https://eldeber.com.bo/pais/1/b/3", "00.000003"),
        ("lostiempos", "T1", "S1", "12/04/2025", "Pais", "https://www.lostiempos.com/n/1", "T12:00:00"),
        ("lostiempos", "T2", "", "", "Ultimas Noticias", "https://www.lostiempos.com/n/2", "00.000001"),
    ]
    assert len({r.data_id for r in rows}) == len(rows)


def test_rejects_and_counts(spark, pages):
    rules = default_rules(spark)
    rejected = extract.rejected_blocks(extract.extract_blocks(scan_pages(pages), rules))
    assert sorted((r.source, r.stage, r.reason, r.url) for r in rejected.collect()) == [
        ("ahoraelpueblo", "extract", "titulo_vacio", "/p/2"),
        ("eldeber", "extract", "titulo_vacio", "/a/2"),
        ("eldeber", "extract", "url_vacia", "https://eldeber.com.bo/pais/1/"),
    ]
    counts = extract.articles_per_page(scan_pages(pages), rules).collect()
    assert sorted((r.source, r.page, r.n_articles) for r in counts) == [
        ("ahoraelpueblo", 1, 1), ("ahoraelpueblo", 2, 1), ("eldeber", 1, 2), ("eldeber", 3, 0), ("eldeber", 4, 0),
        ("lostiempos", 1, 2)]
    assert [r.source for r in extract.unknown_sources(pages, rules).collect()] == ["otro"]


def test_next_page(spark, pages):
    links = extract.next_page_links(scan_pages(pages), default_rules(spark)).collect()
    assert [(r.source, r.next_url) for r in links] == [
        ("lostiempos", "https://www.lostiempos.com/ultimas-noticias?page=1")]


def test_failing_page_is_reported_and_the_others_go_on(spark, pages):
    good = extract._plans(collect_rules(default_rules(spark)), slots := extract.slots_of(collect_rules(default_rules(spark))))
    del good["lostiempos"]
    find = extract._finder(good, len(slots))
    found = {r.source: r.f for r in scan_pages(pages).filter("page = 1").select(
        "source", find("html", "source").alias("f")).collect()}
    assert found["lostiempos"].error.startswith("KeyError") and found["lostiempos"].blocks == []
    assert found["eldeber"].error is None and len(found["eldeber"].blocks) == 4


def test_odd_markup_is_tolerated():
    tree = Tree("<![foo[<p>a<!-- x -->b</p></i></div><br/><div/>c &lt; d<3 <a href=x href=y>z")
    assert select(tree, 0, compile_selector("//a/@href")) == ["x"]
    assert "c < d<3 " in select(tree, 0, compile_selector("//text()"))


def test_fallback_counts_matches_not_content(spark):
    df = spark.createDataFrame([([""], ["b"]), ([], ["b"]), (None, ["b"]), ([], [])], "a array<string>, b array<string>")
    got = df.select(extract.first_filled(F.col("a"), F.col("b")).alias("x")).collect()
    assert [r.x for r in got] == [[""], ["b"], ["b"], []]


def test_section_rules(spark):
    df = spark.createDataFrame([("lostiempos", "p", "c"), ("eldeber", "p", "c"), (None, "p", "c")], "s string, p string, c string")
    assert [r[0] for r in df.select(extract.section_rule(*map(F.col, "spc"))).collect()] == ["p", "c", "c"]
    df = spark.createDataFrame([(None,), ("",), ("x",)], "s string")
    assert [r[0] for r in df.select(extract.with_default_section(F.col("s"))).collect()] == ["Ultimas Noticias", "", "x"]


@pytest.mark.parametrize("selector, expected", [
    ("//li/text()", ["a", "b", "c"]),
    ("//ul/li[2]/text()", ["b"]),
    (".//li[2]/text()", ["b"]),
    ("//li/ancestor::ul/@id", ["u", "v"]),
    ('//*[@id="v"]//text()', ["c", "t", "u"]),
    ('//div[contains(@class, "k")]/@class', ["xky"]),
    ("//p/b/text()", []),
])
def test_selectors(selector, expected):
    tree = Tree('<ul id=u><li>a<li>b</ul><ul id="v"><li>c<table><tr><td>t<td>u</table></ul><div class=xky></div><p>x<div><b>y</div>')
    assert select(tree, 0, compile_selector(selector)) == expected


def test_unsupported_selector():
    with pytest.raises(ValueError):
        compile_selector("//a[last()]")


def test_unclosed_and_stray_tags_cost_little():
    """Work per node stays the same: these pages of some MB would take hours otherwise."""
    n = 40_000
    row = "<div><a href=\"{}\">x</a></div>"
    tree = Tree("<div>" + "".join(row.format(i) for i in range(n)) + "</div>")
    assert select(tree, 0, compile_selector("//div/div[3]/a/@href")) == ["2"]
    tree = Tree("<p>" + "<b>x</i></td>" * n)
    assert len(tree.inside(0, "b")) == n


def test_failing_block_is_quarantined_with_its_markup(spark):
    """A selector that cannot be applied to what one block holds costs that block alone."""
    rules = [dict(source="eldeber", row_selector="//li", row_order=0, field=f, selector=x, fallback_order=0, mode="first", default=None)
             for f, x in (("titulo", ".//b/text()"), ("url", ".//a/@href"), ("fecha", './/i/text()[@x="1"]'))]
    html = '<ul><li><b>uno</b><a href="/1"></a><li class="q"><b>a &lt; b</b><i>dos</i><li><b>tres</b><a href="/3"></a></ul>'
    df = spark.createDataFrame([("eldeber", "s", 1, "https://eldeber.com.bo/", 200, html, AT)], schemas.PAGES)
    blocks = extract.extract_blocks(df, rules)
    assert [r.titulo for r in extract.landing_rows(blocks).orderBy("url").collect()] == ["uno", "tres"]
    (bad,) = extract.rejected_blocks(blocks).collect()
    assert (bad.reason, bad.error.partition(":")[0]) == ("bloque_ilegible", "AttributeError")
    assert bad._corrupt_record == '<li class="q"><b>a &lt; b</b><i>dos</i></li>'
    assert [(r.reason, r.n) for r in quarantine_counts(extract.rejected_blocks(blocks)).collect()] == [("bloque_ilegible", 1)]


def test_pages_are_read_in_pieces():
    """However many pages a batch has, few of them are held as Python objects."""
    pages = pa.array(["x" * 1000, None, "bad"] * 5000)
    held = []

    def find(html, source):
        held.append(html)
        if html == "bad":
            raise ValueError("no")
        return {"blocks": [[[html]]], "next_pages": [], "faults": [], "error": None, "markup": None}

    sizes, got = [], []
    for piece in extract._in_pieces(find, pages, pa.array(["s"] * len(pages))):
        sizes.append(len(held))
        held.clear()
        got += piece.to_pylist()
    assert len(sizes) > 4 and max(sizes) * 334 <= extract.PIECE_CHARS + 4000
    assert [r["error"] for r in got[:3]] == [None, None, "ValueError: no"]
    assert [r["blocks"] for r in got] == [[[["x" * 1000]]], [[[""]]], []] * 5000
