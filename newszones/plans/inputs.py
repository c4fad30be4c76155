"""News-shaped frames derived from the benchmark tables, over their whole content.

``catalog_sql`` derives the same rows in SQL.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newszones.functions.text import normalize_text, null_tokens

TODAY = date(2024, 1, 25)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.expr("timestamp_ntz'2026-12-01 00:00:00'")


def captured_at() -> Column:
    return F.expr("cast(timestamp_ntz'2025-04-01 12:00:00' as timestamp)")


def _by(key: str, n: int, **cases) -> Column:
    """A value by ``key % n``: ``_0`` to ``_k`` give the first remainders, ``rest`` the others."""
    value = F.lit(None)
    for name, case in cases.items():
        if name != "rest":
            match = F.col(key) % n == int(name[1:])
            value = F.when(match, case) if value is None or name == "_0" else value.when(match, case)
    return value.otherwise(cases["rest"])


def _urls(pages: DataFrame) -> DataFrame:
    """Page URLs with hosts of every kind the source rule tells apart; each tenth lacks a scheme."""
    url = F.replace(F.replace("url", F.lit("spam-farm.example.org"), F.lit("eldeber.com.bo")),
                    F.lit("example.com"), F.lit("com.bo"))
    return pages.withColumn(
        "url", F.when(F.col("page_id") % 10 == 0, F.regexp_replace(url, "^https?://", "")).otherwise(url))


def article_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def host_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs whose hosts are, in turn, allowed, subdomains, look-alikes, and written with case, port or user."""
    hosts = ["eldeber.com.bo", "www.lostiempos.com", "notahoraelpueblo.bo", "EL.AhoraElPueblo.bo", "lostiempos.com:8080",
             "user@eldeber.com.bo", "eldeber.com.bo.example", "example.org"]
    host = F.element_at(F.array(*map(F.lit, hosts)), (F.col("page_id") % len(hosts) + 1).cast("int"))
    return table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.lit("https://"), host, F.lit("/n/"), F.col("page_id").cast("string")).alias("url"))


def landed_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing lines whose description is a list, a text, or a text that looks like a list."""
    n = F.col("doc_id").cast("string")
    title = F.concat(F.lit("Nota "), n)
    row = F.struct(n.alias("data_id"), title.alias("titulo"), F.array(F.lit("Uno DOS"), title, F.lit("Ñ!")).alias("descripcion"))
    text = F.when(F.col("doc_id") % 3 == 1, F.concat(F.lit('["A",'), n, F.lit("]"))).otherwise(F.concat(F.lit("[x] Uno "), n))
    plain = F.struct(n.alias("data_id"), title.alias("titulo"), text.alias("descripcion"))
    return table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 3 == 0, F.to_json(row)).otherwise(F.to_json(plain)).alias("value"))


def captured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page table with crawl facts: source, section, page number, status, capture time."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        _by("page_id", 5, _0="eldeber", _1="lostiempos", _2="ahoraelpueblo", _3="otro", rest=None).alias("source"),
        F.when(F.col("page_id") % 3 == 0, "pais").otherwise("mundo").alias("section"),
        (F.col("page_id") % 10 + 1).cast("int").alias("page"),
        "url",
        F.when(F.col("page_id") % 17 == 0, 404).otherwise(200).alias("status"),
        "html",
        captured_at().alias("captured_at"),
    )


_BLOCKS = {
    "eldeber": (
        "<article class=x><div class=\"titulo-teaser-2col\"><a href=\"{href}\"><h2> {title} </h2></a></div>"
        "<div class=\"entradilla-teaser-2col\"><p>{body}<br>fin</div>"
        "<div class=\"fecha-teaser-2col\"><div><time> {date} </time></div></div></article>"),
    "lostiempos": (
        "<div class=\"views-row odd\"><div class=\"views-field-title term\"><a href=\"{href}\"> {title}</a></div>"
        "<div class=\"views-field-field-noticia-sumario\"><span>{body}<br>fin</span></div>"
        "<span class=\"views-field-field-noticia-fecha\"><span>{date}</span></span>{section}</div>"),
    "ahoraelpueblo": (
        "<div itemprop=\"blogPost\"><h2 itemprop=\"name\"><a href=\"{href}\">{title}</a></h2>"
        "<div class=\"article-introtext\"><p>{body}<br>fin</div><time datetime=\"{date}\">x</time></div>"),
}
_FRAMES = {
    "eldeber": ("<html><body><p>", "</body></html>"),
    "lostiempos": ("<section class=\"pane-views-panes\">",
                   "</section><ul><li class=\"pager-next last\"><a href=\"?page={n}\">sig</a></li></ul>"),
    "ahoraelpueblo": ("<div class=\"article-list\">", "</div>"),
}
_PAGE_URLS = {
    "eldeber": "https://eldeber.com.bo/pais/{n}/",
    "lostiempos": "https://www.lostiempos.com/ultimas-noticias",
    "ahoraelpueblo": "https://ahoraelpueblo.bo/index.php/nacional/politica?start={n}",
}
SOURCES = list(_BLOCKS)


def _fill(template: str, **parts: Column) -> Column:
    pieces = []
    while template:
        literal, _, rest = template.partition("{")
        pieces.append(F.lit(literal))
        name, _, template = rest.partition("}")
        if name:
            pieces.append(parts[name])
    return F.concat(*pieces)


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list page per document in the markup of one source.

    Each has a complete block, one without title, one without link and, for every fourth document, no block.
    """
    n = F.col("doc_id").cast("string")
    body = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    section = F.when(F.col("doc_id") % 2 == 0, F.concat(
        F.lit("<span class=\"views-field-seccion\"><span><a>"), F.col("lang"), F.lit("</a></span></span>"))
    ).otherwise("")
    html, url = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, source in enumerate(SOURCES):
        def block(href, title):
            return _fill(_BLOCKS[source], href=href, title=title, body=body, section=section,
                         date=F.lit("2025-04-01 10:15"))
        head, tail = _FRAMES[source]
        whole = F.concat(
            F.lit(head),
            F.when(F.col("doc_id") % 4 == 3, "").otherwise(F.concat(
                block(F.concat(F.lit("/n/"), n), F.concat(F.lit("Nota "), n)),
                block(F.concat(F.lit("/s/"), n), F.lit("")),
                block(F.lit(""), F.lit("Sin enlace")))),
            _fill(tail, n=n))
        here = F.col("doc_id") % 3 == k
        html = F.when(here, whole).otherwise(html)
        url = F.when(here, _fill(_PAGE_URLS[source], n=n)).otherwise(url)
    return table(spark, sf_dir, "documents").select(
        _by("doc_id", 3, _0=SOURCES[0], _1=SOURCES[1], rest=SOURCES[2]).alias("source"),
        F.when(F.col("doc_id") % 3 != 1, "politica").alias("section"),
        F.col("doc_id").cast("int").alias("page"),
        url.alias("url"),
        F.lit(200).alias("status"),
        html.alias("html"),
        captured_at().alias("captured_at"),
    )


def article_url(text: Column, doc_id: Column) -> Column:
    """Equal texts have equal URLs but for case and blanks; every nineteenth article has none."""
    path = F.concat(F.lit("https://Eldeber.com.bo/pais/"), F.md5(text))
    return F.when(doc_id % 19 == 0, "").when(doc_id % 2 == 0, F.concat(F.upper(path), F.lit("\u00a0"))).otherwise(path)


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows from the documents, with blanks, null tokens, dates of every form and repeated URLs."""
    doc = F.col("doc_id")
    n = doc.cast("string")
    day = F.lpad((doc % 28 + 1).cast("string"), 2, "0")
    minute = doc * 7919 % 1440
    clock = F.concat(F.lpad(F.floor(minute / 60).cast("string"), 2, "0"), F.lit(":"),
                     F.lpad((minute % 60).cast("string"), 2, "0"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D-"), n).alias("data_id"),
        F.col("source"),
        _by("doc_id", 11, _0="\u00a0 ", _1=" Null ", rest=F.concat(F.lit("  Nota "), F.col("lang"), F.lit(" "), n))
        .alias("titulo"),
        F.when(doc % 13 == 0, " ").otherwise(F.concat(
            F.col("text"), F.when(doc % 3 == 0, "\u00a0x\u001cy \U0001f600").otherwise(" Ñandú"),
            F.lit(" ver http://www.x.com/"), n)).alias("descripcion"),
        _by("doc_id", 7,
            _0=F.concat(F.lit("2025-04-"), day, F.lit("T08:30:00-04:00")),
            _1=F.concat(F.lit("04/"), day, F.lit("/2025 10:15")),
            _2=F.concat(day, F.lit(" de abril de 2025")),
            _3=F.concat(day, F.lit(" Apr 2025")),
            _4="",
            _5=F.when(doc % 5 == 0, "99999999999999999999").otherwise("10:15"),
            rest=F.concat(F.lit("2025-04-"), day, F.lit(" 08:30:00.5Z"))).alias("fecha"),
        F.when(doc % 9 == 0, " Null ").otherwise(F.upper("lang")).alias("seccion"),
        article_url(F.col("text"), doc).alias("url"),
        F.when(doc % 17 == 0, "ayer").otherwise(F.concat(F.lit("2025-04-01T"), clock, F.lit(":00.25"))).alias("date_saved"),
    )


def known_urls(spark: SparkSession, sf_dir: str, good_only: bool = False) -> DataFrame:
    """URLs of the labelled documents, as a zone table would hold them."""
    labels = table(spark, sf_dir, "labels")
    if good_only:
        labels = labels.filter("quality = 1")
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left_semi")
    url = null_tokens(normalize_text(article_url(F.col("text"), F.col("doc_id"))))
    return docs.select(url.alias("url")).filter(F.col("url").isNotNull()).distinct()


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumption rows from the events; dates, sources and sections are missing at different intervals."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("n"), e.cast("string")).alias("titulo"),
        F.when(e % 11 != 0, F.col("ts").cast("date")).alias("fecha_noticia"),
        F.when(e % 11 != 0, F.date_format("ts", "HH:mm:ss.SSSSSS")).alias("hora_noticia"),
        F.when(e % 17 != 0, F.concat("event_type", F.lit("-"), (F.col("user_id") % 7).cast("string"))).alias("seccion"),
        F.when(e % 13 != 0, F.concat(F.lit("src"), (F.col("user_id") % 5).cast("string"))).alias("fuente"),
        F.concat(F.lit("https://x.bo/"), F.col("user_id").cast("string"), F.lit("/"), F.col("event_type")).alias("url"),
    )


def dated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as free-form texts: ISO, month first, dotted, with offset, Spanish."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        _by("event_id", 5,
            _0=F.date_format(ts, "yyyy-MM-dd't'HH:mm:ss.SSSSSS"),
            _1=F.date_format(ts, "MM/dd/yyyy"),
            _2=F.date_format(ts, "dd.MM.yyyy HH:mm"),
            _3=F.concat(F.date_format(ts, "yyyy-MM-dd't'HH:mm:ss"), F.lit("-04:00")),
            rest=F.concat(F.date_format(ts, "d"), F.lit(" de enero de "), F.date_format(ts, "yyyy"))).alias("fecha"))
