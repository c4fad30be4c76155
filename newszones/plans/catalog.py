"""One query per operator, each over whole benchmark tables: ``name -> f(spark, sf_dir)``."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newszones.functions import dates, records, text, urls
from newszones.operators import extract
from newszones.operators.dedupe import first_wins, known_rows, new_firsts
from newszones.operators.rules import collect_rules, default_rules
from newszones.plans import inputs, reports, zones
from newszones.sources import tables as tb
from newszones.sources.landing import LIST, archived_landing, read_landing, write_landing
from newszones.sources.pages import allowed_pages, rejected_pages, scan_pages
from newszones.sources.storage import work_path, write_and_read
from newszones.streaming.zone_stream import start_bounded, start_zones

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _docs(spark, sf):
    return inputs.table(spark, sf, "documents")


def _pages(spark, sf):
    return inputs.table(spark, sf, "pages")


def _normalized(spark, sf):
    return zones.normalize_rows(inputs.raw_articles(spark, sf), as_of=inputs.as_of())


def _accepted(spark, sf):
    return zones.accepted(_normalized(spark, sf))


def _firsts(spark, sf):
    return first_wins(_accepted(spark, sf), "url", zones.ARRIVAL)


def _report(spark, sf):
    return reports.load_report(inputs.news(spark, sf))


def _chosen(spark, sf):
    return reports.filter_all_sources(_report(spark, sf))


# Pages and extraction

@query
def scan_pages_query(spark, sf):
    return scan_pages(inputs.captured_pages(spark, sf)).select("page_id", "source", "section", "page", "url")


@query
def extract_rules(spark, sf):
    return extract.extract_articles(inputs.list_pages(spark, sf), default_rules(spark))


@query
def union_sources(spark, sf):
    """All sources in one job: each page meets the rules of its source."""
    return extract.extract_articles(inputs.list_pages(spark, sf), default_rules(spark)).select(
        "source", "titulo", "seccion", "url")


@query
def selector_fallback(spark, sf):
    found = extract.first_filled(
        F.regexp_extract_all("html", F.lit('<a href="(/[aA][^"]*)"'), F.lit(1)),
        F.regexp_extract_all("html", F.lit("<h1>([^<]*)</h1>"), F.lit(1)))
    return _pages(spark, sf).select("page_id", F.size(found).alias("n"), text.join_list(found).alias("found"))


@query
def html_first_and_all(spark, sf):
    rules = [dict(source="p", row_selector="//nav", row_order=0, field=f, selector=s, fallback_order=0,
                  mode=m, default=None)
             for f, s, m in [("url", ".//li/a/@href", "first"), ("descripcion", ".//li/a/text()", "all")]]
    pages = _pages(spark, sf).select("page_id", "html", F.lit("p").alias("source"))
    block = F.col("found.blocks")[0]
    return extract.with_matches(pages, rules).select(
        "page_id",
        extract.first_match(block[1], F.lit("")).alias("first_link"),
        extract.all_matches(block[0]).alias("all_texts"))


@query
def default_section(spark, sf):
    section = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 5 != 0, F.col("lang"))
    return _docs(spark, sf).select("doc_id", extract.with_default_section(section).alias("seccion"))


@query
def section_rule(spark, sf):
    return inputs.captured_pages(spark, sf).select("page_id", extract.section_rule(
        F.col("source"), F.regexp_extract("html", 'lang="([a-z]+)"', 1), F.col("section")).alias("seccion"))


@query
def required_fields(spark, sf):
    titulo = text.strip(F.when(F.col("page_id") % 4 == 0, "\u00a0").when(
        F.col("page_id") % 4 != 1, F.regexp_extract("html", "<h1>([^<]*)</h1>", 1)))
    href = F.when(F.col("page_id") % 6 == 0, "").otherwise(F.regexp_extract("html", '<a href="([^"]*)"', 1))
    return _pages(spark, sf).select("page_id", titulo.alias("titulo"), href.alias("href")).filter(
        extract.missing_field(F.col("titulo"), F.col("href")).isNull())


@query
def resolve_url(spark, sf):
    link = F.regexp_extract("html", '<a href="/([^"]*)"', 1)
    href = (
        F.when(F.col("page_id") % 7 == 0, F.concat(F.lit("https://o.bo/"), link))
        .when(F.col("page_id") % 7 == 1, F.concat(F.lit("//h.bo/"), link))
        .when(F.col("page_id") % 7 == 2, F.concat(F.lit("/"), link))
        .when(F.col("page_id") % 7 == 3, "?q=1")
        .when(F.col("page_id") % 7 == 4, "#f")
        .when(F.col("page_id") % 7 == 5, F.concat(F.lit("a/"), link))
        .otherwise(F.concat(F.lit("../"), link)))
    return _pages(spark, sf).select("page_id", urls.resolve_url(F.col("url"), href).alias("resolved"))


@query
def next_page_link(spark, sf):
    return extract.next_page_links(inputs.list_pages(spark, sf), default_rules(spark))


@query
def provenance_key(spark, sf):
    return _pages(spark, sf).select("page_id", extract.provenance_key(F.lit("eldeber"), F.col("url")).alias("data_id"))


@query
def articles_per_page(spark, sf):
    return extract.articles_per_page(inputs.list_pages(spark, sf), default_rules(spark))


@query
def quarantine_counts(spark, sf):
    rejected = extract.rejected_blocks(extract.extract_blocks(inputs.list_pages(spark, sf), default_rules(spark)))
    return zones.quarantine_counts(rejected.unionByName(zones.quarantined(_normalized(spark, sf))))


@query
def unknown_source(spark, sf):
    return extract.unknown_sources(inputs.captured_pages(spark, sf), default_rules(spark)).select("page_id", "source")


@query
def domain_allowlist(spark, sf):
    return allowed_pages(inputs.host_urls(spark, sf))


@query
def page_rejects(spark, sf):
    """Pages that are of no use, by reason, as the quarantine table gets them."""
    pages = inputs.captured_pages(spark, sf).drop("url").join(inputs.host_urls(spark, sf), "page_id")
    return rejected_pages(pages, collect_rules(default_rules(spark))).select("url", "source", "stage", "reason")


# Text, records, URLs

@query
def normalize_text(spark, sf):
    raw = F.concat(F.lit("\u00a0 "), "text", F.when(F.col("doc_id") % 3 == 0, " \u001c").otherwise(" \U0001f600"))
    return _docs(spark, sf).select("doc_id", text.normalize_text(raw).alias("normalized"))


@query
def null_tokens(spark, sf):
    raw = (F.when(F.col("doc_id") % 4 == 0, "").when(F.col("doc_id") % 4 == 1, " NULL ")
           .when(F.col("doc_id") % 4 == 2, " ").otherwise(F.col("lang")))
    return _docs(spark, sf).select("doc_id", text.null_tokens(text.normalize_text(raw)).alias("lang"))


@query
def join_list_field(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", text.clean_description(text.join_list(F.split("text", "\n"))).alias("descripcion"))


@query
def clean_text(spark, sf):
    raw = F.concat(F.lit("\u00a0"), "text", F.when(F.col("doc_id") % 3 == 0, "\u00a0x\u001cy \U0001f600").otherwise("!"))
    return _docs(spark, sf).select("doc_id", text.clean_text(raw).alias("cleaned"))


@query
def remove_links(spark, sf):
    n = F.col("doc_id").cast("string")
    raw = F.concat(F.lit("www.y.bo/á "), "text", F.lit(" ver http://www.x.com/"), n, F.lit("?a=(b)|c https://ñ"))
    return _docs(spark, sf).select("doc_id", text.remove_links(raw).alias("cleaned"))


@query
def clean_description(spark, sf):
    raw = text.normalize_text(F.concat("text", F.lit(" ver http://www.x.com/"), F.col("doc_id").cast("string")))
    return _docs(spark, sf).select(
        "doc_id",
        text.clean_description(raw).alias("descripcion"),
        text.clean_description(raw, "links_then_clean").alias("descripcion_sin_enlaces"))


@query
def to_json_line(spark, sf):
    return _docs(spark, sf).select(
        "doc_id", "source", F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("descripcion"),
    ).select("doc_id", records.to_json_line("source", "descripcion").alias("line"))


@query
def first_of_list(spark, sf):
    words = F.when(F.col("doc_id") % 5 == 0, F.array().cast("array<string>")).otherwise(F.split("text", " "))
    return _docs(spark, sf).select("doc_id", records.first_of_list(words).alias("first_word"))


@query
def url_authority(spark, sf):
    return inputs.article_urls(spark, sf).select("page_id", urls.url_authority(F.col("url")).alias("authority"))


@query
def source_from_url(spark, sf):
    return inputs.article_urls(spark, sf).select("page_id", urls.source_from_url(F.col("url")).alias("fuente"))


# Dates

@query
def parse_fecha(spark, sf):
    return dates.parse_fecha(inputs.dated_texts(spark, sf), as_of=inputs.as_of()).select("event_id", "fecha")


@query
def split_date_time(spark, sf):
    return dates.split_date_time(inputs.dated_texts(spark, sf), as_of=inputs.as_of()).drop("fecha")


@query
def date_saved_iso(spark, sf):
    ts = F.col("ts")
    raw = (F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "yyyy-MM-dd't'HH:mm:ss.SSSSSS"))
           .when(F.col("event_id") % 4 == 1, F.date_format(ts, "yyyy-MM-dd't'HH:mm:ss"))
           .when(F.col("event_id") % 4 == 2, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit("-0400")))
           .otherwise("ayer"))
    return inputs.table(spark, sf, "events").select("event_id", dates.date_saved_iso(raw).alias("date_saved_iso"))


@query
def coerce_time(spark, sf):
    ts = F.col("ts")
    raw = (F.when(F.col("event_id") % 4 == 0, F.date_format(ts, "HH:mm:ss.SSS"))
           .when(F.col("event_id") % 4 == 1, F.date_format(ts, "H:mm:ss"))
           .when(F.col("event_id") % 4 == 2, "25:00:00").otherwise(F.date_format(ts, "HH:mm")))
    return inputs.table(spark, sf, "events").select("event_id", dates.coerce_time(raw).alias("hora_noticia"))


def _dirty_dates(spark, sf):
    ts, e = F.col("ts"), F.col("event_id")
    return inputs.table(spark, sf, "events").select(
        "event_id",
        F.when(e % 4 == 0, F.date_format(ts, "yyyy-MM-dd")).when(e % 4 == 1, "2024-02-30")
        .when(e % 4 == 2, "ayer").alias("fecha_noticia"),
        F.when(e % 6 == 0, "mediodia").otherwise(F.date_format(ts, "HH:mm:ss")).alias("hora_noticia"))


@query
def coerce_date(spark, sf):
    return _dirty_dates(spark, sf).select("event_id", dates.coerce_date(F.col("fecha_noticia")).alias("fecha_noticia"))


@query
def coercion_loss(spark, sf):
    return reports.coercion_loss(_dirty_dates(spark, sf))


# Zones

@query
def landing_roundtrip(spark, sf):
    path = work_path(spark, "landing")
    write_landing(inputs.raw_articles(spark, sf), path, "20261201_000000")
    return read_landing(spark, path).drop("_corrupt_record", LIST)


@query
def list_descriptions(spark, sf):
    """Lists, texts and texts that look like lists, through landing files into refined rows."""
    path = work_path(spark, "landing")
    inputs.landed_descriptions(spark, sf).write.text(f"{path}/run_ts=20261201_000000")
    rows = zones.normalize_rows(read_landing(spark, path), as_of=inputs.as_of())
    return zones.accepted(rows).select("data_id", "descripcion")


@query
def title_required(spark, sf):
    return _normalized(spark, sf).filter(F.col("titulo").isNotNull()).select("data_id", "titulo")


@query
def refined_projection(spark, sf):
    return zones.refined_projection(_accepted(spark, sf))


@query
def consumption_projection(spark, sf):
    return zones.consumption_projection(_accepted(spark, sf)).drop("fecha_procesado")


@query
def dedupe_first_wins(spark, sf):
    return _firsts(spark, sf).select("data_id", "titulo", "url", "date_saved")


@query
def dedupe_against_history(spark, sf):
    return zones.refine(inputs.raw_articles(spark, sf), inputs.known_urls(spark, sf), as_of=inputs.as_of())


@query
def known_articles(spark, sf):
    keys = zones.url_keys(inputs.raw_articles(spark, sf))
    return known_rows(_accepted(spark, sf), inputs.known_urls(spark, sf), "url", keys=keys).select("data_id", "url")


@query
def upsert_do_nothing(spark, sf):
    known = inputs.known_urls(spark, sf, good_only=True)
    rows = new_firsts(_accepted(spark, sf), known, "url", zones.ARRIVAL)
    return zones.consumption_projection(rows).drop("fecha_procesado")


@query
def consumption_backfill(spark, sf):
    """Of three batches the consumption table has lost one as a whole and single URLs of the others."""
    path = work_path(spark, "refined")
    batch = F.concat(F.lit("b"), (F.regexp_extract("data_id", "[0-9]+", 0).cast("long") % 3).cast("string"))
    refined = write_and_read(zones.refined_projection(_firsts(spark, sf)).withColumn("batch_key", batch), path)
    there = inputs.known_urls(spark, sf, good_only=True).withColumn(
        "batch_key", F.when(F.length("url") % 2 == 0, "b0").otherwise("b1"))
    there = there.unionByName(spark.createDataFrame([(None, "b0"), (None, "b1")], "url string, batch_key string"))
    return zones.backfill(refined, there).drop("fecha_procesado")


# Streaming: the zone tables after real runs over landing files

def _stream(spark, tables, checkpoint, landing=None):
    q = start_zones(spark, tables, checkpoint, landing=landing, as_of=inputs.as_of())
    q.awaitTermination()


@query
def stream_refine(spark, sf):
    root = work_path(spark, "stream")
    tables = tb.ZoneTables(root)
    write_landing(inputs.raw_articles(spark, sf), tables.landing, "20261201_000000")
    _stream(spark, tables, f"{root}/checkpoint")
    return tb.read_refined(spark, tables)


@query
def stream_upsert_idempotent(spark, sf):
    """The same landing files under two checkpoints: the second run adds only rows without a URL."""
    root = work_path(spark, "stream")
    tables = tb.ZoneTables(root)
    write_landing(inputs.raw_articles(spark, sf), tables.landing, "20261201_000000")
    _stream(spark, tables, f"{root}/checkpoint_1")
    _stream(spark, tables, f"{root}/checkpoint_2")
    return tb.read_consumption(spark, tables).drop("fecha_procesado")


@query
def stream_available_now(spark, sf):
    """Three incremental runs on one checkpoint: morning rows, the other rows, nothing new."""
    root = work_path(spark, "stream")
    tables = tb.ZoneTables(root)
    rows = inputs.raw_articles(spark, sf)
    morning = F.coalesce(F.col("date_saved") < "2025-04-01T12", F.lit(False))
    for run, part in [("20261201_000000", rows.filter(morning)), ("20261203_000000", rows.filter(~morning)),
                      ("20261205_000000", None)]:
        if part is not None:
            write_landing(part, tables.landing, run)
        _stream(spark, tables, f"{root}/checkpoint")
    return tb.read_consumption(spark, tables).drop("fecha_procesado")


@query
def stream_watermark_dedupe(spark, sf):
    """URLs and rows of a stream whose state forgets; all rows are of one day, so none is late."""
    root = work_path(spark, "bounded")
    write_landing(inputs.raw_articles(spark, sf), f"{root}/landing", "20261201_000000")
    start_bounded(spark, f"{root}/landing", f"{root}/refined", f"{root}/checkpoint", as_of=inputs.as_of()).awaitTermination()
    return spark.read.parquet(f"{root}/refined").groupBy("url").agg(F.count("*").alias("n"))


@query
def stream_archived_landing(spark, sf):
    """Where landing lines are after two incremental runs: a run archives the files of the one before."""
    root = work_path(spark, "archived")
    tables = tb.ZoneTables(f"{root}/zones")
    rows, odd = inputs.raw_articles(spark, sf), F.regexp_extract("data_id", "[0-9]+", 0).cast("long") % 2 == 1
    name = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")  # files are moved before a run ends
    try:
        for run, part in (("20261201_000000", rows.filter(odd)), ("20261203_000000", rows.filter(~odd))):
            write_landing(part, tables.landing, run)
            start_zones(spark, tables, f"{root}/checkpoint", as_of=inputs.as_of(), archive=f"{root}/archive").awaitTermination()
    finally:
        spark.conf.set(name, before)
    places = {"archive": archived_landing(f"{root}/archive", tables.landing), "landing": tables.landing}
    archived, landed = (read_landing(spark, path).select("data_id", "descripcion", "run_ts", F.lit(where).alias("folder"))
                        for where, path in places.items())
    return archived.unionByName(landed)


# Reports

def _view(name):
    def read_back(spark, sf):
        path = work_path(spark, "mart")
        reports.write_views(_chosen(spark, sf), path, [name])
        return reports.read_view(spark, path, name)

    QUERIES[f"extract_{name}"] = read_back


for _name in ("total", "per_day", "per_source", "top_sections", "latest"):
    _view(_name)


@query
def load_report(spark, sf):
    return reports.newest_first(_report(spark, sf))


@query
def filter_sources(spark, sf):
    return reports.filter_sources(_report(spark, sf), ["src1", "src3"])


@query
def filter_date_range(spark, sf):
    return reports.filter_dates(_report(spark, sf), date(2024, 1, 10), date(2024, 1, 19))


@query
def filter_last_30_days(spark, sf):
    """A range asked for the wrong way round gives the last 30 days."""
    report = _report(spark, sf)
    lo, hi = reports.lazy_range(
        reports.date_bounds(report), F.col("fecha_max"), F.col("fecha_min"), as_of=inputs.TODAY)
    return reports.filter_dates(report, lo, hi)


@query
def articles_per_day(spark, sf):
    return reports.articles_per_day(_chosen(spark, sf))


@query
def articles_per_source(spark, sf):
    return reports.articles_per_source(_report(spark, sf))


@query
def top10_sections(spark, sf):
    return reports.top_sections(_chosen(spark, sf))


@query
def filtered_total(spark, sf):
    return reports.filtered_total(_chosen(spark, sf))


@query
def distinct_sources(spark, sf):
    return reports.distinct_sources(_report(spark, sf))


@query
def date_bounds(spark, sf):
    return reports.date_bounds(_report(spark, sf))


@query
def has_values(spark, sf):
    return reports.has_values(_report(spark, sf), "fuente", "fecha_noticia")


@query
def latest_20(spark, sf):
    return reports.latest(_chosen(spark, sf))


QUERIES["scan_pages"] = QUERIES.pop("scan_pages_query")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Articles per source name, read off the URLs of captured pages."""
    pages = inputs.article_urls(spark, sf)
    return reports.articles_per_source(pages.select(urls.source_from_url(F.col("url")).alias("fuente")))


QUERIES["articles_per_url_source"] = flagship

