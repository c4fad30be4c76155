"""Report queries on five rows, and what reaches the scan."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from newszones import schemas
from newszones.operators.dedupe import first_wins, new_rows
from newszones.plans import reports, zones
from newszones.plans.catalog import QUERIES
from newszones.sources import tables as tb

ROWS = [
    ("n1", date(2026, 11, 20), "08:00:00.000000", "pais", "eldeber", "u1", None),
    ("n2", date(2026, 11, 20), "09:00:00.000000", "pais", "eldeber", "u2", None),
    ("n3", date(2026, 11, 21), "07:00:00.000000", "mundo", "lostiempos", "u3", None),
    ("n4", date(2026, 11, 21), "07:30:00.000000", None, None, "u4", None),
    ("n5", None, None, "mundo", "eldeber", "u5", None),
]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def report(spark):
    return reports.load_report(spark.createDataFrame(ROWS, schemas.CONSUMPTION))


def pairs(df):
    return [tuple(r) for r in df.collect()]


def test_load_is_newest_first(report):
    assert report.columns == ["titulo", "fecha_noticia", "hora_noticia", "seccion", "fuente", "url"]
    assert [r.titulo for r in reports.newest_first(report).collect()] == ["n4", "n3", "n2", "n1"]


def test_default_choice(report):
    chosen = reports.filter_sources(report, [r.fuente for r in reports.distinct_sources(report).collect()])
    assert sorted(pairs(chosen)) == sorted(pairs(reports.filter_all_sources(report)))
    views = reports.report_views(chosen)
    assert pairs(views["total"]) == [(3,)]
    assert pairs(views["per_day"]) == [(date(2026, 11, 20), 2), (date(2026, 11, 21), 1)]
    assert pairs(views["per_source"]) == [("eldeber", 2), ("lostiempos", 1)]
    assert pairs(views["top_sections"]) == [("pais", 2), ("mundo", 1)]
    assert [r.titulo for r in views["latest"].collect()] == ["n3", "n2", "n1"]


def test_no_choice_is_no_filter(report):
    chosen = reports.filter_sources(report, [])
    assert pairs(reports.filtered_total(chosen)) == [(4,)]
    assert pairs(reports.articles_per_source(chosen)) == [("eldeber", 2), ("lostiempos", 1)]
    assert pairs(reports.articles_per_day(chosen))[1] == (date(2026, 11, 21), 2)


def test_ranges(report):
    lo, hi, today = date(2026, 11, 20), date(2026, 11, 21), date(2026, 12, 1)
    month = (date(2026, 11, 1), today)
    assert reports.resolve_range(lo, hi, as_of=today) == (lo, hi)
    assert reports.resolve_range(lo, hi, hi, None, as_of=today) == (hi, hi)
    assert reports.resolve_range(lo, hi, hi, lo, as_of=today) == month
    assert reports.resolve_range(None, None, as_of=today) == month
    assert reports.resolve_range(None, None, as_of=today, fallback=(hi, lo)) == (None, None)
    assert [r.titulo for r in reports.filter_dates(report, hi, hi).orderBy("titulo").collect()] == ["n3", "n4"]
    assert reports.filter_dates(report, None, hi).count() == 4
    assert pairs(reports.date_bounds(report)) == [(lo, hi)]


def test_guards_and_losses(spark, report):
    empty = report.withColumn("nada", F.lit(None).cast("string"))
    assert pairs(reports.has_values(empty, "fuente", "nada")) == [(True, False)]
    assert pairs(reports.has_values(empty.filter("false"), "fuente")) == [(False,)]
    dirty = spark.createDataFrame([("2025-04-01", "08:00:00"), ("ayer", "08:00:00"), ("2025-04-01", "x"), (None, "x")],
                                  "fecha_noticia string, hora_noticia string")
    assert pairs(reports.coercion_loss(dirty)) == [(2,)]
    assert reports.load_report(dirty).collect()[0].fecha_noticia == date(2025, 4, 1)
    assert reports.load_report(dirty).count() == 1


def test_views_are_written(spark, report, tmp_path):
    reports.write_views(report, str(tmp_path / "mart"))
    assert spark.read.parquet(str(tmp_path / "mart" / "per_source")).count() == 2


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def stored(spark, tmp_path):
    tables = tb.ZoneTables(str(tmp_path / "zones"))
    tb.write_consumption_batch(spark.createDataFrame(ROWS, schemas.CONSUMPTION), tables.consumption, "b")
    return tables


def test_filters_reach_the_scan(spark, stored):
    report = reports.load_report(tb.read_consumption(spark, stored, tb.MONTH))
    df = reports.filter_dates(
        reports.filter_sources(report, ["eldeber"]), date(2026, 11, 20), date(2026, 11, 30))
    text = formatted(df)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "In(fuente" in pushed or "EqualTo(fuente" in pushed
    assert "GreaterThanOrEqual(fecha_noticia" in pushed and "IsNotNull(hora_noticia" in pushed
    partition = re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "fecha_mes" in partition
    assert df.count() == 2
    per_source = formatted(reports.articles_per_source(report))
    assert re.search(r"ReadSchema: struct<fecha_noticia:date,hora_noticia:string,fuente:string>", per_source)


def test_small_batch_leaves_history_in_place(spark, stored):
    batch = spark.createDataFrame([("u1", 1), ("x", 2), (None, 3)], "url string, i int")
    history = tb.read_consumption(spark, stored)
    text = plan(new_rows(batch, history, "url"))
    scan = text[: text.index("FileScan")]
    last = scan.rindex("BroadcastHashJoin")
    # Between the scan of the history and its join there is no exchange.
    assert "Exchange hashpartitioning" not in scan[last:]
    assert "LeftSemi" in scan[last:last + 120]
    assert "ReadSchema: struct<url:string>" in text
    big = plan(new_rows(batch, history, "url", max_bytes=0).hint("merge"))
    assert "LeftAnti" in big


def test_first_wins_aggregates_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("cast(id % 2 as string) url", "id saved")
    text = plan(first_wins(df, "url", ["saved"]))
    assert "partial_min" in text and "Window" not in text


def test_bucketed_history_is_not_shuffled(spark):
    spark.sql("DROP TABLE IF EXISTS history_by_url")
    try:
        spark.range(100).selectExpr("concat('u', id) AS url").write.bucketBy(8, "url").format(
            "parquet").saveAsTable("history_by_url")
        batch = spark.range(50).selectExpr("concat('u', id * 3) AS url", "id")
        df = new_rows(batch, spark.table("history_by_url"), "url", max_bytes=0)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(df)
        history = text[text.index("LeftAnti"):].split("+- ")
        after = [part for part in history if "history_by_url" in part]
        assert after and "Bucketed: true" in text
        assert df.count() == 50 - 34
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS history_by_url")


PYTHON = {"extract_rules", "union_sources", "html_first_and_all", "next_page_link", "articles_per_page",
          "quarantine_counts"}
RUNS_STREAMS = {"stream_refine", "stream_upsert_idempotent", "stream_available_now", "landing_roundtrip",
                "stream_watermark_dedupe", "stream_archived_landing"}


def test_no_python_outside_extraction(spark):
    for name in sorted(set(QUERIES) - RUNS_STREAMS):
        text = plan(QUERIES[name](spark, SF))
        assert ("Python" in text) == (name in PYTHON), name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_zone_batch_needs_no_python(spark):
    from test_zones import landing
    df = zones.normalize_rows(landing(spark, ("a", "u", "t")), as_of=F.expr("timestamp_ntz'2026-12-01 00:00:00'"))
    assert "Eval" not in plan(df)


def test_typed_times_are_not_coerced_and_missing_columns_are_no_error(spark, stored):
    text = formatted(reports.read_report(spark, stored))
    assert "RLIKE" not in text and "atleastnnonnulls" not in text.lower()
    rows = tb.read_consumption(spark, stored)
    assert reports.load_report(rows.drop("fecha_noticia", "hora_noticia")).count() == rows.count()
    assert "hora_noticia" not in reports.load_report(rows.drop("hora_noticia")).columns


def test_lazy_range_skips_months_in_one_plan(spark, stored):
    """The data's own range, an asked one, and the fallback, without a job while the query is built."""
    report = reports.read_report(spark, stored)
    days = [r.fecha_noticia for r in report.select("fecha_noticia").collect()]
    as_of = date(2026, 12, 1)
    for asked in [(None, None), (date(2026, 11, 20), None), (date(2027, 1, 1), date(2026, 1, 1)), (None, date(2026, 11, 25))]:
        lo, hi = reports.resolve_range(min(days), max(days), *asked, as_of=as_of)
        df = reports.filter_dates(report, *reports.lazy_range(reports.date_bounds(report), *asked, as_of=as_of))
        assert sorted(r.fecha_noticia for r in df.collect()) == sorted(d for d in days if lo <= d <= hi)
    text = formatted(df)
    partition = [x for x in re.findall(r"PartitionFilters: \[(.*)\]", text) if "ubquery" in x]
    assert partition and "fecha_mes" in partition[0]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    reports.filter_dates(report, *reports.lazy_range(reports.date_bounds(report), as_of=as_of))
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext._jsc.clearJobGroup()
