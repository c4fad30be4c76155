"""First-wins, history lookups, batches and streams on small hand-made tables."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newszones import schemas
from newszones.operators.dedupe import first_wins, known_rows, new_rows
from newszones.plans import zones
from newszones.sources import tables as tb
from newszones.operators.extract import articles_per_page, extract_blocks, rejected_blocks
from newszones.sources.landing import archived_landing, read_landing, write_landing
from newszones.streaming.zone_stream import run_pages, start_bounded, start_zones
from newszones.operators.rules import default_rules

from test_extract import pages  # noqa: F401


def as_of():
    return F.expr("timestamp_ntz'2026-12-01 00:00:00'")


def landing(spark, *rows):
    """Rows of (data_id, url, titulo), saved one second after the other."""
    return spark.createDataFrame(
        [(d, "eldeber", t, "texto", "2025-04-01", "pais", u, f"2025-04-01T12:00:{i:02d}")
         for i, (d, u, t) in enumerate(rows)], schemas.LANDING)


BATCH = [
    ("d1", "https://A.bo/1", "t1"), ("d2", "https://a.bo/2", "t2"), ("d3", "HTTPS://A.BO/2 ", "t3"),
    ("d4", None, "t4"), ("d5", None, "t5"), ("d6", "https://a.bo/3", " "),
]


@pytest.fixture
def tables(tmp_path):
    return tb.ZoneTables(str(tmp_path / "zones"))


def run(spark, tables, key, rows, **options):
    zones.run_batch(spark, landing(spark, *rows), tables, key, as_of=as_of(), **options)


def titles(df):
    return sorted(r.titulo for r in df.select("titulo").collect())


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_batch_against_history(spark, tables, max_bytes):
    run(spark, tables, "h", [("d0", "https://a.bo/1", "t0")], max_bytes=max_bytes)
    run(spark, tables, "b", BATCH, max_bytes=max_bytes)
    assert titles(tb.read_refined(spark, tables)) == ["t0", "t2", "t4", "t5"]
    assert titles(tb.read_consumption(spark, tables)) == ["t0", "t2", "t4", "t5"]
    assert [(r.data_id, r.reason) for r in tb.read_quarantine(spark, tables).collect()] == [("d6", "titulo_vacio")]
    # The same batch again is a replay and changes nothing; as a new batch it adds the rows without URL.
    run(spark, tables, "b", BATCH, max_bytes=max_bytes)
    assert titles(tb.read_refined(spark, tables)) == ["t0", "t2", "t4", "t5"]
    run(spark, tables, "c", BATCH, max_bytes=max_bytes)
    assert titles(tb.read_consumption(spark, tables)) == ["t0", "t2", "t4", "t4", "t5", "t5"]


def test_known_in_refined_still_reaches_consumption(spark, tables):
    rows = zones.normalize_rows(landing(spark, ("d0", "https://a.bo/1", "t0")), as_of=as_of())
    refined = zones.refined_projection(zones.accepted(rows))
    tb.write_batch(refined, tables.refined, "h")
    tb.write_consumption_batch(zones.consumption_projection(refined.limit(0)), tables.consumption, "h")  # written, and empty
    run(spark, tables, "b", BATCH)
    assert titles(tb.read_refined(spark, tables)) == ["t0", "t2", "t4", "t5"]
    assert titles(tb.read_consumption(spark, tables)) == ["t1", "t2", "t4", "t5"]


def test_backfill_and_audit(spark, tables):
    rows = zones.normalize_rows(landing(spark, *BATCH), as_of=as_of())
    refined = zones.refined_projection(zones.accepted(rows))
    tb.write_batch(first_wins(refined, "url", ["date_saved_iso", "data_id"]), tables.refined, "h")
    zones.run_backfill(spark, tables, "fill")
    assert titles(tb.read_consumption(spark, tables)) == ["t1", "t2", "t4", "t5"]  # the batch lacks as a whole
    zones.run_backfill(spark, tables, "fill2")
    assert titles(tb.read_consumption(spark, tables)) == ["t1", "t2", "t4", "t5"]
    audit = zones.consumption_without_refined(
        tb.read_consumption(spark, tables), tb.read_refined(spark, tables).filter("url <> 'https://a.bo/2'"))
    assert titles(audit) == ["t2"]


def test_rejects_and_types(spark):
    df = spark.createDataFrame(
        [("a", "s", "t", ["Uno DOS", "Tres"], "99999999999999999999", "x", "u", None),
         ("b", "s", "T", [], "2025-04-01", " Null ", "u", "ayer")],
        "data_id string, source string, titulo string, descripcion array<string>, fecha string, seccion string, "
        "url string, date_saved string")
    rows = {r.data_id: r for r in zones.normalize_rows(df, as_of=as_of()).collect()}
    assert (rows["a"].reason, rows["a"].descripcion) == ("fecha_overflow", "Uno DOS Tres")
    assert (rows["b"].reason, rows["b"].titulo, rows["b"].seccion, rows["b"].date_saved) == (None, "t", None, None)
    assert rows["b"].descripcion is None


def test_corrupt_landing_lines_are_quarantined(spark, tables, tmp_path):
    folder = tmp_path / "landing" / "run_ts=20250401_120000"
    folder.mkdir(parents=True)
    (folder / "x.json").write_text('{"data_id": "a", "titulo": "Ñandú", "url": "u"}\n{"data_id": broken\n', "utf-8")
    rows = read_landing(spark, str(tmp_path / "landing"))
    zones.run_batch(spark, rows, tables, "b", as_of=as_of())
    assert titles(tb.read_refined(spark, tables)) == ["ñandú"]
    assert [(r.stage, r.reason) for r in tb.read_quarantine(spark, tables).collect()] == [("landing", "json_corrupto")]


def test_landing_keeps_null_keys_and_text(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_landing(landing(spark, ("d1", None, "Ñ")), path, "20250401_120000")
    files = (tmp_path / "landing" / "run_ts=20250401_120000").glob("*.json")
    text = "".join(f.read_text("utf-8") for f in files)
    assert '"titulo":"Ñ"' in text and '"url":null' in text


def test_first_wins_is_independent_of_partitioning(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", None, f"k{rng.randint(0, 40)}"]), f"{rng.randint(0, 9)}", i) for i in range(2000)]
    df = spark.createDataFrame(rows, "url string, saved string, id int")
    best = {}
    for url, saved, i in rows:
        if url is not None:
            best[url] = min(best.get(url, ("~", 0)), (saved, i))
    expected = sorted([(u, *b) for u, b in best.items()] + [(u or "", s, i) for u, s, i in rows if u is None])
    for parts in (1, 7):
        got = first_wins(df.repartition(parts), "url", ["saved", "id"]).collect()
        assert sorted((r.url or "", r.saved, r.id) for r in got) == expected


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_lookup_matches_brute_force(spark, max_bytes):
    rng = random.Random(4)
    batch = [(rng.choice([None, f"u{rng.randint(0, 60)}", "u1"]), i) for i in range(500)]
    history = [(rng.choice([None, f"u{rng.randint(0, 90)}"]),) for _ in range(60)]
    known = {u for (u,) in history if u is not None}
    b = spark.createDataFrame(batch, "url string, i int")
    h = spark.createDataFrame(history, "url string")
    assert sorted(r.i for r in new_rows(b, h, "url", max_bytes).collect()) == [i for u, i in batch if u not in known]
    assert sorted(r.i for r in known_rows(b, h, "url", max_bytes).collect()) == [i for u, i in batch if u in known]


def stream(spark, tables, checkpoint):
    start_zones(spark, tables, str(checkpoint), as_of=as_of()).awaitTermination()


def test_stream_equals_batch_and_restarts(spark, tables, tmp_path):
    rows = [r for r in BATCH if r[1] is not None]
    write_landing(landing(spark, *rows[:2]), tables.landing, "20250401_000000")
    stream(spark, tables, tmp_path / "c")
    stream(spark, tables, tmp_path / "c")
    assert titles(tb.read_refined(spark, tables)) == ["t1", "t2"]
    write_landing(landing(spark, *rows[2:]), tables.landing, "20250403_000000")
    stream(spark, tables, tmp_path / "c")
    batch = tb.ZoneTables(str(tmp_path / "batch"))
    run(spark, batch, "b", rows)
    for read in (tb.read_refined, tb.read_consumption):
        assert titles(read(spark, tables)) == titles(read(spark, batch)) == ["t1", "t2"]
    # A fresh checkpoint sees every file again: all of it is known by now.
    stream(spark, tables, tmp_path / "c2")
    assert titles(tb.read_consumption(spark, tables)) == ["t1", "t2"]


def test_pages_to_consumption(spark, tables, pages):  # noqa: F811
    rules = default_rules(spark)
    for _ in range(2):
        run_pages(spark, pages, rules, tables, "b1", as_of=as_of())
    assert titles(tb.read_consumption(spark, tables)) == ["por lugar", "t1", "t2", "tp1", "tres", "uno & dos"]
    assert tb.read_quarantine(spark, tables).filter("stage = 'extract'").count() == 3
    assert read_landing(spark, tables.landing).count() == 6


def shown(df):
    return sorted((tuple(r) for r in df.drop("fecha_procesado").collect()), key=str)


def test_outage_is_made_good_by_the_next_batch(spark, tables, tmp_path, monkeypatch):
    more = [("e1", "https://a.bo/9", "u1"), ("e2", None, "u2"), ("e3", "https://a.bo/2", "u3")]
    whole = tb.ZoneTables(str(tmp_path / "whole"))
    for zones_ in (whole, tables):
        with monkeypatch.context() as m:
            if zones_ is tables:
                m.setattr(tb, "write_consumption_batch", lambda *a: 1 / 0)
            run(spark, zones_, "a", BATCH)
        run(spark, zones_, "b", more)
    assert shown(tb.read_consumption(spark, tables, "batch_key")) == shown(tb.read_consumption(spark, whole, "batch_key"))
    assert titles(tb.read_consumption(spark, tables)) == ["t1", "t2", "t4", "t5", "u1", "u2"]
    for _ in range(2):
        zones.run_backfill(spark, tables, "fill")
    assert shown(tb.read_consumption(spark, tables)) == shown(tb.read_consumption(spark, whole))


def test_backfill_restores_a_lost_batch_with_rows_without_url(spark, tables):
    run(spark, tables, "a", BATCH)
    before = shown(tb.read_consumption(spark, tables, "batch_key"))
    tb.drop_batch(spark, tables.consumption, "a")
    zones.run_backfill(spark, tables, "fill")
    assert shown(tb.read_consumption(spark, tables, "batch_key")) == before


def test_corrupt_text_is_kept(spark, tables, tmp_path):
    path = tmp_path / "raw.jsonl"
    path.write_text('{"data_id": "1", broken\n', encoding="utf-8")
    zones.run_batch(spark, read_landing(spark, str(path)), tables, "a", as_of=as_of())
    assert [(r.reason, r._corrupt_record) for r in tb.read_quarantine(spark, tables).collect()] == [
        ("json_corrupto", '{"data_id": "1", broken')]


def test_clock_of_a_batch_is_fixed(spark, tables):
    first = spark.range(1).select(tb.batch_clock(spark, tables, "a")).first()[0]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert spark.range(1).select(tb.batch_clock(spark, tables, "a")).first()[0] == first
        assert spark.range(1).select(tb.batch_clock(spark, tables, "b")).first()[0] > first
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_pages_of_no_use_are_quarantined(spark, tables):
    rows = [("eldeber", "pais", 1, "https://eldeber.com.bo/a", 404, "x"), ("eldeber", "pais", 2, "https://e.example/a", 200, "x"),
            ("otro", "pais", 3, "https://eldeber.com.bo/b", 200, "x"), (None, "pais", 4, "https://eldeber.com.bo/c", 200, "x"),
            ("eldeber", "pais", 5, "https://eldeber.com.bo/d", None, "x"), ("eldeber", "pais", 6, None, 200, "x")]
    pages_ = spark.createDataFrame([(*r, None) for r in rows], schemas.PAGES)
    run_pages(spark, pages_, default_rules(spark), tables, "a")
    got = tb.read_quarantine(spark, tables).filter("stage = 'pages'").collect()
    assert sorted(r.reason for r in got) == ["dominio_ajeno"] * 2 + ["estado_http"] * 2 + ["fuente_desconocida"] * 2


def test_months_make_few_files(spark, tables):
    rows = spark.range(3000, numPartitions=16).selectExpr(
        "concat('d', id) data_id", "'eldeber' source", "'t' titulo", "'x' descripcion",
        "concat('2025-', lpad(id % 12 + 1, 2, '0'), '-03') fecha", "'s' seccion", "concat('https://a.bo/', id) url", "'' date_saved")
    zones.run_batch(spark, rows, tables, "a", as_of=as_of())
    files = [f for f in Path(tables.consumption).rglob("part-*.parquet")]
    assert tb.read_consumption(spark, tables).count() == 3000 and len(files) <= 24


def bounded(spark, tmp_path, delay="1 hour"):
    start_bounded(spark, str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "c"), as_of=as_of(),
                  delay=delay).awaitTermination()
    return sorted(r.data_id for r in spark.read.parquet(str(tmp_path / "out")).select("data_id").collect())


def test_bounded_state_forgets(spark, tmp_path):
    """Known within the delay, new after it, dropped beyond it; rows without URL or time pass, and a restart goes on."""
    def land(run, *rows):
        data = [(d, "s", "t", "x", "2025-04-01", "p", u, at) for d, u, at in rows]
        write_landing(spark.createDataFrame(data, schemas.LANDING).coalesce(1), str(tmp_path / "landing"), run)

    day = "2025-04-01T"
    land("1", ("a1", "u1", day + "10:00:00"), ("n1", None, day + "10:00:00"), ("n2", None, day + "10:00:00"), ("x1", "u1", "ayer"))
    assert bounded(spark, tmp_path) == ["a1", "n1", "n2", "x1"]
    land("2", ("a2", "U1 ", day + "10:30:00"), ("b2", "u2", day + "12:00:00"), ("n3", None, day + "01:00:00"))
    assert bounded(spark, tmp_path) == ["a1", "b2", "n1", "n2", "n3", "x1"]  # u1 is known
    land("3", ("a3", "u3", day + "09:00:00"), ("b3", "u2", day + "12:10:00"), ("c3", "u1", day + "12:20:00"))
    assert bounded(spark, tmp_path) == ["a1", "b2", "c3", "n1", "n2", "n3", "x1"]  # a3 is too late, u1 is forgotten


def test_progress_and_archive(spark, tables, tmp_path):
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")
    try:
        for run_, rows in (("r1", BATCH[:2]), ("r2", BATCH[2:])):
            write_landing(landing(spark, *rows), tables.landing, run_)
            q = start_zones(spark, tables, str(tmp_path / "c"), as_of=as_of(), archive=str(tmp_path / "old"))
            q.awaitTermination()
            seen = [p.observedMetrics["landing"] for p in q.recentProgress if p.numInputRows]
            assert [(s.rows, s.corrupt) for s in seen] == [(len(rows), 0)]
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.cleaner.numThreads")
    assert {p.parent.name for p in Path(tables.landing).rglob("part-*.json")} == {"run_ts=r2"}
    old = read_landing(spark, archived_landing(str(tmp_path / "old"), tables.landing))
    replayed = tb.ZoneTables(str(tmp_path / "replayed"))
    zones.run_batch(spark, old, replayed, "again", as_of=as_of())
    assert titles(tb.read_refined(spark, replayed)) == ["t1", "t2"]


def test_page_counts_equal_the_queries(spark, tables, pages):  # noqa: F811
    rules = default_rules(spark)
    got = run_pages(spark, pages, rules, tables, "b1", as_of=as_of())
    usable = pages.filter("status = 200 AND source <> 'otro'")
    blocks = extract_blocks(usable, rules)
    want = {r.reason: r.n for r in zones.quarantine_counts(rejected_blocks(blocks)).collect()}
    articles = articles_per_page(usable, rules).agg(F.sum("n_articles")).first()[0]
    assert (got.articles, got.rejected) == (articles, want) and got.batch.rows == articles
