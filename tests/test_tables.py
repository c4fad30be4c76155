"""The ledger, key folders, compaction and concurrent writers."""

import threading
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newszones import schemas
from newszones.plans import zones
from newszones.sources import ledger, storage
from newszones.sources import tables as tb
from newszones.sources.ledger import Batches, State

from test_zones import as_of, landing, run, shown, titles


@pytest.fixture
def tables(tmp_path):
    return tb.ZoneTables(str(tmp_path / "zones"))


def refined(spark, *urls, batch="b"):
    return spark.createDataFrame([(f"{batch}{k}", f"{batch}{k}", None, None, None, u, None) for k, u in enumerate(urls)],
                                 schemas.REFINED)


def test_batches_of_a_stream_are_one_number():
    b = Batches()
    for n in (0, 1, 2, 5):
        b = b.add(f"q-{n:012d}")
    b = b.add("manual")
    assert b.marks == (("q", 5),) and b.holes == {"q-000000000003", "q-000000000004"}
    assert "q-000000000002" in b and "q-000000000003" not in b and "q-000000000006" not in b and "other" not in b
    assert b.missing_from(Batches().add("q-000000000000")) == ["manual", "q-000000000001", "q-000000000002", "q-000000000005"]
    b = b.add("q-000000000003").remove("q-000000000001").remove("manual")
    assert b.holes == {"q-000000000004", "q-000000000001"} and "manual" not in b
    assert Batches().missing_from(b) == []
    state = State(3, 64, (), b, ("x",), (("n", 1.5),))
    assert State.from_json(state.to_json()) == state


def test_one_writer_makes_a_version(spark, tmp_path):
    path = str(tmp_path / "t" / "_ledger" / "1.json")
    (tmp_path / "t" / "_ledger").mkdir(parents=True)
    made = [storage.create_once(spark, path, str(k)) for k in range(3)]
    assert made == [True, False, False] and storage.read_text(spark, path) == "0"
    assert [p.name for p in (tmp_path / "t" / "_ledger").iterdir() if p.suffix == ".json"] == ["1.json"]


def test_commit_starts_again_after_another_writer(spark, tmp_path):
    table, seen = str(tmp_path / "t"), []

    def change(now):
        seen.append(now.version)
        if len(seen) == 1:  # somebody else commits in between
            ledger.commit(spark, table, lambda s: State(buckets=7, open=("other",)))
        return State(buckets=now.buckets + 1, open=(*now.open, "mine"))

    state = ledger.commit(spark, table, change)
    assert seen == [0, 1] and (state.version, state.buckets, state.open) == (2, 8, ("other", "mine"))


def test_old_versions_go_and_a_late_writer_does_not_take_their_numbers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "KEEP", 3)
    table = str(tmp_path / "t")
    stale = ledger.commit(spark, table, lambda s: State())
    for _ in range(8):
        ledger.commit(spark, table, lambda s: State(open=(*s.open, "x")))
    assert len([p for p in (tmp_path / "t" / "_ledger").iterdir() if p.suffix == ".json"]) == 3
    state = ledger.commit(spark, table, lambda s: State(open=(*s.open, "late")), stale)
    assert state.version == 10 and state.open == ("x",) * 8 + ("late",)


def inputs_of(df):
    return sorted(f.partition("/keys/")[2].rpartition("/")[0] for f in df.inputFiles())


def test_small_batch_opens_its_own_key_folders_only(spark, tables, monkeypatch):
    monkeypatch.setattr(tb, "SMALL_KEYS", 10)
    many = spark.range(2000).selectExpr(
        "concat('d', id) data_id", "'t' titulo", "'' descripcion", "'' fecha", "'' seccion", "concat('u', id) url", "'' date_saved_iso")
    big = tb.write_batch(many, tables.refined, "big")
    small = tb.write_batch(refined(spark, "v1", "v2", None), tables.refined, "small")
    assert len(big.buckets) == tb.BUCKETS and small.buckets == (tb.MIXED,)
    state = ledger.read(spark, tables.refined)
    asked = refined(spark, "u7", "new", "v2", None)
    own = {r[0] for r in asked.filter("url IS NOT NULL").select(tb.bucket_of(F.col("url"), tb.BUCKETS)).collect()}
    known = tb.known_keys(spark, tables.refined, state, asked)
    assert set(inputs_of(known)) == {f"chunk={big.name}/bucket={b}" for b in own} | {f"chunk={small.name}/bucket=-1"}
    assert {r.url for r in known.collect()} >= {"u7", "v2"} and not {r.url for r in known.collect()} & {"new"}
    # A batch with keys in every folder reads the whole table, a replay not its own chunk.
    assert len(set(inputs_of(tb.known_keys(spark, tables.refined, state, many)))) == tb.BUCKETS + 1
    assert inputs_of(tb.known_keys(spark, tables.refined, state, asked, "big")) == [f"chunk={small.name}/bucket=-1"]
    text = known._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<url:string>" in text


def test_compaction_keeps_rows_and_keys(spark, tables, monkeypatch):
    monkeypatch.setattr(tb, "SMALL_KEYS", 6)
    for k in range(14):
        tb.write_batch(refined(spark, f"u{k}", f"w{k}", None, batch=f"b{k:02d}-"), tables.refined, f"b{k:02d}")
        tb.compact(spark, tables.refined, schemas.REFINED, fan=3)
    state = ledger.read(spark, tables.refined)
    assert len(state.chunks) <= 2 * 3 and max(c.tier for c in state.chunks) == 2
    rows = tb.read_refined(spark, tables, "batch_key").collect()
    assert Counter(r.batch_key for r in rows) == {f"b{k:02d}": 3 for k in range(14)}
    assert {r.data_id for r in rows} == {f"b{k:02d}-{j}" for k in range(14) for j in range(3)}
    keys = Counter(r.url for r in tb.known_keys(spark, tables.refined, state).collect())
    assert keys == Counter([f"u{k}" for k in range(14)] + [f"w{k}" for k in range(14)])
    asked = refined(spark, "u3", "nothing")
    assert "u3" in {r.url for r in tb.known_keys(spark, tables.refined, state, asked).collect()}
    # A replay of a merged batch adds nothing, one of a batch with a chunk of its own replaces it.
    assert tb.write_batch(refined(spark, "other"), tables.refined, "b00") is None
    own = next(c for c in state.chunks if c.batch)
    tb.write_batch(refined(spark, "z1", batch="z"), tables.refined, own.batch)
    again = tb.read_refined(spark, tables, "batch_key").collect()
    assert [r.url for r in again if r.batch_key == own.batch] == ["z1"] and len(again) == len(rows) - 2
    # Readers that began earlier still find their files; they go when nobody can need them.
    assert len(list(Path(tables.refined, "rows").iterdir())) > len(state.chunks)
    tb.vacuum(spark, tables.refined, retention=0)
    assert len(list(Path(tables.refined, "rows").iterdir())) == len(ledger.read(spark, tables.refined).chunks)
    assert ledger.read(spark, tables.refined).dropped == ()


def test_compaction_gives_way_to_a_replay(spark, tables, monkeypatch):
    for k in range(3):
        tb.write_batch(refined(spark, f"u{k}", batch=f"b{k}"), tables.refined, f"b{k}")
    write = tb._write_keys

    def replay_meanwhile(*args):
        monkeypatch.setattr(tb, "_write_keys", write)
        tb.write_batch(refined(spark, "u9", batch="n"), tables.refined, "b1")
        return write(*args)

    monkeypatch.setattr(tb, "_write_keys", replay_meanwhile)
    tb.compact(spark, tables.refined, schemas.REFINED, fan=3)
    assert {r.url for r in tb.read_refined(spark, tables).collect()} == {"u0", "u9", "u2"}
    keys = [r.url for r in tb.known_keys(spark, tables.refined, ledger.read(spark, tables.refined)).collect()]
    assert sorted(keys) == ["u0", "u2", "u9"]


def test_batches_after_compaction_see_the_history(spark, tables, monkeypatch):
    monkeypatch.setattr(tb, "FAN", 2)
    monkeypatch.setattr(tb.compact, "__defaults__", (2, tb.RETENTION))
    for k in range(4):
        run(spark, tables, f"q-{k:012d}", [("d1", "https://a.bo/1", "t1"), (f"e{k}", f"https://a.bo/n{k}", f"n{k}")])
    assert titles(tb.read_refined(spark, tables)) == titles(tb.read_consumption(spark, tables)) == ["n0", "n1", "n2", "n3", "t1"]
    assert len(ledger.read(spark, tables.consumption).chunks) <= 2
    before = shown(tb.read_consumption(spark, tables, "batch_key"))
    counts = zones.run_batch(spark, landing(spark, ("x", "https://a.bo/new", "x")), tables, "q-000000000001", as_of=as_of())
    assert counts.refined is None and counts.consumption is None
    assert shown(tb.read_consumption(spark, tables, "batch_key")) == before


def test_work_on_the_file_system_does_not_grow(spark, tables, monkeypatch):
    """What a batch lists, asks for and removes, after few and after many batches."""
    monkeypatch.setattr(ledger, "KEEP", 4)
    monkeypatch.setattr(tb.compact, "__defaults__", (3, 0))
    calls = Counter()
    real = storage._hadoop_path

    def counted(spark_, path):
        calls["all"] += 1
        return real(spark_, path)

    monkeypatch.setattr(storage, "_hadoop_path", counted)
    per_batch = []
    for k in range(22):
        calls.clear()
        tb.write_batch(refined(spark, f"u{k}", batch=f"b{k}"), tables.refined, f"q-{k:012d}",
                       ledger.read(spark, tables.refined))
        per_batch.append(calls["all"])
        tb.compact(spark, tables.refined, schemas.REFINED)
    assert max(per_batch[12:]) <= max(per_batch[4:10])
    state = ledger.read(spark, tables.refined)
    assert len(state.chunks) <= 6 and len(state.to_json()) < 2000
    assert len(list(Path(tables.refined, "_ledger").glob("*.json"))) == 4


def test_unique_url_when_another_writer_commits_first(spark, tables, monkeypatch):
    """Between a batch's lookup and its commit another batch stores one of its URLs."""
    add = tb._add_chunk

    def other_first(df, path, batch_key, *rest):
        chunk = add(df, path, batch_key, *rest)
        if batch_key == "a" and path == tables.refined:
            monkeypatch.setattr(tb, "_add_chunk", add)
            run(spark, tables, "b", [("b1", "https://a.bo/1", "theirs"), ("b2", "https://a.bo/3", "t3")])
        return chunk

    monkeypatch.setattr(tb, "_add_chunk", other_first)
    run(spark, tables, "a", [("a1", "https://a.bo/1", "mine"), ("a2", "https://a.bo/2", "t2"), ("a3", None, "none")])
    for read in (tb.read_refined, tb.read_consumption):
        assert titles(read(spark, tables)) == ["none", "t2", "t3", "theirs"]
    for path in (tables.refined, tables.consumption):
        keys = [r.url for r in tb.known_keys(spark, path, ledger.read(spark, path)).collect()]
        assert sorted(keys) == ["https://a.bo/1", "https://a.bo/2", "https://a.bo/3"]


def test_two_writers_at_once(spark, tables):
    rows = [[(f"{w}{k}", f"https://a.bo/{k}", f"t{k}") for k in range(5)] + [(f"{w}x", f"https://a.bo/{w}", w)] for w in "ab"]
    threads = [threading.Thread(target=run, args=(spark, tables, w, r)) for w, r in zip("ab", rows)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for read in (tb.read_refined, tb.read_consumption):
        urls = Counter(r.url for r in read(spark, tables).collect())
        assert urls == {f"https://a.bo/{x}": 1 for x in [*range(5), "a", "b"]}
    assert {"a", "b"} <= ledger.read(spark, tables.consumption).batches.names


def test_a_lasting_fault_is_recorded_and_raised(spark, tables, monkeypatch):
    monkeypatch.setattr(tb, "write_consumption_batch", lambda *a: 1 / 0)
    run(spark, tables, "a", [("a1", "https://a.bo/1", "t1")], max_open=2)
    with pytest.raises(ZeroDivisionError):
        run(spark, tables, "b", [("b1", "https://a.bo/2", "t2")], max_open=2)
    assert titles(tb.read_refined(spark, tables)) == ["t1", "t2"]
    got = [(r.failed_batch, r.table, r.error) for r in tb.read_failures(spark, tables).collect()]
    assert sorted(got) == [(b, "consumption", "ZeroDivisionError: division by zero") for b in "ab"]


def test_counts_come_out_of_the_writes(spark, tables):
    run(spark, tables, "h", [("d0", "https://a.bo/1", "t0")])
    rows = [("d1", "https://A.bo/1", "t1"), ("d2", "https://a.bo/2", "t2"), ("d3", "HTTPS://A.BO/2 ", "t3"),
            ("d4", None, "t4"), ("d6", "https://a.bo/3", " ")]
    got = zones.run_batch(spark, landing(spark, *rows), tables, "b", as_of=as_of())
    assert got == zones.BatchCounts(5, {"titulo_vacio": 1}, 3, 2, 1, 2, [])
    quarantine = zones.quarantine_counts(tb.read_quarantine(spark, tables)).collect()
    assert [(r.reason, r.n) for r in quarantine] == [("titulo_vacio", 1)]
    assert zones.run_batch(spark, landing(spark).limit(0), tables, "e", as_of=as_of()).rows == 0
