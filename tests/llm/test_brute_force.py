"""Operators against plain versions, on odd rows and on the smallest tables."""

import tracemalloc

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newszones.llm import decontaminate, exact_dedup, jaccard, suffix_dedup, token_files
from newszones.llm.queries import QUERIES
from newszones.llm.shared_tokens import shared_tokens

SF = "/root/testdata/sf0.001"


def collected(df, *columns):
    return brute.bag(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="session")
def table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("cut", [0, 9, 25, 99])
def test_exact_dedup(docs, rows, cut):
    """Wherever the history ends."""
    got = exact_dedup.dedup(docs, F.col("key") <= cut)
    got = got.select("key", "keep", "rows", F.col("key").eqNullSafe(F.col("keep")), F.lower(F.hex("digest")))
    assert collected(got, "*") == brute.bag(brute.exact_dedup(rows))


def test_exact_dedup_history_tells_strangers(docs):
    found = exact_dedup.digests(docs)
    history = exact_dedup.History.build(exact_dedup.winners(found.filter("key < 8")), segment_keys=2)
    assert history.n_segments > 1
    known = {bytes(r[0]) for r in found.filter("key < 8").select("digest").collect()}
    asked = exact_dedup.winners(found)
    assert {bytes(r[0]) for r in history.lookup(asked).select("digest").collect()} == known


def test_jaccard_odd_rows(docs, rows):
    got = jaccard.near_duplicates(docs)
    assert collected(got, "key", "n", "component") == brute.bag(brute.jaccard(rows))


@pytest.mark.parametrize("frequent,pair_tokens", [(2, 10_000), (2, 4), (1000, 256)])
def test_jaccard_key_kinds(docs, rows, monkeypatch, frequent, pair_tokens):
    """Single tokens, pairs, and both kinds at the line between them find the same classes."""
    monkeypatch.setattr(jaccard, "PAIR_TOKENS", pair_tokens)
    monkeypatch.setattr(jaccard.keys_of, "__defaults__", (frequent,))
    assert collected(jaccard.near_duplicates(docs), "key", "n", "component") == brute.bag(brute.jaccard(rows))


@pytest.mark.parametrize("bucket_tokens", [7, 1 << 20])
def test_jaccard_counted_tokens(spark, bucket_tokens):
    """Each block gets the number of sets that have its tokens, packed, from few or many buckets."""
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 64, 40, np.uint64)
    own = {node: np.unique(rng.choice(pool, 12)) for node in range(30)}
    sets = spark.createDataFrame([(node // 8, node, len(t), t.tobytes()) for node, t in own.items()],
                                 "block long, node long, n long, tokens binary")
    got = jaccard.counted_tokens(sets, bucket_tokens).orderBy("block", "bucket").collect()
    assert len({(r.block, r.bucket) for r in got}) == len(got) and (bucket_tokens > 7 or len(got) > 8)
    every = np.concatenate(list(own.values()))
    for block in range(4):
        tokens = np.unique(np.concatenate([t for node, t in own.items() if node // 8 == block]))
        counts = np.concatenate([np.frombuffer(r.counts, "<u4") for r in got if r.block == block])
        assert counts.tolist() == [int((every == x).sum()) for x in tokens]


class Steps:
    """Stands for a frame: keeps the functions that it is asked to run."""

    def __init__(self):
        self.run = []

    def mapInArrow(self, function, schema):
        self.run.append(function)
        return self

    def __getattr__(self, name):
        return lambda *a, **b: self


def test_shared_tokens_bucket_in_bounded_memory(spark):
    """A large bucket is counted rightly, and a worker needs little besides the bucket itself."""
    n_docs, size = 64, 1 << 15
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, n_docs * size // 2, np.uint64)  # a share of 1/2
    sets = {k: np.unique(rng.choice(pool, size)) for k in range(n_docs)}
    steps = Steps()
    shared_tokens(steps, lambda raw, key: [(key, sets[key])], 1, 0.5)
    deal, meet = steps.run
    docs = [*range(n_docs), 0]  # a set that comes twice counts as one owner
    rows = pa.RecordBatch.from_arrays([pa.array(docs), pa.array([b""] * len(docs))], names=["key", "raw"])
    dealt = list(deal(iter([rows])))
    assert sum(len(x) for b in dealt for x in b.column(3).to_pylist()) > 4 * 1.6e6

    tracemalloc.start()
    got = {}
    for batch in meet(iter(dealt)):
        for who, n in zip(*(c.to_pylist() for c in batch.columns)):
            got[who] = got.get(who, 0) + n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    every, times = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    for k, own in sets.items():
        there = int((times[np.searchsorted(every, own)] > 1).sum())
        assert there * (1 + (k == 0)) <= got[k] <= there * (1 + (k == 0)) + 60  # 32 bits are compared
    assert peak < 40e6, peak


@pytest.mark.parametrize("n_buckets,slice_tokens,held", [(1, 1, 1), (5, 3, 2), (8, 1 << 18, 1 << 18)])
def test_shared_tokens_counts(spark, monkeypatch, n_buckets, slice_tokens, held):
    """However many buckets and slices there are and however often counts are sent on, the sums are the same."""
    monkeypatch.setattr("newszones.llm.shared_tokens.BLOCK_TOKENS", 40)
    monkeypatch.setattr("newszones.llm.shared_tokens.SLICE_TOKENS", slice_tokens)
    monkeypatch.setattr("newszones.llm.shared_tokens.HELD_OWNERS", held)
    rng = np.random.default_rng(4)
    pool = np.append(rng.integers(0, 1 << 64, 60, np.uint64), np.array([0, 1 << 63, (1 << 64) - 1], np.uint64))
    sets = {k - 15: np.unique(rng.choice(pool, k % 7)) for k in range(30)}
    steps = Steps()
    shared_tokens(steps, lambda raw, key: [(key, sets[key])], n_buckets)
    deal, meet = steps.run
    rows = pa.RecordBatch.from_arrays([pa.array(sets), pa.array([b""] * len(sets))], names=["key", "raw"])
    dealt = sorted((r for b in deal(iter([rows])) for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
    kinds = {"bucket": pa.int32(), "known": pa.bool_(), "who": pa.binary(), "low": pa.binary()}
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*dealt[at:at + 3]), kinds.values())], names=list(kinds))
               for at in range(0, len(dealt), 3)]
    got = {}
    for batch in meet(iter(batches)):
        for who, n in zip(*(c.to_pylist() for c in batch.columns)):
            got[who] = got.get(who, 0) + n
    expected = {k: sum(any(x in o for j, o in sets.items() if j != k) for x in own) for k, own in sets.items()}
    assert got == {k: n for k, n in expected.items() if n}
    assert list(meet(iter([]))) == []


def test_jaccard_rows_without_partner_stay(spark, monkeypatch):
    """Texts that are not in the join after the first count are left out before they move."""
    rows = spark.range(20000).select("id", F.lit("text").alias("text"))
    keys = spark.range(0, 20000, 50).select(F.col("id").alias("k"))
    got = {r.id for r in jaccard._likely(rows, "id", keys).collect()}
    assert got >= set(range(0, 20000, 50)) and len(got) < 3000
    assert jaccard._likely(rows, "id", keys.limit(0)).count() == 0
    monkeypatch.setattr(jaccard, "MOST_BITS", 1 << 15)  # a full map loses nothing
    assert {r.id for r in jaccard._likely(rows, "id", rows.select("id")).collect()} == set(range(20000))


def test_jaccard_table(spark, table):
    assert collected(QUERIES["op7_jaccard_join"](spark, SF), "doc_id", "n_shingles", "component_id") == brute.bag(brute.jaccard(table))


def test_suffix_dedup_odd_rows(docs, rows):
    got = suffix_dedup.remove_repeats(docs)
    got = got.select("key", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert collected(got, "*") == brute.bag(brute.suffix_dedup(rows))


def test_suffix_dedup_table(spark, table):
    got = QUERIES["op5_suffix_dedup"](spark, SF)
    assert collected(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.bag(brute.suffix_dedup(table))


def test_suffix_dedup_left_borders(spark):
    """Passages of little over 50 bytes that start at any distance from the cuts, also where cuts lie close together."""
    rng = np.random.default_rng(5)
    random_text = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    first, rows = random_text(200_000), []
    rows.append((1, first))
    for i in range(2, 22):
        parts = []
        for at, n, gap in zip(rng.integers(0, 199_900, 250), rng.integers(50, 90, 250), rng.integers(20, 60, 250)):
            parts += [random_text(gap), first[at:at + n]]
        rows.append((i, "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(docs).select("key", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert collected(got, "*") == brute.bag(brute.suffix_dedup(rows))


@pytest.mark.parametrize("part", [64, 1000, 1 << 16])
@pytest.mark.parametrize("kinds", [1, 2, 26])
def test_suffix_dedup_stretches(monkeypatch, part, kinds):
    """Every string of a text lies in exactly one stretch, and equal strings in stretches of one mark."""
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", part)
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 97 + kinds, n, np.uint8)) for n in (0, 49, 50, 51, 3000, 7, 400)]
    texts += [texts[4][1000:1300], b"ab" * 200]
    whole, sizes = b"".join(texts), np.array([len(t) for t in texts])
    found, marks = [], {}
    for at, n, mark in zip(*(x.tolist() for x in suffix_dedup.stretches(whole, sizes))):
        assert suffix_dedup.SPAN <= n <= suffix_dedup.WIDTH
        for i in range(at, at + n - suffix_dedup.SPAN + 1):
            found.append(i)
            marks.setdefault(whole[i:i + suffix_dedup.SPAN], set()).add(mark)
    begins = np.cumsum(sizes) - sizes
    assert found == [b + i for b, n in zip(begins.tolist(), sizes.tolist()) for i in range(n - suffix_dedup.SPAN + 1)]
    assert all(len(x) == 1 for x in marks.values())


@pytest.mark.parametrize("kinds", [1, 2, 4, 200])
def test_suffix_order(kinds):
    rng = np.random.default_rng(kinds)
    for n in [*range(40), 500, 4000]:
        x = rng.integers(1, kinds + 1, n)
        want = sorted(range(n), key=lambda i: x[i:].tolist())
        assert suffix_dedup.suffix_order(x, 1, 1 << 40).tolist() == want
        near = suffix_dedup.suffix_order(x).tolist()
        cut = lambda order: [x[i:i + suffix_dedup.SPAN].tolist() for i in order]
        assert sorted(near) == list(range(n)) and cut(near) == cut(want)


@pytest.mark.parametrize("lot", [100, 1 << 16])
@pytest.mark.parametrize("hot", [1, 5])
def test_suffix_dedup_hot_marks(spark, monkeypatch, hot, lot):
    """One passage between texts that all differ: its outer strings are dealt one by one."""
    rng = np.random.default_rng(9)
    text = lambda n: bytes(rng.integers(97, 123, n, np.uint8)).decode()
    passage = text(120)
    rows = [(i, text(60) + passage[i % 7:] + text(60) + passage[:90]) for i in range(60)]
    rows += [(None, passage), (60, passage * 3), (61, "")]
    monkeypatch.setattr(suffix_dedup, "LOT_BYTES", lot)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 2000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = suffix_dedup.remove_repeats(docs, hot=hot).select("key", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert collected(got, "*") == brute.bag(brute.suffix_dedup(rows))


def test_decontaminate(spark, docs, rows):
    items = [(1, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 W12 w13"), (2, "one, TWO!"), (3, None), (4, ""), (5, "漢字漢字"),
             (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"), (6, "one two"), (10, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_hits(docs, bench)
    assert got.columns == [*docs.columns, "hit_"]
    shown = got.select("doc_id", "hit_.n_words", "hit_.n_hit", F.size("hit_.items"), F.sha2(F.array_join("hit_.items", ","), 256),
                       decontaminate.contaminated())
    assert collected(shown, "*") == brute.bag(brute.decontaminate(rows, items))
    spans = got.filter("doc_id = 6").select("hit_.spans").first()[0]
    assert [(s.start, s.end) for s in spans] == [(0, 8)]


def test_decontaminate_table(spark, table):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op10_decontaminate"](spark, SF)
    assert collected(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute.bag(
        brute.decontaminate(table, items))


@pytest.mark.parametrize("max_nodes", [1, 60, 400])
def test_benchmark_in_lots(spark, table, max_nodes):
    """A benchmark beyond the bound of one automaton, long items included, gives the same result."""
    own = [t for _, t in table if t][:40]
    items = [(f"i{i}", " ".join(t.split()[3:3 + n])) for i, (t, n) in enumerate(zip(own, [5, 13, 14, 40, 90] * 3))]
    items += [("none", None), ("short", "the")]
    rows = table[:60] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    given = spark.createDataFrame(items, "item_id string, text string")
    want = decontaminate.find_hits(docs, given)
    assert len(list(decontaminate.lots(((i, (t or "").encode()) for i, t in items), 13, max_nodes))) > 1
    got = decontaminate.find_hits(docs, given, max_nodes=max_nodes) if max_nodes > 1 else None
    if got is None:  # one window a lot: only the cutting
        parts = [x for lot in decontaminate.lots(((i, (t or "").encode()) for i, t in items), 13, 1) for x in lot]
        assert all(len(t.split()) <= 13 for _, t in parts)
        return
    assert got.filter("hit_.n_hit > 0").count() > 5
    assert brute.bag(map(str, got.collect())) == brute.bag(map(str, want.collect()))


def test_token_files(spark, docs, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    want = brute.token_files(rows, tokenizer)
    assert collected(token_files.encode_and_read(docs, path), "doc_id", "start", "n_tokens", "ids_crc32") == brute.bag(want)
    files = token_files.write(docs, path, shard_ids=100)
    assert files.spark.read.parquet(f"{files.path}/files").count() > 3
    for key, nth in ((20, 0), (7, 1), (2, 0)):
        text = [t for i, t in rows if i == key][nth] or ""
        assert files.ids(key, nth).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert files.ids(12345) is None and files.ids(7, 2) is None
    assert collected(files.records, "key", "first", "n_tokens") == brute.bag((i, s, n) for i, s, n, _ in want)


def test_token_files_null_keys(spark):
    docs = spark.createDataFrame([(None, "b"), (None, "a"), (3, None), (1, "c")], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    got = token_files.encode_and_read(docs, path)
    want = brute.token_files([tuple(r) for r in docs.collect()], Tokenizer.from_file(path))
    assert collected(got, "doc_id", "start", "n_tokens", "ids_crc32") == brute.bag(want)


def test_token_files_table(spark, table):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = QUERIES["op3_token_files"](spark, SF)
    assert collected(got, "doc_id", "start", "n_tokens", "ids_crc32") == brute.bag(brute.token_files(table, tokenizer))


def test_other_vocabulary(spark, docs, rows):
    """One that keeps white space: whole texts, 16 bits."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = brute.token_files(rows, Tokenizer.from_file(path), end=50256)
    files = token_files.write(docs, path, end_id=50256)
    assert collected(files.records, "key", "first", "n_tokens") == brute.bag((i, s, n) for i, s, n, _ in want)


def test_null_keys(spark):
    docs = spark.createDataFrame([(None, "x" * 60), (1, "x" * 60), (None, "q w e r t"), (2, "q w e r t")], "doc_id long, text string")
    rows = [tuple(r) for r in docs.collect()]
    got = suffix_dedup.remove_repeats(docs).select("key", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert collected(got, "*") == brute.bag(brute.suffix_dedup(rows))
    assert collected(jaccard.near_duplicates(docs), "key", "component") == brute.bag([(None, 1), (1, 1), (None, 2), (2, 2)])
    kept = exact_dedup.dedup(docs, F.col("key") <= 1)
    assert collected(kept, "key", "keep", "rows") == brute.bag([(None, 1, 2), (1, 1, 2), (None, 2, 2), (2, 2, 2)])


def test_suffix_dedup_rows_of_one_key(spark):
    """Rows without key, or with one key, of equal length and different texts: each loses its own runs only."""
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [(1, words), (None, words[:60] + "A" * 40), (None, "B" * 40 + words[-60:]), (None, "".join(map(chr, range(200, 250)))),
            (5, "C" * 20 + words[5:75] + "D" * 10), (5, "".join(map(chr, range(33, 122))) + "E" * 11), (5, "F" * 100), (5, "F" * 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs).select("key", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert collected(got, "*") == brute.bag(brute.suffix_dedup(rows))


def test_empty_tables(nothing):
    assert exact_dedup.dedup(nothing, F.col("key") <= 1).count() == 0
    assert jaccard.near_duplicates(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    assert token_files.encode_and_read(nothing, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    bench = nothing.select(F.col("doc_id").alias("item_id"), "text")
    assert decontaminate.find_hits(nothing, bench).count() == 0
