"""Merkle manifest, fertility rules and source audit against plain versions, on odd tables and on whole small ones."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import brute
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from newszones.llm import fertility, manifest, source_audit

SF = "/root/testdata/sf0.001"


def odd_table(rows):
    """``doc_id, text, lang, source, n_chars`` with nulls in every column, repeated rows and keys, and hot groups."""
    langs, sources = [None, "", "en", "en", "en", "é"], [None, "", "hot", "hot", "s1", "s2", "s3"]
    out = []
    for k, (i, t) in enumerate(rows * 3):
        out.append((None if k % 11 == 5 else i + (1 << 60) * (k % 2), t, langs[k % 6], sources[k % 7],
                    None if k % 5 == 0 else len(t or "")))
    return out + out[:4] + [(1, "x y z " * 30, "only", "s9", 3), (2, "x y z " * 30, "only", "s8", 3)]


@pytest.fixture(scope="module")
def odd(spark, rows):
    data = odd_table(rows)
    extra = [(*r, 1, b"x", "a", 2.0) for r in data]
    return data, spark.createDataFrame(
        extra, "doc_id long, text string, lang string, source string, n_chars long, pos int, digest binary, places string, "
               "`a.b` double").repartition(5)


def table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()], df


# Merkle manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[k:k + 2])) for k in range(0, len(low), 2)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((level[at ^ 1] if at ^ 1 < len(level) else None, at & 1))
        at >>= 1
    return out


def merkle(rows):
    def leaf(i, t, g, s, n):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, g, n, t)))

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(((r[0] is not None, r[0] or 0), leaf(*r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[1] for x in sorted(groups[g], key=lambda x: x[:2])]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (_, own, (i, t, _, s, n)) in enumerate(sorted(groups[g], key=lambda x: x[:2])):
            path = siblings(trees[g], at) + siblings(top, k)
            bad = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
            folded = leaf(i, t, g, s, n + 1) if bad else own
            for other, right in path:
                folded = sha((other + folded) if right else folded + (other or ""))
            proof = sha("".join(x or "" for x, _ in path))
            out.append((i, own, trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("bits,salt", [(10, 512), (2, 3)])
def test_manifest_odd_rows(odd, monkeypatch, bits, salt):
    """Also with blocks and copies so small that the climb has many steps."""
    monkeypatch.setattr(manifest, "BITS", bits)
    monkeypatch.setattr(manifest, "SALT_ROWS", salt)
    got = manifest.manifest(odd[1]).select(*MANIFEST).collect()
    want = merkle(odd[0])
    assert brute.bag(map(tuple, got)) == brute.bag(want)
    assert {r[-1] for r in want} == {True, False}


def test_manifest_of_many_langs(spark):
    rows = [(k, "t", f"l{k % 37}", "s", 1) for k in range(150)] + [(None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert brute.bag(tuple(r) for r in manifest.manifest(df).select(*MANIFEST).collect()) == brute.bag(merkle(rows))


def test_manifest_of_one_row_and_of_none(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    one = spark.createDataFrame([(5, "t", "l", "s", None)], schema)
    assert [tuple(r) for r in manifest.manifest(one).select(*MANIFEST).collect()] == merkle([(5, "t", "l", "s", None)])
    none = manifest.manifest(one.limit(0))
    assert none.collect() == [] and dict(none.dtypes)["root"] == "string"


# Fertility

def numbers(t):
    words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    hit = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    again = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), again, len(hit), words


def quartile(values, share):
    return sorted(values)[math.ceil(share * len(values)) - 1]


def fertile(rows, min_texts):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(fertility.MODEL))
    found, cells = [], defaultdict(list)
    for i, t, lang, *_ in rows:
        *base, words = numbers(t)
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        own = None
        if base[0] >= 50:
            ids = model.encode(" ".join(words))
            n = len(ids)
            entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
            own = (1000 * base[1] // n, 1000 * sum(map(model.is_byte, ids)) // n, int(1000 * entropy + 0.5))
            if not failed:
                cells[lang, n.bit_length()].append(own)
        found.append((i, base, failed, own, (lang, own and n.bit_length())))
    out = []
    for i, base, failed, own, cell in found:
        kept = not failed
        if kept and len(cells[cell]) >= min_texts:
            for k, slack in enumerate(fertility.SLACK.values()):
                q1, q3 = (quartile([x[k] for x in cells[cell]], s) for s in (0.25, 0.75))
                far = fertility.WIDTH * (q3 - q1) + slack
                kept = kept and q1 - far <= own[k] <= q3 + far
        out.append((i, *base, failed, kept))
    return out


COUNTED = ("key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def judged(df, min_texts):
    measured = fertility.measure(df)
    return brute.bag(tuple(r) for r in fertility.judge(measured, fertility.bands(measured, min_texts=min_texts))
                     .select(*COUNTED).collect())


@pytest.mark.parametrize("min_texts", [1, 4])
def test_fertility_odd_rows(odd, min_texts):
    assert judged(odd[1], min_texts) == brute.bag(fertile(odd[0], min_texts))


def test_fertility_table(spark):
    rows, df = table(spark)
    want = fertile(rows, 20)
    assert judged(df, 20) == brute.bag(want)
    assert any(not r[-2] and not r[-1] for r in want)


def test_fertility_runs_of_words(monkeypatch, spark):
    """A very long text, encoded run by run, has the tokens of the whole."""
    text = " ".join(f"palabra{k % 97} niño 漢字" for k in range(700)).encode()
    path = public_tokenizers.path(fertility.MODEL)
    whole = fertility.measure_text(text, path)
    monkeypatch.setattr(fertility, "RUN", 64)
    assert fertility.measure_text(text, path) == whole and whole[6] > 0
    none = fertility.rules(spark.createDataFrame([], "doc_id long, lang string, text string"))
    assert none.collect() == []


def test_fertility_leaves_good_documents_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = fertility.rules(docs).filter("NOT base_failed").join(labels, F.col("key") == F.col("doc_id"))
    shares = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.98 and shares[0] < 0.6


# Source audit

def audited(rows, min_docs=3, top=200):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, t, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        sources = [s for g, s in groups if g == lang]
        share = {}
        for s in [*sources, None]:
            own = counts[lang, s] if s is not None else sum((counts[lang, x] for x in sources), Counter())
            total = sum(own[t] for t in kept) + len(kept)
            share[s] = {t: 1 + 10 ** 9 * (own[t] + 1) // total for t in kept}
        for s in sources:
            far = [(-sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o.encode(), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(far))]
            own = [(-((share[s][t] - share[None][t]) ** 2 // share[None][t]), t.encode(), t) for t in kept
                   if counts[lang, s][t] and share[s][t] > share[None][t]]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(own)[:top])]
    return out


AUDIT = ("lang", "source", "part", "item", "value", "rank")


@pytest.mark.parametrize("lot_terms,lot_pairs,top", [(1_000_000, 1 << 20, 200), (3, 1, 5), (50, 4, 1)])
def test_audit_odd_rows(odd, monkeypatch, lot_terms, lot_pairs, top):
    """Also with lots so small that terms and pairs are passed on again and again."""
    monkeypatch.setattr(source_audit, "LOT_TERMS", lot_terms)
    monkeypatch.setattr(source_audit, "LOT_PAIRS", lot_pairs)
    got = source_audit.audit(odd[1], top_terms=top).select(*AUDIT).collect()
    want = audited(odd[0], top=top)
    assert brute.bag(map(tuple, got)) == brute.bag(want)
    assert {r[2] for r in want} == {"pair", "term"}


@pytest.mark.parametrize("lot", [1 << 20, 600, 40, 7, 1])
def test_audit_pair_lots(monkeypatch, lot):
    """The corrections for shared terms, whatever the size of a lot, against all pairs."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("p0", pa.int64())]))
    base = {f"s{k}": int(rng.integers(1, 10 ** 6)) for k in range(23)}
    rows, want = [], Counter()
    for _ in range(40):
        own = [(f"s{k}", int(rng.integers(1, 10 ** 9))) for k in rng.permutation(23)[:int(rng.integers(2, 24))]]
        rows.append([{"source": s, "p": p, "p0": base[s]} for s, p in own])
        far = lambda p, q: (p - q) ** 2 // q
        for a, p in own:
            for b, q in own:
                if a != b:
                    want["l", a, b] += far(p, q) - far(p, base[b]) - far(base[a], q) + far(base[a], base[b])
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * len(rows)), pa.array(rows, kind)], names=["lang", "places"])
    monkeypatch.setattr(source_audit, "LOT_PAIRS", lot)
    got = Counter()
    for out in source_audit._pair_lots(iter([batch])):
        for r in out.to_pylist():
            got[r["lang"], r["source"], r["item"]] += r["part"]
    wrap = lambda v: (v + (1 << 63)) % (1 << 64) - (1 << 63)
    assert {k: wrap(v) for k, v in got.items() if wrap(v)} == {k: wrap(v) for k, v in want.items() if wrap(v)}


def test_audit_without_kept_terms(spark):
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame([(1, "a b", "x", "s"), (2, None, "x", "t"), (3, "!", "y", "s")], schema)
    got = sorted(tuple(r) for r in source_audit.audit(df).select(*AUDIT).collect())
    assert got == [("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)]
    assert source_audit.audit(df.limit(0)).collect() == []


def test_share_is_exact_for_large_counts(spark):
    n, total = 8 * 10 ** 18, 9 * 10 ** 18
    got = spark.range(1).select(source_audit.share(F.lit(n), F.lit(total))).first()[0]
    assert got == 1 + 10 ** 9 * (n + 1) // total


# Keys of any kind, and columns of any name, for the operators of earlier rounds

LIMIT = (1 << 63) - 1
WORDS = " ".join(f"w{k}" for k in range(40))
KEYS = [None, (1 << 53) + 1, (1 << 53) + 3, LIMIT, -LIMIT - 1, LIMIT - 1, 0, None, 7, 7, -1]


def test_exact_dedup_keys(spark):
    from newszones.llm import exact_dedup

    rows = [(k, f"text {n % 4}" + " " * (n % 3)) for n, k in enumerate(KEYS)] + [(None, "x y"), ((1 << 53) + 1, "p q r"), (5, "p q r")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for cut in (-LIMIT - 1, 3, 1 << 53, LIMIT):
        got = exact_dedup.dedup(df, F.col("key") <= cut)
        got = got.select("key", "keep", "rows", F.col("key").eqNullSafe(F.col("keep")), F.lower(F.hex("digest"))).collect()
        assert brute.bag(map(tuple, got)) == brute.bag(brute.exact_dedup(rows))


def test_token_files_keys(spark):
    from tokenizers import Tokenizer

    from newszones.llm import token_files

    rows = [(k, f"text number {n}") for n, k in enumerate(KEYS)]
    got = token_files.encode_and_read(spark.createDataFrame(rows, "doc_id long, text string"), token_files.default_tokenizer())
    want = brute.token_files(rows, Tokenizer.from_file(token_files.default_tokenizer()))
    assert brute.bag(tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == brute.bag(want)


def test_jaccard_keys(spark):
    from newszones.llm import jaccard

    a, b = WORDS, " ".join(f"v{k}" for k in range(40))
    few = [(1, a), (1, b), (2, a + " z"), (3, b + " z")]
    many = [(k, (a if n % 2 else b) + f" z{n}" * (n % 3)) for n, k in enumerate(KEYS)] + [(7, "short"), (8, None)] * 2
    chain = [((1 << 62) + n, " ".join(f"c{k}" for k in range(3 * n, 3 * n + 60))) for n in range(12)]
    for rows in (few, many, few + many, chain):
        got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("key", "n", "component")
        assert brute.bag(map(tuple, got.collect())) == brute.bag(brute.jaccard(rows))


def test_stages_with_clashing_columns(spark):
    from newszones.llm import decontaminate, grades, jaccard, mixing

    data = [(k, f"{WORDS} own{k} " * 2, "s", 1, "h", 2.0, "t", "r", True) for k in range(6)] + [(9, None, None, 2, "h", 3.0, "t", "r", False)]
    docs = spark.createDataFrame(
        data, "doc_id long, text string, source string, key int, hit_ string, `a.b` double, tails_ string, h string, rows boolean")
    items = spark.createDataFrame([("i", "nothing of this is there at all")], "item_id string, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, grade int")
    model = grades.train(docs, labels, 2)
    for out in (decontaminate.drop_contaminated(docs, items), mixing.mix_documents(docs), jaccard.keep_one(docs)):
        assert out.columns == docs.columns and out.dtypes == docs.dtypes and out.count() > 0
        assert {tuple(r) for r in out.collect()} <= set(data)
    kept = decontaminate.drop_contaminated(docs, items)
    assert brute.bag(map(tuple, kept.collect())) == brute.bag(data)
    for m in (model, None):
        scored = grades.score(docs, m, out="p")
        assert scored.columns == [*docs.columns, "p"]
        assert brute.bag(tuple(r)[:-1] for r in scored.collect()) == brute.bag(data)
