"""Benchmark decontamination with one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised to words: A-Z lower-cased, words are runs of letters, digits and characters beyond ASCII. A window is
``window`` consecutive words of an item; an item with fewer words is one window. The automaton reads word numbers instead of
characters: words that no item has are 0, so each document is scanned once, whatever the number of windows. Matches are
positions of words; word positions map to character spans of the original text.

The windows are broadcast as item texts, and each task builds the automaton and lets go of it. It has at most a node for each
word of each window, so the items go in lots of at most ``max_nodes`` such words (a long item is cut, its parts overlap by a
window less one word). A benchmark is given by people and does not grow with the corpus: one lot is the rule, and documents
are only mapped, without a shuffle, so neither a hot source nor a passage in every document matters. A larger benchmark costs
one more scan for each further lot, which adds its hits to those before, and the documents are written in between. The driver
holds one lot at a time.

Null text has no words and is never contaminated. Items without words or without text match nothing. Items with equal
texts all count. Rows are judged one by one, so repeated rows and repeated keys are kept; item ids may be of any type and
repeat. Empty tables work. The result has the documents' own columns, and a struct ``hit_``, or another name to be chosen (:func:`fresh_name`).
"""

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newszones.llm.words import bytes_of, fresh_name, through_python
from newszones.sources.storage import work_path, write_and_read

WINDOW = 13
MAX_NODES = 4_000_000
#: Bytes to bytes: A-Z to a-z, other ASCII that is not a letter or digit to a space, the rest unchanged.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Windows:
    """The automaton: ``hits`` gives the hit words of a document and the items with windows in it."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        owners: dict[tuple, set] = {}
        for item, text in items:
            own = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text))
            for at in range(max(len(own) - window + 1, min(len(own), 1))):
                owners.setdefault(own[at:at + window], set()).add(item)
        for key, names in owners.items():
            self.automaton.add_word(key, (len(key), names))
        self.automaton.make_automaton()
        self.empty = not owners

    def hits(self, text: bytes) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, merged runs of hit words, sorted items."""
        own = words(text)
        if self.empty or not own:
            return len(own), [], []
        get, runs, items = self.numbers.get, [], set()
        for end, (length, names) in self.automaton.iter(tuple([get(w, 0) for w in own])):
            items |= names
            _add(runs, end - length + 1, end)
        return len(own), runs, sorted(items)


def _add(runs: list[tuple[int, int]], start: int, end: int) -> None:
    """A run more; it ends at or after the ends of those before, and is merged with what it touches."""
    while runs and runs[-1][1] >= start - 1:
        first, last = runs.pop()
        start, end = min(start, first), max(end, last)
    runs.append((start, end))


def merged(runs: list[tuple[int, int]], more: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for start, end in sorted([*runs, *more], key=lambda x: x[1]):
        _add(out, start, end)
    return out


def lots(items: Iterator[tuple[str, bytes]], window: int, max_nodes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in lots whose windows have at most ``max_nodes`` words (or one window)."""
    held, nodes = [], 0
    most = max(1, max_nodes // window)  # windows of a part
    for item, text in items:
        own = words(text)
        n_windows = max(len(own) - window + 1, min(len(own), 1))
        for at in range(0, n_windows, most):
            n = min(most, n_windows - at) * window
            if held and nodes + n > max_nodes:
                yield held
                held, nodes = [], 0
            held.append((item, b" ".join(own[at:at + most + window - 1])))
            nodes += n
    yield held


def char_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans in the original text of runs of words."""
    kept = np.frombuffer(text.translate(NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], kept.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [(int(chars[starts[a]]), int(chars[ends[b]])) for a, b in runs]


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", _SPANS), T.StructField("runs", _SPANS)])
_ARROW_HITS = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                         ("spans", _ARROW_SPANS), ("runs", _ARROW_SPANS)])


def _pairs(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in spans]


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
              window: int = WINDOW, max_nodes: int = MAX_NODES, out: str = "hit_") -> DataFrame:
    """``docs`` with a struct ``out``: ``n_words, n_hit, items, spans`` (character spans of hit text)."""
    spark = docs.sparkSession
    given = benchmark.select(F.col(item).cast("string").alias("item"), bytes_of(item_text).alias("text"))
    inside, outside, at = through_python(docs, text)
    found = None
    for lot in lots(((str(r.item), bytes(r.text)) for r in given.toLocalIterator()), window, max_nodes):
        if found is not None:
            found = write_and_read(found, work_path(spark, "hits"))
        found = _scanned(inside if found is None else found, at, spark.sparkContext.broadcast(lot), window, found is not None)
    return found.select(*outside, F.struct("hit.n_words", "hit.n_hit", "hit.items", "hit.spans").alias(out))


def _scanned(docs: DataFrame, at: int, items, window: int, further: bool) -> DataFrame:
    """``docs`` with ``hit``; if that is there (``further``), with the hits of these items as well."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(items.value, window)
        for batch in batches:
            rows, before = [], batch.columns[-1].to_pylist() if further else None
            for i, text in enumerate(batch.column(at)):
                raw = text.as_py() or b""
                n, runs, names = windows.hits(raw)
                if further:
                    runs = merged([(r["start"], r["end"]) for r in before[i]["runs"]], runs)
                    names = sorted({*before[i]["items"], *names})
                rows.append({"n_words": n, "n_hit": sum(b - a + 1 for a, b in runs), "items": names,
                             "spans": _pairs(char_spans(raw, runs) if runs else []), "runs": _pairs(runs)})
            own = batch.columns[:-1] if further else batch.columns
            yield pa.RecordBatch.from_arrays([*own, pa.array(rows, _ARROW_HITS)], names=[*batch.schema.names[:len(own)], "hit"])

    fields = docs.schema.fields[:-1] if further else docs.schema.fields
    return docs.mapInArrow(scan, T.StructType([*fields, T.StructField("hit", HITS)]))


def contaminated(hit: str = "hit_"):
    return (F.col(f"{hit}.n_hit") > 0) & (20 * F.col(f"{hit}.n_hit") >= F.col(f"{hit}.n_words"))


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "hit_.n_words", "hit_.n_hit", F.size("hit_.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_.items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The pipeline's stage: documents that are not contaminated."""
    hit = fresh_name(docs, "hit_")
    return find_hits(docs, benchmark, out=hit).filter(~contaminated(hit)).drop(hit)
