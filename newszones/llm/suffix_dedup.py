"""Removal of repeated passages by a distributed suffix order, built with difference covers.

A byte goes if a string of ``SPAN`` bytes that covers it also starts in a document with a smaller key. Texts are UTF-8
bytes; matches never cross documents.

1. *Stretches.* In each string of ``SPAN`` bytes the run of ``MARK`` bytes with the smallest hash is its mark. Consecutive
   strings with the same mark make a stretch of at most ``WIDTH`` bytes. Equal strings have equal marks, so they lie in
   stretches of one mark: the marks part the suffixes into classes that need no comparison with each other.
2. *Equal stretches.* Stretches meet by mark, as hashes. All strings of a stretch that a smaller document has as well go.
   A mark all of whose stretches are equal is finished. Of the rest, the stretches of the smallest document of each are
   sorted; what is left to find are repeats between stretches that differ.
3. *Suffix order.* Lots of whole marks are ordered by suffix: triples at positions 1 and 2 modulo 3 are sorted and named by
   rank, the names are ordered in the same way (until names stand for ``SPAN`` bytes or more, or are all different), and
   the remaining suffixes are sorted by their first byte and the rank after it and merged.
4. *Neighbours.* Suffixes next to each other are compared on their first ``SPAN`` bytes, all of them. Of a run of equal
   ones the smallest document keeps the string. What others have of it is joined to runs and cut out.

Texts are packed whole, in blocks of about ``BLOCK_BYTES`` bytes (or one longer text), in a table that is bucketed by block:
three times it meets answers from elsewhere, and is not shuffled. Each block sends its distinct marks first, as 32 bits, and
only those that another block has, or that have different stretches, a second time with the hashes of their stretches. If
more than ``hot`` different stretches have one mark, their strings are dealt by a hash of their own instead of the mark, so no
task gets all contexts of a frequent passage to sort; in step 2 each block adds 28 bytes to a bucket for each of its distinct
stretches. Strings are compared byte by byte in step 4; step 2 takes stretches as equal if their marks' and their own hashes,
64 bits each, are.

Null and empty texts keep nothing and lose nothing. Rows without key are smaller than all others for nobody: they lose what
any other row has, and nobody loses to them (nor to the largest key of 64 bits). Rows with equal keys do not lose to each
other, and each loses its own runs. Texts of any length are read whole. An empty table gives no rows. Other columns are not
looked at.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newszones.llm.shingles import byte_hashes, mixed
from newszones.llm.words import bytes_of
from newszones.sources.storage import work_path, write_and_read

SPAN = 50
MARK = 28
WIDTH = 2 * SPAN - MARK  # of a stretch, at most
BLOCK_BYTES = 8 << 20
PART_BYTES = 1 << 16  # of a block, read at once: in the processor's cache
CHUNK = 1 << 13  # stretches, likewise
BUCKET_BYTES = 16 << 20  # of text whose stretches meet in one bucket
LOT_BYTES = 1 << 16  # of stretches ordered at once
HOT = 1 << 15
_PLACE = 17  # bits of a place in a part
_NO_KEY = (1 << 63) - 1  # a missing key, larger than all
_PACKED = "bucket long, block string, parts binary, docs binary, starts binary, lengths binary, marks binary, text binary"
_NAMES = [c.split(" ")[0] for c in _PACKED.split(", ")]


def _i64(x) -> bytes:
    return np.asarray(x).astype(np.int64, copy=False).tobytes()


def _least_of_runs(x: np.ndarray, size: int) -> np.ndarray:
    """The minimum of every run of ``size``, by runs whose length doubles."""
    n, done = len(x) - size + 1, 1
    while done * 2 <= size:
        x = np.minimum(x[:len(x) - done], x[done:])
        done *= 2
    return np.minimum(x[:n], x[size - done:][:n])


#: For each length up to ``WIDTH``, which bits of a row of that many bytes are text.
_TEXT = np.where(np.arange(WIDTH) < np.arange(WIDTH + 1)[:, None], np.uint8(255), np.uint8(0)).view("<u8")


def _at(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Strings of the text as rows of ``WIDTH`` bytes in words of eight, zero after their ends."""
    if len(starts) and starts.max() + WIDTH > len(text):
        text = np.concatenate((text, np.zeros(WIDTH, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(text, WIDTH)[starts] if len(starts) else np.empty((0, WIDTH), np.uint8)
    return rows.view("<u8") & _TEXT[lengths]


def digests(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each string of the text."""
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), CHUNK):
        own = lengths[i:i + CHUNK]
        found = own.astype(np.uint64) + np.uint64(1)
        for column in _at(text, starts[i:i + CHUNK], own).T:
            found = mixed(found) ^ (column + np.uint64(0x9E3779B97F4A7C15))
        out[i:i + CHUNK] = mixed(found)
    return out


def _stretches(text: bytes, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes = byte_hashes(text, MARK)
    # The leftmost of the smallest hashes (by their first bits), so that a string's mark depends on nothing else.
    ranked = (hashes >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(hashes), dtype=np.uint64)
    place = (_least_of_runs(ranked, SPAN - MARK + 1) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)[whole]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(whole) != 1) | (np.diff(place) != 0))))
    last = np.append(first[1:], len(whole)) - 1
    return whole[first], whole[last] - whole[first] + SPAN, hashes[place[first]]


def stretches(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and mark (its hash) of every stretch of texts that stand in one, ``lengths`` bytes each."""
    ends = np.cumsum(lengths)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))]
    for a in range(0, len(text), PART_BYTES):
        places = np.arange(a, min(a + PART_BYTES, len(text)))
        whole = np.flatnonzero(ends[np.searchsorted(ends, places, "right")] - places >= SPAN)
        if len(whole):
            at, n, marks = _stretches(text[a:a + PART_BYTES + SPAN - 1], whole)
            found.append((at + a, n, marks))
    return tuple(np.concatenate(x) for x in zip(*found))


def blocks(docs: DataFrame, n_buckets: int) -> DataFrame:
    """The rows of ``key, raw`` packed, whole texts, in a table that is bucketed by ``block``: it meets answers without
    being shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def pack() -> pa.RecordBatch:
            keys, raws = zip(*held)
            columns = [uuid.uuid4().hex, _i64([_NO_KEY if k is None else k for k in keys]),
                       np.array([k is not None for k in keys]).tobytes(), _i64([len(t) for t in raws]), b"".join(raws)]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in columns], names=["block", "docs", "known", "lengths", "text"])

        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py()
                if held and size + len(raw) > BLOCK_BYTES:
                    yield pack()
                    held, size = [], 0
                held.append((key, raw))
                size += len(raw)
        if held:
            yield pack()

    spark = docs.sparkSession
    packed = docs.select("key", "raw").mapInArrow(run, "block string, docs binary, known binary, lengths binary, text binary")
    table = f"suffix_blocks_{uuid.uuid4().hex}"
    packed.write.bucketBy(n_buckets, "block").option("path", work_path(spark, "suffix_blocks")).option(
        "compression", "zstd").saveAsTable(table)
    stored = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only; the files stay
    return stored


class Block:
    """The stretches of a packed block, and the distinct ones among them."""

    def __init__(self, row):
        self.docs, lengths = np.frombuffer(row.docs, np.int64), np.frombuffer(row.lengths, np.int64)
        self.text = np.frombuffer(row.text, np.uint8)
        self.at, self.lengths, self.marks = stretches(row.text, lengths)
        ends = np.cumsum(lengths)
        self.part = np.searchsorted(ends, self.at, "right")
        self.begins = ends - lengths
        self.keys = self.docs[self.part]
        self.own = digests(self.text, self.at, self.lengths)
        order = np.argsort(self.own)
        new = _differs(self.own[order]) | _differs(self.marks[order])
        first = np.flatnonzero(new)
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(new) - 1
        self.distinct = order[first]  # one stretch of each kind
        self.least = np.minimum.reduceat(self.keys[order], first) if len(first) else self.keys

    def places(self, of: np.ndarray) -> np.ndarray:
        """Where stretches start in their documents."""
        return self.at[of] - self.begins[self.part[of]]


def _differs(x: np.ndarray) -> np.ndarray:
    """Which values differ from the one before."""
    return np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1]))


def _dealt(values: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that has some of the hashes, and which."""
    bucket = (mixed(values) % np.uint64(n_buckets)).astype(np.min_scalar_type(n_buckets))
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        yield int(b), order[edges[b]:edges[b + 1]]


_SMALLER, _SHARED, _HOT = 1, 2, 4


def verdicts(marks: np.ndarray, own: np.ndarray, keys: np.ndarray, hot: int) -> np.ndarray:
    """For each stretch: has a smaller document an equal one; has its mark others, of another smallest document; more than
    ``hot``. If all have the same smallest document, nobody loses anything that equal stretches do not tell."""
    order = np.lexsort((own, marks))
    new_mark = _differs(marks[order])
    new = new_mark | _differs(own[order])
    least = np.minimum.reduceat(keys[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    of, of_mark = np.cumsum(new_mark) - 1, np.flatnonzero(new_mark)
    kinds = np.add.reduceat(new.astype(np.int64), of_mark)[of]
    several = (np.minimum.reduceat(least, of_mark) < np.maximum.reduceat(least, of_mark))[of]
    out = np.empty(len(order), np.uint8)
    out[order] = _SMALLER * (least < keys[order]) | _SHARED * several | _HOT * (kinds > hot)
    return out


def joined(groups: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that touch or overlap made one: the first of each, its start and stop. Starts and stops ascend in a group."""
    if not len(starts):
        return np.empty(0, np.int64), starts, stops
    first = np.flatnonzero(np.concatenate(([True], (groups[1:] != groups[:-1]) | (starts[1:] > stops[:-1]))))
    return first, starts[first], stops[np.append(first[1:], len(starts)) - 1]


def judged_block(name: str, block: Block, answers: np.ndarray, n_buckets: int) -> Iterator[tuple]:
    """Packed rows: runs that go (bucket -1), and the stretches that are to be sorted, by bucket."""
    answers = answers[block.which]
    smaller = (answers & _SMALLER > 0) | (block.keys > block.least[block.which])
    gone = np.flatnonzero(smaller)
    starts = block.places(gone)
    first, starts, stops = joined(block.part[gone], starts, starts + block.lengths[gone])
    if len(first):
        part = block.part[gone[first]]
        yield -1, name, _i64(part), _i64(block.docs[part]), _i64(starts), _i64(stops - starts), b"", b""
    rest = np.flatnonzero(~smaller & (answers & _SHARED > 0))
    hot = answers[rest] & _HOT > 0
    cool, hot = rest[~hot], rest[hot]
    n = block.lengths[hot] - SPAN + 1  # strings of hot marks stand alone
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    of = np.concatenate((cool, np.repeat(hot, n)))
    shift = np.concatenate((np.zeros(len(cool), np.int64), within))
    lengths = np.where(np.arange(len(of)) < len(cool), block.lengths[of], SPAN)
    at, marks, places = block.at[of] + shift, block.marks[of], block.places(of) + shift
    if len(hot):
        alone = slice(len(cool), None)
        marks[alone] = digests(block.text, at[alone], lengths[alone])
    part = block.part[of]
    for b, own in _dealt(marks, n_buckets):
        text = _at(block.text, at[own], lengths[own]).view(np.uint8)[np.arange(WIDTH) < lengths[own, None]]
        yield (b, name, _i64(part[own]), _i64(block.docs[part[own]]), _i64(places[own]), _i64(lengths[own]),
               marks[own].tobytes(), text.tobytes())


def suffix_order(symbols: np.ndarray, covers: int = 1, enough: int = SPAN) -> np.ndarray:
    """Starts of all suffixes of ``symbols`` (positive numbers), ascending by difference cover modulo 3.

    A symbol stands for ``covers`` bytes. Suffixes that agree on ``enough`` bytes may come in any order.
    """
    n = len(symbols)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), np.int64)
    t = np.concatenate((symbols.astype(np.int64), np.zeros(3, np.int64)))
    size = int(symbols.max()) + 1
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # after the last 1, a triple ends with a zero
    sample = np.concatenate((ones, twos))
    triples, names = np.unique((t[sample] * size + t[sample + 1]) * size + t[sample + 2], return_inverse=True)
    rank = np.zeros(n + 3, np.int64)
    if len(triples) == len(sample) or covers * 3 >= enough:
        rank[sample] = names + 1
        ordered = sample[np.argsort(names)]
    else:
        ordered = sample[suffix_order(names + 1, covers * 3, enough)]
        rank[ordered] = np.arange(1, len(sample) + 1)
    ordered = ordered[ordered < n]
    zeros = np.arange(0, n, 3)
    top = n + 2
    zeros = zeros[np.argsort(t[zeros] * top + rank[zeros + 1])]
    # A suffix at 0 compares with one at 1 by a symbol and a rank, with one at 2 by two symbols and a rank.
    one, two = ordered[ordered % 3 == 1], ordered[ordered % 3 == 2]
    before = np.searchsorted(t[one] * top + rank[one + 1], t[zeros] * top + rank[zeros + 1])
    long = lambda i: (t[i] * size + t[i + 1]) * top + rank[i + 2]
    before += np.searchsorted(long(two), long(zeros))
    out = np.empty(n, np.int64)
    place = np.maximum.accumulate(before) + np.arange(len(zeros))
    out[place] = zeros
    rest = np.ones(n, bool)
    rest[place] = False
    out[rest] = ordered
    return out


def repeated(text: np.ndarray, lengths: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Positions of the strings of ``SPAN`` bytes that smaller documents have as well, ascending."""
    part = np.repeat(np.arange(len(lengths)), lengths)
    left = np.cumsum(lengths)[part] - np.arange(len(text))
    order = suffix_order(text.astype(np.int64) + 1)
    order = order[left[order] >= SPAN]
    words = np.lib.stride_tricks.sliding_window_view(text, 8)
    words = np.ascontiguousarray(words).view("<u8")[:, 0]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in [*range(0, SPAN - 8, 8), SPAN - 8]:
        column = words[order + k]
        new[1:] |= column[1:] != column[:-1]
    who = docs[part[order]]
    least = np.minimum.reduceat(who, np.flatnonzero(new))[np.cumsum(new) - 1] if len(who) else who
    return np.sort(order[least < who])


def _lots(marks: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Whole marks together, about ``LOT_BYTES`` at a time."""
    order = np.argsort(marks, kind="stable")
    sizes, new = np.cumsum(lengths[order]), np.flatnonzero(np.diff(marks[order]) != 0) + 1
    at = 0
    while at < len(order):
        full = np.searchsorted(sizes, (sizes[at - 1] if at else 0) + LOT_BYTES)
        stop = np.searchsorted(new, max(full, at + 1))
        stop = new[stop] if stop < len(new) else len(order)
        yield order[at:stop]
        at = stop


def sorted_bucket(held: list) -> Iterator[tuple]:
    """Runs that go, of all stretches of a bucket."""
    parts, docs, starts, lengths = (np.frombuffer(b"".join(getattr(r, c) for r in held), np.int64)
                                    for c in ("parts", "docs", "starts", "lengths"))
    source = np.repeat(np.arange(len(held)), [len(r.marks) // 8 for r in held])
    marks = np.frombuffer(b"".join(r.marks for r in held), np.uint64)
    text = np.frombuffer(b"".join(r.text for r in held), np.uint8)
    begins = np.cumsum(lengths) - lengths
    found = []
    for lot in _lots(marks, lengths):
        n = lengths[lot]
        own = np.cumsum(n) - n
        part = np.repeat(np.arange(len(lot)), n)
        within = np.arange(n.sum()) - own[part]
        gone = repeated(text[begins[lot][part] + within], n, docs[lot])
        part, within = part[gone], within[gone]
        first, a, b = joined(part, within, within + SPAN)
        found.append((lot[part[first]], a, b - a))
    of, start, n = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(source[of], kind="stable")
    of, start, n = of[order], start[order], n[order]
    for run in np.split(np.arange(len(of)), np.flatnonzero(np.diff(source[of])) + 1):
        if len(run):
            own = of[run]
            yield (-1, held[source[own[0]]].block, _i64(parts[own]), _i64(docs[own]), _i64(starts[own] + start[run]),
                   _i64(n[run]), b"", b"")


def _by_bucket(work, columns: list[str]):
    """``work(bucket, rows)`` for all rows of each bucket, of partitions that are sorted by it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held = None, []

        def done() -> Iterator[pd.DataFrame]:
            if held:
                yield pd.DataFrame(list(work(at, held)), columns=columns)

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                if row.bucket != at:
                    yield from done()
                    at, held = row.bucket, []
                held.append(row)
        yield from done()

    return run


def _answered(dealt: DataFrame, work) -> DataFrame:
    """What ``work(held)`` answers, an array of bytes for the rows of a bucket, back to each: ``block, bucket, which, answers``."""

    def run(_, held: list) -> Iterator[tuple]:
        found, at = work(held), 0
        for r in held:
            yield r.block, r.bucket, r.which, found[at:at + r.n].tobytes()
            at += r.n

    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(
        _by_bucket(run, ["block", "bucket", "which", "answers"]), "block string, bucket long, which binary, answers binary")


def _answers(answers: pd.DataFrame, n: int) -> np.ndarray:
    """The answers in one array, zero where there is none."""
    out = np.zeros(n, np.uint8)
    out[np.frombuffer(b"".join(answers.which), np.int32)] = np.frombuffer(b"".join(answers.answers), np.uint8)
    return out


def repeats(packed: DataFrame, n_buckets: int, hot: int = HOT) -> DataFrame:
    """``block, parts, starts, lengths``: all runs of bytes that documents with smaller keys have, in any order, also
    overlapping, packed for each block of :func:`blocks`."""
    spark = packed.sparkSession

    def deal_marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                marks = np.unique(stretches(row.text, np.frombuffer(row.lengths, np.int64))[2])
                yield pd.DataFrame([(b, row.block, len(of), of.astype(np.int32).tobytes(),
                                     (marks[of] >> np.uint64(32)).astype(np.uint32).tobytes())
                                    for b, of in _dealt(marks, n_buckets)], columns=["bucket", "block", "n", "which", "marks"])

    def seen_elsewhere(held: list) -> np.ndarray:
        _, which, n = np.unique(np.frombuffer(b"".join(r.marks for r in held), np.uint32), return_inverse=True, return_counts=True)
        return (n > 1)[which].astype(np.uint8)

    def deal_stretches(_, own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples(index=False):
            block = Block(row)
            marks, mark, kinds = np.unique(block.marks[block.distinct], return_inverse=True, return_counts=True)
            wanted = np.flatnonzero(((_answers(answers, len(marks)) > 0) | (kinds > 1))[mark])
            marks, digest = block.marks[block.distinct[wanted]], block.own[block.distinct[wanted]]
            for b, of in _dealt(marks, n_buckets):
                out.append((b, row.block, len(of), wanted[of].astype(np.int32).tobytes(), marks[of].tobytes(), digest[of].tobytes(),
                            _i64(block.least[wanted[of]])))
        return pd.DataFrame(out, columns=["bucket", "block", "n", "which", "marks", "own", "least"])

    def compare(held: list) -> np.ndarray:
        marks, own = (np.frombuffer(b"".join(getattr(r, c) for r in held), np.uint64) for c in ("marks", "own"))
        return verdicts(marks, own, np.frombuffer(b"".join(r.least for r in held), np.int64), hot)

    def judge(_, own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.itertuples(index=False):
            block = Block(row)
            out.extend(judged_block(row.block, block, _answers(answers, len(block.distinct)), n_buckets))
        return pd.DataFrame(out, columns=_NAMES)

    own = packed.select("block", "docs", "lengths", "text").groupBy("block")
    marks = packed.select("block", "lengths", "text").mapInPandas(
        deal_marks, "bucket long, block string, n long, which binary, marks binary")
    dealt = own.cogroup(_answered(marks, seen_elsewhere).groupBy("block")).applyInPandas(
        deal_stretches, "bucket long, block string, n long, which binary, marks binary, own binary, least binary")
    judged = own.cogroup(_answered(dealt, compare).groupBy("block")).applyInPandas(judge, _PACKED)
    judged = write_and_read(judged, work_path(spark, "suffix_judged"))
    found = judged.filter("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket").mapInPandas(
        _by_bucket(lambda _, held: sorted_bucket(held), _NAMES), _PACKED)
    return judged.filter("bucket < 0").unionByName(found).select("block", "parts", "starts", "lengths")


def cut_out(raw: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, int, int, int]:
    """A text without its runs: what is left, bytes, removed bytes, maximal runs."""
    if not len(starts):
        return raw, len(raw), 0, 0
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > stops[:-1])))
    starts, stops = starts[first], stops[np.append(first[1:], len(stops)) - 1]
    edges = [0, *np.column_stack((starts, stops)).ravel().tolist(), len(raw)]
    kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return kept, len(raw), int((stops - starts).sum()), len(first)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """``key, kept, n_bytes, n_removed, n_spans`` of every row; ``kept`` is the rest of the text as bytes."""
    spark = docs.sparkSession
    own = docs.select(F.col(key).cast("long").alias("key"), bytes_of(text).alias("raw"))
    total = own.agg(F.coalesce(F.sum(F.length("raw")), F.lit(0))).first()[0]
    n_buckets = max(8, int(total // BUCKET_BYTES) + 1)
    packed = blocks(own, n_buckets)
    gone = write_and_read(repeats(packed, n_buckets, hot), work_path(spark, "suffix_repeats"))

    def cut(_, mine: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
        parts, starts, lengths = (np.frombuffer(b"".join(runs[c]), np.int64) for c in ("parts", "starts", "lengths"))
        order = np.argsort(parts, kind="stable")
        parts, starts, stops = parts[order], starts[order], (starts + lengths)[order]
        out = []
        for row in mine.itertuples(index=False):
            sizes, keys = np.frombuffer(row.lengths, np.int64), np.frombuffer(row.docs, np.int64)
            edges = np.searchsorted(parts, np.arange(len(sizes) + 1))
            at = 0
            for i, (known, size) in enumerate(zip(np.frombuffer(row.known, bool), sizes.tolist())):
                own = slice(edges[i], edges[i + 1])
                out.append((int(keys[i]), bool(known), *cut_out(row.text[at:at + size], starts[own], stops[own])))
                at += size
        return pd.DataFrame(out, columns=["key", "known", "kept", "n_bytes", "n_removed", "n_spans"])

    found = packed.groupBy("block").cogroup(gone.groupBy("block")).applyInPandas(
        cut, "key long, known boolean, kept binary, n_bytes long, n_removed long, n_spans long")
    return found.select(F.when(F.col("known"), F.col("key")).alias("key"), "kept", "n_bytes", "n_removed", "n_spans")


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select(F.col("key").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
