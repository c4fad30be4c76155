"""Which tokens do others have too? Counted over all rows in packed arrays, without a row for each token."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TOKENS = 1 << 19
#: Tokens of a bucket that a worker compares at once, and owners whose counts it holds.
SLICE_TOKENS = 1 << 18
HELD_OWNERS = 1 << 18


def shared_tokens(docs: DataFrame, sets_of: Callable[[bytes, int | None], Iterator[tuple]], n_buckets: int,
                  share: float = 1.0) -> DataFrame:
    """``who, repeated``: how many of its tokens another owner has too, or a few more (32 bits of a bucket are compared).

    ``docs`` has ``key, raw``; ``sets_of(raw, key)`` gives owners (one, or one for each token) and tokens, hashes below
    ``share`` of 2^64. An owner may come again with the same tokens; it counts as one, and its count then counts each coming. A block sends
    each token once, with its owner or a sign that it has several, so a token that all rows have is no hot spot. A worker reads
    a bucket where Arrow has put it and copies only a slice of it at a time: besides that it needs as much for any bucket.
    """
    scale = n_buckets / (share * 2.0 ** 64)

    def block(owners: list[np.ndarray], sets: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.concatenate(sets)
        who = np.concatenate(owners)
        order = np.lexsort((who, tokens))
        tokens, who = tokens[order], who[order]
        new = np.concatenate(([True], tokens[1:] != tokens[:-1]))
        group = np.cumsum(new) - 1
        ends = np.append(np.flatnonzero(new)[1:], len(tokens)) - 1
        several = who[new] != who[ends]
        rows = []
        known, counts = np.unique(who[several[group]], return_counts=True)
        if len(known):
            rows.append((int(tokens[0] % np.uint64(n_buckets)), True, known.tobytes(), counts.astype("<u4").tobytes()))
        tokens, who = tokens[new], who[new]
        place = tokens * scale
        bucket = np.minimum(place.astype(np.int64), n_buckets - 1)
        low = np.minimum((place - bucket) * 2.0 ** 32, 2.0 ** 32 - 1).astype("<u4")  # ascending within a bucket
        edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            part = slice(edges[b], edges[b + 1])
            one = ~several[part]  # tokens of several owners first, without owners
            mixed_low = np.concatenate((low[part][~one], low[part][one]))
            rows.append((int(b), False, who[part][one].tobytes(), mixed_low.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.bool_(), pa.binary(), pa.binary()])],
            names=["bucket", "known", "who", "low"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, sets, n = [], [], 0
        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                for owner, tokens in sets_of(raw.as_py(), key):
                    if not len(tokens):
                        continue
                    owners.append(np.full(len(tokens), owner, np.int64))
                    sets.append(tokens)
                    n += len(tokens)
                    if n >= BLOCK_TOKENS:
                        yield block(owners, sets)
                        owners, sets, n = [], [], 0
        if n:
            yield block(owners, sets)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, held, n = None, [], [], 0

        def counts(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found[0]], names=["who", "repeated"])

        def hold(parts: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            for part in parts:
                held.append(part)
                n += len(part[0])
                if n >= HELD_OWNERS:
                    held = [_summed(held)]
                    n = len(held[0][0])
                    if n >= HELD_OWNERS // 2:
                        yield counts(held)
                        held, n = [], 0

        for batch in batches:
            for bucket, known, w, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if bucket != at:
                    yield from hold(_repeated(rows))
                    at, rows = bucket, []
                w, x = np.frombuffer(w.as_buffer(), np.int64), np.frombuffer(x.as_buffer(), "<u4")
                if known:
                    yield from hold([(w.copy(), x.astype(np.int64))])
                else:
                    rows.append((x[:len(x) - len(w)], x[len(x) - len(w):], w))
        yield from hold(_repeated(rows))
        if n:
            yield counts([_summed(held)])

    dealt = docs.select("key", "raw").mapInArrow(deal, "bucket int, known boolean, who binary, low binary")
    met = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "who long, repeated long")
    return met.groupBy("who").agg(F.sum("repeated").alias("repeated"))


def _repeated(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Owners in a bucket and how many of their tokens are repeated, slice by slice. ``rows`` of blocks: tokens of several owners,
    tokens of one owner, both ascending, and the owners of the latter."""
    n = sum(len(several) + len(one) for several, one, _ in rows) // SLICE_TOKENS + 1
    edges = ((np.arange(1, n, dtype=np.uint64) << np.uint64(32)) // np.uint64(n)).astype("<u4")
    cuts = [[np.concatenate(([0], np.searchsorted(x, edges), [len(x)])) for x in (several, one)] for several, one, _ in rows]
    for k in range(n if rows else 0):
        several = np.concatenate([x[c[k]:c[k + 1]] for (x, _, _), (c, _) in zip(rows, cuts)])
        tokens = np.concatenate([x[c[k]:c[k + 1]] for (_, x, _), (_, c) in zip(rows, cuts)])
        owners = np.concatenate([x[c[k]:c[k + 1]] for (_, _, x), (_, c) in zip(rows, cuts)])
        if not len(tokens):
            continue
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        new = np.concatenate(([True], tokens[1:] != tokens[:-1]))
        firsts = np.flatnonzero(new)
        shared = np.minimum.reduceat(owners, firsts) != np.maximum.reduceat(owners, firsts)
        if len(several):
            shared |= np.isin(tokens[firsts], several)
        yield np.unique(owners[shared[np.cumsum(new) - 1]], return_counts=True)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Each owner once, with the sum of its counts."""
    owners, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(owners)
    owners, n = owners[order], n[order]
    firsts = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
    return owners[firsts], np.add.reduceat(n, firsts)
