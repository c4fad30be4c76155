"""N-gram Jaccard join: token-combination prefixes over word-shingle sets, and the classes it links.

Tokens are 64-bit hashes of five-word shingles. With ``c = ceil(0.8 n)`` tokens that any partner of a set of ``n`` must
share, the steps are:

1. Equal sets are one node; only nodes take part from here on. Nodes are numbered in the order of their smallest keys, so
   the smallest node of a class has its smallest key, also where one key comes with several texts.
2. A set with more than ``n - c`` tokens that no other set has is finished. That is counted over all documents for a fixed
   share of the tokens (a hash range), which can only let more sets pass. Tokens go to their buckets in packed arrays, at
   most one entry for a token and block of documents, so a token in every document is no hot spot.
3. For what is left, tokens are ordered by how many sets have them. That is counted in packed arrays as well: a block of
   sets sends 32 bits of each of its tokens to the bucket of its range and gets the numbers back in the same order. Tokens that these bits
   do not tell apart get the sum, which is one order for all sets, and none too small. Rare tokens of the prefix (``n - c + 1`` tokens) are
   keys by themselves. For tokens in ``frequent`` sets or more the prefix is extended by one and each pair of them is a
   key: if the first common token is frequent, so is every later one, and two of them lie in both extended prefixes. Pairs
   grow with the square of the prefix, so that sets above ``PAIR_TOKENS`` tokens use single frequent tokens; classes of
   size that may meet across that line have both kinds.
4. In the list of a key each member is paired with a few centres, not with all others. Pairs that pass the filters on size
   and on a sketch of the symmetric difference are verified on the whole sets. Linked nodes form classes; then pairs in
   the same list whose classes still differ are verified too, all of them. So every class is exact, and groups of near
   copies cost what their members cost.

Null and empty texts have no tokens and are linked with nothing. Rows without key take the class of an equal set, if any,
and else have none. Repeated rows are equal sets. Very long texts are cut into pieces of words that overlap, so that no
shingle is lost. An empty table gives no rows. Other columns are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newszones.llm.components import components
from newszones.llm.shared_tokens import shared_tokens
from newszones.llm.shingles import mixed, shingles
from newszones.llm.words import bytes_of, fresh_name
from newszones.operators.dedupe import broadcast_if_small
from newszones.sources.storage import work_path, write_and_read

PERCENT = 80
FREQUENT = 24
PAIR_TOKENS = 256
SKETCH_WORDS = 16
#: Parts that a class is dealt into where its key is looked up.
PARTS = 16
CHUNK = 256
#: Sets that a worker builds at once, and whose tokens travel as one block.
SET_ROWS = 500
#: Share of the tokens that step 2 counts, in 256ths.
COUNTED = 104
BUCKET_TOKENS = 1 << 22
#: Tokens of sets left after step 2 that a worker counts at once.
LEFT_TOKENS = 1 << 20
#: Bits of the map that tells most of the rows without partner, so that they need not move.
MOST_BITS = 1 << 27
_MAP_BITS = 1 << 15
_SIGNATURE = "key long, h long, n long, a long, b long, counted long"
_SET = "block long, node long, n long, tokens binary, sketch array<long>"


def required(n):
    return -(-PERCENT * n // 100)


def _counted(tokens: np.ndarray) -> np.ndarray:
    """The counted share; tokens are sorted."""
    return tokens[:np.searchsorted(tokens, np.uint64(COUNTED << 56))]


def _identity(tokens: np.ndarray) -> np.ndarray:
    """128 bits that tell sets apart."""
    return np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), "<i8")


def _counted_set(raw: bytes, key) -> Iterator[tuple[int, np.ndarray]]:
    """The owner of tokens is the set, whatever rows have it."""
    own = shingles(raw)
    yield _identity(own)[0], _counted(own)


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, h, n, a, b, counted`` of every row: a hash of its text, the size of its set and 128 bits that tell sets apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw in batch.column(2):
                own = shingles(raw.as_py())
                rows.append((len(own), *_identity(own), len(_counted(own))))
            columns = np.array(rows, np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(columns[:, i]) for i in range(4))],
                                             names=["key", "h", "n", "a", "b", "counted"])

    return _texts(docs, key, text).mapInArrow(run, _SIGNATURE)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    raw = bytes_of(text)
    return docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(raw).alias("h"), raw.alias("raw"))


def token_sets(docs: DataFrame, nodes: DataFrame, key: str, text: str) -> DataFrame:
    """``block, node, n, tokens, sketch`` of ``nodes`` (``node, key, h, a, rows``), from the rows that have their key and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), SET_ROWS):
                batch = whole.slice(at, SET_ROWS)
                sets = [shingles(raw.as_py()) for raw in batch.column(2)]
                good = [_identity(s)[0] == a for s, a in zip(sets, batch.column(1).to_pylist())]
                sets = [s for s, g in zip(sets, good) if g]
                own = batch.column(0).filter(pa.array(good, pa.bool_()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[0].as_py()] * len(sets), pa.int64()), own, pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary()),
                     pa.array([_sketch(s) for s in sets], pa.list_(pa.int64()))], names=["block", "node", "n", "tokens", "sketch"])

    def sets(some: DataFrame) -> DataFrame:
        texts = _likely(_texts(docs, key, text), "h", some.select("h"))
        return texts.join(some, ["key", "h"]).select("node", "a", "raw").mapInArrow(run, _SET)

    # Rows that are there several times are few; only for them equal sets are dropped.
    return sets(nodes.filter("rows = 1")).unionByName(sets(nodes.filter("rows > 1")).dropDuplicates(["node"]))


def _sketch(tokens: np.ndarray) -> list[int]:
    """Parities of the numbers of tokens in 64 * SKETCH_WORDS classes: at most as many differ as the sets differ in."""
    at = (tokens % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * SKETCH_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8").tolist()


def _kinds(n: int) -> tuple[bool, bool]:
    """Whether frequent tokens of a set of ``n`` are keys in pairs, and singly. Sets that may meet share a kind."""
    least, most = required(n), 100 * n // PERCENT
    return least <= PAIR_TOKENS, most > PAIR_TOKENS


def prefix_keys(tokens: np.ndarray, counts: np.ndarray, n: int, frequent: int) -> np.ndarray:
    """Keys of a set from those of its tokens that other sets have."""
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    alone, c = n - len(tokens), required(n)  # tokens of no other set come first
    first, more = tokens[:max(0, n - c + 1 - alone)], tokens[:max(0, n - c + 2 - alone)]
    is_rare = counts[:len(first)] < frequent
    keys = [first[is_rare]]
    pairs, single = _kinds(n)
    with np.errstate(over="ignore"):
        if single:
            keys.append(mixed(first[~is_rare] + np.uint64(1)))
        if pairs:
            own = more[counts[:len(more)] >= frequent]
            i, j = np.triu_indices(len(own), 1)
            keys.append(mixed(own[i] * np.uint64(0x9E3779B97F4A7C15) + own[j]))
    return np.concatenate(keys)


def _likely(rows: DataFrame, name: str, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``name`` may be in ``keys`` (one column): all that are, and a few others while keys are much fewer than
    ``MOST_BITS``. The keys are broadcast as a map of bits."""
    bits = min(MOST_BITS, max(_MAP_BITS, 1 << (16 * keys.count()).bit_length()))

    def place(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(bits))

    # These functions count from 1.
    place_of_key = place(keys.columns[0]) + 1
    maps = keys.groupBy((F.bitmap_bucket_number(place_of_key) - 1).alias("map_")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place_of_key)).alias("bits_"))
    placed = rows.withColumn("place_", place(name))
    byte = F.substring("bits_", (F.pmod("place_", F.lit(_MAP_BITS)) / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod("place_", F.lit(8)).cast("int"))
    return placed.join(F.broadcast(maps), F.floor(F.col("place_") / _MAP_BITS) == F.col("map_")).filter(bit == 1).select(*rows.columns)


def _of_block(pdf: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
    """The token sets of a block, and the distinct tokens in ascending order."""
    own = [np.frombuffer(x, np.uint64) for x in pdf.tokens]
    return own, np.unique(np.concatenate(own))


def counted_tokens(sets: DataFrame, bucket_tokens: int = LEFT_TOKENS) -> DataFrame:
    """``block, bucket, counts``: how many sets have each of the distinct tokens of a block, in ascending order of buckets and tokens."""
    n_buckets = int((sets.agg(F.sum("n")).first()[0] or 0) // bucket_tokens) + 1

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        own, tokens = _of_block(pdf)
        every = np.sort(np.concatenate(own))
        times = np.diff(np.append(np.searchsorted(every, tokens), len(every))).astype("<u4")
        bucket = np.minimum(((tokens >> np.uint64(32)) * (n_buckets / 2.0 ** 32)).astype(np.int64), n_buckets - 1)
        edges = np.searchsorted(bucket, np.arange(n_buckets + 1))
        low = (tokens & np.uint64(0xFFFFFFFF)).astype("<u4")
        there = np.flatnonzero(np.diff(edges))
        parts = [slice(edges[b], edges[b + 1]) for b in there]
        return pd.DataFrame({"bucket": there.astype(np.int32), "block": pdf.block.iloc[0],
                             "low": [low[p].tobytes() for p in parts], "times": [times[p].tobytes() for p in parts]})

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        low = [np.frombuffer(x, "<u4") for x in pdf.low]
        _, place = np.unique(np.concatenate(low), return_inverse=True)
        # Sums below 2^53 are exact as doubles.
        total = np.bincount(place, np.concatenate([np.frombuffer(x, "<u4") for x in pdf.times]))
        counts = np.split(total[place].astype("<u4"), np.cumsum([len(x) for x in low])[:-1])
        return pd.DataFrame({"block": pdf.block, "bucket": pdf.bucket, "counts": [c.tobytes() for c in counts]})

    dealt = sets.select("block", "node", "n", "tokens").groupBy("block").applyInPandas(
        deal, "bucket int, block long, low binary, times binary")
    return dealt.groupBy("bucket").applyInPandas(meet, "block long, bucket int, counts binary")


def keys_of(sets: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``key, node, n, live, weight``: what the sets are indexed by. ``live`` is how many tokens of the set other sets have
    as well: no partner can share more. ``weight`` is how many sets have a token of the set, on
    average: in a group of near copies it is largest for the text that the others vary."""

    def index(pdf: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        own, tokens = _of_block(pdf)
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in counted.sort_values("bucket").counts]).astype(np.int64)
        keys, which, live, weight = [], [], [], []
        for at, mine in enumerate(own):
            times = counts[np.searchsorted(tokens, mine)]
            shared = times > 1
            if 100 * shared.sum() >= PERCENT * len(mine):
                found = prefix_keys(mine[shared], times[shared], len(mine), frequent)
                keys.append(found.view(np.int64))
                which.append(np.full(len(found), at))
                live.append(np.full(len(found), shared.sum()))
                weight.append(np.full(len(found), times[shared].sum() / len(mine)))
        keys, which, live, weight = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (keys, which, live, weight))
        return pd.DataFrame({"key": keys, "node": pdf.node.to_numpy()[which], "n": pdf.n.to_numpy()[which], "live": live, "weight": weight})

    own = sets.select("block", "node", "n", "tokens")
    found = own.groupBy("block").cogroup(counted_tokens(sets).groupBy("block")).applyInPandas(
        index, "key long, node long, n long, live long, weight double")
    return write_and_read(found, work_path(sets.sparkSession, "jaccard_keys"))


def _plausible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct ``x, y`` that sizes and sketches do not rule out."""
    side = sets.select("node", "n", "sketch")
    both = (pairs.distinct().join(side.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("sketch").alias("sx")), "x")
            .join(side.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("sketch").alias("sy")), "y"))
    differ = sum((F.bit_count(F.col("sx")[i].bitwiseXOR(F.col("sy")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    # intersection >= 0.8 union  <=>  9 * difference <= sizes, with percent p: (100 + p) * difference <= (100 - p) * sizes
    return both.filter((F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * PERCENT)
                       & (differ * (100 + PERCENT) <= (F.col("nx") + F.col("ny")) * (100 - PERCENT))).select("x", "y")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``x, y`` of pairs whose sets are as similar as asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for a, b in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                common = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
                good.append(100 * common >= PERCENT * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["x", "y"])

    pairs = write_and_read(pairs, work_path(sets.sparkSession, "jaccard_pairs"))
    own = _likely(sets.select("node", "tokens"), "node", pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct())
    both = (pairs.join(own.select(F.col("node").alias("x"), F.col("tokens").alias("tx")), "x")
            .join(own.select(F.col("node").alias("y"), F.col("tokens").alias("ty")), "y"))
    return both.select("x", "y", "tx", "ty").mapInArrow(run, "x long, y long")


def between_classes(members: DataFrame) -> DataFrame:
    """Distinct plausible ``x, y`` of different labels in one list. Lists are cut into chunks of about ``CHUNK`` members, and
    each two chunks of a list are compared as arrays by one task: no row for a pair that is not plausible."""
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / CHUNK)).alias("chunk")
    own = F.collect_list(F.struct("node", "n", "live", "label", "sketch")).alias("own")
    chunks = members.groupBy("key", chunk).agg(own)
    fields = [F.col("own")[f].alias(f) for f in ("node", "n", "live", "label")] + [F.flatten("own.sketch").alias("sketch")]
    chunks = write_and_read(chunks.select("key", "chunk", *fields), work_path(members.sparkSession, "jaccard_chunks"))
    names = ["node", "n", "live", "label", "sketch"]
    a = chunks.select("key", F.col("chunk").alias("c1"), *[F.col(f).alias(f"{f}1") for f in names])
    b = chunks.select("key", F.col("chunk").alias("c2"), *[F.col(f).alias(f"{f}2") for f in names])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [(c.values.to_numpy(), c.offsets.to_numpy()) for c in batch.columns[1:]]
            found = []
            for r, same in enumerate(batch.column(0).to_pylist()):
                x, nx, vx, lx, sx, y, ny, vy, ly, sy = (v[o[r]:o[r + 1]] for v, o in columns)
                sizes = nx[:, None] + ny
                good = (lx[:, None] != ly) & (np.minimum(vx[:, None], vy) * (100 + PERCENT) >= sizes * PERCENT)
                if same:
                    good = np.triu(good, 1)
                i, j = np.nonzero(good)
                sx, sy = (v.view(np.uint64).reshape(-1, SKETCH_WORDS) for v in (sx, sy))
                differ = np.bitwise_count(sx[i] ^ sy[j]).sum(axis=1, dtype=np.int64)
                near = differ * (100 + PERCENT) <= (nx[i] + ny[j]) * (100 - PERCENT)
                pairs = np.stack((x[i[near]], y[j[near]]))
                found.append(np.sort(pairs, axis=0))
            pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.empty((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["x", "y"])

    both = a.join(b, "key").filter("c1 <= c2")
    both = both.select((F.col("c1") == F.col("c2")).alias("same"), *[f"{f}{k}" for k in "12" for f in names])
    return both.mapInArrow(compare, "x long, y long").distinct()


def links(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """``node, component`` over all nodes that have a partner."""
    spark = sets.sparkSession
    central = F.struct("weight", (-F.col("node")).alias("minus"))
    centres = keys.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("c1"), F.max(central).alias("c2")).filter("m > 1")
    centres = centres.select("key", "m", "c1", (-F.col("c2.minus")).alias("c2"))
    lists = write_and_read(keys.select("key", "node", "n", "live").join(centres, "key"), work_path(spark, "jaccard_lists"))
    star = lists.select(F.explode(F.array("c1", "c2")).alias("c"), "node").filter("c <> node").select(
        F.least("c", "node").alias("x"), F.greatest("c", "node").alias("y"))
    found = write_and_read(verify(_plausible(star, sets), sets), work_path(spark, "jaccard_links"))
    classes = write_and_read(components(found), work_path(spark, "jaccard_classes"))

    label = F.coalesce("component", "node").alias("label")
    members = lists.join(classes, "node", "left").select("key", "node", "n", "live", "m", label)
    torn = members.groupBy("key").agg(F.min("label").alias("l1"), F.max("label").alias("l2")).filter("l1 < l2")
    members = members.join(torn.select("key"), "key", "left_semi").join(sets.select("node", "sketch"), "node")
    more = write_and_read(verify(between_classes(members), sets), work_path(spark, "jaccard_more"))
    if more.isEmpty():
        return classes
    return components(found.unionByName(more))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n, component`` of every row: the size of its set and the smallest key it is linked to, itself included."""
    spark = docs.sparkSession
    signed = write_and_read(signatures(docs, key, text), work_path(spark, "jaccard_signatures"))
    total = signed.agg(F.coalesce(F.sum("counted"), F.lit(0))).first()[0]
    raw = docs.select(F.col(key).cast("long").alias("key"), bytes_of(text).alias("raw"))
    repeated = shared_tokens(raw, _counted_set, max(8, int(total // BUCKET_TOKENS) + 1), COUNTED / 256)
    groups = write_and_read(_nodes(signed), work_path(spark, "jaccard_groups"))
    left = groups.join(repeated, F.col("a") == F.col("who"), "left").filter(
        (F.col("n") > 1) & (F.col("counted") - F.coalesce("repeated", F.lit(0)) <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100)))
    left = write_and_read(left.select("node", "key", "h", "a", "rows"), work_path(spark, "jaccard_left"))
    sets = write_and_read(token_sets(docs, left, key, text), work_path(spark, "jaccard_sets"))
    classes = write_and_read(links(sets, keys_of(sets)).filter("node <> component"), work_path(spark, "jaccard_members"))
    # The key that a class has by its smallest node; a class may have a large part of all nodes.
    first = groups.select(F.col("node").alias("component"), F.col("key").alias("first_key")).join(
        classes.select("component").distinct(), "component")
    small = broadcast_if_small(first)
    if small is None:
        part = F.pmod(F.xxhash64("node"), F.lit(PARTS)).cast("int")
        first = first.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        classes = classes.withColumn("part", part).join(first, ["component", "part"])
    else:
        classes = classes.join(small, "component")
    named = groups.join(classes.select("node", "first_key"), "node", "left").select(
        "a", "b", "n", F.coalesce("first_key", "key").alias("component"))
    grouped = signed.join(named, ["a", "b", "n"], "left")
    return grouped.select("key", "n", F.coalesce("component", "key").alias("component"))


def _nodes(signed: DataFrame) -> DataFrame:
    """``node, a, b, n, key, h, rows, counted``: each set that a row with a key has, with its smallest key, a text of that key
    that has the set, and the number of such rows; numbered in the order of the keys."""
    texts = signed.filter(F.col("key").isNotNull() & (F.col("n") > 0)).groupBy("a", "b", "n", "key", "h").agg(
        F.count("*").alias("rows"), F.first("counted").alias("counted"))
    sets = texts.groupBy("a", "b", "n").agg(F.min(F.struct("key", "h", "rows", "counted")).alias("x")).select("a", "b", "n", "x.*")
    order = ["key", "a", "b", "n"]
    dealt = sets.repartitionByRange(int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")), *order)
    return dealt.sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id())


def op7_jaccard_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The pipeline's stage: of each class the document with the smallest id stays, with all its repeated rows but one."""
    spark = docs.sparkSession
    found = near_duplicates(docs)
    kept = found.groupBy("key").agg(F.count("*").alias("rows"), F.bool_or(F.col("key").eqNullSafe(F.col("component"))).alias("kept"))
    kept = write_and_read(kept.filter("kept").select("key", "rows"), work_path(spark, "jaccard_kept"))

    def of(keys: DataFrame) -> DataFrame:
        small = broadcast_if_small(keys)
        return docs.join(keys if small is None else small, F.col("doc_id").eqNullSafe(F.col(name)), "left_semi")

    name = fresh_name(docs, "kept_key")
    once, several = (kept.filter(x).select(F.col("key").alias(name)) for x in ("rows = 1", "rows > 1"))
    return of(once).unionByName(of(several).dropDuplicates(["doc_id", "text"]))
