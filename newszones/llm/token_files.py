"""Token-id files with keyed access through a minimal perfect hash.

Format, in one folder: ``shards/*.ids`` are raw token ids, little-endian, 16 bits where the vocabulary allows it, else 32,
and nothing else; ``records`` is a Parquet table ``key, nth, file, offset, n_tokens, first`` (byte offset in the file, and
ids before that record in the whole corpus); ``index/*.mph`` are segments of a minimal perfect hash from keys to places,
each slot holding a 64-bit fingerprint, the file's number, the offset and the length; ``files`` numbers the shard files.
A reader finds a key with one segment, one slot and one read.

Keys are ascending over the whole corpus; a key that repeats is numbered by ``nth`` from 0 (in the order of the texts), and
the pair is what the index knows. Documents are range-partitioned by key and encoded after that, so texts are shuffled once
and ids never. A task writes files under names of its own attempt and reports them in the rows it returns; only reported
files count, so a lost or repeated task leaves a stray file and nothing wrong. Shards end at a bounded number of ids.

Where the tokenizer drops white space, a text is encoded word by word (:class:`Encoder`), and frequent words are encoded
once for each worker: the same ids as for the whole text, which tests compare.

Null and empty texts are records of the end id alone; null keys come first. Very long texts only make long records. Empty
tables give an empty index. Columns other than key and text are not looked at.
"""

import itertools
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newszones.llm import mph
from newszones.llm.words import bytes_of
from newszones.sources.storage import qualified, work_path

END_ID = 1
SHARD_IDS = 8 << 20
SEGMENT_KEYS = 4096
#: Words that a worker remembers.
KNOWN_WORDS = 300_000
#: Bytes of texts that are encoded together.
GROUP_BYTES = 1 << 18
_SLOT = np.dtype([("fingerprint", "<u8"), ("file", "<i4"), ("n_tokens", "<i4"), ("offset", "<i8"), ("first", "<i8")])
_RECORDS = "key long, nth long, file string, offset long, n_tokens long"


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared path with a scheme, for use inside tasks."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)


class Encoder:
    """Ids of whole texts with a vocabulary file of the tokenizers library, without special tokens added.

    Where the pre-tokenizer drops white space, texts are cut at it, and ASCII full stops and commas are cut off the words
    they follow, as the pre-tokenizer does. Words seen before are looked up. Words of letters alone are single
    pre-tokens, so many are encoded in one call, and the ids that end a word tell where the next begins.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[bytes, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and "\\s" in str(spec.get("pre_tokenizer")) and "Lowercase" in str(
            spec.get("normalizer")) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
        if self.by_word:
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
            self.ends[[i for w, i in self.tokenizer.get_vocab().items() if w.endswith(suffix)]] = True

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        out, plain = {}, []
        for word in words:
            text = word.decode("utf-8", "replace")
            if text.isalpha():
                plain.append((word, text))
            else:
                out[word] = self._encode(text).tobytes()
        ids = self._encode(" ".join(text for _, text in plain))
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(plain):  # never so far: then one by one
            return out | {word: self._encode(text).tobytes() for word, text in plain}
        raw, width, at = ids.tobytes(), self.dtype.itemsize, 0
        for (word, _), stop in zip(plain, (stops * width).tolist()):
            out[word] = raw[at:stop]
            at = stop
        return out

    def _words(self, text: bytes) -> list[bytes]:
        if b"<|" in text:  # special tokens are written in lower case
            return text.split()
        return _STOP.sub(rb" \1", text.lower() + b" ").split()

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as bytes of ``dtype``."""
        if not self.by_word:
            return [self._encode(t.decode("utf-8", "replace")).tobytes() for t in texts]
        cut = [self._words(t) for t in texts]
        new = set().union(*cut).difference(self.known)
        if new:
            learnt = self._learn(new)
            self.known.update(learnt)
        out = [b"".join(map(self.known.__getitem__, words)) for words in cut]
        if new and len(self.known) > KNOWN_WORDS:  # words met first are the frequent ones
            for word in itertools.islice(learnt, len(self.known) - KNOWN_WORDS):
                del self.known[word]
        return out


_STOP = re.compile(rb"(?<=[a-z0-9])([.,]+)(?=[ \t\n\x0b\x0c\r])")
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _hashes(*columns):
    return F.xxhash64(F.lit(1), *columns).alias("a"), F.xxhash64(F.lit(2), *columns).alias("b")


def _flat(rows: DataFrame) -> DataFrame:
    """Without nulls in ``key``, as a column of longs with nulls would reach pandas as doubles."""
    return rows.withColumns({"has_key": F.col("key").isNotNull(), "key": F.coalesce("key", F.lit(0).cast("long"))})


def _whole(rows: DataFrame) -> DataFrame:
    return rows.withColumn("key", F.when(F.col("has_key"), F.col("key"))).drop("has_key")


def _segment_of(n: int):
    return F.pmod(F.xxhash64(F.lit(3), "key", "nth"), F.lit(n)).cast("int").alias("segment")


class TokenFiles:
    """A written folder."""

    def __init__(self, spark, path: str, n_segments: int, dtype: str):
        self.spark, self.path, self.n_segments, self.dtype = spark, path, n_segments, dtype

    @property
    def records(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/records")

    def locate(self, keys: DataFrame) -> DataFrame:
        """``key, nth, file, offset, n_tokens, first`` of the pairs ``key, nth`` that the index knows."""
        path, n = self.path, self.n_segments

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            fs, root = filesystem(path)
            at, segment = None, None
            for pdf in batches:
                for number, part in pdf.groupby("segment", sort=True):
                    if number != at:
                        with fs.open_input_stream(f"{root}/index/{number:06d}.mph") as f:
                            at, segment = number, mph.Segment(f.read(), _SLOT)
                    b = part.b.to_numpy().view(np.uint64)
                    slot = segment.slots(part.a.to_numpy().view(np.uint64), b)
                    found = np.flatnonzero(slot >= 0)
                    held = segment.records[slot[found]]
                    same = held["fingerprint"] == b[found]
                    held, part = held[same], part.iloc[found[same]]
                    yield pd.DataFrame({
                        "key": part.key, "has_key": part.has_key, "nth": part.nth, "file_no": held["file"].astype("int32"),
                        "offset": held["offset"], "n_tokens": held["n_tokens"].astype("int64"), "first": held["first"]})

        if not n:
            return self.records.limit(0)
        probes = keys.select("key", "nth", *_hashes("key", "nth"), _segment_of(n))
        found = _flat(probes).repartition("segment").sortWithinPartitions("segment").mapInPandas(
            look, "key long, has_key boolean, nth long, file_no int, offset long, n_tokens long, first long")
        return _whole(found).join(self.spark.read.parquet(f"{path}/files"), "file_no").drop("file_no")

    def read(self, places: DataFrame, what, schema: str) -> DataFrame:
        """``what(ids)`` for each place, as the columns of ``schema`` after those of ``places``. Places of a file are read
        by one task, in order, one record at a time."""
        dtype = np.dtype(self.dtype)

        def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, f, fs = None, None, None
            for pdf in batches:
                out = []
                for file, offset, n in zip(pdf.file, pdf.offset, pdf.n_tokens):
                    if file != name:
                        if f:
                            f.close()
                        fs, where = filesystem(file)
                        name, f = file, fs.open_input_file(where)
                    out.append(what(np.frombuffer(f.read_at(int(n) * dtype.itemsize, int(offset)), dtype)))
                columns = [c.strip().split(" ")[0] for c in schema.split(",")]
                yield pdf.assign(**{c: [row[i] for row in out] for i, c in enumerate(columns)})
            if f:
                f.close()

        places = _flat(places)
        names = ", ".join(f"`{n}` {t}" for n, t in places.dtypes)
        return _whole(places.repartition("file").sortWithinPartitions("file", "offset").mapInPandas(load, f"{names}, {schema}"))

    def ids(self, key, nth: int = 0) -> np.ndarray | None:
        """The ids of one key: one segment, one slot, one read; None for a key that is not there."""
        one = self.spark.createDataFrame([(key, nth)], "key long, nth long")
        places = self.locate(one).collect()
        if not places:
            return None
        fs, where = filesystem(places[0].file)
        with fs.open_input_file(where) as f:
            dtype = np.dtype(self.dtype)
            return np.frombuffer(f.read_at(places[0].n_tokens * dtype.itemsize, places[0].offset), dtype)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    keys, texts, size = [], [], 0
    for key, raw in zip(batch.column(0), batch.column(1)):
        keys.append(key.as_py())
        texts.append(raw.as_py())
        size += len(texts[-1])
        if size >= GROUP_BYTES:
            yield keys, texts
            keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def write(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", path: str | None = None,
          end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> TokenFiles:
    """Encode every whole text, append ``end_id``, write the folder and its index."""
    spark = docs.sparkSession
    path = qualified(spark, path or work_path(spark, "tokens"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer)
        width = encode_texts.dtype.itemsize
        end = np.array([end_id], encode_texts.dtype).tobytes()
        fs, root = filesystem(path)
        fs.create_dir(f"{root}/shards", recursive=True)
        name, f, written, last, nth = None, None, 0, (), 0
        for batch in batches:
            rows = []
            for keys, texts in _groups(batch):
                for key_, ids in zip(keys, encode_texts(texts)):
                    if f is None or written >= shard_ids * width:
                        if f:
                            f.close()
                        name, written = f"shards/{uuid.uuid4().hex}.ids", 0
                        f = fs.open_output_stream(f"{root}/{name}")
                    f.write(ids + end)
                    nth = nth + 1 if (key_,) == last else 0
                    last = (key_,)
                    rows.append((key_, nth, f"{path}/{name}", written, len(ids) // width + 1))
                    written += len(ids) + width
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5,
                                                [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()])],
                names=["key", "nth", "file", "offset", "n_tokens"])
        if f:
            f.close()

    whole = docs.select(F.col(key).cast("long").alias("key"), bytes_of(text).alias("raw"))
    size = whole.agg(F.count("*"), F.min("key")).first()
    dealt = whole.repartitionByRange("key").sortWithinPartitions("key", "raw") if size[0] else whole
    dealt.mapInArrow(encode, _RECORDS).write.parquet(f"{path}/places")
    places = spark.read.parquet(f"{path}/places")

    # Files follow each other in the order of their first record; what lies before a file is the sum of those before it.
    per_file = places.groupBy("file").agg(
        F.min(F.struct("key", "nth")).alias("begin"), F.sum("n_tokens").alias("file_ids"))
    order = Window.orderBy("begin")
    before = F.coalesce(F.sum("file_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_file.select("file", (F.row_number().over(order) - 1).alias("file_no"), before.alias("before")).write.parquet(
        f"{path}/files")
    files = spark.read.parquet(f"{path}/files")
    width = encoder(tokenizer).dtype.itemsize
    places.join(files, "file").select(
        "key", "nth", "file", "file_no", "offset", "n_tokens",
        (F.col("before") + F.col("offset") / width).cast("long").alias("first")).write.parquet(f"{path}/records")
    records = spark.read.parquet(f"{path}/records")

    n_segments = -(-size[0] // SEGMENT_KEYS)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(path)
        fs.create_dir(f"{root}/index", recursive=True)
        for number, pdf in _runs(batches, "segment"):
            slots = np.zeros(len(pdf), _SLOT)
            b = pdf.b.to_numpy().view(np.uint64)
            slots["fingerprint"], slots["file"], slots["n_tokens"] = b, pdf.file_no, pdf.n_tokens
            slots["offset"], slots["first"] = pdf.offset, pdf["first"]
            temporary = f"{root}/index/.{uuid.uuid4().hex}"
            with fs.open_output_stream(temporary) as f:
                f.write(mph.build(pdf.a.to_numpy().view(np.uint64), b, slots))
            fs.move(temporary, f"{root}/index/{number:06d}.mph")
            yield pd.DataFrame({"segment": [number], "keys": [len(pdf)]})

    if n_segments:
        hashed = records.select(_segment_of(n_segments), *_hashes("key", "nth"), "file_no", "offset", "n_tokens", "first")
        (hashed.repartition("segment").sortWithinPartitions("segment")
         .mapInPandas(index, "segment int, keys long").write.parquet(f"{path}/segments"))
    return TokenFiles(spark, path, n_segments, "<u2" if width == 2 else "<u4")


def _runs(batches: Iterator[pd.DataFrame], column: str) -> Iterator[tuple[int, pd.DataFrame]]:
    """Rows of equal ``column`` as one frame each; the batches are sorted by it. A run is one segment."""
    parts, at = [], None
    for pdf in itertools.chain(batches, [None]):
        for number, part in [(None, None)] if pdf is None else pdf.groupby(column, sort=True):
            if parts and number != at:
                yield at, pd.concat(parts)
                parts = []
            at = number
            if part is not None:
                parts.append(part)


def crc32(ids: np.ndarray) -> tuple[int]:
    return (zlib.crc32(ids.astype("<u4").tobytes()),)


def encode_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write documents and read every record back through the index, by its key."""
    files = write(docs, tokenizer)
    counted = docs.groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.count("*").alias("n"))
    keys = counted.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("nth"))
    read = files.read(files.locate(keys), crc32, "ids_crc32 long")
    return read.select(F.col("key").alias("doc_id"), F.col("first").alias("start"), "n_tokens", "ids_crc32")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    return encode_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
