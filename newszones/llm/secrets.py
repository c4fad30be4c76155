"""Secret scans: candidate strings, judged by a random forest that is trained from labelled findings.

Candidates are runs of 16 or more letters, digits and signs of keys and tokens, with what is joined to them by dots; and what
is assigned to a telling name, of any length and signs, up to the next blank or the closing quote (without quotes, a last
full stop, comma or semicolon is the sentence's). Of candidates that lie in each other the longest stays. A finding has features of the string (length,
transitions between kinds of characters, variety, share of digits and capitals, how likely its letter pairs are in words),
its dictionary coverage (share of its characters in frequent words of the corpus), its path (hashed parts of a column that
names where the text is from) and its neighbouring words (hashed, and whether something is assigned). Labelled findings
train a forest of ``TREES`` trees; it removes false positives and leaves a probability.

The dictionary holds at most ``DICTIONARY`` words, those of most documents; every word of every document counts, so it does
not depend on partitions. A task passes its counts on whenever it holds ``HELD_WORDS`` of them. The forest is trained by Spark on at most
``train_rows`` findings, chosen by a hash. Documents are only mapped; findings are few.

What is found is not stored: only offsets, digests, features and labels are written between jobs (:func:`sealed`).

Null and empty texts have no findings. Null paths have no parts. Repeated rows give repeated findings. Without labelled
findings of both kinds the probability is the share of real ones, or null without any. Very long texts are scanned whole.
An empty table gives no rows. Other columns are not looked at.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newszones.llm.words import bytes_of
from newszones.sources.storage import work_path, write_and_read

TREES, DEPTH = 24, 6
TRAIN_ROWS = 20_000
DICTIONARY = 4_000
HELD_WORDS = 50_000
HASHED = 32
_CANDIDATE = re.compile(rb"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{16,}={0,2}(?![A-Za-z0-9_+/-])")
_DOTTED = re.compile(rb"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]++(?:\.[A-Za-z0-9_+/-]++)+={0,2}")
_LONG = re.compile(rb"[A-Za-z0-9_+/-]{16}")
#: Names that secrets are assigned to.
_NAMES = r"(?i)(?:password|passwd|pwd|token|secret|api_?key)[\"']?\s*[=:]\s*"
_VALUE = re.compile(_NAMES.encode() + rb"(?:\"([^\"\s]+)|'([^'\s]+)|([^\s\"']\S*))")
_WORD = re.compile(rb"[A-Za-z]+")
_KINDS = np.full(256, 3, np.int64)
_KINDS[list(range(97, 123))], _KINDS[list(range(65, 91))], _KINDS[list(range(48, 58))] = 0, 1, 2


def dictionary(docs: DataFrame, text: str, size: int = DICTIONARY) -> list[bytes]:
    """The words of three letters or more that most documents have."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()

        def passed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["w", "n"])

        for batch in batches:
            for raw in batch.column(0):
                seen.update({w for w in _WORD.findall(raw.as_py().lower()) if len(w) > 2})
                if len(seen) >= HELD_WORDS:
                    yield passed()
                    seen.clear()
        if seen:
            yield passed()

    counted = docs.select(bytes_of(text).alias("raw")).mapInArrow(count, "w binary, n long")
    top = counted.groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(size)
    return [bytes(r.w) for r in top.collect()]


def candidates(raw: bytes) -> list[tuple[int, int]]:
    """Start and end of every candidate, in order."""
    spans = {m.span() for m in _CANDIDATE.finditer(raw)}
    spans.update(m.span() for m in _DOTTED.finditer(raw) if _LONG.search(m[0]))
    for m in _VALUE.finditer(raw):
        start, end = m.span(m.lastindex)
        if m.lastindex == 3:
            end = start + len(m[3].rstrip(b".,;"))
        if start < end:
            spans.add((start, end))
    out, last = [], -1
    for start, end in sorted(spans, key=lambda x: (x[0], -x[1])):
        if end > last:
            out.append((start, end))
            last = end
    return out


class Judge:
    """Features of one finding."""

    def __init__(self, words: list[bytes]):
        self.words = set(words)
        self.longest = max(map(len, words), default=0)
        self.pairs = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
        self.total = sum(self.pairs.values()) + 676

    def coverage(self, text: bytes) -> float:
        covered = at = 0
        while at < len(text):
            n = next((n for n in range(min(self.longest, len(text) - at), 2, -1) if text[at:at + n] in self.words), 0)
            covered += n
            at += n or 1
        return covered / len(text)

    def __call__(self, raw: bytes, start: int, end: int, path: str | None) -> list[float]:
        own = raw[start:end]
        kinds = _KINDS[np.frombuffer(own, np.uint8)]
        moves = np.bincount(kinds[:-1] * 4 + kinds[1:], minlength=16) / max(1, len(own) - 1)
        share = np.bincount(np.frombuffer(own, np.uint8), minlength=256) / len(own)
        variety = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
        low = own.lower()
        likely = sum(math.log((self.pairs[low[i:i + 2]] + 1) / self.total) for i in range(len(low) - 1)) / len(low)
        before, after = raw[max(0, start - 40):start], raw[end:end + 20]
        hashed = np.zeros(2 * HASHED)
        for part in re.split(r"[^A-Za-z0-9]+", path or ""):
            if part:
                hashed[xxhash.xxh32_intdigest(part.lower()) % HASHED] = 1
        for word in _WORD.findall(before.lower())[-2:] + _WORD.findall(after.lower())[:1]:
            hashed[HASHED + xxhash.xxh32_intdigest(word) % HASHED] = 1
        assigned = bool(re.search(rb"[=:]\s*[\"']?$", before))
        hexadecimal = not own.strip(b"0123456789abcdefABCDEF")
        return [len(own), variety, float(share[48:58].sum()), float(share[65:91].sum()), likely, self.coverage(low),
                float(assigned), float(hexadecimal), float(before[-1:] in (b'"', b"'")), *moves, *hashed]


def findings(docs: DataFrame, key: str, text: str, path: str, words: list[bytes]) -> DataFrame:
    """``key, start, length, secret, before, features``: byte offsets of every candidate."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for batch in batches:
            rows = []
            for key_, path_, raw in zip(*batch.columns):
                key_, path_, raw = key_.as_py(), path_.as_py(), raw.as_py()
                for start, end in candidates(raw):
                    before = raw[max(0, start - 40):start].decode("utf-8", "ignore")
                    own = raw[start:end].decode("utf-8", "replace")
                    rows.append((key_, start, end - start, own, before, judge(raw, start, end, path_)))
            columns = zip(*rows) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=["key", "start", "length", "secret", "before", "features"])

    own = docs.select(F.col(key).cast("long").alias("key"), F.col(path).cast("string").alias("path"), bytes_of(text).alias("raw"))
    return own.mapInArrow(scan, "key long, start long, length long, secret string, before string, features array<double>")


def sealed(found: DataFrame) -> DataFrame:
    """``found`` with a digest (``secret_sha256``) instead of the string, and without what stands before it."""
    return found.withColumn("secret_sha256", F.sha2("secret", 256)).drop("secret", "before")


def judged(found: DataFrame, labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``found`` with ``p_secret``. ``labelled``: findings with ``label`` 0 or 1."""
    order = ["key", "start", "length"]
    sample = labelled.filter(F.col("label").isin(0, 1)).orderBy(F.xxhash64(*order), *order).limit(train_rows)
    rows = write_and_read(sample.select("features", F.col("label").cast("double").alias("label")),
                          work_path(found.sparkSession, "secret_labels"))
    kinds = rows.agg(F.count_distinct("label"), F.avg("label")).first()
    if kinds[0] < 2:
        return found.withColumn("p_secret", F.lit(kinds[1]).cast("double"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featuresCol="vector", labelCol="label",
                                    probabilityCol="p_", rawPredictionCol="r_", predictionCol="y_")
    model = forest.fit(rows.withColumn("vector", array_to_vector("features")))
    scored = model.transform(found.withColumn("vector", array_to_vector("features")))
    return scored.withColumn("p_secret", vector_to_array("p_")[1]).drop("vector", "p_", "r_", "y_")


#: What stands before an assigned value, and a key format that is told by its first letters.
ASSIGNED = _NAMES + r"[\"']?$"
KEY_FORMAT = r"^AKIA[A-Z0-9]{16}$"
#: Share of a string in frequent words from which it is words.
WORDS = 0.9
#: Small letters, perhaps with a first capital, and such joined by signs; or numbers: hardly ever a key of 16 or more.
WORD_LIKE = r"^([A-Z]?[a-z]+([-_/+][A-Z]?[a-z]+)*|[0-9_/+-]+)$"


def known_format(found: DataFrame) -> DataFrame:
    """Labels by format, as the tables have none for findings: keys of a known format and assigned values are real; strings
    that look like words or numbers, or are made of frequent words, and are assigned to nothing, are not. All others, as
    keys of other formats or words after ``password:``, have none."""
    words = F.col("features")[5] >= WORDS
    assigned = F.col("before").rlike(ASSIGNED)
    label = F.when(F.col("secret").rlike(KEY_FORMAT) | (assigned & ~words), 1).when(
        (words | F.col("secret").rlike(WORD_LIKE)) & ~assigned, 0)
    return found.withColumn("label", label.cast("int"))


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = findings(docs, "doc_id", "text", "source", dictionary(docs, "text"))
    found = write_and_read(sealed(known_format(found)), work_path(spark, "secret_findings"))
    return judged(found.drop("label"), found).select(
        F.col("key").alias("doc_id"), "start", "length", "secret_sha256",
        F.round("p_secret", 6).alias("p_secret"), (F.col("p_secret") >= 0.5).alias("is_secret"))
