"""Token counts by section: whole texts are encoded once, and token spans are joined with section spans.

A vocabulary of byte ranks gives each token's bytes, so the spans of a text's tokens are the running sums of their lengths.
They are joined as intervals with the text's sections (disjoint, in order, in characters of the text) by binary search. A
token that lies in two sections or more is allocated by a rule: ``start`` (the section of its first byte), ``end`` (of its
last byte), ``most`` (the one with most of its bytes, the first of equals) or ``shares`` (each by its share of bytes).
Tokens of no section count for none. The counts of a text's sections add up to its tokens, but for tokens outside them.

Null and empty texts have one empty section without tokens, where sections are lines. Repeated rows are counted alike.
Documents are only mapped. Very long texts are encoded whole; text that the fast encoder refuses goes to a slower one with
the same vocabulary. An empty table gives no rows. Other columns are not looked at.
"""

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newszones.llm.words import bytes_of

RULES = ("start", "end", "most", "shares")
_encoders: dict[str, "Encoder"] = {}


class Encoder:
    def __init__(self, ranks: str, pattern: str, same: str):
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.lengths = np.zeros(max(table.values()) + 1, np.int64)
        self.lengths[list(table.values())] = [len(k) for k in table]
        self.same, self.slow = same, None

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as e:  # the encoder's own panic is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.same)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def ends(self, raw: bytes) -> np.ndarray:
        """The byte after each token."""
        return np.cumsum(self.lengths[np.array(self.ids(raw.decode("utf-8", "replace")), np.int64)])


def lines(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines of a text, each with its line feed."""
    stops = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) + 1
    if not len(stops) or stops[-1] != len(raw):
        stops = np.append(stops, len(raw))
    return np.concatenate(([0], stops[:-1])), stops


def allocate(ends: np.ndarray, first: np.ndarray, last: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many tokens that belong to it reach beyond it. Spans are ``[first, last)``."""
    starts = np.concatenate(([0], ends[:-1]))
    low = np.searchsorted(last, starts, "right")  # sections that a token may reach: low to high
    high = np.searchsorted(first, ends, "left") - 1
    high = np.maximum(high, low - 1)
    many = np.flatnonzero(high > low)
    counts = np.zeros(len(first))
    crossing = np.zeros(len(first), np.int64)
    one = high == low
    np.add.at(counts, low[one], 1.0)
    inside = (starts[one] < first[low[one]]) | (ends[one] > last[low[one]])
    np.add.at(crossing, low[one][inside], 1)
    for t in many:
        sections = np.arange(low[t], high[t] + 1)
        overlap = np.minimum(last[sections], ends[t]) - np.maximum(first[sections], starts[t])
        sections, overlap = sections[overlap > 0], overlap[overlap > 0]
        if len(sections):
            crossing[sections] += 1
            if rule == "shares":
                counts[sections] += overlap / overlap.sum()
            else:
                counts[sections[{"start": 0, "end": -1, "most": int(np.argmax(overlap))}[rule]]] += 1
    return counts, crossing


def count_tokens(docs: DataFrame, ranks: str, pattern: str, same: str, key: str = "doc_id", text: str = "text",
                 rule: str = "start", sections: str | None = None) -> DataFrame:
    """``key, section, start, end, tokens, crossing`` for each section of every row, in characters.

    ``sections`` names a column ``array<struct<start, end>>`` of character spans; without it the lines are the sections.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if ranks not in _encoders:
            _encoders[ranks] = Encoder(ranks, pattern, same)
        encoder = _encoders[ranks]
        for batch in batches:
            columns = [[] for _ in range(6)]
            for key_, raw, given in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                raw = raw.as_py()
                is_start = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
                chars = np.concatenate(([0], np.cumsum(is_start)))
                if given.is_valid:
                    spans = [(s["start"], s["end"]) for s in given.as_py() if s and s["start"] is not None and s["end"] is not None]
                    at = np.append(np.flatnonzero(is_start), len(raw))
                    clip = np.clip(np.array(spans, np.int64).reshape(-1, 2), 0, len(at) - 1)
                    first, last = at[clip[:, 0]], at[clip[:, 1]]
                else:
                    first, last = lines(raw)
                counts, crossing = allocate(encoder.ends(raw), first, last, rule)
                for column, values in zip(columns, (
                        [key_] * len(first), range(len(first)), chars[first], chars[last], counts, crossing)):
                    column.extend(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.float64(), pa.int64()])],
                names=["key", "section", "start", "end", "tokens", "crossing"])

    spans = F.col(sections) if sections else F.lit(None)
    spans = spans.cast("array<struct<start:bigint,end:bigint>>").alias("sections")
    return docs.select(F.col(key).cast("long").alias("key"), bytes_of(text).alias("raw"), spans).mapInArrow(
        run, "key long, section long, start long, end long, tokens double, crossing long")


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of each line of every document; a token across lines belongs to the line it starts in."""
    import public_tokenizers as public

    counted = count_tokens(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN,
        public.path("byte_bpe_50k.json"))
    return counted.select(F.col("key").alias("doc_id"), "section", "start", "end",
                          F.col("tokens").cast("long").alias("n_tokens"), F.col("crossing").alias("n_crossing"))
