"""Quality rules on tokeniser fertility: how a public vocabulary cuts a text, judged by bands per language.

Every text is encoded whole, as its words joined by single spaces. Three measures are taken, in thousandths: characters per
token, the share of tokens that are single bytes (characters that the vocabulary lacks), and the entropy of the tokens in
bits. Texts in capitals or full of signs have short tokens, repeated words have little entropy, and foreign scripts or
broken encodings have many bytes.

Bands come from the corpus: texts that pass the base rules are counted per language, length class (a power of two of
tokens, as short texts vary more and have less entropy) and value, so quartiles are exact and a language that a third of all
rows have is no hot spot. A value is outside if it is further from the quartiles than ``WIDTH`` times their distance plus
``SLACK``. Classes of fewer than ``MIN_TEXTS`` texts have no band and reject nothing.

The base rules: fewer than 50 words, or more than half of the words in three-word windows that the text has twice.

Null and empty texts have no words and fail the base rules. A null language is a language of its own. Repeated rows are
judged alike, and each counts. Very long texts are encoded in runs of words, with the same tokens. An empty table gives no
rows. Other columns are not looked at.
"""

import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newszones.llm.words import SPACES, bytes_of
from newszones.operators.dedupe import broadcast_if_small
from newszones.sources.storage import work_path, write_and_read

MODEL = "piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
#: Fences of the bands: times the distance of the quartiles, and thousandths beside it; texts that make a band.
WIDTH = 2
SLACK = {"chars_per_token": 50, "byte_share": 20, "entropy": 100}
MIN_TEXTS = 100
#: Words encoded at once.
RUN = 1 << 16

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens", "entropy"]


@functools.lru_cache(2)
def _model(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.vocab_size())])


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three words that occur twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    at = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    pairs = np.unique(at[:-1] * len(numbers) + at[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:n] * len(numbers) + at[2:], return_inverse=True, return_counts=True)
    hit = np.zeros(len(words), bool)
    twice = times[which] > 1
    for k in range(3):
        hit[k:k + n] |= twice
    return int(hit.sum())


def token_numbers(words: list[bytes], path: str) -> tuple[int, int, int]:
    """Tokens, byte tokens, and the entropy of the tokens in thousandths of a bit."""
    model, is_byte = _model(path)
    times = np.zeros(len(is_byte), np.int64)
    for at in range(0, len(words), RUN):
        ids = model.encode(b" ".join(words[at:at + RUN]).decode("utf-8", "replace"))
        times += np.bincount(ids, minlength=len(is_byte))
    total = int(times.sum())
    if not total:
        return 0, 0, 0
    share = times[times > 0] / total
    return total, int(times[is_byte].sum()), int(-1000 * (share * np.log2(share)).sum() + 0.5)


def measure_text(raw: bytes, path: str) -> tuple[int, ...]:
    """The numbers of one text, in the order of ``COUNTS``; texts without enough words are not encoded."""
    words = raw.split()
    chars = int(np.count_nonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    spaces = len(raw) - len(raw.translate(None, SPACES.encode()))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    tokens = token_numbers(words, path) if len(words) >= MIN_WORDS else (0, 0, 0)
    return (len(words), chars - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), *tokens)


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
            model: str | None = None) -> DataFrame:
    """``key, lang`` and the ``COUNTS`` of every row. ``model`` is a path that workers can read."""
    path = model or public_tokenizers.path(MODEL)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure_text(x.as_py(), path) for x in batch.column(2)]
            columns = zip(*found) if found else [[] for _ in COUNTS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in columns]], names=["key", "lang", *COUNTS])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(lang).cast("string").alias("lang"), bytes_of(text).alias("raw"))
    return rows.mapInArrow(scan, "key long, lang string, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _measures():
    tokens = F.greatest("n_tokens", F.lit(1))
    return {"chars_per_token": F.expr("1000 * word_chars div greatest(n_tokens, 1)"),
            "byte_share": F.expr("1000 * n_byte_tokens div greatest(n_tokens, 1)"), "entropy": F.col("entropy"),
            "class": F.floor(F.log2(tokens.cast("double"))).cast("int")}


def bands(measured: DataFrame, width: int = WIDTH, slack: dict[str, int] = SLACK, min_texts: int = MIN_TEXTS) -> DataFrame:
    """``lang, class`` and the lowest and highest value allowed of each measure, from texts that pass the base rules."""
    rows = measured.filter(~base_failed()).select("lang", *[x.alias(c) for c, x in _measures().items()])
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in slack]))
    counted = (rows.select("lang", "class", values.alias("x")).groupBy("lang", "class", "x.measure", "x.value")
               .agg(F.count("*").alias("n")))
    of = Window.partitionBy("lang", "class", "measure")
    upto = F.sum("n").over(of.orderBy("value"))
    total = F.sum("n").over(of)
    quartiles = counted.select("*", upto.alias("upto"), total.alias("total")).groupBy("lang", "class", "measure").agg(
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("value"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("value"))).alias("q3"), F.max("total").alias("texts"))
    allowed = F.create_map(*[x for m, s in slack.items() for x in (F.lit(m), F.lit(s))])[F.col("measure")]
    far = F.lit(width) * (F.col("q3") - F.col("q1")) + allowed
    fences = quartiles.filter(F.col("texts") >= min_texts).withColumn("far", far)
    return fences.groupBy("lang", "class").agg(*[
        F.max(F.when(F.col("measure") == m, x)).alias(f"{m}_{end}")
        for m in slack for end, x in (("low", F.col("q1") - F.col("far")), ("high", F.col("q3") + F.col("far")))])


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``base_failed``, the measures, and ``kept``."""
    own = measured.withColumns({**_measures(), "base_failed": base_failed()})
    limits = limits.withColumnRenamed("lang", "lang_").withColumnRenamed("class", "class_")
    small = broadcast_if_small(limits)
    met = own.join(limits if small is None else small,
                   F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("class") == F.col("class_")), "left")
    inside = F.lit(True)
    for m in SLACK:
        inside = inside & F.coalesce(F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(True))
    return met.withColumn("kept", ~F.col("base_failed") & inside).select(*own.columns, "kept")


def rules(docs: DataFrame, **options) -> DataFrame:
    """Measures and verdicts of every row of ``doc_id, lang, text``."""
    spark = docs.sparkSession
    measured = write_and_read(measure(docs, **options), work_path(spark, "fertility"))
    limits = write_and_read(bands(measured), work_path(spark, "fertility_bands"))
    return judge(measured, limits)


def op12_quality_rules(spark, sf_dir: str) -> DataFrame:
    found = rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "chars_per_token", "byte_share", "entropy")
