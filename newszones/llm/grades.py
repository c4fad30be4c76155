"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight per hashed feature is shared by all grades, and ascending thresholds ``t1 < t2 < ...`` divide the score:
``P(grade >= k) = sigmoid(score - t_k)``. The expected grade is the sum of those tails over k, and a document is selected
if the tail of the wanted grade reaches a limit.

Features of a whole text: presence of each word and of word beginnings, shares of token shapes (case and the signs at the
ends), and coarse classes of how much tokens and lines repeat. All are hashed into one fixed table, so the model that is
broadcast has a fixed size. It is fitted with numpy on at most ``train_rows`` labelled documents, chosen by a hash of
their keys; features that fewer than ``MIN_DOCS`` of them have, or that tell nothing about the grade, are left out. Scoring maps the documents and shuffles
nothing.

Null and empty texts are scored by their repeat classes alone. Labels that are null or of documents that are not there do
not count; of several labels of one document the lowest grade counts. Without any label every document is selected and
has null grade. Repeated rows are scored alike, and documents keep their columns whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newszones.llm.words import bytes_of, fresh_name, through_python

BITS = 18
TRAIN_ROWS = 8000
MIN_DOCS = 3
MIN_Z = 3.0
KNOWN_TOKENS = 200_000
ROUNDS = 200
L2 = 1e-4
_SIGNS = bytes(b for b in range(128) if not chr(b).isalnum())


def _slot(kind: str, value: bytes) -> int:
    return xxhash.xxh32_intdigest(kind.encode() + value) & ((1 << BITS) - 1)


class Features:
    """Hashed features of texts as ``(slots, values)``."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.table = np.empty((1 << 10, 3), np.int64)  # word, beginning, shape

    def _learn(self, tokens: set[bytes]) -> None:
        new = tokens.difference(self.known)
        if new and len(self.known) > KNOWN_TOKENS:
            self.known.clear()
            new = tokens
        if len(self.known) + len(new) > len(self.table):
            more = np.empty((len(self.known) + len(new), 3), np.int64)
            self.table = np.concatenate((self.table, more))
        for token in new:
            core = token.strip(_SIGNS)
            text = core.decode("utf-8", "replace")
            case = "0" if not core else "A" if text.isupper() else "a" if text.islower() else "Aa" if text.istitle() else "x"
            head = token[:2] if token[0] in _SIGNS else b""
            tail = token[-2:] if core and token[-1] in _SIGNS else b""
            word = text.lower().encode()
            self.table[len(self.known)] = (
                _slot("w", word), _slot("b", text.lower()[:5].encode()),
                _slot("s", case.encode() + b"|" + head + b"|" + tail))
            self.known[token] = len(self.known)

    def __call__(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        tokens = raw.split()
        self._learn(set(tokens))
        n = max(1, len(tokens))
        codes = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        own = np.unique(codes)
        present = np.unique(self.table[own][:, :2].ravel()) if len(own) else np.empty(0, np.int64)
        shapes, counts = np.unique(self.table[codes, 2], return_counts=True) if len(codes) else (present, present)
        lines = [x for x in raw.split(b"\n") if x.strip()]
        again = float((codes[1:] == codes[:-1]).mean()) if len(codes) > 1 else 0.0
        classes = [
            _slot("again", b"%d" % int(20 * again)), _slot("distinct", b"%d" % int(10 * len(own) / n)),
            _slot("lines", b"%d" % int(10 * (1 - len(set(lines)) / max(1, len(lines))))),
            _slot("rest", b"%d%d" % (min(9, int(10 * (1 - len(own) / n))), min(9, n.bit_length() // 2)))]
        slots = np.concatenate((present, shapes, classes)).astype(np.int32)
        values = np.concatenate((np.ones(len(present)), 6.0 * counts / n, np.ones(len(classes)))).astype(np.float32)
        return slots, values


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    def tails(self, slots: np.ndarray, values: np.ndarray) -> np.ndarray:
        """``P(grade >= k)`` for k from 1."""
        score = float(self.weights[slots] @ values)
        return 1 / (1 + np.exp(-np.clip(score - self.thresholds, -500, 500)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam over all rows; the same input gives the same model."""
    lengths = np.array([len(s) for s, _ in rows])
    slots, values = (np.concatenate(x) for x in zip(*rows))
    row = np.repeat(np.arange(len(rows), dtype=np.int32), lengths)
    # A feature is of use if the mean grade of its documents is further from the overall mean than chance explains.
    seen = np.bincount(slots, minlength=1 << BITS)
    far = np.abs(np.bincount(slots, (grades - grades.mean())[row], 1 << BITS)) / np.sqrt(np.maximum(seen, 1))
    kept = (seen >= MIN_DOCS) & (far >= MIN_Z * max(grades.std(), 1e-9))
    dense = np.cumsum(kept) - 1
    use = kept[slots]
    slots, values, row = dense[slots[use]].astype(np.int32), values[use], row[use]
    n_features = int(kept.sum())
    # Thresholds as the first one and the logarithms of the steps.
    share = np.clip([(grades >= k).mean() for k in range(1, n_grades)], 0.01, 0.99)
    start = -np.log(share / (1 - share))
    p = np.concatenate((np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 0.1))))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, ROUNDS + 1):
        w, t = p[:n_features], np.cumsum(np.concatenate((p[n_features:n_features + 1], np.exp(p[n_features + 1:]))))
        score = np.bincount(row, w[slots] * values, len(rows))
        bounds = np.concatenate(([-np.inf], t, [np.inf]))
        low, high = bounds[grades] - score, bounds[grades + 1] - score
        s_low, s_high = (1 / (1 + np.exp(-np.clip(x, -500, 500))) for x in (low, high))
        d_low, d_high = s_low * (1 - s_low), s_high * (1 - s_high)
        prob = np.maximum(s_high - s_low, 1e-12)
        g_score = (d_high - d_low) / prob / len(rows)
        g_t = np.array([((grades == k) * d_low - (grades == k - 1) * d_high) @ (1 / prob) for k in range(1, n_grades)])
        g_t /= len(rows)
        g = np.concatenate((np.bincount(slots, g_score[row] * values, n_features) + L2 * w,
                            [g_t.sum()], [g_t[k:].sum() * np.exp(p[n_features + k]) for k in range(1, n_grades - 1)]))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    weights = np.zeros(1 << BITS, np.float32)
    weights[kept] = p[:n_features]
    return Model(weights, np.cumsum(np.concatenate((p[n_features:n_features + 1], np.exp(p[n_features + 1:])))))


def train(docs: DataFrame, graded: DataFrame, n_grades: int, key: str = "doc_id", text: str = "text",
          train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most ``train_rows`` of ``graded`` (``key``, ``grade`` from 0); None if there are none."""
    labels = (graded.filter(F.col("grade").between(0, n_grades - 1) & F.col(key).isNotNull())
              .groupBy(F.col(key).alias("key_")).agg(F.min("grade").cast("int").alias("grade_"))
              .orderBy(F.xxhash64("key_"), "key_").limit(train_rows))
    rows = docs.select(F.col(key).alias("key_"), bytes_of(text).alias("raw_")).join(F.broadcast(labels), "key_")
    rows = rows.dropDuplicates(["key_"]).select("key_", "grade_", "raw_")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features()
        for batch in batches:
            got = [of(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([s.tobytes() for s, _ in got], pa.binary()),
                 pa.array([v.tobytes() for _, v in got], pa.binary())], names=["key_", "grade_", "slots", "values"])

    key_type = rows.schema["key_"].dataType
    schema = T.StructType([T.StructField("key_", key_type), T.StructField("grade_", T.IntegerType()),
                           T.StructField("slots", T.BinaryType()), T.StructField("values", T.BinaryType())])
    sample = sorted(rows.mapInArrow(features, schema).toLocalIterator(), key=lambda r: str(r.key_))
    if not sample:
        return None
    return fit([(np.frombuffer(r.slots, np.int32), np.frombuffer(r["values"], np.float32)) for r in sample],
               np.array([r.grade_ for r in sample]), n_grades)


def score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "tails_") -> DataFrame:
    """``docs`` with ``out``: the tail probabilities of grades 1 and up, null without a model. :func:`fresh_name` gives a
    name that no column has. The text goes to Python once, as bytes, and comes back."""
    tails = T.ArrayType(T.DoubleType())
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.lit(None).cast(tails).alias(out))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features()
        for batch in batches:
            got = [shared.value.tails(*of(x.as_py() or b"")).tolist() for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(got, pa.list_(pa.float64()))], names=[*batch.schema.names, "tails"])

    inside, outside, at = through_python(docs, text)
    scored = inside.mapInArrow(run, T.StructType([*inside.schema.fields, T.StructField("tails", tails)]))
    return scored.select(*outside, F.col("tails").alias(out))


#: Grades of the given labels: toxic 0, poor 1, good 2.
N_GRADES = 3


def given_grades(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def expected_grade(tails: str = "tails_") -> Column:
    return F.aggregate(tails, F.lit(0.0), lambda a, x: a + x)


def selected(grade: int = 2, least: float = 0.5, tails: str = "tails_") -> Column:
    """Documents whose probability of at least ``grade`` reaches ``least``."""
    return F.coalesce(F.element_at(tails, grade) >= least, F.lit(True))


def graded_documents(spark, docs: DataFrame, sf_dir: str, out: str = "tails_") -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labelled = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(labelled, given_grades(labels), N_GRADES), out=out)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = graded_documents(spark, docs, sf_dir)
    return scored.select("doc_id", F.round(expected_grade(), 6).alias("expected_grade"),
                         F.round(F.element_at("tails_", 2), 6).alias("p_good"),
                         F.round(F.element_at("tails_", 1), 6).alias("p_not_toxic"), selected().alias("selected"))


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's stage: documents that the classifier selects."""
    tails = fresh_name(docs, "tails_")
    return graded_documents(spark, docs, sf_dir, tails).filter(selected(tails=tails)).drop(tails)
