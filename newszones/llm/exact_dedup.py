"""Exact deduplication by digest, with a minimal perfect hash over the digests of earlier batches.

Two texts are equal when they are identical without white space; the digest is the SHA-256 of that text. Of equal texts the
row with the most code points stays, then the one with the smallest key. The history is an index: segments of a minimal
perfect hash, whose slots hold the full digest and the locator of the winner (its key, its length and the group's size).
A new batch is grouped by digest first, so that a digest that a third of all rows share reaches a lookup as one row;
a slot counts only if all 32 bytes of its digest are those asked for. Members join their slot's group, the others form
groups of their own.

Null text counts as empty, and all empty or blank texts are equal. Rows without key are grouped like others, but win only
where no other row has as many code points. Repeated rows are copies of each other; an empty table gives no rows. Columns
other than key and text are not looked at.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newszones.llm import mph
from newszones.llm.words import SPACES
from newszones.sources.storage import work_path, write_and_read

#: Digests to a segment on average. One task builds a segment or looks into it.
SEGMENT_KEYS = 2048
_SLOT = np.dtype([("digest", "V32"), ("key", "<i8"), ("has_key", "<i8"), ("chars", "<i8"), ("rows", "<i8")])
_LOOKUP = "digest binary, h_chars long, h_key long, h_rows long"


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, digest, chars`` of every row."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).cast("long").alias("key"),
        F.unhex(F.sha2(F.translate(whole, SPACES, ""), 256)).alias("digest"),
        F.length(whole).cast("long").alias("chars"))


def winners(rows: DataFrame) -> DataFrame:
    """``digest, chars, key, rows``: of each digest the row that stays and the number of rows."""
    # The complement turns the order of keys round without overflow; no key is less than any.
    best = F.max(F.struct("chars", F.bitwise_not("key").alias("turned")))
    return (rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("rows"))
            .select("digest", F.col("best.chars").alias("chars"), F.bitwise_not("best.turned").alias("key"), "rows"))


def _bucket(n_segments: int):
    return F.pmod(F.xxhash64("digest"), F.lit(n_segments)).cast("int").alias("segment")


def _halves(digest: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(digest), "<u8").reshape(-1, 4)
    return raw[:, 0], raw[:, 1], np.frombuffer(b"".join(digest), "V32")


class History:
    """The index of a history: ``table`` has ``segment int, data binary``."""

    def __init__(self, table: DataFrame, n_segments: int):
        self.table, self.n_segments = table, n_segments

    @staticmethod
    def build(won: DataFrame, segment_keys: int = SEGMENT_KEYS) -> "History":
        """Index the rows of :func:`winners`; written to the shared folder."""
        spark = won.sparkSession
        won = write_and_read(won, work_path(spark, "winners"))
        n_segments = max(1, -(-won.count() // segment_keys))

        def segment(pdf: pd.DataFrame) -> pd.DataFrame:
            a, b, whole = _halves(pdf.digest)
            slots = np.zeros(len(pdf), _SLOT)
            slots["digest"], slots["chars"], slots["rows"] = whole, pdf.chars, pdf.rows
            slots["key"], slots["has_key"] = pdf.key, pdf.has_key
            return pd.DataFrame({"segment": pdf.segment.iloc[:1], "data": [mph.build(a, b, slots)]})

        # A column of longs with nulls would reach pandas as doubles.
        flat = won.withColumns({"has_key": F.col("key").isNotNull(), "key": F.coalesce("key", F.lit(0).cast("long"))})
        table = flat.select(_bucket(n_segments), "*").groupBy("segment").applyInPandas(segment, "segment int, data binary")
        return History(write_and_read(table, work_path(spark, "digest_index")), n_segments)

    def lookup(self, probes: DataFrame) -> DataFrame:
        """What the slots hold for the distinct digests of ``probes``; no row for digests that are not in the history."""

        def look(_, asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
            if not len(asked) or not len(index):
                return pd.DataFrame({"digest": [], "h_chars": [], "h_key": [], "h_rows": []})
            segment = mph.Segment(index.data.iloc[0], _SLOT)
            a, b, whole = _halves(asked.digest)
            at = segment.slots(a, b)
            found = np.flatnonzero(at >= 0)
            slots = segment.records[at[found]]
            same = slots["digest"] == whole[found]
            found, slots = found[same], slots[same]
            key = pd.Series(slots["key"], dtype="Int64").where(slots["has_key"] == 1)
            return pd.DataFrame({"digest": asked.digest.to_numpy()[found], "h_chars": slots["chars"], "h_key": key,
                                 "h_rows": slots["rows"]})

        asked = probes.select(_bucket(self.n_segments), "digest").groupBy("segment")
        return asked.cogroup(self.table.groupBy("segment")).applyInPandas(look, _LOOKUP)


def resolve(batch: DataFrame, history: History) -> DataFrame:
    """``digest, chars, key, rows, member``: the groups of a batch (:func:`winners`), joined with their historical ones."""
    found = history.lookup(batch)
    a = F.struct("chars", F.bitwise_not("key").alias("turned"))
    b = F.struct(F.col("h_chars").alias("chars"), F.bitwise_not("h_key").alias("turned"))
    return (batch.join(found, "digest", "left")
            .withColumn("best", F.when(F.col("h_rows").isNull(), a).otherwise(F.greatest(a, b)))
            .select("digest", F.col("best.chars").alias("chars"), F.bitwise_not("best.turned").alias("key"),
                    (F.col("rows") + F.coalesce("h_rows", F.lit(0))).alias("rows"),
                    F.col("h_rows").isNotNull().alias("member")))


def dedup(docs: DataFrame, is_history, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Verdicts over a table that came in two parts: ``is_history`` (a column on ``key``) holds for the earlier rows.

    One row per row: ``key, keep, rows, digest``. The result does not depend on where the table is cut.
    """
    spark = docs.sparkSession
    rows = write_and_read(digests(docs, key, text), work_path(spark, "digests"))
    earlier = F.coalesce(is_history, F.lit(True))
    old = winners(rows.filter(earlier))
    history = History.build(old)
    new = write_and_read(resolve(winners(rows.filter(~earlier)), history), work_path(spark, "resolved"))
    groups = old.join(new.filter("member").select("digest"), "digest", "left_anti").unionByName(new.drop("member"))
    return rows.join(groups.select("digest", F.col("key").alias("keep"), "rows"), "digest")


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document: the half with the smaller ids is the history, the other half the new batch."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    out = dedup(docs, F.col("key") <= F.lit(middle))
    return out.select(F.col("key").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("rows").alias("group_size"),
                      F.col("key").eqNullSafe(F.col("keep")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256,
         length(coalesce(text, '')) AS chars
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS kept,
       text_sha256
FROM d
"""
