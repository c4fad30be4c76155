"""Keyed first-wins and lookups against a history table.

Rows without a key are never duplicates of each other and never known: they pass by every shuffle here,
so that any number of them does no harm.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A set of keys up to this measured size is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 64 * 1024 * 1024
# Allowance per row of a broadcast hash relation, on top of the key's own bytes.
_ROW_OVERHEAD = 64


def first_of_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first by ``order`` (NULLs last, ties settled by the other columns); no NULL keys.

    It is an aggregation, not a window: each task reduces a key to one row before the shuffle, so a key
    that holds a large part of all rows costs no more than any other.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(_ranked(df, [key], order)).alias("__first"))
        .select(*[F.col(key) if c == key else F.col(f"__first.{c}").alias(c) for c in df.columns])
    )


def _ranked(df: DataFrame, leave_out: list[str], order: list[str]):
    """A row as one value, ordered by ``order`` with NULLs last, then by the other columns."""
    rest = [c for c in df.columns if c not in leave_out and c not in order]
    return F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"__{c}_missing"), F.col(c))], *rest)


_KEY = "__key"


def _firsts(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """As ``first_wins``, with the column ``__key`` that the rows are dealt by: a row without a key has its own digest there.

    One scan does for both kinds. Rows without a key that are equal in every column travel as one, with their number.
    """
    whole = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).cast("binary"), 256)
    dealt = F.coalesce(F.col(key), F.concat(F.lit("\0"), whole))
    firsts = df.withColumn(_KEY, dealt).groupBy(_KEY).agg(
        F.min(_ranked(df, [], order)).alias("__first"), F.count("*").alias("__rows"))
    copies = F.when(F.col(f"__first.{key}").isNull(), F.col("__rows")).otherwise(F.lit(1).cast("long"))
    return firsts.select(_KEY, "__first", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias("__copy")).select(
        _KEY, *[F.col(f"__first.{c}").alias(c) for c in df.columns])


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key, as ``first_of_key``, and all rows without a key."""
    return _firsts(df, key, order).drop(_KEY)


def broadcast_if_small(keys: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``keys`` marked for broadcast if their measured size allows it, else None. Runs one aggregation."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in keys.columns),
               F.lit(_ROW_OVERHEAD))
    measured = keys.agg(F.sum(size.cast("bigint")).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(keys) if measured <= max_bytes else None


#: Parts that a key's rows are dealt into for a semi-join that cannot broadcast.
_PARTS = 16


def _lookup(batch, history, key, how, max_bytes, keys) -> DataFrame:
    keyed = batch.filter(F.col(key).isNotNull())
    known = history.select(key).filter(F.col(key).isNotNull())
    keys = (batch if keys is None else keys).select(key).filter(F.col(key).isNotNull()).distinct()
    small = broadcast_if_small(keys, max_bytes)
    if small is None:
        if how != "left_semi":
            return keyed.join(known, key, how)
        # All rows of one key may be a large part of the batch: they are dealt into parts, and the known keys into as many.
        hits = known.join(keys, key, "left_semi").distinct().withColumn(
            "__part", F.explode(F.sequence(F.lit(0), F.lit(_PARTS - 1))))
        part = F.pmod(F.xxhash64(*batch.columns), F.lit(_PARTS)).cast("int")
        return keyed.withColumn("__part", part).join(hits, [key, "__part"], how)
    # The history is scanned once, by its key column alone, and not shuffled. What is left of it is part
    # of the measured keys, hence as small as they are.
    hits = known.join(small, key, "left_semi").distinct()
    return keyed.join(F.broadcast(hits), key, how)


def unknown_keys(
    batch: DataFrame, history: DataFrame, key: str, max_bytes: int = BROADCAST_BYTES, keys: DataFrame | None = None,
) -> DataFrame:
    """Rows with a key that is not in the history; ``keys`` as in ``new_rows``."""
    return _lookup(batch, history, key, "left_anti", max_bytes, keys).select(batch.columns)


def new_rows(
    batch: DataFrame, history: DataFrame, key: str, max_bytes: int = BROADCAST_BYTES, keys: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key is not in the history, and those without a key.

    ``keys`` may name a frame that holds at least the batch's keys and is cheaper to compute than the batch.
    """
    return unknown_keys(batch, history, key, max_bytes, keys).unionByName(batch.filter(F.col(key).isNull()))


def new_firsts(batch: DataFrame, history: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``first_wins``, then ``new_rows``, in one plan that reads the batch once.

    The firsts are partitioned by key already; of the history one column is shuffled, or broadcast if it turns out small.
    Rows without a key are dealt by their own digests, which no key equals.
    """
    known = history.filter(F.col(key).isNotNull()).select(F.col(key).alias(_KEY))
    return _firsts(batch, key, order).join(known, _KEY, "left_anti").select(batch.columns)


def known_rows(
    batch: DataFrame, history: DataFrame, key: str, max_bytes: int = BROADCAST_BYTES, keys: DataFrame | None = None,
) -> DataFrame:
    """Rows whose key is in the history already; ``keys`` as in ``new_rows``."""
    return _lookup(batch, history, key, "left_semi", max_bytes, keys).select(batch.columns)
