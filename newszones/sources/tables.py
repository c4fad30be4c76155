"""The zone tables: Parquet folders under a ledger (:mod:`newszones.sources.ledger`), with a narrow table of keys beside.

A batch is one chunk, ``rows/chunk=<name>``; a replay replaces it as a whole by a new one. Small chunks are merged, tier by
tier, so their number stays bounded; a batch that was merged is finished, and a replay of it adds nothing. The key table
holds the URLs in ``keys/chunk=<name>/bucket=<hash>``, so that a lookup opens the folders of its own hashes only.
"""

import time
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newszones import schemas
from newszones.sources import ledger
from newszones.sources.ledger import Chunk, State
from newszones.sources.storage import folder_names, path_exists, remove_path

MONTH = "fecha_mes"
NO_MONTH = "none"
KEY = "url"
#: Folders of keys to a chunk. Chunks with few keys have one folder for all, so that small batches make few files.
BUCKETS = 64
MIXED = -1
SMALL_KEYS = 10_000
#: Chunks of one tier that are merged into one of the next.
FAN = 8
#: Seconds for which folders stay that are no longer part of a table, for readers that still use them.
RETENTION = 24 * 3600


@dataclass(frozen=True)
class ZoneTables:
    """Paths below one root folder."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def refined(self) -> str:
        return f"{self.root}/refined"

    @property
    def consumption(self) -> str:
        return f"{self.root}/consumption"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def failures(self) -> str:
        return f"{self.root}/failures"


def month_of(day: Column) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


# Reading

def read_table(spark: SparkSession, path: str, schema: T.StructType, *more: str,
               without_batch: str | None = None, state: State | None = None) -> DataFrame:
    """The table's rows; an empty frame before the first batch. ``more`` names columns beside the schema to keep."""
    state = state or ledger.read(spark, path)
    beside = ["batch_key", MONTH] if schema is schemas.CONSUMPTION else ["batch_key"]
    full = T.StructType([*schema.fields, *[T.StructField(p, T.StringType()) for p in beside]])
    chunks = [c for c in state.chunks if c.rows and (without_batch is None or c.batch != without_batch)]
    df = _read_chunks(spark, path, full, chunks)
    if without_batch is not None and any(c.batch is None for c in chunks):
        df = df.filter(F.col("batch_key") != without_batch)
    return df.select(*schema.names, *more)


def _read_chunks(spark: SparkSession, path: str, schema: T.StructType, chunks: list[Chunk]) -> DataFrame:
    if not chunks:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/rows/chunk={c.name}" for c in chunks]
    return spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*folders)


def read_refined(spark: SparkSession, tables: ZoneTables, *more: str, without_batch: str | None = None,
                 state: State | None = None) -> DataFrame:
    return read_table(spark, tables.refined, schemas.REFINED, *more, without_batch=without_batch, state=state)


def read_consumption(spark: SparkSession, tables: ZoneTables, *more: str, without_batch: str | None = None,
                     state: State | None = None) -> DataFrame:
    return read_table(spark, tables.consumption, schemas.CONSUMPTION, *more, without_batch=without_batch, state=state)


def read_quarantine(spark: SparkSession, tables: ZoneTables, *more: str) -> DataFrame:
    return read_table(spark, tables.quarantine, schemas.QUARANTINE, *more)


def read_failures(spark: SparkSession, tables: ZoneTables) -> DataFrame:
    return read_table(spark, tables.failures, schemas.FAILURES)


def known_keys(spark: SparkSession, path: str, state: State, keys: DataFrame | None = None,
               without_batch: str | None = None) -> DataFrame:
    """URLs of the table. With ``keys``, at least those of them that are there: only folders of their hashes are listed and
    read, unless they have all of them. Runs one job that gathers at most ``BUCKETS`` numbers."""
    chunks = [c for c in state.chunks if c.buckets and (without_batch is None or c.batch != without_batch)]
    return _read_keys(spark, path, state, chunks, keys)


def _read_keys(spark: SparkSession, path: str, state: State, chunks: list[Chunk], keys: DataFrame | None) -> DataFrame:
    schema = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("bucket", T.IntegerType())])
    wanted = None
    if keys is not None and any(c.buckets != (MIXED,) for c in chunks):
        wanted = {r[0] for r in keys.filter(F.col(KEY).isNotNull()).select(
            bucket_of(F.col(KEY), state.buckets or BUCKETS)).distinct().collect()}
    folders = []
    for c in chunks:
        own = [b for b in c.buckets if wanted is None or b == MIXED or b in wanted]
        folder = f"{path}/keys/chunk={c.name}"
        folders += [folder] if len(own) == len(c.buckets) else [f"{folder}/bucket={b}" for b in own]
    if not folders:
        return spark.createDataFrame([], schema).select(KEY)
    return spark.read.schema(schema).option("basePath", f"{path}/keys").parquet(*folders).select(KEY)


def complete_batches(spark: SparkSession, path: str) -> ledger.Batches:
    """Keys of the batches that were written to the end; a batch without rows is one as well."""
    return ledger.read(spark, path).batches


# Writing

def batch_clock(spark: SparkSession, tables: "ZoneTables", batch_key: str) -> Column:
    """The time a batch was first run at, as local time of the session; a replay of the batch gets the same."""
    path = f"{tables.root}/clocks/batch_key={batch_key}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.range(1).select(F.localtimestamp().cast("string").alias("as_of")).coalesce(1).write.mode("overwrite").text(path)
    return F.to_timestamp_ntz(F.lit(spark.read.text(path).first()[0]))


def _write_rows(df: DataFrame, path: str, name: str, by_month: bool) -> dict:
    """Write a chunk's folder; its numbers of rows and keys come out of the write itself."""
    seen = Observation()
    has_key = KEY in df.columns
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"), (F.count(KEY) if has_key else F.lit(0)).alias("keys"))
    if by_month:
        # The rebalance gives each month as many files as its size needs, not one for each task.
        df = df.withColumn(MONTH, month_of(F.col("fecha_noticia"))).hint("rebalance", MONTH)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(MONTH) if by_month else writer).parquet(f"{path}/rows/chunk={name}")
    return seen.get


def _write_keys(keys: DataFrame, path: str, name: str, n: int, buckets: int) -> tuple[int, ...]:
    """Write the keys of a chunk; the buckets it has."""
    if not n:
        return ()
    folder = f"{path}/keys/chunk={name}"
    if n <= SMALL_KEYS:
        keys.coalesce(1).write.mode("overwrite").parquet(f"{folder}/bucket={MIXED}")
        return (MIXED,)
    dealt = keys.withColumn("bucket", bucket_of(F.col(KEY), buckets)).hint("rebalance", "bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    return tuple(sorted(int(x.partition("=")[2]) for x in folder_names(keys.sparkSession, folder) if x.startswith("bucket=")))


def _written(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/rows/chunk={name}")


def _add_chunk(df: DataFrame, path: str, batch_key: str, by_month: bool, with_keys: bool, buckets: int) -> Chunk:
    spark, name = df.sparkSession, ledger.new_name()
    counts = _write_rows(df.withColumn("batch_key", F.lit(batch_key)), path, name, by_month)
    keys = ()
    if with_keys and counts["keys"]:
        written = _written(spark, path, name, T.StructType([T.StructField(KEY, T.StringType())]))
        keys = _write_keys(written.filter(F.col(KEY).isNotNull()), path, name, counts["keys"], buckets)
    return Chunk(name, batch_key, 0, counts["rows"], keys)


def write_batch(df: DataFrame, path: str, batch_key: str, since: State | None = None, by_month: bool = False,
                with_keys: bool = True, still_open: list[str] | None = None) -> Chunk | None:
    """Make ``df`` the whole content of the batch, unless the batch was merged with others long ago (None then).

    With ``since``, the state that ``df`` was compared with, a URL stays unique among all writers: what others have
    committed since then is looked up before the commit, and rows whose URL they have are taken out. ``still_open`` replaces
    the list of batches that the next table lacks.
    """
    spark = df.sparkSession
    base = since or ledger.read(spark, path)
    if base.merged(batch_key):
        return None
    buckets = base.buckets or BUCKETS
    chunk = _add_chunk(df, path, batch_key, by_month, with_keys, buckets)
    seen, schema = base.version, df.withColumn("batch_key", F.lit("")).schema

    def change(now: State) -> State | None:
        nonlocal chunk, seen
        if now.merged(batch_key):
            remove_chunk(spark, path, chunk.name)
            return None
        others = [c for c in now.chunks if c.version > seen and c.batch != batch_key and c.buckets]
        if since is not None and others and chunk.buckets:
            own = _read_keys(spark, path, now, [chunk], None)
            taken = own.join(_read_keys(spark, path, now, others, own), KEY, "left_semi")
            if not taken.isEmpty():
                rest = _written(spark, path, chunk.name, schema).drop("batch_key").join(taken, KEY, "left_anti").select(
                    *[c for c in schema.names if c != "batch_key"])
                old, chunk = chunk, _add_chunk(rest, path, batch_key, by_month, with_keys, buckets)
                remove_chunk(spark, path, old.name)
        seen = now.version
        chunk = replace(chunk, version=now.version + 1)
        new = replace(now.with_chunk(chunk), buckets=buckets)
        return new if still_open is None else replace(new, open=tuple(dict.fromkeys([*still_open, batch_key])))

    ledger.commit(spark, path, change, None if since is None else since)
    return chunk


def write_consumption_batch(df: DataFrame, path: str, batch_key: str, since: State | None = None) -> Chunk | None:
    """As ``write_batch``, below that one folder per month so that date filters skip files."""
    return write_batch(df, path, batch_key, since, by_month=True)


def drop_batch(spark: SparkSession, path: str, batch_key: str) -> None:
    """Take a batch that has its own chunk out of the table."""
    if ledger.read(spark, path).merged(batch_key):
        raise ValueError(f"batch {batch_key} was merged with others")
    ledger.commit(spark, path, lambda now: now.without_batch(batch_key))


def remove_chunk(spark: SparkSession, path: str, name: str) -> None:
    for part in ("rows", "keys"):
        remove_path(spark, f"{path}/{part}/chunk={name}")


# Maintenance

def compact(spark: SparkSession, path: str, schema: T.StructType, fan: int = FAN, retention: float = RETENTION) -> int:
    """Merge chunks wherever a tier has ``fan`` of them; the number of merges. Readers and writers may go on meanwhile.

    A row is rewritten once for each tier it climbs, and there are about ``fan`` chunks to a tier.
    """
    merges, state = 0, ledger.read(spark, path)
    while True:
        tiers: dict[int, list[Chunk]] = {}
        for c in state.chunks:
            tiers.setdefault(c.tier, []).append(c)
        full = next((t for t, chunks in sorted(tiers.items()) if len(chunks) >= fan), None)
        if full is None:
            break
        state, done = _merge(spark, path, schema, state, tiers[full])
        merges += done
    vacuum(spark, path, retention, state)
    return merges


def _merge(spark: SparkSession, path: str, schema: T.StructType, state: State, old: list[Chunk]) -> tuple[State, int]:
    by_month = schema is schemas.CONSUMPTION
    full = T.StructType([*schema.fields, T.StructField("batch_key", T.StringType())])
    rows = [c for c in old if c.rows]
    merged = Chunk("", None, max(c.version for c in old), 0, (), max(c.tier for c in old) + 1)
    if rows:
        name = ledger.new_name()
        df = _read_chunks(spark, path, full, rows).select(*full.names)
        counts = _write_rows(df if by_month else df.hint("rebalance"), path, name, by_month)
        with_keys = [c for c in rows if c.buckets]
        keys = ()
        if with_keys:
            keys = _write_keys(_read_keys(spark, path, state, with_keys, None), path, name, counts["keys"], state.buckets)
        merged = replace(merged, name=name, rows=counts["rows"], buckets=keys)
    gone, committed = {c.name for c in old}, False

    def change(now: State) -> State | None:
        nonlocal committed
        committed = gone <= {c.name for c in now.chunks}  # else a replay has replaced one of them meanwhile
        if not committed:
            return None
        left = [c for c in now.chunks if c.name not in gone]
        return replace(now, chunks=tuple([merged, *left] if rows else left),
                       dropped=(*now.dropped, *((n, time.time()) for n in sorted(gone))))

    state = ledger.commit(spark, path, change, state)
    if not committed and merged.name:
        remove_chunk(spark, path, merged.name)
    return state, int(committed)


def vacuum(spark: SparkSession, path: str, retention: float = RETENTION, state: State | None = None) -> int:
    """Delete folders that have not been part of the table for ``retention`` seconds; their number."""
    state = state or ledger.read(spark, path)
    limit = time.time() - retention
    old = {n for n, t in state.dropped if t <= limit}
    if not old:
        return 0
    for name in old:
        remove_chunk(spark, path, name)
    ledger.commit(spark, path, lambda now: replace(now, dropped=tuple(x for x in now.dropped if x[0] not in old)), state)
    return len(old)
