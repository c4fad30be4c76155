"""The zones as a stream: the batch functions under ``foreachBatch``.

The tables are the only state and never expire; late rows are always accepted, so there is no watermark. Only
``start_bounded`` has one: it needs no history at all, and forgets.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newszones.operators.extract import BLOCK_REASONS, extract_blocks, landing_rows, rejected_blocks
from newszones.operators.rules import collect_rules
from newszones.plans.zones import BatchCounts, accepted, normalize_rows, refined_projection, run_batch
from newszones.sources.landing import read_landing, read_landing_stream, write_landing
from newszones.sources.pages import page_reason, rejected_pages
from newszones.sources.storage import work_dir, write_and_read
from newszones.sources.tables import ZoneTables, batch_clock, write_batch


def _batch_key(batch: DataFrame, batch_id: int) -> str:
    """Unique per checkpoint and batch: a replay gets the same key, a new checkpoint never an old one."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query_id:
        raise ValueError("no streaming query id: the batch cannot be named safely")
    return f"{query_id}-{batch_id:012d}"


def _start(stream: DataFrame, handle, checkpoint: str, available_now: bool, interval: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def start_zones(
    spark: SparkSession,
    tables: ZoneTables,
    checkpoint: str,
    *,
    landing: str | None = None,
    as_of: Column | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    max_files: int | None = None,
    archive: str | None = None,
    **options,
) -> StreamingQuery:
    """Carry new landing files into the refined and consumption tables.

    With ``available_now`` the query takes what has arrived since the last run, then ends: that is the
    periodic incremental run, to be started by any timer. The progress of a batch has its rows and corrupt lines under
    ``landing``. ``archive`` as in ``read_landing_stream``.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark, key = batch.sparkSession, _batch_key(batch, batch_id)
        run_batch(spark, batch, tables, key, as_of=batch_clock(spark, tables, key) if as_of is None else as_of, **options)

    stream = read_landing_stream(spark, landing or tables.landing, max_files, archive).observe(
        "landing", F.count(F.lit(1)).alias("rows"), F.count("_corrupt_record").alias("corrupt"))
    return _start(stream, handle, checkpoint, available_now, interval)


@dataclass(frozen=True)
class PageCounts:
    """What became of a batch of pages, counted by the writes themselves: usable pages, blocks by reason for rejecting them
    (articles have none), and the batch of articles."""

    articles: int
    rejected: dict[str, int]
    batch: BatchCounts


def run_pages(
    spark: SparkSession,
    pages: DataFrame,
    rules,
    tables: ZoneTables,
    batch_key: str,
    *,
    as_of: Column | None = None,
    **options,
) -> PageCounts:
    """Carry captured pages through extraction and all three zones as one batch."""
    rows, seen = collect_rules(rules), Observation()
    with work_dir(spark, "pages") as path:
        usable = pages.filter(page_reason(rows).isNull())
        blocks = write_and_read(extract_blocks(usable, rows).observe(
            seen, F.count_if(F.col("reason").isNull()).alias("articles"),
            *[F.count_if(F.col("reason") == r).alias(r) for r in BLOCK_REASONS]), path)
        write_batch(rejected_pages(pages, rows), tables.quarantine, f"{batch_key}-pages", with_keys=False)
        write_landing(landing_rows(blocks), tables.landing, batch_key, mode="overwrite")
        write_batch(rejected_blocks(blocks), tables.quarantine, f"{batch_key}-extract", with_keys=False)
    landing = read_landing(spark, f"{tables.landing}/run_ts={batch_key}")
    batch = run_batch(spark, landing, tables, batch_key,
                      as_of=batch_clock(spark, tables, batch_key) if as_of is None else as_of, **options)
    return PageCounts(seen.get["articles"], {r: n for r in BLOCK_REASONS if (n := seen.get[r])}, batch)


def start_pages(
    pages: DataFrame,
    rules: DataFrame,
    tables: ZoneTables,
    checkpoint: str,
    *,
    as_of: Column | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
    **options,
) -> StreamingQuery:
    """Carry a stream of captured pages through extraction and all three zones."""
    rows = collect_rules(rules)

    def handle(batch: DataFrame, batch_id: int) -> None:
        run_pages(batch.sparkSession, batch, rows, tables, _batch_key(batch, batch_id), as_of=as_of, **options)

    return _start(pages, handle, checkpoint, available_now, interval)


def first_within(rows: DataFrame, delay: str) -> DataFrame:
    """Of a stream of normalised rows, the first to arrive of each URL, with a state that forgets.

    This is not what the tables do: a URL is known for ``delay`` after its ``date_saved``, then it is new again, and rows
    that are later than ``delay`` behind the newest one seen are dropped. Rows without URL, or without a time that could
    tell when to forget them, pass.
    """
    saved = F.to_timestamp(F.substring("date_saved", 1, 26))
    rows = rows.withColumn("__saved", saved)
    has_both = F.col("url").isNotNull() & F.col("__saved").isNotNull()
    firsts = rows.filter(has_both).withWatermark("__saved", delay).dropDuplicatesWithinWatermark(["url"])
    return firsts.drop("__saved").unionByName(rows.filter(~has_both).drop("__saved"))


def start_bounded(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoint: str,
    *,
    as_of: Column,
    delay: str = "2 days",
    available_now: bool = True,
    interval: str = "1 minute",
    **options,
) -> StreamingQuery:
    """Refined rows of new landing files as Parquet, each URL once within ``delay``: no table is looked up, none is needed."""
    rows = accepted(normalize_rows(read_landing_stream(spark, landing), as_of=as_of, **options))
    writer = (refined_projection(first_within(rows, delay)).writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
