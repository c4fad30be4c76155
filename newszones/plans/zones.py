"""Raw articles to refined and consumption rows, and the batch that carries them there."""

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newszones import schemas
from newszones.functions import dates, text, urls
from newszones.operators.dedupe import BROADCAST_BYTES, first_of_key, first_wins, new_firsts, new_rows, unknown_keys
from newszones.sources import ledger
from newszones.sources import tables as tb
from newszones.sources.landing import LIST
from newszones.sources.storage import work_dir, write_and_read

log = logging.getLogger(__name__)

ARRIVAL = ["date_saved", "data_id"]
_TEXT_FIELDS = ["data_id", "source", "titulo", "fecha", "seccion", "url", "date_saved"]


def normalize_rows(
    landing: DataFrame,
    *,
    as_of: Column,
    order: str = "clean_then_links",
    **date_options,
) -> DataFrame:
    """All landing rows with normalised fields and a ``reason``, NULL unless the row is rejected.

    A list-valued description (the column itself, or ``descripcion_lista`` of landing files) is joined and, unlike a
    text, not lower-cased.
    """
    if isinstance(landing.schema["descripcion"].dataType, T.ArrayType):
        landing = landing.withColumnRenamed("descripcion", LIST).withColumn("descripcion", F.lit(None).cast("string"))
    names = [*_TEXT_FIELDS, "descripcion"]
    # Two projections: what the second one mentions more than once is computed once, by the first.
    rows = landing.withColumns({name: text.normalize_text(F.col(name)) for name in names})
    rows = rows.withColumns({name: text.null_tokens(F.col(name)) for name in names})
    description = F.col("descripcion")
    if LIST in rows.columns:
        description = F.coalesce(text.join_list(F.when(F.size(LIST) > 0, F.col(LIST))), description)
    rows = rows.withColumn("descripcion", text.clean_description(description, order))
    rows = dates.parse_fecha(rows, "fecha", as_of=as_of, **date_options)
    rows = rows.withColumn("date_saved", dates.date_saved_iso(F.col("date_saved")))
    raw = F.col("_corrupt_record") if "_corrupt_record" in rows.columns else F.lit(None).cast("string")
    return rows.select(
        *schemas.LANDING_FIELDS, raw.alias("_corrupt_record"),
        F.when(raw.isNotNull(), "json_corrupto")
        .when(F.col("fecha_overflow"), "fecha_overflow")
        .when(F.col("titulo").isNull(), "titulo_vacio").alias("reason"),
    )


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reason").isNull()).drop("reason", "_corrupt_record")


def quarantined(normalized: DataFrame) -> DataFrame:
    return normalized.filter(F.col("reason").isNotNull()).select(
        *schemas.LANDING_FIELDS,
        F.when(F.col("reason") == "json_corrupto", "landing").otherwise("refined").alias("stage"), "reason",
        F.lit(None).cast("string").alias("error"), "_corrupt_record")


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("stage", "reason").agg(F.count("*").alias("n"))


def refined_projection(rows: DataFrame) -> DataFrame:
    return rows.select(
        "data_id", "titulo", "descripcion", "fecha", "seccion", "url", F.col("date_saved").alias("date_saved_iso"))


def consumption_projection(rows: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Consumption rows from normalised or refined ones, whose ``fecha`` is ISO text where it is a date."""
    return rows.select(
        "titulo",
        dates.iso_day(F.col("fecha")).alias("fecha_noticia"),
        dates.iso_clock(F.col("fecha")).alias("hora_noticia"),
        "seccion",
        urls.source_from_url(F.col("url")).alias("fuente"),
        "url",
        (F.current_timestamp() if processed_at is None else processed_at).alias("fecha_procesado"),
    )


def refine(
    landing: DataFrame,
    history: DataFrame,
    *,
    as_of: Column,
    **options,
) -> DataFrame:
    """Refined rows that one batch adds to ``history``."""
    rows = accepted(normalize_rows(landing, as_of=as_of, **options))
    return refined_projection(new_firsts(rows, history, "url", ARRIVAL))


def url_keys(landing: DataFrame) -> DataFrame:
    """The normalised URLs of landing rows, rejected ones included, without the cost of the other fields."""
    return landing.select(text.null_tokens(text.normalize_text(F.col("url"))).alias("url"))


def backfill(
    refined: DataFrame,
    consumption: DataFrame,
    processed_at: Column | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Consumption rows for refined articles that the consumption table lacks, as after an outage.

    Rows with a URL go by that. Rows without one cannot be told apart, but batches can: with a column ``batch_key`` on
    both sides, those of batches that the consumption table has nothing of are restored, too.
    """
    missing = first_of_key(unknown_keys(refined, consumption, "url", max_bytes), "url", ["date_saved_iso", "data_id"])
    if "batch_key" in refined.columns and "batch_key" in consumption.columns:
        there = consumption.select("batch_key").distinct()
        missing = missing.unionByName(refined.filter(F.col("url").isNull()).join(there, "batch_key", "left_anti")
                                      .select(refined.columns))
    return consumption_projection(missing, processed_at)


def consumption_without_refined(consumption: DataFrame, refined: DataFrame) -> DataFrame:
    """Audit: articles in the consumption table that never made it into the refined one."""
    keys = refined.select("url").filter(F.col("url").isNotNull())
    return consumption.filter(F.col("url").isNotNull()).join(keys, "url", "left_anti").select(consumption.columns)


#: Reasons for which a row is rejected, in the order of precedence.
REASONS = ["json_corrupto", "fecha_overflow", "titulo_vacio"]
#: Batches that the consumption table may lack before its fault ends the run.
MAX_OPEN = 10


@dataclass(frozen=True)
class BatchCounts:
    """What became of a batch's rows, counted by the writes themselves. ``known`` are articles that refined had already;
    a number is None where nothing was written, as for a batch that was merged long ago."""

    rows: int
    rejected: dict[str, int]
    articles: int
    refined: int | None
    known: int | None
    consumption: int | None
    filled: list[str] = field(default_factory=list)


def run_batch(
    spark: SparkSession,
    landing: DataFrame,
    tables: tb.ZoneTables,
    batch_key: str,
    *,
    as_of: Column,
    processed_at: Column | None = None,
    max_bytes: int = BROADCAST_BYTES,
    max_open: int = MAX_OPEN,
    **options,
) -> BatchCounts:
    """Carry one batch of landing rows into quarantine, refined and consumption.

    The rows are normalised once and reduced to one per URL once; both tables take their new rows from
    that. The history a batch is compared with excludes the batch itself, so it can be run again.
    """
    with work_dir(spark, "batch") as path:
        refined, consumption = (ledger.read(spark, t) for t in (tables.refined, tables.consumption))
        seen, articles = Observation(), Observation()
        normalized = normalize_rows(landing, as_of=as_of, **options).observe(
            seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS])
        staged = write_and_read(
            normalized.withColumn("rejected", F.col("reason").isNotNull()), f"{path}/rows", ["rejected"])
        rejected = {r: n for r in REASONS if (n := seen.get[r])}
        tb.write_batch(quarantined(staged.filter("rejected").drop("rejected")), tables.quarantine, batch_key, with_keys=False)
        rows = accepted(staged.filter("NOT rejected").drop("rejected"))
        firsts = write_and_read(
            first_wins(rows, "url", ARRIVAL).observe(articles, F.count(F.lit(1)).alias("rows")), f"{path}/firsts")
        lacking = [k for k in refined.open if k not in consumption.batches and k != batch_key]
        known = tb.known_keys(spark, tables.refined, refined, firsts, batch_key)
        added = tb.write_batch(refined_projection(new_rows(firsts, known, "url", max_bytes)), tables.refined, batch_key,
                               refined, still_open=lacking)
        # A failed write of this table must not cost the batch; a later batch, or a backfill, fills the gap.
        filled, shown = [], None
        try:
            filled = fill_gaps(spark, tables, lacking, processed_at, max_bytes)
            consumption = ledger.read(spark, tables.consumption) if filled else consumption
            known = tb.known_keys(spark, tables.consumption, consumption, firsts, batch_key)
            shown = tb.write_consumption_batch(
                consumption_projection(new_rows(firsts, known, "url", max_bytes), processed_at),
                tables.consumption, batch_key, consumption)
        except Exception as e:
            log.exception("consumption rows of batch %s are missing", batch_key)
            record_failure(spark, tables, batch_key, "consumption", e)
            if len(lacking) + 1 >= max_open:
                raise
    for table, schema in ((tables.refined, schemas.REFINED), (tables.consumption, schemas.CONSUMPTION),
                          (tables.quarantine, schemas.QUARANTINE)):
        tb.compact(spark, table, schema)
    total = articles.get["rows"]
    return BatchCounts(seen.get["rows"], rejected, total, added and added.rows, added and total - added.rows,
                       shown and shown.rows, filled)


def record_failure(spark: SparkSession, tables: tb.ZoneTables, batch_key: str, table: str, error: Exception) -> None:
    """Add a fault to the table of failures; a fault of that table itself is only logged."""
    try:
        row = spark.createDataFrame([(batch_key, table, f"{type(error).__name__}: {error}"[:2000])],
                                    "failed_batch string, `table` string, error string")
        tb.write_batch(row.withColumn("failed_at", F.current_timestamp().cast("string")), tables.failures,
                       f"{batch_key} {ledger.new_name()}", with_keys=False)
    except Exception:
        log.exception("the failure of batch %s could not be recorded", batch_key)


def fill_gaps(spark: SparkSession, tables: tb.ZoneTables, keys: list[str], processed_at: Column | None = None,
              max_bytes: int = BROADCAST_BYTES) -> list[str]:
    """Write the consumption rows of these refined batches, each under its own key, in key order."""
    for key in sorted(keys):
        state = ledger.read(spark, tables.consumption)
        rows = tb.read_refined(spark, tables, "batch_key").filter(F.col("batch_key") == key).drop("batch_key")
        rows = rows.withColumnRenamed("date_saved_iso", "date_saved")
        known = tb.known_keys(spark, tables.consumption, state, rows, key)
        tb.write_consumption_batch(
            consumption_projection(new_rows(rows, known, "url", max_bytes), processed_at), tables.consumption, key, state)
    return sorted(keys)


def run_backfill(
    spark: SparkSession, tables: tb.ZoneTables, batch_key: str, processed_at: Column | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> None:
    """Restore what the consumption table lacks: whole batches under their own keys, then single URLs under ``batch_key``."""
    lacking = tb.complete_batches(spark, tables.refined).missing_from(tb.complete_batches(spark, tables.consumption))
    fill_gaps(spark, tables, lacking, processed_at, max_bytes)
    state = ledger.read(spark, tables.consumption)
    rows = backfill(
        tb.read_refined(spark, tables), tb.read_consumption(spark, tables, without_batch=batch_key, state=state),
        processed_at, max_bytes)
    tb.write_consumption_batch(rows, tables.consumption, batch_key, state)
