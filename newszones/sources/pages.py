"""Captured list pages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newszones import schemas
from newszones.functions.dates import iso_text
from newszones.functions.urls import on_allowed_domain


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_pages_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(schemas.PAGES).parquet(path)


def scan_pages(pages: DataFrame) -> DataFrame:
    """Pages that were answered with HTTP 200."""
    return pages.filter(F.col("status") == 200)


def page_reason(rules: list) -> Column:
    """Why a captured page cannot be used, NULL if it can; missing facts are reasons as well."""
    sources = sorted({r["source"] for r in rules})
    return (
        F.when(F.coalesce(F.col("status") != 200, F.lit(True)), "estado_http")
        .when(~on_allowed_domain(F.col("url")), "dominio_ajeno")
        .when(~F.coalesce(F.col("source").isin(sources), F.lit(False)), "fuente_desconocida"))


def rejected_pages(pages: DataFrame, rules: list) -> DataFrame:
    """Pages that nobody can use, in the shape of the quarantine table."""
    empty = F.lit(None).cast("string")
    facts = {"source": F.col("source"), "seccion": F.col("section"), "url": F.col("url"),
             "date_saved": iso_text(F.col("captured_at")), "stage": F.lit("pages"), "reason": page_reason(rules)}
    return pages.filter(page_reason(rules).isNotNull()).select(
        *[facts.get(name, empty).alias(name) for name in schemas.QUARANTINE.names])


def allowed_pages(pages: DataFrame, domains: list[str] | None = None, url: Column | None = None) -> DataFrame:
    return pages.filter(on_allowed_domain(F.col("url") if url is None else url, domains))
