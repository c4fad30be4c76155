"""Report queries over the consumption table. All are lazy; filters reach the Parquet scan."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newszones import fixed_values as fixed
from newszones.functions.dates import coerce_date, coerce_time
from newszones.sources.tables import MONTH, ZoneTables, month_of, read_consumption


def newest_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("fecha_noticia"), F.desc("hora_noticia"), "url")


def load_report(consumption: DataFrame) -> DataFrame:
    """The report columns that exist, of rows with a valid date and time, as far as there are such columns.

    A typed table holds valid times beside its dates, so its filters stay plain and are pushed to the scan.
    """
    keep = [c for c in [*fixed.REPORT_COLUMNS, MONTH] if c in consumption.columns]
    dated = [c for c in ("fecha_noticia", "hora_noticia") if c in keep]
    report = _with_values(consumption.select(*keep), dated)
    if dict(report.dtypes).get("fecha_noticia") == "date":
        return report
    for name, coerced in (("fecha_noticia", coerce_date), ("hora_noticia", coerce_time)):
        if name in dated:
            report = report.withColumn(name, coerced(F.col(name)))
    return _with_values(report, dated)


def _with_values(report: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with all of these columns; plain null checks, unlike ``dropna``, reach the scan."""
    for name in columns:
        report = report.filter(F.col(name).isNotNull())
    return report


def read_report(spark: SparkSession, tables: ZoneTables) -> DataFrame:
    """The report frame of the zone tables, with the month column that lets date filters skip folders."""
    return load_report(read_consumption(spark, tables, MONTH))


def coercion_loss(consumption: DataFrame) -> DataFrame:
    """Rows with a date and a time of which one is invalid."""
    given = F.col("fecha_noticia").isNotNull() & F.col("hora_noticia").isNotNull()
    valid = coerce_date(F.col("fecha_noticia")).isNotNull() & coerce_time(F.col("hora_noticia")).isNotNull()
    return consumption.agg(F.count_if(given & ~valid).alias("n_lost"))


def filter_sources(report: DataFrame, sources: list[str] | None) -> DataFrame:
    """Rows of the chosen sources; no choice means no filter. A choice drops rows without a source."""
    return report.filter(F.col("fuente").isin(list(sources))) if sources else report


def filter_all_sources(report: DataFrame) -> DataFrame:
    """What choosing every source there is comes to: only rows without one are dropped."""
    return report.filter(F.col("fuente").isNotNull())


def filter_dates(report: DataFrame, lo: date | Column | None, hi: date | Column | None) -> DataFrame:
    """Rows from ``lo`` to ``hi``, both included; without both ends there is no filter."""
    if lo is None or hi is None:
        return report
    lo, hi = (d if isinstance(d, Column) else F.lit(d) for d in (lo, hi))
    filtered = report.filter(F.col("fecha_noticia").between(lo, hi))
    if MONTH in report.columns:
        filtered = filtered.filter(F.col(MONTH).between(month_of(lo), month_of(hi)))
    return filtered


def resolve_range(
    data_lo: date | None,
    data_hi: date | None,
    asked_lo: date | None = None,
    asked_hi: date | None = None,
    *,
    as_of: date,
    fallback: tuple[date, date] | None = None,
) -> tuple[date | None, date | None]:
    """The range to filter by: what was asked for, else the data's own.

    Without data, or with a start after the end, it is the ``fallback``, by default the last 30 days; if
    that runs backwards as well, there is no range.
    """
    if data_lo is not None and data_hi is not None and data_lo <= data_hi:
        lo = data_lo if asked_lo is None else asked_lo
        hi = data_hi if asked_hi is None else asked_hi
        if lo <= hi:
            return lo, hi
    lo, hi = fallback or last_days(as_of)
    return (lo, hi) if lo <= hi else (None, None)


def lazy_range(
    bounds: DataFrame,
    asked_lo: date | Column | None = None,
    asked_hi: date | Column | None = None,
    *,
    as_of: date,
    fallback: tuple[date, date] | None = None,
) -> tuple[Column | None, Column | None]:
    """``resolve_range`` inside the plan: ends as scalar subqueries on ``date_bounds``, for ``filter_dates``.

    Nothing runs while the query is built, and month folders outside the range are skipped when it runs. What was asked for
    may be an expression on ``fecha_min`` and ``fecha_max``. A fallback that runs backwards leaves the data's own range.
    """
    lo, hi = F.col("fecha_min"), F.col("fecha_max")
    asked_lo, asked_hi = (d if d is None or isinstance(d, Column) else F.lit(d) for d in (asked_lo, asked_hi))
    first, last = (lo if asked_lo is None else asked_lo), (hi if asked_hi is None else asked_hi)
    back = fallback or last_days(as_of)
    back = back if back[0] <= back[1] else (lo, hi)
    good = F.coalesce((lo <= hi) & (first <= last), F.lit(False))
    resolved = bounds.select(*[
        F.when(good, own).otherwise(b if isinstance(b, Column) else F.lit(b)).alias(name)
        for name, own, b in zip(("lo", "hi"), (first, last), back)])
    return resolved.select("lo").scalar(), resolved.select("hi").scalar()


def last_days(as_of: date, days: int = fixed.FALLBACK_DAYS) -> tuple[date, date]:
    return as_of - timedelta(days=days), as_of


def date_bounds(report: DataFrame) -> DataFrame:
    return report.agg(F.min("fecha_noticia").alias("fecha_min"), F.max("fecha_noticia").alias("fecha_max"))


def has_values(report: DataFrame, *columns: str) -> DataFrame:
    """Whether each column holds any value at all."""
    return report.agg(*[
        F.coalesce(F.bool_or(F.col(c).isNotNull()), F.lit(False)).alias(f"has_{c}") for c in columns])


def distinct_sources(report: DataFrame) -> DataFrame:
    return report.select("fuente").dropna().distinct().orderBy("fuente")


def filtered_total(report: DataFrame) -> DataFrame:
    return report.agg(F.count("*").alias("total"))


def articles_per_day(report: DataFrame) -> DataFrame:
    """Distinct URLs per day. Spark reduces to one row per day and URL before it counts by day."""
    return (
        report.filter(F.col("fecha_noticia").isNotNull())
        .groupBy("fecha_noticia").agg(F.count_distinct("url").alias("n")).orderBy("fecha_noticia")
    )


def articles_per_source(report: DataFrame) -> DataFrame:
    return _counts(report, "fuente")


def top_sections(report: DataFrame, k: int = fixed.TOP_SECTIONS) -> DataFrame:
    return _counts(report, "seccion").limit(k)


def latest(report: DataFrame, k: int = fixed.SAMPLE_ROWS) -> DataFrame:
    names = [c for c in fixed.REPORT_COLUMNS if c in report.columns]
    return newest_first(report).select(*names).limit(k)


def _counts(report: DataFrame, column: str) -> DataFrame:
    return (
        report.filter(F.col(column).isNotNull())
        .groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    )


def report_views(report: DataFrame) -> dict[str, DataFrame]:
    """The five views of a filtered report."""
    return {
        "total": filtered_total(report),
        "per_day": articles_per_day(report),
        "per_source": articles_per_source(report),
        "top_sections": top_sections(report),
        "latest": latest(report),
    }


def write_views(report: DataFrame, path: str, names: list[str] | None = None) -> None:
    """Write the views as Parquet extracts for charting tools; each scan reads only its own columns."""
    for name, view in report_views(report).items():
        if names is None or name in names:
            view.write.mode("overwrite").parquet(f"{path}/{name}")


def read_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}")
