"""Table schemas. All columns are nullable; JSON and Parquet are always read with one of these."""

from pyspark.sql import types as T

LANDING_FIELDS = ["data_id", "source", "titulo", "descripcion", "fecha", "seccion", "url", "date_saved"]
REFINED_FIELDS = ["data_id", "titulo", "descripcion", "fecha", "seccion", "url", "date_saved_iso"]


def _strings(names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PAGES = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("page", T.IntegerType()),
    T.StructField("url", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("html", T.StringType()),
    T.StructField("captured_at", T.TimestampType()),
])

LANDING = _strings(LANDING_FIELDS)
# ``descripcion`` may be a JSON text or a JSON list; only the raw value tells them apart.
LANDING_ON_DISK = T.StructType([
    *[T.StructField(n, T.VariantType() if n == "descripcion" else T.StringType()) for n in LANDING_FIELDS],
    T.StructField("_corrupt_record", T.StringType()), T.StructField("run_ts", T.StringType())])

REFINED = _strings(REFINED_FIELDS)

CONSUMPTION = T.StructType([
    T.StructField("titulo", T.StringType()),
    T.StructField("fecha_noticia", T.DateType()),
    T.StructField("hora_noticia", T.StringType()),
    T.StructField("seccion", T.StringType()),
    T.StructField("fuente", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("fecha_procesado", T.TimestampType()),
])

# ``_corrupt_record`` is what could not be read: a landing line, or the markup of a block or page; ``error`` says why.
QUARANTINE = _strings([*LANDING_FIELDS, "stage", "reason", "error", "_corrupt_record"])

FAILURES = _strings(["failed_batch", "table", "error", "failed_at"])

RULES = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("row_selector", T.StringType()),
    T.StructField("row_order", T.IntegerType()),
    T.StructField("field", T.StringType()),
    T.StructField("selector", T.StringType()),
    T.StructField("fallback_order", T.IntegerType()),
    T.StructField("mode", T.StringType()),
    T.StructField("default", T.StringType()),
])
