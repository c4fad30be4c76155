"""Landing zone: raw article rows as JSON lines, one partition per run."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newszones import schemas


def _options(reader):
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")


#: Where a list-valued description is after reading; its text column is NULL then.
LIST = "descripcion_lista"


def _typed(rows: DataFrame) -> DataFrame:
    """Descriptions by the type they have in the file: a text that looks like a list stays a text."""
    is_list = F.coalesce(F.startswith(F.schema_of_variant("descripcion"), F.lit("ARRAY")), F.lit(False))
    found = F.col("descripcion")
    columns = {
        "descripcion": F.when(~is_list, F.try_variant_get(found, "$", "string")),
        LIST: F.when(is_list, F.try_variant_get(found, "$", "array<string>"))}
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in rows.columns], columns[LIST].alias(LIST))


def write_landing(rows: DataFrame, path: str, run_ts: str, mode: str = "append") -> None:
    """Add raw rows under ``run_ts``; keys with NULL values are written too."""
    (
        rows.select(*schemas.LANDING_FIELDS)
        .write.mode(mode)
        .option("ignoreNullFields", "false")
        .json(f"{path}/run_ts={run_ts}")
    )


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return _typed(_options(spark.read.schema(schemas.LANDING_ON_DISK)).json(path))


def archived_landing(archive: str, path: str) -> str:
    """Where the files of a landing folder are that a stream has archived; to be read with ``read_landing``."""
    return f"{archive.rstrip('/')}/{re.sub('^[a-z0-9]+://[^/]*', '', path).strip('/')}"


def read_landing_stream(spark: SparkSession, path: str, max_files: int | None = None,
                        archive: str | None = None) -> DataFrame:
    """New landing files. With ``archive``, a folder outside of ``path``, the files of a batch move there when the next one is
    complete, so that a trigger lists what is new and the last batch, and not all there ever was."""
    reader = _options(spark.readStream.schema(schemas.LANDING_ON_DISK))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _typed(reader.json(path))
