"""Shared-storage helpers: existence, cleanup, and the folder for intermediate tables."""

import os
import tempfile
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system: without one, it lies in Spark's default file system."""
    fs, p = _hadoop_path(spark, path)
    return fs.makeQualified(p).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no folder."""
    fs, p = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session may go without that setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors can reach")
    made = tempfile.mkdtemp(prefix="newszones-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/newszones/{uuid.uuid4().hex}/{name}"


def write_and_read(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet and read it back: a frame without lineage that prunes columns and rows."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def work_dir(spark: SparkSession, name: str):
    """A new folder that is deleted at the end; nothing read from it may be used afterwards."""
    path = work_path(spark, name)
    try:
        yield path
    finally:
        remove_path(spark, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with ``text`` appear in one step; False, and nothing changed, if there is one of that name already.

    Local files are linked, elsewhere the file is renamed without overwriting, which HDFS does in one step. On an object
    store without such a rename, only one writer at a time is safe.
    """
    fs, target = _hadoop_path(spark, path)
    _, draft = _hadoop_path(spark, f"{path.rpartition('/')[0]}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    stream.write(text.encode("utf-8"))
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            jvm = spark.sparkContext._jvm
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(draft, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        return False
    finally:
        fs.delete(draft, False)
    return True
