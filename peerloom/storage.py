"""Where intermediate tables live: the shared folder named by the session, never a machine-local one on a cluster."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a temporary folder only where it is unset and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="peerloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _hadoop(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file on any file system that the session knows; null where there is none."""
    fs, where = _hadoop(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it into it in one step, over what is there."""
    fs, where = _hadoop(spark, path)
    _, part = _hadoop(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    hadoop, gateway = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    rename = getattr(hadoop, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.makeQualified(where).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(part), fs.makeQualified(where), options)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch() -> None:
    """Delete every table written by materialise in this process."""
    while _written:
        spark, path = _written.pop()
        try:
            delete(spark, path)
        except Exception:  # the session is gone; the folder's owner cleans up
            return


atexit.register(drop_scratch)
