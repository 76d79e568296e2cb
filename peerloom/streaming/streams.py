"""Streams: records deduplicated under a watermark, event counts by window, and enrichment of new targets."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.links import pending
from ..storage import exists, scratch_dir


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def unique_within(stream: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """The first row of each key; a key is remembered for delay behind the watermark, so the state stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, kind: str, width: str, delay: str) -> DataFrame:
    stream = stream.withColumn(time, F.col(time).cast("timestamp"))
    windowed = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n"))
    return windowed.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), kind, "n")


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives for all that is there now, as a table in the shared folder."""
    spark = stream.sparkSession
    base = f"{scratch_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        # A batch that is tried again writes over its own folder; a complete result replaces the one before.
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={0 if mode == 'complete' else number}")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    if not exists(spark, f"{base}/out"):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(StructType([*stream.schema.fields, StructField("batch", IntegerType())])).parquet(f"{base}/out").drop("batch")


def enrich_new(targets: DataFrame, path: str, resolve: Callable[[DataFrame], DataFrame], state: str):
    """Start a query that resolves targets the table at path does not record yet; a second run adds only new ones."""
    query = "q" + hashlib.sha256(state.encode()).hexdigest()[:12]  # batches are numbered anew for each state

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        # What this batch wrote before it failed is not done: it is written again, over its own folder.
        mine = f"{query}-{number}"
        done = rows.select("target_value").limit(0)
        if exists(spark, path):
            done = spark.read.parquet(path).where(F.col("batch") != mine).select("target_value")
        resolve(pending(rows.dropDuplicates(["target_value"]), done, "target_value")).write.mode("overwrite").parquet(f"{path}/batch={mine}")

    return targets.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(batch).start()
