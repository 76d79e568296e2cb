"""A cache table of fetched answers, with a row for what was looked for and not found."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "namespace string, key string, key_hash string, status string, payload string, error string"


def read(spark: SparkSession, path: str, refresh: tuple[str, ...] = ()) -> DataFrame:
    """The cache without the namespaces that are to be fetched anew; empty where there is none."""
    try:
        found = spark.read.schema(SCHEMA).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        found = spark.createDataFrame([], SCHEMA)
    return found.where(~F.col("namespace").isin(list(refresh))) if refresh else found


def fetch_missing(wanted: DataFrame, cached: DataFrame, fetch: Callable[[str, str], str | None], partitions: int = 8) -> DataFrame:
    """Rows for the wanted (namespace, key) that the cache lacks, by fetch(namespace, key).

    Null is kept as not_found, a failure as error: failures are rows, and errors alone are tried again. Few partitions
    keep the rate low."""
    done = cached.where("status != 'error'").select("namespace", "key")
    todo = wanted.select("namespace", "key").distinct().join(done, ["namespace", "key"], "left_anti").repartition(partitions, "key")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for namespace, key in zip(b["namespace"], b["key"], strict=True):
                try:
                    payload = fetch(namespace, key)
                    rows.append((namespace, key, "found" if payload is not None else "not_found", payload, None))
                except Exception as e:
                    rows.append((namespace, key, "error", None, str(e)))
            yield pd.DataFrame(rows, columns=["namespace", "key", "status", "payload", "error"])

    got = todo.mapInPandas(run, "namespace string, key string, status string, payload string, error string")
    return got.select("namespace", "key", F.sha2("key", 256).alias("key_hash"), "status", "payload", "error")
