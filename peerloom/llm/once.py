"""One row for each key, without moving the rows whose key stands once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise

#: Beyond so many repeated keys they are joined by a shuffle.
BROADCAST_ROWS = 500_000


def once(rows: DataFrame, key: str) -> tuple[DataFrame, int]:
    """rows with one row for each key, and their number. Only keys are shuffled to find those that are repeated; of a
    repeated key any one row is kept, as rows that repeat a key repeat the content. key must not be null."""
    keys = rows.groupBy(key).agg(F.count("*").alias("n"))
    keys = materialise(keys.groupBy((F.col("n") > 1).alias("repeated"), F.when(F.col("n") > 1, F.col(key)).alias(key)).agg(F.count("*").alias("keys")), "repeated")
    n = keys.agg(F.sum("keys")).first()[0] or 0
    repeated = keys.where("repeated").select(key)
    few = repeated.count()
    if not few:
        return rows, n
    repeated = F.broadcast(repeated) if few <= BROADCAST_ROWS else repeated.hint("merge")
    return rows.join(repeated, key, "left_anti").unionByName(rows.join(repeated, key, "left_semi").dropDuplicates([key])), n
