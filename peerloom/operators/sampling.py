"""Deterministic samples: seeded order, tiers, the first n accepted, and what was turned down on the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import seeded
from ..storage import materialise


def ordered(rows: DataFrame, key: str, seed: str, tier: Column | None = None) -> DataFrame:
    """rows with tier and place, by which they are to be sorted."""
    return rows.withColumn("tier", F.lit(0) if tier is None else tier).withColumn("place", seeded(seed, F.col(key)))


def first_accepted(rows: DataFrame, accepted: Column, limit: int) -> DataFrame:
    return rows.where(accepted).orderBy("tier", "place").limit(limit)


def with_running_count(rows: DataFrame, counted: Column, into: str) -> DataFrame:
    """rows with the number of counted ones up to each in the order (tier, place).

    The places are hashes, so their leading digits cut the order into even ranges: counts run inside the ranges, and
    the few range totals in front of one are added. No window holds all rows."""
    ranged = rows.withColumn("__range", F.substring("place", 1, 3)).withColumn("__one", counted.cast("int"))
    totals = ranged.groupBy("tier", "__range").agg(F.sum("__one").alias("__n"))
    before = Window.orderBy("tier", "__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy("tier", "__range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(F.broadcast(totals), ["tier", "__range"])  # at most 4,096 rows a tier
    return joined.withColumn(into, F.col("__before") + F.sum("__one").over(inside)).drop("__range", "__one", "__before")


def turned_down(rows: DataFrame, reason: str, limit: int) -> DataFrame:
    """reason, n for rows with a reason that come before the limit-th accepted (null reason) row."""
    counted = with_running_count(rows, F.col(reason).isNull(), "accepted")
    return counted.where(F.col(reason).isNotNull() & (F.col("accepted") < limit)).groupBy(reason).agg(F.count("*").alias("n"))


def order_fingerprint(rows: DataFrame, key: str) -> DataFrame:
    """fingerprint, keys: one hash of all keys in order, from the hashes of its 65,536 ranges."""
    part = F.substring("place", 1, 4)
    inside = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", key))), lambda x: x[key]), "\n")
    ranges = rows.groupBy("tier", part.alias("range")).agg(F.sha2(inside, 256).alias("h"), F.count("*").alias("n"))
    chained = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tier", "range", "h"))), lambda x: x["h"]), "\n")
    return ranges.agg(F.sha2(chained, 256).alias("fingerprint"), F.sum("n").alias("keys"))


def numbered(rows: DataFrame, order: list[str], into: str) -> DataFrame:
    """rows with their number from 1 in a global order, by range partitions: each numbers its own rows, and the totals of
    those before it, one number a partition, are added."""
    ranged = rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    # Written, so that the partitions are the same in both reads.
    ranged = materialise(ranged, "ranged")
    totals = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(F.broadcast(totals.select("__part", before.alias("__before"))), "__part").withColumn(into, (F.col("__before") + inside).cast("int")).drop("__part", "__before")


def examples(rows: DataFrame, reason: str, key: str, most: int) -> DataFrame:
    """reason, key: the first few rows of each reason in the order (tier, place), for a report."""
    order = Window.partitionBy(reason).orderBy("tier", "place")
    return rows.where(F.col(reason).isNotNull()).withColumn("__i", F.row_number().over(order)).where(F.col("__i") <= most).select(reason, key)
