"""Versions, rounds, representative values and timelines of a family of records."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Sorts behind every date.
NO_DATE = "9999"


def target_versions(reviews: DataFrame) -> DataFrame:
    """family_key, value, version, first_date, reviews: one row for each version that was reviewed."""
    dated = F.when(F.coalesce(F.col("review_date"), F.lit("")) != "", F.col("review_date"))
    return reviews.select(F.col("target.family_key").alias("family_key"), F.col("target.value").alias("value"), F.col("target.version").alias("version"), dated.alias("d"), "review_id").groupBy("family_key", "value").agg(
        F.min("version").alias("version"), F.coalesce(F.min("d"), F.lit(NO_DATE)).alias("first_date"), F.countDistinct("review_id").alias("reviews")
    )


def number_rounds(versions: DataFrame) -> DataFrame:
    """versions with round: explicit versions ascending, those without last, then by first date and value."""
    order = Window.partitionBy("family_key").orderBy(F.col("version").asc_nulls_last(), "first_date", "value")
    return versions.withColumn("round", F.row_number().over(order))


def latest_versions(versions: DataFrame) -> DataFrame:
    """family_key, latest: the highest explicit version; those without one come lowest, ties go to the higher value."""
    return versions.groupBy("family_key").agg(F.max_by("value", F.struct(F.col("version").isNotNull(), F.coalesce("version", F.lit(0)), "value")).alias("latest"))


def representative(rows: DataFrame, group: str, value: str, order: list[str]) -> DataFrame:
    """group, value, times: the most frequent non-blank value of each group, ties going to the one seen first."""
    seen = rows.where(F.trim(F.coalesce(F.col(value), F.lit(""))) != "").groupBy(group, value).agg(F.count("*").alias("times"), F.min(F.struct(*order)).alias("first"))
    best = seen.groupBy(group).agg(F.min_by(F.struct(value, "times"), F.struct(-F.col("times"), "first", value)).alias("b"))
    return best.select(group, "b.*")


def positions(rows: DataFrame, group: list[str], order: list[str], into: str) -> DataFrame:
    """rows with their number from 1 in the order of their group.

    Numbers run inside the ranges of equal first order column; the totals of the ranges before are added. So a hot group is
    spread over as many tasks as it has such values, and only their totals come together."""
    ranged = Window.partitionBy(*group, order[0])
    totals = rows.groupBy(*group, order[0]).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*group).orderBy(order[0]).rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*[F.col(c).alias(f"__{c}") for c in [*group, order[0]]], F.coalesce(before, F.lit(0)).alias("__before"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*group, order[0]]])
    inside = F.row_number().over(ranged.orderBy(*order))
    return rows.join(totals, same).withColumn(into, (F.col("__before") + inside).cast("int")).drop("__before", *[f"__{c}" for c in [*group, order[0]]])


def timeline(events: DataFrame, group: str) -> DataFrame:
    """group, position, kind, event_id, event_date: events in the order date, reviews first, id."""
    rows = events.select(group, "kind", "event_id", "event_date", (F.col("kind") != "review").alias("reply"))
    return positions(rows, [group], ["event_date", "reply", "event_id"], "position").select(group, "position", "kind", "event_id", "event_date")


def out_of_order(events: DataFrame, group: str, position: str, value: str) -> DataFrame:
    """Rows that come before what stands in front of them."""
    before = F.lag(value).over(Window.partitionBy(group).orderBy(position))
    return events.withColumn("before", before).where(F.col("before") > F.col(value)).select(group, position, value, "before")
