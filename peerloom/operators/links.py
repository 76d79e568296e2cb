"""Linkage between records: unique, verified, unresolved, pending and covered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_links(interactions: DataFrame, key: str, link: str, reviews: DataFrame, review_key: str, keep: list[str]) -> DataFrame:
    """key, review id and keep columns for interactions whose links name exactly one known review.

    interactions has one row for each link; the order of arrival plays no part, as all links meet all reviews."""
    known = interactions.select(key, F.col(link).alias(review_key)).join(reviews.select(review_key, *keep).dropDuplicates([review_key]), review_key)
    met = known.groupBy(key).agg(F.countDistinct(review_key).alias("n"), F.min(F.struct(review_key, *keep)).alias("r"))
    return met.where("n = 1").select(key, "r.*")


def unresolved(interactions: DataFrame, key: str, resolved: DataFrame) -> DataFrame:
    return interactions.join(resolved.select(key), key, "left_anti")


def pending(wanted: DataFrame, done: DataFrame, key: str, retry: str | None = None) -> DataFrame:
    """Rows of wanted that are not recorded in done; with retry, also those recorded without that status."""
    recorded = done if retry is None else done.where(F.col("status") == retry)
    return wanted.join(recorded.select(key).distinct(), key, "left_anti")


def reconcile(expected: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """key, side for ids on one side only: missing (not written) or unexpected (not expected)."""
    left = expected.select(key).distinct().withColumn("expected", F.lit(1))
    right = written.select(key).distinct().withColumn("written", F.lit(1))
    both = left.join(right, key, "full_outer").where("expected is null or written is null")
    return both.select(key, F.when(F.col("written").isNull(), "missing").otherwise("unexpected").alias("side"))
