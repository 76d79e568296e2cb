"""Exact duplicates: which record survives and what was removed for it."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import body_hash, name_keys


def unique_records(rows: DataFrame, key: str, latest: str) -> DataFrame:
    """One row for each key: the one harvested last, ties going to the greater hash of the whole row, whatever the order of
    rows. An aggregate with partial results, so that a hot key is no burden."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct("*"), F.struct(latest, F.xxhash64("*"))).alias("__r")).select("__r.*")


def repeated_records(rows: DataFrame, key: str) -> DataFrame:
    """records, unique_records, repeated_records: how far a scan drifted."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).agg(F.sum("n").alias("records"), F.count("*").alias("unique_records"), F.sum(F.col("n") - 1).alias("repeated_records"))


def survivors(rows: DataFrame, scope: list[str], key: str, order: list[str], text: str) -> DataFrame:
    """scope columns, body_hash, key, copies: the first of each set of exact duplicates in the scope, ties going to the lower
    key. One aggregate with partial results: texts are hashed where they are read and never move."""
    hashed = rows.select(*scope, key, *order, body_hash(F.col(text)).alias("body_hash"))
    return hashed.groupBy(*scope, "body_hash").agg(F.min_by(key, F.struct(*order, key)).alias(key), F.count("*").alias("copies"))


def mark_duplicates(rows: DataFrame, scope: list[str | Column], key: str, order: list[str], text: str, survivor: str = "kept") -> DataFrame:
    """scope columns, body_hash, key, survivor, copies: for every row the survivor of its exact duplicates in the scope.

    The survivor is the first in order, ties going to the lower key. It is found by an aggregate with partial results
    and joined back on the duplicates' hash, so that no window has to hold a hot scope."""
    hashed = rows.select(*scope, key, *order, body_hash(F.col(text)).alias("body_hash"))
    names = [c if isinstance(c, str) else hashed.columns[i] for i, c in enumerate(scope)]
    best = hashed.groupBy(*names, "body_hash").agg(F.min_by(key, F.struct(*order, key)).alias(survivor), F.count("*").alias("copies"))
    best = best.select(*[F.col(n).alias(f"__{n}") for n in [*names, "body_hash"]], survivor, "copies")
    on = reduce(and_, [F.col(n).eqNullSafe(F.col(f"__{n}")) for n in [*names, "body_hash"]])
    return hashed.join(best, on).select(*names, "body_hash", key, survivor, "copies")


def participants(creators: str | Column) -> Column:
    """The people of a record as one key, whatever their order."""
    return F.array_join(F.array_sort(name_keys(F.col(creators) if isinstance(creators, str) else creators)), "|")


def log(marked: DataFrame, kind: str, key: str, survivor: str) -> DataFrame:
    """record_type, removed_id, kept_id for the rows of mark_duplicates that did not survive."""
    gone = marked.where(F.col(key) != F.col(survivor))
    return gone.select(F.lit(kind).alias("record_type"), F.col(key).alias("removed_id"), F.col(survivor).alias("kept_id"))
