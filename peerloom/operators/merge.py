"""Answers of several providers merged under precedence, with provenance and early stop."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import first_match, first_seen, orcids


def target_key(c: Column) -> Column:
    """A target as providers write it, in its normal form."""
    c = F.regexp_replace(F.lower(F.trim(c)), "[ .]+$", "")
    return F.regexp_replace(F.regexp_replace(c, "^https?://[^/]+/", ""), "^(?:doi|arxiv): *", "")


def ranked_answers(metadata: DataFrame, providers: DataFrame, swap: tuple[list[str], str, str] | None = None) -> DataFrame:
    """One row for each answer: target, rank (trust first, then id), and what it has of title, authors and year.

    swap: (prefixes, one, other): for targets that begin with one of the prefixes two providers change places."""
    ranks = F.broadcast(providers.select("provider", "trust_rank"))  # a fixed table
    rows = metadata.select(target_key(F.col("target_value")).alias("target_value"), "provider_record_id", "provider", "title", "authors", "author_orcids", "year", "venue_candidates", "fields")
    rows = rows.groupBy("target_value", "provider_record_id").agg(F.max(F.struct("provider", "title", "authors", "author_orcids", "year", "venue_candidates", "fields")).alias("r")).select("target_value", "provider_record_id", "r.*")
    if swap:
        prefixes, one, other = swap
        turned = begins_with(F.col("target_value"), prefixes)
        asked = F.when(turned & (F.col("provider") == one), other).when(turned & (F.col("provider") == other), one).otherwise(F.col("provider"))
        rows = rows.withColumn("asked", asked).join(ranks.withColumnRenamed("provider", "asked"), "asked", "left").drop("asked")
        rows = rows.withColumn("trust_rank", F.coalesce("trust_rank", F.lit(99)))
        return _cleaned(rows)
    rows = rows.join(ranks, "provider", "left").withColumn("trust_rank", F.coalesce("trust_rank", F.lit(99)))
    return _cleaned(rows)


def _cleaned(rows: DataFrame) -> DataFrame:
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    return (
        rows.withColumn("title", F.when(~blank("title"), F.trim("title")))
        .withColumn("year", F.when(F.trim("year").rlike("^[0-9]{4}$"), F.trim("year")))
        .withColumn("authors", first_seen(F.col("authors")))
        .withColumn("author_orcids", orcids(F.col("author_orcids")))
        .withColumn("fields", first_seen(F.col("fields")))
        .withColumn("venue_candidates", first_seen(F.col("venue_candidates")))
    )


def begins_with(c: Column, prefixes: list[str]) -> Column:
    return reduce(or_, [F.startswith(c, F.lit(p)) for p in prefixes], F.lit(False))


def has_venue(by_prefix: list[tuple[str, str]], names: list[str]) -> Column:
    """Whether the target's identifier tells a venue or a venue candidate of the answer holds a listed name (lower case)."""
    listed = F.exists("venue_candidates", lambda c: reduce(or_, [F.contains(F.lower(c), F.lit(n)) for n in names], F.lit(False)))
    return (first_match(F.col("target_value"), by_prefix, "startswith") != "") | listed


def venue(by_prefix: list[tuple[str, str]], names: list[tuple[str, str]]) -> Column:
    """The venue the target's identifier tells, else the label of the first listed name (lower case) that any candidate holds; '' if none."""
    return F.coalesce(F.nullif(first_match(F.col("target_value"), by_prefix, "startswith"), F.lit("")), first_match(F.lower(F.array_join("venue_candidates", "\n")), names))


def venue_of_family(versions: DataFrame, venues: DataFrame) -> DataFrame:
    """family_key, venue: that of the latest version, else of the most recent one that has any. venues: target_value, venue."""
    rows = versions.join(venues.where("venue != ''"), F.col("value") == F.col("target_value"))
    return rows.groupBy("family_key").agg(F.max_by("venue", F.struct(F.col("version").isNotNull(), F.coalesce("version", F.lit(0)), "value")).alias("venue"))


def contributing(answers: DataFrame, venue: Column) -> DataFrame:
    """Answers up to the one that completes title, authors, year and venue of its target; later ones add nothing.

    venue tells of an answer whether it has one (has_venue)."""
    before = Window.partitionBy("target_value").orderBy("trust_rank", "provider_record_id").rowsBetween(Window.unboundedPreceding, -1)
    had = lambda c: F.coalesce(F.max(c.cast("int")).over(before), F.lit(0)) == 1
    complete = had(F.col("title").isNotNull()) & had(F.size("authors") > 0) & had(F.col("year").isNotNull()) & had(venue)
    return answers.withColumn("done", complete).where("not done").drop("done")


def found(merged: DataFrame) -> DataFrame:
    """merged with found: whether a target has any of title, authors and year."""
    return merged.withColumn("found", F.col("title").isNotNull() | (F.coalesce(F.size("authors"), F.lit(0)) > 0) | F.col("year").isNotNull())


def merge_answers(answers: DataFrame) -> DataFrame:
    """One row for each target: the first title, authors and year by rank with the provider each came from, all ORCIDs,
    venue candidates and fields in rank order, and the providers used."""
    place = F.struct("trust_rank", "provider_record_id")
    first = lambda c, has: F.min_by(F.struct(F.col(c).alias("value"), F.col("provider").alias("source")), F.when(has, place))
    lists = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("trust_rank", "provider_record_id", c))), lambda x: x[c]))
    merged = answers.groupBy("target_value").agg(
        first("title", F.col("title").isNotNull()).alias("t"), first("authors", F.size("authors") > 0).alias("a"), first("year", F.col("year").isNotNull()).alias("y"),
        F.array_distinct(lists("author_orcids")).alias("author_orcids"), lists("venue_candidates").alias("venue_candidates"), F.array_distinct(lists("fields")).alias("fields"),
        F.array_sort(F.collect_set("provider")).alias("sources"), F.count("*").alias("answers"),
    )
    return merged.select(
        "target_value", F.col("t.value").alias("title"), F.col("t.source").alias("title_from"), F.col("a.value").alias("authors"), F.col("a.source").alias("authors_from"),
        F.col("y.value").alias("year"), F.col("y.source").alias("year_from"), "author_orcids", "venue_candidates", "fields", "sources", "answers",
    )
