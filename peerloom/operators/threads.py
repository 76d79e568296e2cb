"""Review threads: the events of each round of a family in order, and nested with comments, responses, discussion and timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import mark_duplicates
from .links import resolve_links
from .rounds import number_rounds, positions, target_versions


#: Events of a part of a nested round: a round of more has several parts.
PART_EVENTS = 500


def _latest() -> Column:
    """Of rows that repeat an id: the one harvested last, ties going to the greater hash of the whole row."""
    return F.struct(F.coalesce("harvested_at", F.timestamp_micros(F.lit(0))), "tie")


def review_rows(reviews: DataFrame) -> DataFrame:
    """Distinct reviews with flat target columns: of an id given several times the one harvested last."""
    flat = reviews.select("review_id", F.col("target.family_key").alias("family_key"), F.col("target.value").alias("value"), F.col("target.version").alias("version"), "comment", F.coalesce("review_date", F.lit("")).alias("review_date"), "creators", "creator_orcids", "harvested_at")
    flat = flat.withColumn("tie", F.xxhash64("*"))
    return flat.where("review_id is not null").groupBy("review_id").agg(F.max_by(F.struct("family_key", "value", "version", "comment", "review_date", "creators", "creator_orcids"), _latest()).alias("r")).select("review_id", "r.*")


def interaction_rows(responses: DataFrame, comments: DataFrame) -> DataFrame:
    """Distinct responses and discussion comments in one shape."""
    def shape(df: DataFrame, kind: str, key: str, date: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.col(key).alias("event_id"), "target_review_id", "family_key", "content", F.coalesce(date, F.lit("")).alias("event_date"), "creators", "creator_orcids", "harvested_at")

    both = shape(responses, "response", "response_id", "response_date").unionByName(shape(comments, "discussion", "comment_id", "comment_date"))
    both = both.withColumn("tie", F.xxhash64("*"))
    last = F.max_by(F.struct("target_review_id", "family_key", "content", "event_date", "creators", "creator_orcids"), _latest())
    return both.where("event_id is not null").groupBy("kind", "event_id").agg(last.alias("r")).select("kind", "event_id", "r.*")


def kept_reviews(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the reviews that survive among exact duplicates of their round, review_id -> kept for all)."""
    marked = mark_duplicates(reviews, ["family_key", "value"], "review_id", ["review_date"], "comment")
    return reviews.join(marked.where("review_id = kept").select("review_id"), "review_id", "left_semi"), marked.select("review_id", "kept")


def events(reviews: DataFrame, responses: DataFrame, comments: DataFrame) -> DataFrame:
    """kind, event_id, review_id, family_key, value, event_date and content of all events of surviving reviews; interactions
    of a removed duplicate follow its survivor."""
    rows = review_rows(reviews)
    kept, moved = kept_reviews(rows)
    inter = interaction_rows(responses, comments)
    linked = resolve_links(inter.where("target_review_id is not null"), "event_id", "target_review_id", rows, "review_id", ["value"])
    linked = linked.join(moved, "review_id").select("event_id", F.col("kept").alias("review_id"), "value")
    replies = inter.join(linked, "event_id").select("kind", "event_id", "review_id", "family_key", "value", "event_date", "content", "creators")
    own = kept.select(F.lit("review").alias("kind"), F.col("review_id").alias("event_id"), "review_id", "family_key", "value", F.col("review_date").alias("event_date"), F.col("comment").alias("content"), "creators")
    return own.unionByName(replies)


def thread_events(reviews: DataFrame, responses: DataFrame, comments: DataFrame) -> DataFrame:
    """family_key, value, version, round, position and the columns of events, a row for each event of a round in the order of
    its timeline: date, reviews first, id. No list is built, so a hot family is as good as any other."""
    rows = events(reviews, responses, comments).withColumn("reply", F.col("kind") != "review")
    placed = positions(rows, ["family_key", "value"], ["event_date", "reply", "event_id"], "position").drop("reply")
    numbered = number_rounds(target_versions(reviews)).select("family_key", "value", "version", "round")
    return numbered.join(placed, ["family_key", "value"])


def threads(reviews: DataFrame, responses: DataFrame, comments: DataFrame) -> DataFrame:
    """family_key, value, version, round, part, comments, responses, discussions, timeline: the rounds nested, in order.

    A row holds PART_EVENTS events at most, consecutive ones of the timeline; a round of more goes on in the next part, so
    that no row and no task grows with a hot target. A round of fewer is one row, part 1."""
    rows = thread_events(reviews, responses, comments).withColumn("part", F.ceil(F.col("position") / PART_EVENTS).cast("int"))
    item = F.struct("event_date", "event_id", "review_id", "content", "creators")
    listed = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, item)))
    line = F.transform(F.array_sort(F.collect_list(F.struct("position", "event_date", "event_id", "kind", "review_id"))), lambda e: e.dropFields("position"))
    return rows.groupBy("family_key", "value", "version", "round", "part").agg(listed("review").alias("comments"), listed("response").alias("responses"), listed("discussion").alias("discussions"), line.alias("timeline"))


def shaped(rows: DataFrame, extended: bool = False) -> DataFrame:
    """family_key, round_json: the nested rounds as they are written out, a line for each part of a round; the extended
    shape also names the version each round is about and its part."""
    parts = [F.col("round").alias("Round"), F.col("comments").alias("Comments"), F.col("responses").alias("Response"), F.col("discussions").alias("Discussion"), F.col("timeline").alias("Timeline")]
    if extended:
        parts += [F.col("value").alias("Target_DOI"), F.col("part").alias("Part")]
    return rows.select("family_key", "round", "part", F.to_json(F.struct(*parts)).alias("round_json"))
