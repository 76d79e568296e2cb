"""Data-quality constraints as rows: each broken one gives constraint, record_key and detail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import family, has_markup, iso_date, orcid, squash
from .links import reconcile

Constraint = tuple[str, Column, Column]


def breaches(rows: DataFrame, key: str, constraints: list[Constraint]) -> DataFrame:
    """constraint, record_key, detail for every row and (name, broken, detail) that holds. One pass over rows."""
    found = F.filter(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(name).alias("constraint"), F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))) for name, broken, detail in constraints]), lambda x: x.isNotNull())
    return rows.select(F.col(key).alias("record_key"), F.explode(found).alias("b")).select("b.constraint", "record_key", "b.detail")


def record_constraints(text: str, date: str) -> list[Constraint]:
    """What holds for any single record."""
    bad_orcid = F.exists("creator_orcids", lambda v: orcid(v) == "")
    return [
        ("text_empty", squash(F.col(text)) == "", F.lit("")),
        ("date_shape", ~iso_date(F.col(date)), F.col(date)),
        ("markup_in_text", has_markup(F.col(text)), F.lit("")),
        ("orcid_shape", bad_orcid, F.array_join("creator_orcids", " ")),
        ("no_creator", F.coalesce(F.size("creators"), F.lit(0)) < 1, F.lit("")),
        ("url_missing", F.trim(F.coalesce(F.col("record_url"), F.lit(""))) == "", F.lit("")),
    ]


def repeated_keys(rows: DataFrame, key: str, name: str) -> DataFrame:
    n = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return n.select(F.lit(name).alias("constraint"), F.col(key).alias("record_key"), F.col("n").cast("string").alias("detail"))


def dangling(rows: DataFrame, key: str, link: str, known: DataFrame, known_key: str, name: str) -> DataFrame:
    """Rows whose link names no known record."""
    lost = rows.where(F.col(link).isNotNull()).join(known.select(F.col(known_key).alias(link)), link, "left_anti")
    return lost.select(F.lit(name).alias("constraint"), F.col(key).alias("record_key"), F.col(link).alias("detail"))


def too_early(rows: DataFrame, key: str, date: str, link: str, known: DataFrame, known_key: str, known_date: str, name: str) -> DataFrame:
    """Rows dated before what they answer, where both dates have their shape."""
    there = known.where(iso_date(F.col(known_date))).groupBy(known_key).agg(F.min(known_date).alias("answered"))
    met = rows.where(iso_date(F.col(date))).join(there, F.col(link) == F.col(known_key)).where(F.col(date) < F.col("answered"))
    return met.select(F.lit(name).alias("constraint"), F.col(key).alias("record_key"), F.col(date).alias("detail"))


def consecutive(rounds: DataFrame, group: str, number: str, name: str) -> DataFrame:
    """Groups whose numbers are not 1..n."""
    before = F.coalesce(F.lag(number).over(Window.partitionBy(group).orderBy(number)), F.lit(0))
    gaps = rounds.withColumn("before", before).where(F.col(number) != F.col("before") + 1)
    return gaps.select(F.lit(name).alias("constraint"), F.col(group).alias("record_key"), F.col(number).cast("string").alias("detail"))


def shape(rows: DataFrame, columns: list[str], expected: int | None = None) -> DataFrame:
    """Issues of a table as a whole: columns that are missing, not expected or out of order, and another number of rows."""
    spark, issues = rows.sparkSession, [("column_missing", c, "") for c in columns if c not in rows.columns] + [("column_unexpected", c, "") for c in rows.columns if c not in columns]
    if not issues and rows.columns != columns:
        issues.append(("column_order", ", ".join(rows.columns), ""))
    out = spark.createDataFrame(issues, "constraint string, record_key string, detail string")
    if expected is None:
        return out
    n = rows.agg(F.count("*").alias("n")).where(F.col("n") != expected)
    return out.unionByName(n.select(F.lit("row_count").alias("constraint"), F.lit(str(expected)).alias("record_key"), F.col("n").cast("string").alias("detail")))


def paper_constraints(first_year: int, last_year: int) -> list[Constraint]:
    """What holds for a row of the output: a title on one line without markup, people with names, a plausible year, rounds."""
    year = F.coalesce("year", F.lit(""))
    return [
        ("doi_shape", F.coalesce(F.col("doi"), F.lit("")) == "", F.col("doi")),
        ("title_missing", squash(F.col("title")) == "", F.lit("")),
        ("title_markup", has_markup(F.col("title")) | F.col("title").rlike("[\\r\\n]"), F.col("title")),
        ("year_shape", ~year.rlike("^[0-9]{4}$"), year),
        ("year_range", year.rlike("^[0-9]{4}$") & ~year.between(str(first_year), str(last_year)), year),
        ("authors_missing", F.coalesce(F.size("authors"), F.lit(0)) < 1, F.lit("")),
        ("author_blank", F.exists("authors", lambda a: F.trim(F.coalesce(a, F.lit(""))) == ""), F.lit("")),
        ("rounds_missing", F.coalesce(F.col("rounds"), F.lit(0)) < 1, F.lit("")),
    ]


def repeated_families(papers: DataFrame) -> DataFrame:
    """Rows of the output that share the family of their DOI with another one; rows without a DOI are not judged."""
    rows = papers.where(F.coalesce(F.col("doi"), F.lit("")) != "").select(family(F.col("doi")).alias("f"))
    n = rows.groupBy("f").agg(F.count("*").alias("n")).where("n > 1")
    return n.select(F.lit("family_repeated").alias("constraint"), F.col("f").alias("record_key"), F.col("n").cast("string").alias("detail"))


def round_shape(events: DataFrame) -> DataFrame:
    """Issues of rounds given as events (family_key, value, kind, event_id, review_id, position): a round without a review,
    an event that stands twice in its round, a reply to a review that is not in its round, and positions that are not 1..n."""
    place = F.concat_ws(" ", "family_key", "value")
    kinds = events.groupBy(place.alias("record_key")).agg(F.count_if(F.col("kind") == "review").alias("reviews"), F.max("position").alias("last"), F.count("*").alias("n"), F.countDistinct("position").alias("places"))
    empty = kinds.where("reviews = 0").select(F.lit("round_without_review").alias("constraint"), "record_key", F.lit("").alias("detail"))
    gaps = kinds.where("last != n or places != n").select(F.lit("timeline_positions").alias("constraint"), "record_key", F.col("last").cast("string").alias("detail"))
    twice = events.groupBy(place.alias("record_key"), "event_id").agg(F.count("*").alias("n")).where("n > 1")
    twice = twice.select(F.lit("event_twice").alias("constraint"), "record_key", F.col("event_id").alias("detail"))
    own = events.where("kind = 'review'").select(F.col("event_id").alias("review_id"), "family_key", "value").distinct()
    lost = events.where("kind != 'review'").join(own, ["review_id", "family_key", "value"], "left_anti")
    return empty.unionByName(gaps).unionByName(twice).unionByName(lost.select(F.lit("reply_outside_round").alias("constraint"), place.alias("record_key"), F.col("event_id").alias("detail")))


def coverage(expected: DataFrame, written: DataFrame, key: str, name: str) -> DataFrame:
    """Ids that are expected and not written, or written and not expected."""
    return reconcile(expected, written, key).select(F.concat(F.lit(f"{name}_"), "side").alias("constraint"), F.col(key).alias("record_key"), F.lit("").alias("detail"))


def audit_against_rows(audit: DataFrame, rows: DataFrame) -> DataFrame:
    """Issues of an audit (position, doi, family_key, provenance) beside the rows it tells about (position, doi), joined by position:
    a position on one side only, another DOI, a family that is not the DOI's (rows without a DOI are not judged), and fields
    without a source."""
    a = audit.select("position", F.col("doi").alias("audit_doi"), "family_key", "provenance").withColumn("a", F.lit(True))
    r = rows.select("position", F.col("doi").alias("row_doi")).withColumn("r", F.lit(True))
    both = a.join(r, "position", "full_outer")
    doi_ = F.coalesce(F.col("audit_doi"), F.lit(""))
    known = F.col("a").isNotNull() & F.col("r").isNotNull()
    bare = F.exists(F.map_values("provenance"), lambda v: v.isNull() | (v == ""))
    return breaches(both, "position", [
        ("audit_missing", F.col("a").isNull(), F.col("row_doi")), ("row_missing", F.col("r").isNull(), F.col("audit_doi")),
        ("doi_differs", known & ~F.col("audit_doi").eqNullSafe(F.col("row_doi")), F.col("audit_doi")),
        ("family_differs", known & (doi_ != "") & ~F.col("family_key").eqNullSafe(family(doi_)), F.col("family_key")),
        ("field_without_source", known & F.coalesce(bare, F.lit(True)), F.lit("")),
    ])


def report(issues: DataFrame) -> DataFrame:
    """constraint, issues: how often each constraint is broken; passed if there is no row."""
    return issues.groupBy("constraint").agg(F.count("*").alias("issues"))


def all_issues(*issues: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, issues).distinct()
