"""Problem 2: best representative of each duplicate group.

Method: skyline selection. The answers of a target are compared on completeness, recency and trust. Dominance layers are
peeled off: layer 0 is the skyline of the answers no other dominates, layer 1 the skyline of the rest, and so on. Within
a layer a lexicographic policy decides, the latest answer first, then the most trusted, then the lower id. Each field is
taken from the first layer that has it whole, so what the skyline leaves null is filled from the layers behind it.

An answer that dominates another has every field whole that the other has, is not older and not trusted less. So the
latest whole answer of a field always stands in layer 0, and between answers equal in recency and trust the layer, which
there tells the more complete one, comes before the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise
from .skeleton import ordinary_form

FIELDS = ["title", "authors", "year", "fields"]
# What providers write where they have no title, person or field.
NO_TITLE = ["", "-", "--", "n/a", "na", "none", "null", "untitled", "no title", "[no title]", "(no title)", "title not available", "not available", "unknown", "tba", "tbd", "?"]
NO_PERSON = ["", "-", "n/a", "none", "unknown", "anonymous", "et al.", "et al", "and others", "others", "null"]
NO_FIELD = ["", "-", "n/a", "none", "null", "other", "others", "general", "unknown", "misc", "miscellaneous"]
CUT_MARK = "\\s*(?:\\.{2,}|…|[\\[(](?:\\.{2,}|…)[\\])])\\s*$"
INITIALS_ONLY = (
    "^(?:\\p{Lu}(?:\\.[ -]?|[ -]))+[\\p{L}'’-]{2,}(?: [\\p{L}'’-]{2,})*$"
    "|^[\\p{L}'’ -]{2,}, (?:\\p{Lu}(?:\\.[ -]?|[ -]|$))+$"
    "|^[\\p{L}'’-]{2,} \\p{Lu}{1,2}$"
)
FIRST_YEAR, LAST_YEAR = 1500, 2100
#: Letters of a title by which the titles of one target are spread; shorter titles meet the beginnings of that length.
SPREAD = 16


def normal_target(c: Column) -> Column:
    """A target_value as providers send it in its normal form: no blanks, resolver, label or final dot, lower case."""
    c = F.lower(F.regexp_replace(c, "(?U)^\\s+|[\\s.]+$", ""))
    c = F.regexp_replace(c, "^https?://[^/]+/", "")
    return F.regexp_replace(c, "^(?:doi|arxiv)\\s*:\\s*", "")


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["ordinary"] = [None if t is None else " ".join(ordinary_form(t).split()) for t in b["title"]]
        yield b


def _real(values: Column, stand_ins: list[str]) -> Column:
    """The distinct entries of an array that stand for something, trimmed; an empty array for null."""
    trimmed = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda x: F.trim(x))
    return F.array_distinct(F.filter(trimmed, lambda x: x.isNotNull() & ~F.lower(x).isin(stand_ins)))


def answers(metadata: DataFrame, providers: DataFrame) -> DataFrame:
    """One row for each target and provider_record_id, with whole_<field> and trust.

    Whole: a title that is real and not cut short; as many people as any answer of the target names, not all by
    initials; a plausible four-digit year; as many distinct real fields as any answer names. Answers without a known
    provider have the lowest trust. Null or blank targets and null ids give no row; of rows repeating an id the
    latest counts.
    """
    trust = providers.groupBy("provider").agg(F.min("trust_rank").alias("trust"))
    rows = metadata.select(normal_target(F.col("target_value")).alias("target_value"), "provider_record_id", "provider", "title", "authors", "year", "fields", "retrieved_at")
    rows = rows.where("target_value is not null and target_value != '' and provider_record_id is not null")
    rows = rows.groupBy("target_value", "provider_record_id").agg(
        F.max_by(F.struct("provider", "title", "authors", "year", "fields", "retrieved_at"), F.struct("retrieved_at", "provider", "title", "year")).alias("r"),
        F.count("*").alias("__n"),
    )
    rows = rows.select("target_value", "provider_record_id", "r.*").join(F.broadcast(trust), "provider", "left")
    rows = rows.withColumn("trust", F.coalesce("trust", F.lit(2**31 - 1)))
    rows = rows.withColumn("people", _real(F.col("authors"), NO_PERSON)).withColumn("topics", F.size(_real(F.col("fields"), NO_FIELD)))
    # Numbers, not lists, go through the joins below.
    rows = rows.withColumn("named", F.exists("people", lambda p: ~p.rlike(INITIALS_ONLY))).withColumn("people", F.size("people"))

    # Titles: the ordinary form without a leading label; one that begins another title of its target is cut short.
    marked = rows.select("target_value", "title").where("title is not null").distinct()
    marked = marked.mapInPandas(_folded, "target_value string, title string, ordinary string")
    bare = F.lower(F.regexp_replace(F.regexp_replace("ordinary", CUT_MARK, ""), "^(?:\\p{L}+ ){0,2}\\p{L}+(?:: | - )", ""))
    bare = F.regexp_replace(bare, "[ .,;:-]+$", "")  # a final dot more or less is no cut
    stands_in = F.lower(F.trim("ordinary")).isin(NO_TITLE)
    marked = marked.select("target_value", "title", bare.alias("bare"), stands_in.alias("stand_in"), (~stands_in & ~F.col("ordinary").rlike(CUT_MARK)).alias("real"))
    marked = materialise(marked, "titles")  # read twice below; the fold runs once
    stems = marked.where("bare != '' and not stand_in").select("target_value", "bare").distinct()
    cut = cut_short(stems).withColumn("cut", F.lit(True))
    whole = marked.join(cut, ["target_value", "bare"], "left").select("target_value", "title", (F.col("real") & F.col("cut").isNull()).alias("whole_title"))
    rows = rows.join(whole, ["target_value", "title"], "left")

    most = rows.groupBy("target_value").agg(F.max("people").alias("most_people"), F.max("topics").alias("most_topics"), F.count("*").alias("answers"))
    rows = rows.join(most, "target_value")
    year = F.trim("year")
    return rows.select(
        "target_value", "provider_record_id", "provider", "trust", "retrieved_at", "title", "authors", "year", "fields", "answers",
        F.coalesce("whole_title", F.lit(False)).alias("whole_title"),
        ((F.col("people") > 0) & (F.col("people") == F.col("most_people")) & F.col("named")).alias("whole_authors"),
        F.coalesce(year.rlike("^[0-9]{4}$") & F.expr(f"try_cast(trim(year) as int) between {FIRST_YEAR} and {LAST_YEAR}"), F.lit(False)).alias("whole_year"),
        ((F.col("topics") > 0) & (F.col("topics") == F.col("most_topics"))).alias("whole_fields"),
    )


def cut_short(stems: DataFrame) -> DataFrame:
    """The rows of stems (target_value, bare, distinct) that are a proper beginning of another title of their target.

    In sorted order a proper beginning stands right before a text that continues it. A hot target is spread by the first
    SPREAD letters; titles shorter than that are looked for among the distinct beginnings of that length.
    """
    head = F.substring("bare", 1, SPREAD)
    following = lambda by: F.lead("bare").over(Window.partitionBy("target_value", by).orderBy("bare"))
    long = stems.where(F.length("bare") >= SPREAD).withColumn("next", following(head))
    heads = stems.select("target_value", head.alias("bare")).distinct().withColumn("next", following(F.substring("bare", 1, 2)))
    short = heads.where((F.length("bare") < SPREAD) & (F.length("bare") > 1))
    # A single letter has no two to be spread by; it is cut short if any longer title of its target begins with it.
    one = stems.where(F.length("bare") == 1).join(stems.where(F.length("bare") > 1).select("target_value", F.substring("bare", 1, 1).alias("bare")).distinct(), ["target_value", "bare"], "left_semi")
    return long.unionByName(short).where(F.startswith("next", "bare")).select("target_value", "bare").unionByName(one)


def layers(rows: DataFrame) -> DataFrame:
    """target_value, met: the answers of each target that can matter (layer, older, trust, missing, mask, id), by policy.

    Of answers with the same whole fields and trust all but the latest are dominated; they are dropped before the
    answers of a target come together, so that at most 16 x the number of providers meet, however many there are.
    layer is the dominance layer: 0 for the skyline, else one more than the highest layer among those that dominate it,
    which is the round in which peeling skylines off would reach it.
    """
    mask = sum(F.col(f"whole_{f}").cast("int") * 2**i for i, f in enumerate(FIELDS))
    older = -F.unix_micros(F.coalesce("retrieved_at", F.timestamp_micros(F.lit(0))))
    best = rows.withColumn("mask", mask).groupBy("target_value", "mask", "trust").agg(F.min(F.struct(older.alias("older"), F.col("provider_record_id").alias("id"))).alias("r"))
    one = F.struct(F.col("r.older").alias("older"), "trust", (len(FIELDS) - F.bit_count("mask")).alias("missing"), "mask", F.col("r.id").alias("id"))
    # Sorted so that whatever dominates an answer stands before it: latest, most trusted, fewest fields missing.
    met = best.groupBy("target_value").agg(F.array_sort(F.collect_list(one)).alias("met"))
    # x dominates y: nowhere worse, somewhere better. Completeness is compared field by field.
    dominates = lambda x, y: (
        (x["mask"].bitwiseAND(y["mask"]) == y["mask"]) & (x["older"] <= y["older"]) & (x["trust"] <= y["trust"]) & ((x["mask"] != y["mask"]) | (x["older"] < y["older"]) | (x["trust"] < y["trust"]))
    )
    above = lambda done, y: F.array_max(F.transform(F.filter(done, lambda x: dominates(x, y)), lambda x: x["layer"]))
    placed = lambda done, y: F.struct((F.coalesce(above(done, y), F.lit(-1)) + 1).alias("layer"), *[y[c].alias(c) for c in ("older", "trust", "missing", "mask", "id")])
    none = F.array().cast("array<struct<layer:int,older:bigint,trust:int,missing:int,mask:int,id:bigint>>")
    return met.select("target_value", F.array_sort(F.aggregate("met", none, lambda done, y: F.concat(done, F.array(placed(done, y))))).alias("met"))


def _first_whole(bit: int) -> Column:
    """The id of the first answer, by layer and then by policy, that has the field of this bit whole."""
    return F.get(F.filter("met", lambda x: x["mask"].bitwiseAND(F.lit(bit)) != 0), F.lit(0))["id"]


def _picks(met: DataFrame) -> DataFrame:
    picks = [F.struct(F.lit(f).alias("field_name"), _first_whole(2**i).alias("provider_record_id")) for i, f in enumerate(FIELDS)]
    return met.select("target_value", F.explode(F.array(*picks)).alias("p")).select("target_value", "p.*")


def survivors(metadata: DataFrame, providers: DataFrame) -> DataFrame:
    """target_value, field_name, provider_record_id for targets with two or more answers.

    For each field: of the answers where it is whole, the one of the lowest dominance layer, there the latest
    retrieved_at, ties going to the lower trust_rank, then to the lower provider_record_id. A field no answer has whole
    gives no row. A null retrieved_at counts as the earliest. Empty tables give an empty result; other columns are
    ignored.
    """
    return _picks(layers(answers(metadata, providers).where("answers > 1"))).where("provider_record_id is not null")


def merged(metadata: DataFrame, providers: DataFrame) -> DataFrame:
    """One surviving record for each target: title, authors, year and fields, each from its best answer."""
    rows = answers(metadata, providers)
    picked = _picks(layers(rows)).join(rows.select("target_value", "provider_record_id", *FIELDS), ["target_value", "provider_record_id"], "left")
    of = lambda f, c: F.any_value(F.when(F.col("field_name") == f, F.col(c)), F.lit(True))
    return picked.groupBy("target_value").agg(*[of(f, f).alias(f) for f in FIELDS], *[of(f, "provider_record_id").alias(f"{f}_from") for f in FIELDS])
