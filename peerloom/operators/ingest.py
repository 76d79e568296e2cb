"""Semi-structured records and registry answers in typed columns.

Records arrive as JSON text whose fields may be missing or of another type; they are parsed to VARIANT once, and each
field is read by a path that gives null where it does not fit. Nothing here leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import arxiv_id, arxiv_version, doi, family, leading_year, orcid, squash, version


def parsed(df: DataFrame, json: str = "record") -> DataFrame:
    """df with v, the VARIANT of a JSON column; text that is no JSON gives null."""
    return df.withColumn("v", F.try_parse_json(json))


def text(path: str, of: str | Column = "v") -> Column:
    """A scalar by path as trimmed text, '' where there is none."""
    return squash(F.try_variant_get(of if isinstance(of, Column) else F.col(of), path, "string"))


def items(path: str, of: str = "v") -> Column:
    """A list by path, its entries still VARIANT; an empty list where there is none."""
    return F.coalesce(F.try_variant_get(F.col(of), path, "array<variant>"), F.array().cast("array<variant>"))


def first_of(*values: Column) -> Column:
    """The first that is not ''."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def unique(values: Column) -> Column:
    """The non-empty entries once each, in their order."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (x != "")))


def _first_orcid(values: Column) -> Column:
    """The first ORCID among identifiers of any kind, '' if there is none."""
    return F.coalesce(F.get(F.filter(F.transform(values, orcid), lambda v: v != ""), F.lit(0)), F.lit(""))


def record_keys(records: DataFrame, prefix: str) -> DataFrame:
    """records with review_id: the first valid DOI of a record, else one made of prefix and a numeric id, else record: and the id."""
    made = F.when(F.col("record_id").rlike("^[0-9]+$"), F.concat(F.lit(prefix), "record_id")).otherwise(F.concat(F.lit("record:"), "record_id"))
    found = first_of(doi(text("$.pids.doi.identifier")), doi(text("$.metadata.doi")), doi(text("$.doi")))
    return records.withColumn("review_id", F.coalesce(F.nullif(found, F.lit("")), made))


def people(records: DataFrame) -> DataFrame:
    """records with creators, creator_orcids and subjects, unique in their order; an entry may be an object or a plain string."""
    creators, subjects = items("$.metadata.creators"), items("$.metadata.subjects")
    return (
        records.withColumn("creators", unique(F.transform(creators, lambda x: first_of(text("$.name", x), text("$", x)))))
        .withColumn("creator_orcids", unique(F.transform(creators, lambda x: first_of(orcid(text("$.orcid", x)), _first_orcid(F.transform(F.coalesce(F.try_variant_get(x, "$.nameIdentifiers", "array<variant>"), F.array().cast("array<variant>")), lambda n: text("$.nameIdentifier", n)))))))
        .withColumn("subjects", unique(F.transform(subjects, lambda x: first_of(text("$.term", x), text("$", x)))))
        .withColumn("record_date", F.substring(first_of(text("$.metadata.publication_date"), text("$.created")), 1, 10))
    )


def _related(records: DataFrame, key: str) -> DataFrame:
    """A row for each related identifier: key, pos, relation, kind, raw, doi (also from the path of an address)."""
    rows = records.select(key, F.posexplode(items("$.metadata.related_identifiers")).alias("pos", "r"))
    kind = first_of(text("$.resource_type.type", F.col("r")), text("$.resource_type.id", F.col("r")), text("$.resource_type", F.col("r")))
    raw = first_of(text("$.identifier", F.col("r")), text("$.id", F.col("r")), text("$.value", F.col("r")))
    rows = rows.select(key, "pos", F.lower(first_of(text("$.relation", F.col("r")), text("$.relation_type", F.col("r")))).alias("relation"), F.lower(kind).alias("kind"), raw.alias("raw"), text("$.scheme", F.col("r")).alias("scheme"))
    path = F.regexp_replace(F.coalesce(F.try_parse_url(F.when(F.col("raw").rlike("(?i)^https?://"), F.col("raw")), F.lit("PATH")), F.lit("")), "^/+", "")
    return rows.withColumn("doi", first_of(doi(F.col("raw")), doi(path)))


def targets(records: DataFrame, key: str = "record_id", relation: str = "reviews", kind: str = "preprint") -> DataFrame:
    """key, target, reason for every record: what it explicitly is about.

    Related identifiers of the relation count whose kind is empty or mentions kind. One target, or several of one
    family, of which the highest version is taken (multiple_same_family); of many families none (ambiguous); none at all
    (none). reason is ok otherwise."""
    rows = _related(records, key).where((F.col("relation") == relation) & ((F.col("kind") == "") | F.col("kind").contains(kind)))
    arxiv = F.regexp_extract(F.col("raw"), "(?i)((?:[a-z.-]+/[0-9]{7}|[0-9]{4}\\.[0-9]{4,5})(?:v[0-9]+)?)", 1)
    value = first_of(F.col("doi"), arxiv_id(arxiv))
    rows = rows.select(
        key, "pos", value.alias("value"), F.when(F.col("doi") != "", "doi").otherwise("arxiv").alias("target_kind"), "doi",
        F.when(F.col("doi") != "", family(F.col("doi"))).otherwise(F.concat(F.lit("arxiv:"), arxiv_id(arxiv))).alias("family_key"),
        F.when(F.col("doi") != "", version(F.col("doi"))).otherwise(arxiv_version(arxiv)).alias("version"), F.col("raw").alias("source_identifier"), "scheme",
    ).where("value != ''")
    target = F.struct(F.col("target_kind").alias("kind"), "value", "doi", "family_key", "version", first_of(F.col("scheme"), F.col("target_kind")).alias("scheme"), "source_identifier")
    found = rows.groupBy(key).agg(
        F.max_by(target, F.struct(F.col("version").isNotNull(), F.coalesce("version", F.lit(0)), "value", -F.col("pos"))).alias("target"),
        F.countDistinct("value").alias("n"), F.countDistinct("family_key").alias("families"),
    )
    reason = F.when(F.col("families").isNull(), "none").when(F.col("families") > 1, "ambiguous").when(F.col("n") > 1, "multiple_same_family").otherwise("ok")
    return records.select(key).join(found, key, "left").select(key, F.when(F.col("families") == 1, F.col("target")).alias("target"), reason.alias("reason"))


def links(records: DataFrame, key: str = "record_id", relations: tuple[str, ...] = ("cites", "isresponseto", "references")) -> DataFrame:
    """key, link: a row for each distinct DOI a record is related to in one of these ways."""
    return _related(records, key).where(F.col("relation").isin(list(relations)) & (F.col("doi") != "")).select(key, F.col("doi").alias("link")).distinct()


def bodies(records: DataFrame, attachments: DataFrame, key: str = "record_id", order: tuple[str, ...] = ("description", "html", "pdf")) -> DataFrame:
    """key, body, body_source: the first non-blank of a record's description and attached texts (key, kind, text) in order."""
    texts = attachments.where(F.trim(F.coalesce("text", F.lit(""))) != "").groupBy(key).pivot("kind", ["html", "pdf"]).agg(F.min("text"))
    rows = records.select(key, F.try_variant_get("v", "$.metadata.description", "string").alias("description")).join(texts, key, "left")
    has = [(F.trim(F.coalesce(o, F.lit(""))) != "", o) for o in order]
    body, source = F.lit(None).cast("string"), F.lit("")
    for there, o in reversed(has):
        body, source = F.when(there, F.col(o)).otherwise(body), F.when(there, o).otherwise(source)
    return rows.select(key, F.coalesce(body, F.lit("")).alias("body"), source.alias("body_source"))


# Where a work's date stands, in this order.
DATE_KEYS = ["posted", "published-online", "published", "issued", "published-print"]


def _named(people_: Column, *paths: tuple[str, ...]) -> Column:
    """Names of people by the first of paths that is there; a path of two parts is joined by a blank."""
    one = lambda x: first_of(*[F.trim(F.concat_ws(" ", *[F.nullif(text(p, x), F.lit("")) for p in parts])) for parts in paths], text("$", x))
    return unique(F.transform(people_, one))


def _orcids(people_: Column, *paths: str) -> Column:
    return unique(F.flatten(F.transform(people_, lambda x: F.array(*[orcid(text(p, x)) for p in paths]))))


def registry_answers(answers: DataFrame) -> DataFrame:
    """target_value, provider, title, authors, author_orcids, year, venue_candidates, fields of answers
    (target_value, provider, v), whose shape is known by provider: works, dois or graph."""
    works = {
        "title": first_of(text("$.message.title[0]"), text("$.message.title")), "people": items("$.message.author"),
        "year": first_of(*[F.regexp_extract(text(f"$.message['{k}']['date-parts'][0][0]"), "^([0-9]{4})$", 1) for k in DATE_KEYS]),
        "venues": F.flatten(F.array(*[F.transform(items(f"$.message['{k}']"), lambda x: text("$", x)) for k in ("container-title", "short-container-title", "institution", "group-title")], F.array(text("$.message.URL")), F.transform(items("$.message.link"), lambda x: text("$.URL", x)))),
        "fields": F.transform(items("$.message.subject"), lambda x: text("$", x)),
    }
    a = "$.data.attributes"
    titles = F.filter(F.transform(items(f"{a}.titles"), lambda x: text("$.title", x)), lambda t: t != "")
    dois = {
        "title": F.coalesce(F.get(titles, F.lit(0)), F.lit("")), "people": items(f"{a}.creators"),
        "year": first_of(F.regexp_extract(text(f"{a}.publicationYear"), "^([0-9]{4})$", 1), leading_year(text(f"{a}.published"))),
        "venues": F.array(text(f"{a}.publisher"), text(f"{a}.url"), text(f"{a}.container.title")),
        "fields": F.transform(items(f"{a}.subjects"), lambda x: first_of(text("$.subject", x), text("$", x))),
    }
    graph = {
        "title": first_of(text("$.title"), text("$.display_name")), "people": items("$.authorships"), "year": text("$.publication_year"),
        "venues": F.array(text("$.primary_location.source.display_name"), text("$.primary_location.source.host_organization_name"), text("$.primary_location.landing_page_url"), text("$.primary_location.pdf_url")),
        "fields": F.concat(F.array(text("$.primary_topic.display_name")), F.transform(items("$.topics"), lambda x: text("$.display_name", x))),
    }
    shapes = {"works": works, "dois": dois, "graph": graph}
    pick = lambda part: F.coalesce(*[F.when(F.col("provider") == name, shape[part]) for name, shape in shapes.items()])
    rows = answers.select("target_value", "provider", pick("title").alias("title"), pick("people").alias("people"), pick("year").alias("year"), pick("venues").alias("venues"), pick("fields").alias("fields"))
    names = (("$.given", "$.family"), ("$.name",), ("$.givenName", "$.familyName"), ("$.person_or_org.name",), ("$.person_or_org.given_name", "$.person_or_org.family_name"), ("$.author.display_name",))
    return rows.select(
        "target_value", "provider", "title", _named(F.col("people"), *names).alias("authors"),
        _orcids(F.col("people"), "$.ORCID", "$.orcid", "$.person_or_org.orcid", "$.author.orcid", "$.nameIdentifiers[0].nameIdentifier").alias("author_orcids"),
        "year", F.filter("venues", lambda x: x != "").alias("venue_candidates"), unique(F.col("fields")).alias("fields"),
    )
