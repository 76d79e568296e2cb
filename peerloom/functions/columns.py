"""Column functions: text folding, identifiers, dates and name keys. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How identifiers are written.
DOI = "10\\.[0-9]{4,9}/[-._;()/:A-Za-z0-9]+"
RESOLVER = "^https?://(?:dx\\.)?doi\\.[a-z]+/"
VERSION = "(?:[._-]v|/v|[._-]version)([0-9]+)$"
ARXIV = "([a-z.-]+/[0-9]{7}|[0-9]{4}\\.[0-9]{4,5})(?:v([0-9]+))?"
ORCID = "\\b([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9Xx])\\b"
ISO_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
# Elements whose tags count as markup.
TAGS = (
    "a abbr article aside b blockquote br code dd div dl dt em figcaption figure h1 h2 h3 h4 h5 h6 hr i img li ol p pre q s section small span strong sub sup "
    "table tbody td th thead tr u ul"
).split()


def squash(c: Column) -> Column:
    """Blanks, tabs and line ends collapsed to one blank, trimmed; null as an empty string."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[ \\t\\r\\n\\f]+", " "))


def body_hash(c: Column) -> Column:
    """SHA-256 of the folded body: bodies that differ in case and blanks only are equal."""
    return F.sha2(F.lower(squash(c)), 256)


def doi(c: Column) -> Column:
    """The lower-case DOI in an identifier, resolver address or labelled text; an empty string if it holds none."""
    c = F.coalesce(c, F.lit(""))
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x2F;", "/"), ("&#47;", "/"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), f"(?i){RESOLVER}", ""), "(?i)^doi:\\s*", "")
    bare = F.regexp_replace(bare, "[.,;:)\\]}>]+$", "")
    return F.when(bare.rlike(f"^{DOI}$"), F.lower(bare)).otherwise("")


def _arxiv(c: Column, group: int) -> Column:
    """A part of the identifier a text is, else of the first one it holds, as in an address or a report number."""
    c = F.coalesce(c, F.lit(""))
    whole = F.regexp_extract(c, f"(?i)^(?:arxiv:)?{ARXIV}$", group)
    return F.when(c.rlike(f"(?i)^(?:arxiv:)?{ARXIV}$"), whole).otherwise(F.regexp_extract(c, f"(?i)(?:arxiv[.:/]|/abs/|/pdf/){ARXIV}", group))


def arxiv_id(c: Column) -> Column:
    return F.lower(_arxiv(c, 1))


def arxiv_version(c: Column) -> Column:
    return F.nullif(_arxiv(c, 2), F.lit("")).cast("int")


def output_family(c: Column) -> Column:
    """The family of an identifier as it is written out: that of its DOI; an empty string if it holds none."""
    return F.when(doi(c) != "", family(doi(c))).otherwise("")


def encoded(c: Column) -> Column:
    """Percent-encoded, with no character kept safe but letters, digits and -_.~; blanks as %20."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def family(doi_value: Column) -> Column:
    """doi: and the DOI without a trailing version."""
    return F.concat(F.lit("doi:"), F.regexp_replace(F.lower(F.trim(doi_value)), VERSION, ""))


def version(doi_value: Column) -> Column:
    """The number of a trailing version, else null."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(doi_value)), VERSION, 1), F.lit("")).cast("int")


def orcid(c: Column) -> Column:
    return F.upper(F.regexp_extract(F.coalesce(c, F.lit("")), ORCID, 1))


def iso_date(c: Column) -> Column:
    """Whether a text has the shape of a date; its value is not judged."""
    return F.coalesce(c.rlike(ISO_DATE), F.lit(False))


def leading_year(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), "^([0-9]{4})", 1)


def has_markup(c: Column) -> Column:
    """Whether a text holds a tag of a known element; a bare 'a < b' is none."""
    return F.coalesce(c.rlike(f"(?i)</?(?:{'|'.join(TAGS)})(?:[ /][^<>]*)?>"), F.lit(False))


def name_key(c: Column) -> Column:
    """The sorted ASCII words of a name, joined: equal for names that differ in order, case and marks."""
    return F.array_join(F.array_sort(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))), " ")


def name_keys(names: Column) -> Column:
    """The distinct keys of a list of names, empty ones left out; null as an empty list."""
    keys = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: name_key(F.coalesce(n, F.lit(""))))
    return F.array_distinct(F.filter(keys, lambda k: k != ""))


def orcids(values: Column) -> Column:
    found = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: orcid(v))
    return F.array_distinct(F.filter(found, lambda v: v != ""))


def first_seen(values: Column) -> Column:
    """The non-blank entries of a list once each, in their order."""
    trimmed = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.trim(v))
    return F.array_distinct(F.filter(trimmed, lambda v: v.isNotNull() & (v != "")))


def word_jaccard(left: Column, right: Column) -> Column:
    """Shared share of the distinct ASCII words of two texts; 1 if either has none."""
    a, b = (F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))) for c in (left, right))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def first_match(text: Column, table: list[tuple[str, str]], how: str = "contains") -> Column:
    """The label of the first needle of an ordered table that text contains (or starts with); an empty string if none.

    A CASE chain: no join, and the optimiser folds it."""
    out: Column | None = None
    for needle, label in table:
        hit = F.contains(text, F.lit(needle)) if how == "contains" else F.startswith(text, F.lit(needle))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return F.lit("") if out is None else out.otherwise("")


def seeded(seed: str, key: Column) -> Column:
    """A key's place in a seeded order: SHA-256 of the seed, a NUL and the key."""
    return F.sha2(F.concat(F.lit(seed), F.chr(F.lit(0)), key), 256)
