"""Queries of the core operators, each beside the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import texts as X
from ..operators import dedup, ingest, links, merge, papers, rounds, sampling, threads, validate
from ..sources import files
from ..sources.tables import table
from ..storage import scratch_dir
from ..streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
SEED = "peerloom"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


# Identifier prefixes of the test tables and a label for each, more specific ones first.
PREFIXES = [("10.99011/quarry.", "Quarry"), ("10.99012/bq.", "BioQuarry"), ("10.99013/hall", "Deposit Hall"), ("10.99014/omp/", "Open Meridian Preprints"), ("10.99015/strand.", "Strand"), ("10.99016/", "Other")]
# Of these prefixes a venue follows from the identifier alone, and for those the second provider is asked first.
VENUE_PREFIXES = PREFIXES[:3]
SWAP = (["10.99013/", "10.99014/"], "CrossIndex", "DataRegister")
_BY_PREFIX = "case " + " ".join(f"when starts_with(o.target_value, '{p}') then '{v}'" for p, v in VENUE_PREFIXES) + " else '' end"
_SWAPPED = "(" + " or ".join(f"starts_with(o.target_value, '{p}')" for p in SWAP[0]) + ")"

# SQL shared by several queries.
FOLD = r"trim(regexp_replace(lower(coalesce({0}, '')), '[ \t\r\n\f]+', ' ', 'g'))"
BODY = f"sha256({FOLD})"
REVIEWS = "rv as (select review_id, arg_max(struct_pack(family_key := target.family_key, value := target.value, version := target.version, comment := comment, review_date := coalesce(review_date, ''), creators := creators, creator_orcids := creator_orcids), harvested_at) r from reviews where review_id is not null group by review_id), flat as (select review_id, r.* from rv)"
INTERACTIONS = (
    "raw as (select 'response' kind, response_id event_id, target_review_id, family_key, content, coalesce(response_date, '') event_date, creators, creator_orcids, harvested_at from author_responses "
    "union all select 'discussion', comment_id, target_review_id, family_key, content, coalesce(comment_date, ''), creators, creator_orcids, harvested_at from discussion_comments), "
    "inter as (select kind, event_id, r.* from (select kind, event_id, arg_max(struct_pack(target_review_id := target_review_id, family_key := family_key, content := content, event_date := event_date, creators := creators, creator_orcids := creator_orcids), harvested_at) r from raw where event_id is not null group by kind, event_id))"
)
MARKED = f"hashed as (select *, {BODY.format('comment')} body_hash from flat), best as (select family_key, value, body_hash, arg_min(review_id, struct_pack(a := review_date, b := review_id)) kept, count(*) copies from hashed group by all), marked as (select h.*, b.kept, b.copies from hashed h join best b on h.family_key is not distinct from b.family_key and h.value is not distinct from b.value and h.body_hash = b.body_hash)"
VERSIONS = "versions as (select target.family_key family_key, target.value \"value\", min(target.version) \"version\", coalesce(min(nullif(coalesce(review_date, ''), '')), '9999') first_date, count(distinct review_id) reviews from reviews group by 1, 2)"
NUMBERED = VERSIONS + ", numbered as (select *, cast(row_number() over (partition by family_key order by version asc nulls last, first_date, value) as int) round from versions)"
EVENTS = f"{REVIEWS}, {INTERACTIONS}, {MARKED}, linked as (select i.event_id, m.kept review_id, m.value from inter i join marked m on i.target_review_id = m.review_id), events as (select 'review' kind, review_id event_id, review_id, family_key, value, review_date event_date from marked where review_id = kept union all select i.kind, i.event_id, l.review_id, i.family_key, l.value, i.event_date from inter i join linked l on i.event_id = l.event_id)"
TARGET = r"regexp_replace(regexp_replace(regexp_replace(lower(trim({0}, ' ')), '[ .]+$', ''), '^https?://[^/]+/', ''), '^(?:doi|arxiv): *', '')"
ANSWERS = (
    f"one as (select {TARGET.format('target_value')} target_value, provider_record_id, max(struct_pack(provider := provider, title := title, authors := authors, author_orcids := author_orcids, year := year, venue_candidates := venue_candidates)) r from provider_metadata group by 1, 2), "
    "venue_of as (select distinct u.target_value, u.provider_record_id from (select target_value, provider_record_id, unnest(r.venue_candidates) c from one) u join venues v on contains(lower(trim(u.c, ' ')), lower(v.venue_name))), "
    f"ranked as (select o.target_value, o.provider_record_id, o.r.provider provider, coalesce(p.trust_rank, 99) trust_rank, ({_BY_PREFIX}) <> '' or vo.target_value is not null has_venue, nullif(trim(o.r.title, ' '), '') title, "
    "list_filter(list_transform(coalesce(o.r.authors, []), lambda x: trim(x, ' ')), lambda x: x is not null and x <> '') authors, "
    f"case when regexp_matches(trim(o.r.year, ' '), '^[0-9]{{4}}$') then trim(o.r.year, ' ') end \"year\" from one o left join providers p on p.provider = case when {_SWAPPED} and o.r.provider = '{SWAP[1]}' then '{SWAP[2]}' when {_SWAPPED} and o.r.provider = '{SWAP[2]}' then '{SWAP[1]}' else o.r.provider end left join venue_of vo on vo.target_value = o.target_value and vo.provider_record_id = o.provider_record_id), "
    "running as (select *, coalesce(bool_or(title is not null) over w, false) and coalesce(bool_or(len(authors) > 0) over w, false) and coalesce(bool_or(year is not null) over w, false) and coalesce(bool_or(has_venue) over w, false) done from ranked window w as (partition by target_value order by trust_rank, provider_record_id rows between unbounded preceding and 1 preceding)), used as (select * from running where not done)"
)
ORDERED = f"families as (select family_key, count(distinct target_value) n, max(case when status = 'resolved' then 1 else 0 end) resolved from targets where family_key is not null group by 1), placed as (select *, sha256('{SEED}' || chr(0) || family_key) place from families)"


def _flat(s: SparkSession, d: str) -> DataFrame:
    return threads.review_rows(table(s, d, "reviews"))


def _interactions(s: SparkSession, d: str) -> DataFrame:
    return threads.interaction_rows(table(s, d, "author_responses"), table(s, d, "discussion_comments"))


def _versions(s: SparkSession, d: str) -> DataFrame:
    return rounds.target_versions(table(s, d, "reviews"))


def _events(s: SparkSession, d: str) -> DataFrame:
    return threads.events(table(s, d, "reviews"), table(s, d, "author_responses"), table(s, d, "discussion_comments"))


def _answers(s: SparkSession, d: str) -> DataFrame:
    return merge.ranked_answers(table(s, d, "provider_metadata"), table(s, d, "providers"), SWAP)


def _venue_names(s: SparkSession, d: str) -> list[str]:
    """The names of the list, a fixed table of 40."""
    return [r[0].lower() for r in table(s, d, "venues").orderBy("venue_id").select("venue_name").collect()]


def _contributing(s: SparkSession, d: str) -> DataFrame:
    return merge.contributing(_answers(s, d), merge.has_venue(VENUE_PREFIXES, _venue_names(s, d)))


def _families(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "targets").where("family_key is not null").groupBy("family_key")
    rows = rows.agg(F.countDistinct("target_value").alias("n"), F.max((F.col("status") == "resolved").cast("int")).alias("resolved"))
    return sampling.ordered(rows, "family_key", SEED)


# Duplicates


@query(f"with {REVIEWS}, {MARKED} select family_key, value target_value, body_hash, kept review_id, copies from marked where review_id = kept")
def dedup_reviews_keep_first(s: SparkSession, d: str) -> DataFrame:
    kept = dedup.survivors(_flat(s, d), ["family_key", "value"], "review_id", ["review_date"], "comment")
    return kept.select("family_key", F.col("value").alias("target_value"), "body_hash", "review_id", "copies")


@query(f"with {REVIEWS}, {MARKED} select review_id removed_id, kept kept_id, body_hash from marked where review_id <> kept")
def dedup_reviews_log(s: SparkSession, d: str) -> DataFrame:
    marked = dedup.mark_duplicates(_flat(s, d), ["family_key", "value"], "review_id", ["review_date"], "comment")
    return marked.where("review_id != kept").select(F.col("review_id").alias("removed_id"), F.col("kept").alias("kept_id"), "body_hash")


@query(
    f"with {REVIEWS}, {INTERACTIONS}, {MARKED}, d as (select i.event_id, i.event_date, m.kept, m.review_date, m.review_id, {BODY.format('i.content')} body_hash, array_to_string(list_sort(list_distinct(list_filter(list_transform(coalesce(i.creators, []), "
    "lambda n: array_to_string(list_sort(regexp_extract_all(lower(coalesce(n, '')), '[a-z0-9]+')), ' ')), lambda k: k <> ''))), '|') people from inter i join marked m on i.target_review_id = m.review_id where i.kind = 'discussion'), "
    "g as (select kept, body_hash, people, arg_min(event_id, struct_pack(a := review_date, b := review_id, c := event_date, d := event_id)) comment_id, count(*) copies from d group by all) select kept review_id, people, comment_id, copies from g"
)
def dedup_discussions(s: SparkSession, d: str) -> DataFrame:
    """Comments are visited by their reviews' order, then date and id; people count, whatever their order."""
    flat = _flat(s, d)
    reviews = flat.select("review_id", "review_date").join(threads.kept_reviews(flat)[1], "review_id")
    rows = _interactions(s, d).where("kind = 'discussion'").join(reviews, F.col("target_review_id") == F.col("review_id"))
    rows = rows.select("kept", dedup.participants("creators").alias("people"), "event_id", "review_date", "review_id", "event_date", "content")
    marked = dedup.mark_duplicates(rows, ["kept", "people"], "event_id", ["review_date", "review_id", "event_date"], "content", "survivor")
    return marked.where("event_id = survivor").select(F.col("kept").alias("review_id"), "people", F.col("event_id").alias("comment_id"), "copies")


@query("with g as (select review_id, count(*) n from reviews group by 1) select cast(sum(n) as bigint) records, count(*) unique_records, cast(sum(n - 1) as bigint) repeated_records from g")
def repeated_records(s: SparkSession, d: str) -> DataFrame:
    return dedup.repeated_records(table(s, d, "reviews"), "review_id")


# Identifiers and text functions

_DOI = r"regexp_replace(regexp_replace(regexp_replace(trim(coalesce({0}, ''), ' '), '^https?://(?:dx\.)?doi\.[a-z]+/', '', 'i'), '^doi:\s*', '', 'i'), '[.,;:)\]}}>]+$', '')"


@query(f"with v as (select distinct target_value raw, {_DOI.format('target_value')} bare from provider_metadata) select raw, case when regexp_full_match(bare, '10\\.[0-9]{{4,9}}/[-._;()/:A-Za-z0-9]+') then lower(bare) else '' end doi from v")
def doi_normalize(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "provider_metadata").select(F.col("target_value").alias("raw")).distinct()
    return raw.select("raw", C.doi(F.col("raw")).alias("doi"))


@query(r"select target_value, 'doi:' || regexp_replace(lower(trim(doi)), '(?:[._-]v|/v|[._-]version)([0-9]+)$', '') family_key, cast(nullif(regexp_extract(lower(trim(doi)), '(?:[._-]v|/v|[._-]version)([0-9]+)$', 1), '') as int) \"version\" from targets where kind = 'doi'".replace('\\"', '"'))
def family_version(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "targets").where("kind = 'doi'")
    return rows.select("target_value", C.family(F.col("doi")).alias("family_key"), C.version(F.col("doi")).alias("version"))


@query(r"""with v as (select distinct target.source_identifier raw from reviews where target.kind = 'arxiv') select raw, lower(regexp_extract(raw, '(?i)^(?:arxiv:)?([a-z.-]+/[0-9]{7}|[0-9]{4}\.[0-9]{4,5})(?:v([0-9]+))?$', 1)) arxiv_id, cast(nullif(regexp_extract(raw, '(?i)^(?:arxiv:)?([a-z.-]+/[0-9]{7}|[0-9]{4}\.[0-9]{4,5})(?:v([0-9]+))?$', 2), '') as int) "version" from v""")
def arxiv_parse(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "reviews").where("target.kind = 'arxiv'").select(F.col("target.source_identifier").alias("raw")).distinct()
    return raw.select("raw", C.arxiv_id(F.col("raw")).alias("arxiv_id"), C.arxiv_version(F.col("raw")).alias("version"))


@query(r"with v as (select unnest(creator_orcids) o from reviews) select upper(regexp_extract(coalesce(o, ''), '\b([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9Xx])\b', 1)) orcid, count(*) times from v group by 1")
def orcid_normalize(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "reviews").select(F.explode("creator_orcids").alias("o")).groupBy(C.orcid(F.col("o")).alias("orcid")).agg(F.count("*").alias("times"))


@query("select coalesce(regexp_matches(review_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'), false) well_formed, regexp_extract(coalesce(review_date, ''), '^([0-9]{4})', 1) \"year\", count(*) records from reviews group by 1, 2")
def date_shapes(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "reviews").groupBy(C.iso_date(F.col("review_date")).alias("well_formed"), C.leading_year(F.col("review_date")).alias("year")).agg(F.count("*").alias("records"))


@query(r"with v as (select distinct provider_record_id, list_filter(list_transform(coalesce(fields, []), lambda x: trim(x, ' ')), lambda x: x is not null and x <> '') f from provider_metadata), p as (select provider_record_id, f, list_filter(range(1, len(f) + 1), lambda i: not list_contains(f[1:i-1], f[i])) k from v) select distinct provider_record_id, array_to_string(list_transform(k, lambda i: f[i])[1:8], '; ') field_list from p")
def field_list(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "provider_metadata").select("provider_record_id", F.array_join(F.slice(C.first_seen(F.col("fields")), 1, 8), "; ").alias("field_list"))
    return rows.distinct()


@query((r"""with m as (select provider_record_id, max(title) title, max({TARGET.format("target_value")}) t from provider_metadata group by 1), h as (select target.value v, min(title_hint) hint from reviews where trim(coalesce(title_hint, '')) <> '' group by 1),
p as (select provider_record_id, list_distinct(regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]+')) a, list_distinct(regexp_extract_all(lower(hint), '[a-z0-9]+')) b from m join h on t = v)
select provider_record_id, case when len(a) = 0 or len(b) = 0 then 1.0 else round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) end jaccard from p""").replace('{TARGET.format("target_value")}', TARGET.format("target_value")))
def title_jaccard(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "provider_metadata").groupBy("provider_record_id").agg(F.max("title").alias("title"), F.max(merge.target_key(F.col("target_value"))).alias("t"))
    h = table(s, d, "reviews").where("trim(coalesce(title_hint, '')) != ''").groupBy(F.col("target.value").alias("v")).agg(F.min("title_hint").alias("hint"))
    return m.join(h, F.col("t") == F.col("v")).select("provider_record_id", F.round(C.word_jaccard(F.col("title"), F.col("hint")), 6).alias("jaccard"))


@query("with c as (select venue_name, venue_id from venues), v as (select distinct unnest(venue_candidates) x from provider_metadata), w as (select x from v where trim(coalesce(x, '')) <> '') select x candidate, coalesce((select arg_min(venue_name, venue_id) from c where contains(lower(x), lower(venue_name))), '') venue from w")
def alias_match(s: SparkSession, d: str) -> DataFrame:
    """The first name of the list a candidate contains; the list is a fixed table of 40."""
    names = [(r[0].lower(), r[0]) for r in table(s, d, "venues").orderBy("venue_id").select("venue_name").collect()]
    x = table(s, d, "provider_metadata").select(F.explode("venue_candidates").alias("candidate")).where("trim(coalesce(candidate, '')) != ''").distinct()
    return x.select("candidate", C.first_match(F.lower("candidate"), names).alias("venue"))


@query("select target_value, case " + " ".join(f"when starts_with(doi, '{p}') then '{v}'" for p, v in PREFIXES) + " else '' end venue from targets")
def prefix_match(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "targets").select("target_value", C.first_match(F.coalesce("doi", F.lit("")), PREFIXES, "startswith").alias("venue"))


# Records as JSON: made of the tables, parsed and read again


def _records(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "reviews").where("review_id is not null").groupBy("review_id").agg(F.max_by(F.struct("target.source_identifier", "creators", "creator_orcids", "subjects", "review_date"), "harvested_at").alias("r"))
    related = F.array(F.struct(F.lit("reviews").alias("relation"), F.col("r.source_identifier").alias("identifier")), F.struct(F.lit("cites").alias("relation"), F.col("review_id").alias("identifier")))
    metadata = F.struct(related.alias("related_identifiers"), F.col("r.creators").alias("creators"), F.col("r.subjects").alias("subjects"), F.col("r.review_date").alias("publication_date"))
    return ingest.parsed(rows.select(F.col("review_id").alias("record_id"), F.to_json(F.struct(metadata.alias("metadata"))).alias("record")))


@query("select distinct review_id record_id, target.value \"value\", target.family_key family_key, target.version \"version\" from reviews where review_id is not null")
def record_targets(s: SparkSession, d: str) -> DataFrame:
    return ingest.targets(_records(s, d)).select("record_id", "target.value", "target.family_key", "target.version")


@query("with r as (select review_id, arg_max(struct_pack(c := creators, s := subjects, d := review_date), harvested_at) r from reviews where review_id is not null group by 1) select review_id record_id, len(list_distinct(list_filter(coalesce(r.c, []), lambda x: trim(coalesce(x, ''), ' ') <> ''))) creators, len(list_distinct(list_filter(coalesce(r.s, []), lambda x: trim(coalesce(x, ''), ' ') <> ''))) subjects, left(coalesce(r.d, ''), 10) record_date from r")
def record_people(s: SparkSession, d: str) -> DataFrame:
    return ingest.people(_records(s, d)).select("record_id", F.size("creators").alias("creators"), F.size("subjects").alias("subjects"), "record_date")


# Links


@query(f"with {REVIEWS}, {INTERACTIONS} select i.kind, i.event_id, f.review_id, f.value target_value from inter i join flat f on i.target_review_id = f.review_id")
def link_interactions(s: SparkSession, d: str) -> DataFrame:
    inter = _interactions(s, d).where("target_review_id is not null")
    found = links.resolve_links(inter, "event_id", "target_review_id", _flat(s, d), "review_id", ["value"])
    return inter.select("kind", "event_id").join(found, "event_id").select("kind", "event_id", "review_id", F.col("value").alias("target_value"))


@query(f"with {REVIEWS}, {INTERACTIONS} select kind, count(*) unresolved from inter i where not exists (select 1 from flat f where f.review_id = i.target_review_id) group by kind")
def link_unresolved(s: SparkSession, d: str) -> DataFrame:
    inter = _interactions(s, d)
    found = links.resolve_links(inter.where("target_review_id is not null"), "event_id", "target_review_id", _flat(s, d), "review_id", ["value"])
    return links.unresolved(inter, "event_id", found).groupBy("kind").agg(F.count("*").alias("unresolved"))


@query(f"with {REVIEWS}, {INTERACTIONS} select i.event_id, i.family_key is not distinct from f.family_key verified from inter i join flat f on i.target_review_id = f.review_id")
def link_verified(s: SparkSession, d: str) -> DataFrame:
    inter = _interactions(s, d).where("target_review_id is not null")
    found = links.resolve_links(inter.withColumnRenamed("family_key", "own_family"), "event_id", "target_review_id", _flat(s, d), "review_id", ["family_key"])
    return inter.select("event_id", F.col("family_key").alias("own")).join(found, "event_id").select("event_id", F.col("own").eqNullSafe(F.col("family_key")).alias("verified"))


@query(f"select target_value, status from targets t where not exists (select 1 from provider_metadata p where {TARGET.format('p.target_value')} = t.target_value)")
def pending_targets(s: SparkSession, d: str) -> DataFrame:
    """Targets without an answer, in whatever form the answer names its target."""
    answered = table(s, d, "provider_metadata").select(merge.target_key(F.col("target_value")).alias("target_value"))
    return links.pending(table(s, d, "targets").select("target_value", "status"), answered, "target_value")


@query("select distinct target.value target_value from reviews r where not exists (select 1 from targets t where t.target_value = r.target.value and t.status = 'resolved')")
def coverage_check(s: SparkSession, d: str) -> DataFrame:
    wanted = table(s, d, "reviews").select(F.col("target.value").alias("target_value")).distinct()
    return links.pending(wanted, table(s, d, "targets"), "target_value", retry="resolved")


@query(f"with {EVENTS} select kind, count(*) expected, count(e.event_id) written from (select event_id from inter union all select review_id from flat) x(event_id) left join events e using (event_id) group by kind")
def events_written(s: SparkSession, d: str) -> DataFrame:
    ids = _interactions(s, d).select("event_id").unionByName(_flat(s, d).select(F.col("review_id").alias("event_id")))
    written = _events(s, d).select("kind", F.col("event_id").alias("w"))
    return ids.join(written, F.col("event_id") == F.col("w"), "left").groupBy("kind").agg(F.count("*").alias("expected"), F.count("w").alias("written"))


@query(f"with {EVENTS}, ids as (select event_id from inter union select review_id from flat) select event_id, 'missing' side from ids where event_id not in (select event_id from events)")
def integrity_reconcile(s: SparkSession, d: str) -> DataFrame:
    ids = _interactions(s, d).select("event_id").unionByName(_flat(s, d).select(F.col("review_id").alias("event_id")))
    return links.reconcile(ids, _events(s, d).select("event_id"), "event_id")


@query("select target_review_id, count(*) interactions from (select target_review_id from author_responses union all select target_review_id from discussion_comments) where target_review_id is not null group by 1")
def interaction_counts(s: SparkSession, d: str) -> DataFrame:
    both = table(s, d, "author_responses").select("target_review_id").unionByName(table(s, d, "discussion_comments").select("target_review_id"))
    return both.where("target_review_id is not null").groupBy("target_review_id").agg(F.count("*").alias("interactions"))


@query("with a as (select distinct target_review_id id from author_responses where target_review_id is not null), b as (select distinct target_review_id id from discussion_comments where target_review_id is not null) select (select count(*) from (select * from a union select * from b)) in_either, (select count(*) from (select * from a intersect select * from b)) in_both, (select count(*) from (select * from a except select * from b)) answered_only")
def set_operations(s: SparkSession, d: str) -> DataFrame:
    a, b = (table(s, d, t).where("target_review_id is not null").select(F.col("target_review_id").alias("id")).distinct() for t in ("author_responses", "discussion_comments"))
    n = lambda df, name: df.agg(F.count("*").alias(name))
    return n(a.union(b).distinct(), "in_either").crossJoin(n(a.intersect(b), "in_both")).crossJoin(n(a.subtract(b), "answered_only"))  # three rows of one


@query(f"with {REVIEWS}, {INTERACTIONS}, k as (select i.event_id, list_filter(list_transform(coalesce(i.creators, []), lambda n: array_to_string(list_sort(regexp_extract_all(lower(coalesce(n, '')), '[a-z0-9]+')), ' ')), lambda x: x <> '') a, list_filter(list_transform(coalesce(f.creators, []), lambda n: array_to_string(list_sort(regexp_extract_all(lower(coalesce(n, '')), '[a-z0-9]+')), ' ')), lambda x: x <> '') b from inter i join flat f on i.target_review_id = f.review_id) select event_id, list_has_any(a, b) same_person from k")
def person_overlap(s: SparkSession, d: str) -> DataFrame:
    rows = _interactions(s, d).select("event_id", "target_review_id", C.name_keys(F.col("creators")).alias("a")).join(_flat(s, d).select("review_id", C.name_keys(F.col("creators")).alias("b")), F.col("target_review_id") == F.col("review_id"))
    return rows.select("event_id", F.arrays_overlap("a", "b").alias("same_person"))


_OR = r"list_filter(list_transform(coalesce({0}, []), lambda v: upper(regexp_extract(coalesce(v, ''), '\b([0-9]{{4}}-[0-9]{{4}}-[0-9]{{4}}-[0-9]{{3}}[0-9Xx])\b', 1))), lambda v: v <> '')"


@query(f"with {REVIEWS}, {INTERACTIONS} select i.event_id, list_has_any({_OR.format('i.creator_orcids')}, {_OR.format('f.creator_orcids')}) same_orcid from inter i join flat f on i.target_review_id = f.review_id")
def orcid_overlap(s: SparkSession, d: str) -> DataFrame:
    rows = _interactions(s, d).select("event_id", "target_review_id", C.orcids(F.col("creator_orcids")).alias("a")).join(_flat(s, d).select("review_id", C.orcids(F.col("creator_orcids")).alias("b")), F.col("target_review_id") == F.col("review_id"))
    return rows.select("event_id", F.arrays_overlap("a", "b").alias("same_orcid"))


# Versions, rounds and order


@query(f"with {NUMBERED} select family_key, value target_value, version, first_date, reviews, round from numbered")
def round_number(s: SparkSession, d: str) -> DataFrame:
    return rounds.number_rounds(_versions(s, d)).withColumnRenamed("value", "target_value")


@query(f"with {VERSIONS} select family_key, arg_max(value, struct_pack(a := version is not null, b := coalesce(version, 0), c := value)) latest from versions group by 1")
def latest_version(s: SparkSession, d: str) -> DataFrame:
    return rounds.latest_versions(_versions(s, d))


@query(f"with {ANSWERS} select target_value, min(year) first_year from ranked where year is not null group by 1")
def min_year(s: SparkSession, d: str) -> DataFrame:
    return _answers(s, d).where("year is not null").groupBy("target_value").agg(F.min("year").alias("first_year"))


@query(f"with h as (select target.family_key family_key, title_hint, count(*) times, min(struct_pack(a := coalesce(review_date, ''), b := review_id)) seen from reviews where trim(coalesce(title_hint, ''), ' ') <> '' group by 1, 2) select family_key, arg_min(title_hint, struct_pack(a := -times, b := seen, c := title_hint)) title_hint, max(times) times from h group by 1")
def representative_hint(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "reviews").select(F.col("target.family_key").alias("family_key"), "title_hint", F.coalesce("review_date", F.lit("")).alias("review_date"), "review_id")
    return rounds.representative(rows, "family_key", "title_hint", ["review_date", "review_id"])


@query(f"with {REVIEWS} select family_key, value target_value, review_id, cast(row_number() over (partition by family_key, value order by review_date, review_id) as int) place from flat")
def review_order(s: SparkSession, d: str) -> DataFrame:
    rows = rounds.positions(_flat(s, d).select("family_key", "value", "review_date", "review_id"), ["family_key", "value"], ["review_date", "review_id"], "place")
    return rows.select("family_key", F.col("value").alias("target_value"), "review_id", "place")


@query(f"with {EVENTS} select value target_value, cast(row_number() over (partition by value order by event_date, kind <> 'review', event_id) as int) position, kind, event_id, event_date from events")
def timeline(s: SparkSession, d: str) -> DataFrame:
    return rounds.timeline(_events(s, d), "value").withColumnRenamed("value", "target_value")


@query(f"with {EVENTS}, t as (select review_id, event_id, event_date, kind, lag(event_date) over (partition by review_id order by kind <> 'review', event_id) \"before\" from events) select review_id, event_id, event_date, \"before\" from t where \"before\" > event_date")
def timeline_order_check(s: SparkSession, d: str) -> DataFrame:
    rows = _events(s, d).withColumn("position", F.struct((F.col("kind") != "review").alias("a"), F.col("event_id").alias("b")))
    return rounds.out_of_order(rows.select("review_id", "position", "event_date"), "review_id", "position", "event_date").select("review_id", F.col("position.b").alias("event_id"), "event_date", "before")


# Samples


@query(f"with {ORDERED} select family_key, place from placed where resolved = 1 order by place limit 25")
def sample_hash(s: SparkSession, d: str) -> DataFrame:
    return sampling.first_accepted(_families(s, d), F.col("resolved") == 1, 25).select("family_key", "place")


@query(f"with {ORDERED}, talked as (select family_key from author_responses union select family_key from discussion_comments) select family_key, case when family_key in (select family_key from talked where family_key is not null) then 0 when n > 1 then 1 else 2 end tier, place from placed where resolved = 1 order by tier, place limit 25")
def sample_coverage(s: SparkSession, d: str) -> DataFrame:
    """Families with replies first, then those of several versions, then the rest."""
    talked = table(s, d, "author_responses").select("family_key").unionByName(table(s, d, "discussion_comments").select("family_key")).where("family_key is not null").distinct()
    rows = _families(s, d).join(talked.withColumn("talked", F.lit(True)), "family_key", "left")
    rows = rows.withColumn("tier", F.when(F.col("talked"), 0).when(F.col("n") > 1, 1).otherwise(2))
    return sampling.first_accepted(rows, F.col("resolved") == 1, 25).select("family_key", "tier", "place")


@query(f"with {ORDERED}, r as (select left(place, 4) g, sha256(string_agg(family_key, chr(10) order by place, family_key)) h, count(*) n from placed group by 1) select sha256(string_agg(h, chr(10) order by g)) fingerprint, cast(sum(n) as bigint) \"keys\" from r")
def order_fingerprint(s: SparkSession, d: str) -> DataFrame:
    return sampling.order_fingerprint(_families(s, d), "family_key")


@query(f"with {ORDERED}, t as (select *, case when resolved = 0 then 'not_resolved' when n > 3 then 'many_versions' end reason from placed), c as (select *, sum(case when reason is null then 1 else 0 end) over (order by place rows unbounded preceding) a from t) select reason, count(*) n from c where reason is not null and a < 60 group by 1")
def rejections_until_limit(s: SparkSession, d: str) -> DataFrame:
    """The reason is that of the first gate a family fails."""
    rows = _families(s, d).withColumn("reason", F.when(F.col("resolved") == 0, "not_resolved").when(F.col("n") > 3, "many_versions"))
    return sampling.turned_down(rows, "reason", 60)


# Merge of provider answers


@query(f"with {ANSWERS} select target_value, provider_record_id, provider, trust_rank from used")
def provider_early_stop(s: SparkSession, d: str) -> DataFrame:
    return _contributing(s, d).select("target_value", "provider_record_id", "provider", "trust_rank")


@query(
    f"with {ANSWERS}, k as (select *, struct_pack(a := trust_rank, b := provider_record_id) place from used) select target_value, arg_min(title, place) filter (where title is not null) title, arg_min(provider, place) filter (where title is not null) title_from, "
    "coalesce(len(list_distinct(arg_min(authors, place) filter (where len(authors) > 0))), -1) n_authors, arg_min(provider, place) filter (where len(authors) > 0) authors_from, arg_min(\"year\", place) filter (where \"year\" is not null) \"year\", arg_min(provider, place) filter (where \"year\" is not null) year_from, count(*) answers from k group by 1"
)
def provider_merge(s: SparkSession, d: str) -> DataFrame:
    m = merge.merge_answers(_contributing(s, d))
    return m.select("target_value", "title", "title_from", F.coalesce(F.size("authors"), F.lit(-1)).alias("n_authors"), "authors_from", "year", "year_from", "answers")


@query(f"with {ANSWERS}, p as (select target_value, unnest(['title', 'authors', 'year']) field, unnest([title is not null, len(authors) > 0, year is not null]) has, provider, trust_rank, provider_record_id from used) select target_value, field, arg_min(provider, struct_pack(a := trust_rank, b := provider_record_id)) source from p where has group by 1, 2")
def provider_provenance(s: SparkSession, d: str) -> DataFrame:
    m = merge.merge_answers(_contributing(s, d))
    rows = m.select("target_value", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"{f}_from").alias("source")) for f in ("title", "authors", "year")])).alias("p"))
    return rows.select("target_value", "p.field", "p.source").where("source is not null")


# Counts


@query("select review_type, count(*) records, count(distinct review_id) reviews from reviews group by 1")
def review_type_histogram(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "reviews").groupBy("review_type").agg(F.count("*").alias("records"), F.countDistinct("review_id").alias("reviews"))


@query("select kind, status, count(*) targets, count(distinct family_key) families from targets group by 1, 2")
def status_histogram(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "targets").groupBy("kind", "status").agg(F.count("*").alias("targets"), F.countDistinct("family_key").alias("families"))


@query("with d as (select distinct review_id, review_date from reviews where coalesce(review_date, '') <> '') select count(*) filter (where review_date < '2023-01-01') earlier, count(*) filter (where review_date >= '2023-01-01') later from d")
def split_by_date(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "reviews").where("coalesce(review_date, '') != ''").select("review_id", "review_date").distinct()
    return rows.agg(F.count_if(F.col("review_date") < "2023-01-01").alias("earlier"), F.count_if(F.col("review_date") >= "2023-01-01").alias("later"))


@query(f"with {VERSIONS} select family_key, count(*) versions, cast(sum(reviews) as bigint) reviews from versions group by 1")
def family_counts(s: SparkSession, d: str) -> DataFrame:
    return _versions(s, d).groupBy("family_key").agg(F.count("*").alias("versions"), F.sum("reviews").alias("reviews"))


@query(f"with {EVENTS} select kind, count(*) events, count(distinct review_id) reviews, count(distinct value) targets from events group by 1")
def stats_rollup(s: SparkSession, d: str) -> DataFrame:
    return _events(s, d).groupBy("kind").agg(F.count("*").alias("events"), F.countDistinct("review_id").alias("reviews"), F.countDistinct("value").alias("targets"))


@query("with p as (select distinct family_key, version, target_value from targets), k as (select *, row_number() over (partition by target_value order by family_key, version nulls last) n from p) select family_key, version, target_value from k where n = 1")
def unique_targets(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "targets").groupBy("target_value").agg(F.min_by(F.struct("family_key", "version"), F.struct("family_key", F.col("version").isNull(), "version")).alias("r"))
    return rows.select("r.family_key", "r.version", "target_value").orderBy("family_key", F.col("version").asc_nulls_last(), "target_value")


# Validation

_TAGGED = "regexp_matches(coalesce({0}, ''), '(?i)</?(?:" + "|".join(C.TAGS) + ")(?:[ /][^<>]*)?>')"
_BAD_ORCID = r"len(list_filter(coalesce(creator_orcids, []), lambda v: regexp_extract(coalesce(v, ''), '\b([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9Xx])\b', 1) = '')) > 0"


@query(
    f"with {REVIEWS.replace('creator_orcids := creator_orcids)', 'creator_orcids := creator_orcids, record_url := record_url)')}, i as (select unnest([{{'c': 'text_empty', 'b': {FOLD.format('comment')} = ''}}, {{'c': 'date_shape', 'b': not regexp_matches(review_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')}}, "
    f"{{'c': 'markup_in_text', 'b': {_TAGGED.format('comment')}}}, {{'c': 'orcid_shape', 'b': {_BAD_ORCID}}}, {{'c': 'no_creator', 'b': coalesce(len(creators), 0) < 1}}, {{'c': 'url_missing', 'b': trim(coalesce(record_url, ''), ' ') = ''}}]) x, review_id from flat) select x.c \"constraint\", review_id record_key from i where x.b"
)
def validate_reviews(s: SparkSession, d: str) -> DataFrame:
    rows = dedup.unique_records(table(s, d, "reviews"), "review_id", "harvested_at")
    return validate.breaches(rows, "review_id", validate.record_constraints("comment", "review_date")).select("constraint", "record_key")


@query(
    f"with {REVIEWS}, {INTERACTIONS}, ok as (select * from flat where regexp_matches(review_date, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')) select 'reply_target' \"constraint\", event_id record_key, target_review_id detail from inter where target_review_id is not null and target_review_id not in (select review_id from flat) "
    "union select 'reply_before_review', i.event_id, i.event_date from inter i join ok f on i.target_review_id = f.review_id where regexp_matches(i.event_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') and i.event_date < f.review_date"
)
def validate_interactions(s: SparkSession, d: str) -> DataFrame:
    inter, flat = _interactions(s, d), _flat(s, d)
    return validate.all_issues(validate.dangling(inter, "event_id", "target_review_id", flat, "review_id", "reply_target"), validate.too_early(inter, "event_id", "event_date", "target_review_id", flat, "review_id", "review_date", "reply_before_review"))


@query(f"with {NUMBERED}, g as (select family_key, max(round) m, count(*) n, count(distinct round) u from numbered group by 1) select 'rounds_consecutive' \"constraint\", family_key record_key from g where m <> n or u <> n union all select 'repeated_id', review_id from reviews group by review_id having count(*) > 1")
def validate_rounds(s: SparkSession, d: str) -> DataFrame:
    gaps = validate.consecutive(rounds.number_rounds(_versions(s, d)), "family_key", "round", "rounds_consecutive")
    return validate.all_issues(gaps, validate.repeated_keys(table(s, d, "reviews"), "review_id", "repeated_id")).select("constraint", "record_key")


# Threads, papers and their audit

PLACED = f"{EVENTS}, {NUMBERED}, placed_events as (select *, cast(row_number() over (partition by family_key, value order by event_date, kind <> 'review', event_id) as int) position from events), thread as (select n.family_key, n.value, n.version, n.round, p.position, p.kind, p.event_id, p.review_id, p.event_date from numbered n join placed_events p on n.family_key = p.family_key and n.value = p.value)"


@query(f"with {PLACED} select family_key, value target_value, version, round, position, kind, event_id, review_id, event_date from thread")
def thread_events(s: SparkSession, d: str) -> DataFrame:
    rows = threads.thread_events(table(s, d, "reviews"), table(s, d, "author_responses"), table(s, d, "discussion_comments"))
    return rows.select("family_key", F.col("value").alias("target_value"), "version", "round", "position", "kind", "event_id", "review_id", "event_date")


@query(f"with {PLACED} select family_key, value target_value, round, cast(ceil(position / {threads.PART_EVENTS}.0) as int) part, count(*) filter (kind = 'review') comments, count(*) filter (kind = 'response') responses, count(*) filter (kind = 'discussion') discussions, string_agg(event_id, ' ' order by position) timeline from thread group by 1, 2, 3, 4")
def thread_parts(s: SparkSession, d: str) -> DataFrame:
    """The nested rounds, as the sizes of their lists and the ids of their timeline."""
    rows = threads.threads(table(s, d, "reviews"), table(s, d, "author_responses"), table(s, d, "discussion_comments"))
    ids = F.array_join(F.transform("timeline", lambda e: e["event_id"]), " ")
    return rows.select("family_key", F.col("value").alias("target_value"), "round", "part", *[F.size(c).cast("long").alias(c) for c in ("comments", "responses", "discussions")], ids.alias("timeline"))


LATEST = "latest as (select family_key, arg_max(value, struct_pack(a := version is not null, b := coalesce(version, 0), c := value)) latest, count(*) rounds from versions group by 1)"
_MERGED = (
    "merged as (select target_value, arg_min(title, struct_pack(a := trust_rank, b := provider_record_id)) filter (where title is not null) title, arg_min(authors, struct_pack(a := trust_rank, b := provider_record_id)) filter (where len(authors) > 0) authors, "
    "arg_min(\"year\", struct_pack(a := trust_rank, b := provider_record_id)) filter (where \"year\" is not null) \"year\", list_sort(list(distinct provider)) sources from used group by 1)"
)
PAPERS = f"{ANSWERS}, {VERSIONS}, {LATEST}, {_MERGED}, papers as (select l.family_key, coalesce(t.doi, '') doi, l.latest target_value, m.title, m.authors, m.\"year\", l.rounds from latest l left join merged m on l.latest = m.target_value left join (select target_value, max(doi) doi from targets group by 1) t on l.latest = t.target_value)"


def _papers(s: SparkSession, d: str) -> DataFrame:
    return papers.papers(_versions(s, d), merge.merge_answers(_contributing(s, d)), table(s, d, "targets"))


@query(f"with {PAPERS} select family_key, doi, target_value, title, coalesce(len(authors), -1) n_authors, \"year\", rounds from papers")
def papers_built(s: SparkSession, d: str) -> DataFrame:
    return _papers(s, d).select("family_key", "doi", "target_value", "title", F.coalesce(F.size("authors"), F.lit(-1)).alias("n_authors"), "year", "rounds")


@query(
    f"with {PAPERS}, i as (select family_key, unnest([struct_pack(c := 'doi_shape', b := doi = ''), struct_pack(c := 'title_missing', b := trim(coalesce(title, '')) = ''), struct_pack(c := 'title_markup', b := regexp_matches(coalesce(title, ''), '(?i)</?(?:" + "|".join(C.TAGS) + ")(?:[ /][^<>]*)?>|[\\r\\n]')), "
    "struct_pack(c := 'year_shape', b := not regexp_full_match(coalesce(\"year\", ''), '[0-9]{4}')), struct_pack(c := 'year_range', b := regexp_full_match(coalesce(\"year\", ''), '[0-9]{4}') and not \"year\" between '1900' and '2026'), struct_pack(c := 'authors_missing', b := coalesce(len(authors), 0) < 1), struct_pack(c := 'rounds_missing', b := rounds < 1)]) x from papers) "
    "select x.c \"constraint\", family_key record_key from i where x.b union all select 'family_repeated', f from (select 'doi:' || regexp_replace(lower(trim(doi)), '(?:[._-]v|/v|[._-]version)([0-9]+)$', '') f, count(*) n from papers where doi <> '' group by 1) where n > 1"
)
def validate_papers(s: SparkSession, d: str) -> DataFrame:
    rows = _papers(s, d)
    issues = validate.breaches(rows, "family_key", validate.paper_constraints(1900, 2026)).unionByName(validate.repeated_families(rows))
    return issues.unionByName(validate.shape(rows, papers.COLUMNS)).select("constraint", "record_key")


@query(
    f"with {PLACED}, own as (select distinct family_key, value, event_id from thread where kind = 'review'), a as (select family_key || ' ' || value k, count(*) filter (kind = 'review') r, max(position) m, count(*) n from thread group by 1) select 'round_without_review' \"constraint\", k record_key from a where r = 0 "
    "union all select 'timeline_positions', k from a where m <> n union all select 'event_twice', k from (select family_key || ' ' || value k, event_id, count(*) n from thread group by 1, 2) where n > 1 "
    "union all select 'reply_outside_round', t.family_key || ' ' || t.value from thread t where kind <> 'review' and not exists (select 1 from own o where o.family_key = t.family_key and o.value = t.value and o.event_id = t.review_id)"
)
def validate_threads(s: SparkSession, d: str) -> DataFrame:
    """Rounds without a review, events that stand twice, replies outside their round and gaps in the timeline."""
    rows = threads.thread_events(table(s, d, "reviews"), table(s, d, "author_responses"), table(s, d, "discussion_comments"))
    return validate.round_shape(rows).select("constraint", "record_key")


@query(f"with {PLACED}, ids as (select event_id from inter union select review_id from flat), w as (select distinct event_id from thread) select 'timeline_missing' \"constraint\", event_id record_key from ids where event_id not in (select event_id from w) union all select 'timeline_unexpected', event_id from w where event_id not in (select event_id from ids)")
def validate_coverage(s: SparkSession, d: str) -> DataFrame:
    """Reviews and interactions that stand in no timeline: removed duplicates and those without a review."""
    ids = _interactions(s, d).select("event_id").unionByName(_flat(s, d).select(F.col("review_id").alias("event_id")))
    return validate.coverage(ids, threads.thread_events(table(s, d, "reviews"), table(s, d, "author_responses"), table(s, d, "discussion_comments")), "event_id", "timeline").select("constraint", "record_key")


@query(
    f"with {PAPERS}, a as (select cast(row_number() over (order by family_key) as int) position, * from papers), r as (select cast(row_number() over (order by doi, family_key) as int) position, doi from papers where title is not null), "
    "j as (select coalesce(a.position, r.position) position, a.position is not null has_a, r.position is not null has_r, a.doi adoi, r.doi rdoi, a.family_key, a.title is null or a.authors is null or a.\"year\" is null bare from a full join r on a.position = r.position) "
    "select 'row_missing' \"constraint\", cast(position as varchar) record_key from j where not has_r union all select 'audit_missing', cast(position as varchar) from j where not has_a union all select 'doi_differs', cast(position as varchar) from j where has_a and has_r and adoi <> rdoi "
    "union all select 'family_differs', cast(position as varchar) from j where has_a and has_r and adoi <> '' and family_key <> 'doi:' || regexp_replace(lower(trim(adoi)), '(?:[._-]v|/v|[._-]version)([0-9]+)$', '') union all select 'field_without_source', cast(position as varchar) from j where has_a and has_r and bare"
)
def audit_by_position(s: SparkSession, d: str) -> DataFrame:
    """The audit in the order of families beside the titled rows in the order of DOIs: where the two go apart it is told."""
    rows = _papers(s, d)
    audit = sampling.numbered(rows, ["family_key"], "position")
    audit = audit.withColumn("provenance", F.create_map(*[x for f in ("title", "authors", "year") for x in (F.lit(f), F.col(f"{f}_from"))]))
    lines = sampling.numbered(rows.where("title is not null"), ["doi", "family_key"], "position")
    return validate.audit_against_rows(audit, lines).select("constraint", F.col("record_key").cast("string").alias("record_key"))


@query(
    f"with {ANSWERS}, {VERSIONS}, hits as (select u.target_value, arg_min(v.venue_name, v.venue_id) venue from (select x.target_value, unnest(o.r.venue_candidates) c from used x join one o on o.target_value = x.target_value and o.provider_record_id = x.provider_record_id) u join venues v on contains(lower(trim(u.c, ' ')), lower(v.venue_name)) group by 1), "
    f"named as (select o.target_value, coalesce(nullif({_BY_PREFIX}, ''), h.venue, '') venue from (select distinct target_value from used) o left join hits h on h.target_value = o.target_value) "
    "select family_key, arg_max(venue, struct_pack(a := version is not null, b := coalesce(version, 0), c := value)) venue from versions join named on value = target_value where venue <> '' group by 1"
)
def venue_choice(s: SparkSession, d: str) -> DataFrame:
    names = [(r[0].lower(), r[0]) for r in table(s, d, "venues").orderBy("venue_id").select("venue_name").collect()]
    merged = merge.merge_answers(_contributing(s, d)).select("target_value", merge.venue(VENUE_PREFIXES, names).alias("venue"))
    return merge.venue_of_family(_versions(s, d), merged)


@query(f"with {ANSWERS}, {_MERGED}, s as (select unnest(sources) source from merged) select source, count(*) targets from s group by 1")
def source_histogram(s: SparkSession, d: str) -> DataFrame:
    return merge.merge_answers(_contributing(s, d)).select(F.explode("sources").alias("source")).groupBy("source").agg(F.count("*").alias("targets"))


@query(f"with {ANSWERS}, {_MERGED} select coalesce(\"year\", '') \"year\", count(*) targets, count(*) filter (title is not null or authors is not null or \"year\" is not null) found from merged group by 1")
def year_histogram(s: SparkSession, d: str) -> DataFrame:
    m = merge.found(merge.merge_answers(_contributing(s, d)))
    return m.groupBy(F.coalesce("year", F.lit("")).alias("year")).agg(F.count("*").alias("targets"), F.count_if("found").alias("found"))


@query(f"with {ANSWERS}, {_MERGED} select m.target_value, m.\"year\", array_to_string(list_sort(list(distinct r.provider)), ' ') sources from merged m join ranked r on r.target_value = m.target_value and r.\"year\" = m.\"year\" group by 1, 2")
def year_provenance(s: SparkSession, d: str) -> DataFrame:
    """The providers that say the year that was chosen."""
    chosen = merge.merge_answers(_contributing(s, d)).where("year is not null").select("target_value", "year")
    said = _answers(s, d).select("target_value", "year", "provider").where("year is not null")
    return chosen.join(said, ["target_value", "year"]).groupBy("target_value", "year").agg(F.array_join(F.array_sort(F.collect_set("provider")), " ").alias("sources"))


@query(f"with {ORDERED}, t as (select *, case when resolved = 0 then 'not_resolved' when n > 3 then 'many_versions' end reason from placed), k as (select *, row_number() over (partition by reason order by place) i from t where reason is not null) select reason, family_key from k where i <= 5")
def rejection_examples(s: SparkSession, d: str) -> DataFrame:
    """The first five of each reason, a report."""
    rows = _families(s, d).withColumn("reason", F.when(F.col("resolved") == 0, "not_resolved").when(F.col("n") > 3, "many_versions"))
    return sampling.examples(rows, "reason", "family_key", 5)


@query(f"with {PLACED}, t as (select review_id, list_sort(list(distinct event_id)) a from thread group by 1), e as (select review_id, list_sort(list(distinct event_id)) b from (select review_id, event_id from events) group by 1) select e.review_id, t.a is not distinct from e.b complete from e left join t using (review_id)")
def timeline_sets(s: SparkSession, d: str) -> DataFrame:
    """Whether the timeline has exactly the events of each review: equal sums of hashes and equal counts, not lists."""
    marks = lambda df, n: df.select("review_id", "event_id").distinct().groupBy("review_id").agg(F.count("*").alias(f"{n}_n"), F.sum(F.xxhash64("event_id").cast("decimal(38,0)")).alias(f"{n}_h"))
    placed = threads.thread_events(table(s, d, "reviews"), table(s, d, "author_responses"), table(s, d, "discussion_comments"))
    both = marks(_events(s, d), "e").join(marks(placed, "t"), "review_id", "left")
    return both.select("review_id", (F.col("e_n").eqNullSafe(F.col("t_n")) & F.col("e_h").eqNullSafe(F.col("t_h"))).alias("complete"))


@query(f"with {REVIEWS}, {INTERACTIONS}, {MARKED}, d as (select i.event_id, i.event_date, m.kept, m.review_date, m.review_id, {BODY.format('i.content')} body_hash, array_to_string(list_sort(list_distinct(list_filter(list_transform(coalesce(i.creators, []), lambda n: array_to_string(list_sort(regexp_extract_all(lower(coalesce(n, '')), '[a-z0-9]+')), ' ')), lambda k: k <> ''))), '|') people from inter i join marked m on i.target_review_id = m.review_id where i.kind = 'discussion'), g as (select kept, body_hash, people, arg_min(event_id, struct_pack(a := review_date, b := review_id, c := event_date, d := event_id)) survivor from d group by all) select 'review' record_type, review_id removed_id, kept kept_id from marked where review_id <> kept union all select 'discussion', d.event_id, g.survivor from d join g using (kept, body_hash, people) where d.event_id <> g.survivor")
def dedup_log(s: SparkSession, d: str) -> DataFrame:
    """Every removed duplicate with what was kept for it, reviews and discussion comments."""
    flat = _flat(s, d)
    marked = dedup.mark_duplicates(flat, ["family_key", "value"], "review_id", ["review_date"], "comment")
    reviews = flat.select("review_id", "review_date").join(marked.select("review_id", "kept"), "review_id")
    rows = _interactions(s, d).where("kind = 'discussion'").join(reviews, F.col("target_review_id") == F.col("review_id"))
    rows = rows.select("kept", dedup.participants("creators").alias("people"), "event_id", "review_date", "review_id", "event_date", "content")
    comments = dedup.mark_duplicates(rows, ["kept", "people"], "event_id", ["review_date", "review_id", "event_date"], "content", "survivor")
    return dedup.log(marked, "review", "review_id", "kept").unionByName(dedup.log(comments, "discussion", "event_id", "survivor"))


@query("select distinct doi, replace(doi, '/', '%2F') encoded, " + " or ".join(f"starts_with(doi, '{p}')" for p in SWAP[0]) + " second_first from targets where kind = 'doi'")
def doi_requests(s: SparkSession, d: str) -> DataFrame:
    """DOIs as they stand in an address, and which provider is asked first."""
    rows = table(s, d, "targets").where("kind = 'doi'").select("doi").distinct()
    return rows.select("doi", C.encoded(F.col("doi")).alias("encoded"), merge.begins_with(F.col("doi"), SWAP[0]).alias("second_first"))


# Without an SQL equivalent


@query()
def clean_comments(s: SparkSession, d: str) -> DataFrame:
    return X.mapped(_flat(s, d).select("review_id", "comment"), X.clean_comment, ["comment"], "clean").select("review_id", "clean")


@query()
def clean_titles(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "provider_metadata").select("title").where("title is not null").distinct()
    return X.mapped(rows, X.clean_title, ["title"], "clean")


@query()
def title_warnings(s: SparkSession, d: str) -> DataFrame:
    """Targets whose merged title and representative hint are less alike than 0.58; a warning, never a filter."""
    titles = merge.merge_answers(_contributing(s, d)).select(F.col("target_value").alias("t"), "title")
    rows = table(s, d, "reviews").select(F.col("target.value").alias("target_value"), "title_hint", F.coalesce("review_date", F.lit("")).alias("review_date"), "review_id")
    pairs = rounds.representative(rows, "target_value", "title_hint", ["review_date", "review_id"]).join(titles, F.col("target_value") == F.col("t"))
    scored = X.mapped(pairs.select("target_value", "title", "title_hint"), X.title_similarity, ["title", "title_hint"], "similarity", "double")
    return scored.where("similarity < 0.58").withColumn("similarity", F.round("similarity", 4))


@query()
def own_answers(s: SparkSession, d: str) -> DataFrame:
    """Responses without what they quote of their review."""
    rows = _interactions(s, d).where("kind = 'response'").join(_flat(s, d).select("review_id", "comment"), F.col("target_review_id") == F.col("review_id"))
    return X.mapped(rows.select("event_id", "content", "comment"), X.own_answers, ["content", "comment"], "answer").select("event_id", "answer")


@query()
def unwrapped_documents(s: SparkSession, d: str) -> DataFrame:
    return X.mapped(table(s, d, "documents").select("doc_id", "text"), X.unwrap, ["text"], "unwrapped").select("doc_id", "unwrapped")


@query()
def person_keys(s: SparkSession, d: str) -> DataFrame:
    names = table(s, d, "reviews").select(F.explode("creators").alias("name")).distinct()
    return X.mapped(names, X.person_key, ["name"], "key")


@query()
def threads_nested(s: SparkSession, d: str) -> DataFrame:
    return threads.threads(table(s, d, "reviews"), table(s, d, "author_responses"), table(s, d, "discussion_comments"))


@query("select target_value, kind, family_key, version, coalesce(doi, '') doi, status from targets")
def csv_round_trip(s: SparkSession, d: str) -> DataFrame:
    """A table written as CSV and read again."""
    rows = table(s, d, "targets").select("target_value", "kind", "family_key", "version", "doi", "status")
    path = f"{scratch_dir(s).rstrip('/')}/csv-round-trip-{uuid.uuid4().hex}"
    files.write_csv(rows, path)
    return files.read_csv(s, path, rows.columns).withColumn("version", F.nullif("version", F.lit("")).cast("int"))


@query("select distinct review_id from reviews")
def stream_unique_reviews(s: SparkSession, d: str) -> DataFrame:
    stream = streams.stream_of(s, d, "reviews").select("review_id", "harvested_at")
    return streams.drain(streams.unique_within(stream, "review_id", "harvested_at", "400 days")).select("review_id")


@query("select time_bucket(interval '1 day', ts) window_start, event_type, count(*) n from events where time_bucket(interval '1 day', ts) + interval '1 day' <= (select max(ts) - interval '1 hour' from events) group by 1, 2")
def stream_event_counts(s: SparkSession, d: str) -> DataFrame:
    """Windows that ended an hour or more before the latest event: those of which no more can come."""
    return streams.drain(streams.counts_by_window(streams.stream_of(s, d, "events"), "ts", "event_type", "1 day", "1 hour"))
