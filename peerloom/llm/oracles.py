"""SQL equivalents of queries in this package, where SQL can express them. They compare all with all and suit small tables."""

from __future__ import annotations

from . import near_dup, skeleton, survivor, venues


def _text(values: list[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _put(template: str, *values: str) -> str:
    for i, v in enumerate(values):
        template = template.replace(f"{{{i}}}", v)
    return template


# Problem 4: every two records that share a three-word sequence.
_SEQUENCES = f"""
texts as (select distinct id, x from (select review_id id, comment x from reviews union all select comment_id, content from discussion_comments) where id is not null and x is not null),
split as (select id, regexp_extract_all(lower(x), '[\\p{{L}}\\p{{N}}]+') w from texts),
seqs as (select id, unnest(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) q from split where len(w) >= {near_dup.LEAST_WORDS}),
sizes as (select id, count(*) n from seqs group by id),
met as (select a.id id_a, b.id id_b, count(*) shared from seqs a join seqs b on a.q = b.q and a.id < b.id group by all)
"""
_PAIRS = f"select id_a, id_b from met join sizes a on a.id = id_a join sizes b on b.id = id_b where shared >= {near_dup.SIMILARITY} * (a.n + b.n - shared)"

# Problem 3: the same keys, every value against every listed name.
_ACCENTS = f"translate(replace(lower({{0}}), 'ß', 'ss'), '{venues.ACCENTED}', '{venues.PLAIN}')"
_PLAIN = "trim(regexp_replace(regexp_replace(" + _put(_ACCENTS, "regexp_replace(regexp_replace({0}, '&amp;', '&', 'gi'), '[\\s\\x{00a0}]+', ' ', 'g')") + ", '&', ' and ', 'g'), ' +', ' ', 'g'))"
_COMPACT = "regexp_replace({0}, '[^\\p{L}\\p{N}]', '', 'g')"
_WORDS = "list_filter(string_split(regexp_replace({0}, '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda w: w <> '' and w not in " + _text(venues.SMALL_WORDS) + ")"
_UNWRAP = (
    "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '^(?:posted on|posted at|published in|available at|in:|see) ', ''), "
    "'(?:[,;]? ?(?:vol(?:ume)?|no|issue|pp?)\\.? ?[0-9][0-9() ,.:-]*| ?\\([^()]*\\)|: posted content|,? preprint server|[ ,.;:-]+)+$', ''), "
    "'^(.+), ((?:[^, ]+ )*(?:of|for|on|in|the))$', '\\2 \\1'), '^the ', ''))"
)
_MATCHED = f"""
cand as (select distinct provider_record_id, i - 1 cand_pos, venue_candidates[i] raw from (select provider_record_id, venue_candidates, unnest(range(1, len(venue_candidates) + 1)) i from provider_metadata) where venue_candidates[i] is not null),
vals as (select distinct raw, {_put(_PLAIN, 'raw')} p from cand), v as (select raw, p, regexp_replace(regexp_extract(p, '^(?:https?://)?(?:www\\.)?([a-z0-9-]+(?:\\.[a-z0-9-]+)+)(?:[:/].*)?$', 1), '^www\\.', '') h from vals where p <> ''),
forms as (select raw, h, unnest([p, {_put(_UNWRAP, 'p')}, {_put(_UNWRAP, "regexp_replace(p, '[.;,: -]+$', '')")}, regexp_extract(p, '\\((?:now |formerly |ex )?([^()]+)\\)\\s*$', 1)]) f from v where h = '' or p not like 'http%'),
keyed as (select distinct raw, f, regexp_replace({_put(_COMPACT, 'f')}, '^the(.)', '\\1') k from forms where f <> ''),
refs as (select distinct venue_id, {_put(_PLAIN, 'n')} n from (select venue_id, unnest([venue_name, short_name, former_name]) n from venues) where n is not null),
refk as (select venue_id, n, {_put(_COMPACT, "regexp_replace(n, '^the ', '')")} k from refs),
sure as (select raw, venue_id from v join venues on h = lower(host) where h <> '' union select raw, venue_id from keyed join refk using (k) where k <> ''),
open_ as (select * from keyed where raw not in (select raw from sure) and k <> ''),
short as (select distinct raw, {_put(_WORDS, 'f')} s from open_), full_ as (select venue_id, {_put(_WORDS, 'n')} w from refs),
abbr as (select raw, venue_id from short join full_ on len(s) = len(w) and len(s) > 1 and len(list_filter(range(1, len(s) + 1), lambda i: starts_with(w[i], s[i]))) = len(s) and len(list_filter(s, lambda x: len(x) > 2)) > 0),
near as (select raw, venue_id, min(levenshtein(o.k, r.k)) d from open_ o join refk r on levenshtein(o.k, r.k) <= case when length(r.k) < {venues.SHORT} then -1 when length(r.k) < {venues.LONG} then 2 else 3 end group by 1, 2),
got as (select raw, venue_id, 0.0 c from sure union all select raw, venue_id, 0.5 from abbr union all select raw, venue_id, d from near),
best as (select raw, arg_min(venue_id, struct_pack(a := c, b := venue_id)) venue_id from got group by raw),
mapped as (select c.provider_record_id, cast(c.cand_pos as int) cand_pos, c.raw, coalesce(b.venue_id, 0) venue_id from cand c join v on c.raw = v.raw left join best b on c.raw = b.raw)
"""

# Problem 2: the rules for whole fields, the first of those that are whole.
_LOOKALIKE = "".join(skeleton.CYRILLIC) + "".join(skeleton.GREEK)
_PROTOTYPE = "".join(skeleton.CYRILLIC.values()) + "".join(skeleton.GREEK.values())
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "''")
_HIDDEN = "[" + "".join(f"\\x{{{c:04x}}}" for c in skeleton.INVISIBLE) + "]"
_BLANK = "[" + "".join(f"\\x{{{c:04x}}}" for c in skeleton.SPACES) + "]"
_HYPHEN = "[" + "".join(f"\\x{{{c:04x}}}" for c in skeleton.HYPHENS) + "]"
_SKELETON = (
    f"lower(strip_accents(nfc_normalize(trim(regexp_replace(translate(translate(replace(replace(regexp_replace(regexp_replace(regexp_replace({{0}}, '{_HIDDEN}', '', 'g'), '{_BLANK}', ' ', 'g'), '{_HYPHEN}', '-', 'g'), chr(64257), 'fi'), chr(64258), 'fl'), '{_WIDE}', '{_NARROW}'), '{_LOOKALIKE}', '{_PROTOTYPE}'), ' +', ' ', 'g')))))"
)
_TARGET = "regexp_replace(regexp_replace(lower(regexp_replace({0}, '^\\s+|[\\s.]+$', '', 'g')), '^https?://[^/]+/', ''), '^(?:doi|arxiv)\\s*:\\s*', '')"
_REAL = "list_distinct(list_filter(list_transform(coalesce({0}, []), lambda x: trim(x, ' ')), lambda x: x is not null and lower(x) not in {1}))"
_CUT = "\\s*(?:\\.{2,}|…|[\\[(](?:\\.{2,}|…)[\\])])\\s*$"
_SURVIVORS = f"""
raw as (select distinct {_put(_TARGET, 'target_value')} t, provider_record_id id, provider, title, authors, "year", fields, retrieved_at from provider_metadata),
a as (select t, id, raw.provider, coalesce(trust_rank, 2147483647) trust, retrieved_at, title, {_put(_SKELETON, 'title')} sk, {_put(_REAL, 'authors', _text(survivor.NO_PERSON))} people, {_put(_REAL, 'fields', _text(survivor.NO_FIELD))} topics, trim("year", ' ') y from raw left join providers p on raw.provider = p.provider),
b as (select *, sk is not null and sk not in {_text(survivor.NO_TITLE)} and not regexp_matches(sk, '{_CUT}') "real", regexp_replace(regexp_replace(regexp_replace(sk, '{_CUT}', ''), '^(?:\\p{{L}}+ ){{0,2}}\\p{{L}}+(?:: | - )', ''), '[ .,;:-]+$', '') bare from a),
g as (select t, max(len(people)) mp, max(len(topics)) mt, count(distinct id) n from b group by t),
w as (select b.*, g.n, b."real" and not exists (select 1 from b o where o.t = b.t and o.bare <> b.bare and starts_with(o.bare, b.bare) and o.sk not in {_text(survivor.NO_TITLE)}) wt,
 len(people) > 0 and len(people) = mp and len(list_filter(people, lambda p: not regexp_matches(p, '{survivor.INITIALS_ONLY.replace("'", "''")}'))) > 0 wa,
 coalesce(regexp_full_match(y, '[0-9]{{4}}') and try_cast(y as int) between {survivor.FIRST_YEAR} and {survivor.LAST_YEAR}, false) wy, len(topics) > 0 and len(topics) = mt wf from b join g using (t) where t <> ''),
k as (select t, id, n, trust, -epoch_us(coalesce(retrieved_at, timestamp '1970-01-01')) older, coalesce(wt, false)::int + 2 * wa::int + 4 * wy::int + 8 * wf::int mask from w),
layer_0 as (select * from k y where not exists (select 1 from k x where x.t = y.t and (x.mask & y.mask) = y.mask and x.older <= y.older and x.trust <= y.trust and (x.mask <> y.mask or x.older < y.older or x.trust < y.trust))),
layer_1 as (select * from (select * from k except select * from layer_0) y where not exists (select 1 from (select * from k except select * from layer_0) x where x.t = y.t and (x.mask & y.mask) = y.mask and x.older <= y.older and x.trust <= y.trust and (x.mask <> y.mask or x.older < y.older or x.trust < y.trust))),
peeled as (select *, 0 layer from layer_0 union all select *, 1 from layer_1 union all select *, 2 from (select * from k except select * from layer_0 except select * from layer_1)),
f as (select *, unnest(['title', 'authors', 'year', 'fields']) field_name, unnest([1, 2, 4, 8]) bit from peeled),
s as (select t, n, field_name, arg_min(id, struct_pack(l := layer, a := older, b := trust, c := id)) id from f where mask & bit > 0 group by all)
"""

SQL: dict[str, str] = {
    "p2_found": f"with {_SURVIVORS} select t target_value, field_name, id provider_record_id from s where n > 1",
    "p2_merged": f"with {_SURVIVORS}, v as (select s.t, s.field_name, s.id, r.title, r.authors, r.\"year\", r.fields from s join (select distinct t, id, title, authors, \"year\", fields from raw) r on s.t = r.t and s.id = r.id) select g.t target_value, "
    + ", ".join(f"any_value(\"{f}\") filter (field_name = '{f}') \"{f}\", max(id) filter (field_name = '{f}') {f}_from" for f in survivor.FIELDS)
    + " from g left join v on g.t = v.t where g.t <> '' group by 1",
    "p3_found": f"with {_MATCHED} select provider_record_id, cand_pos, venue_id from mapped",
    "p3_unmatched": f"with {_MATCHED} select raw candidate, count(*) times from mapped where venue_id = 0 group by 1",
    "p4_found": f"with {_SEQUENCES} {_PAIRS}",
    "p4_classes": f"with {_SEQUENCES}, found as ({_PAIRS}), classes as (select id, min(id) over (partition by w) class_id from split where len(w) >= {near_dup.LEAST_WORDS}), reps as (select distinct class_id from classes), "
    "ends as (select unnest([id_a, id_b]) class_id from found where id_a in (select class_id from reps) and id_b in (select class_id from reps)) select id, class_id, coalesce(n, 0) links from classes left join (select class_id, count(*) n from ends group by 1) using (class_id)",
    # Problems 7 and 8: what has to hold of any answer.
    "p7_breaches": "select container_id, 0 missing, 0 twice, 0 overfull, 0 gaps from container_sizes",
    "p8_breaches": "select source, 0 unknown, 0 too_often, 0 twice from mixture_targets",
}
