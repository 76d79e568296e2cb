"""Problem 3: mapping free-entered values to a canonical list.

Method: partition-based pigeonhole join, in SQL functions only. Each reference string is cut into k+1 segments; a
value within k edits holds at least one of them unchanged, at most k places away. Values and references are joined on
(segment, place) equality, verified with levenshtein, and values without a partner are found by an anti-join.

Before that, equal keys are joined: the plain form, the form without what providers add around a name (a leading
"posted on", a trailing volume, a bracketed short name), the turned-round form ("Hydrology, Journal of"), the host of
an address, and the initials of abbreviated words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialise

# Accented letters and their plain ones, for the SQL translate function.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿøł"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyol"
# Words left out of abbreviated names.
SMALL_WORDS = ["of", "for", "the", "and", "in", "on", "de", "do", "da", "des", "der", "die", "das", "fur", "du", "la", "le", "el"]
#: Values shorter than this are taken only as they are; up to LONG letters two edits are allowed, beyond three.
SHORT, LONG = 6, 16
#: Names and hosts of the list up to which it is broadcast; each has at most 4 segments and 28 shapes of them.
BROADCAST_REFS = 50_000


def plain(c: Column) -> Column:
    """Lower case, entities resolved, accents off, '&' as 'and', blanks collapsed."""
    c = F.lower(F.regexp_replace(F.regexp_replace(c, "(?i)&amp;", "&"), "(?U)\\s+", " "))
    c = F.translate(F.replace(c, F.lit("ß"), F.lit("ss")), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(F.regexp_replace(c, "&", " and "), " +", " "))


def compact(c: Column) -> Column:
    return F.regexp_replace(c, "(?U)[^\\p{L}\\p{N}]", "")


def words(c: Column) -> Column:
    """The words of a plain name without the small ones."""
    parts = F.filter(F.split(F.regexp_replace(c, "(?U)[^\\p{L}\\p{N}]+", " "), " "), lambda w: w != "")
    return F.filter(parts, lambda w: ~w.isin(SMALL_WORDS))


def host(c: Column) -> Column:
    """The host of an address or a bare host name, else an empty string."""
    bare = F.regexp_extract(c, "^(?:https?://)?(?:www\\.)?([a-z0-9-]+(?:\\.[a-z0-9-]+)+)(?:[:/].*)?$", 1)
    return F.regexp_replace(bare, "^www\\.", "")


def unwrapped(c: Column) -> Column:
    """A plain name without what is put before and after it."""
    c = F.regexp_replace(c, "^(?:posted on|posted at|published in|available at|in:|see) ", "")
    c = F.regexp_replace(c, "(?:[,;]? ?(?:vol(?:ume)?|no|issue|pp?)\\.? ?[0-9][0-9() ,.:-]*| ?\\([^()]*\\)|: posted content|,? preprint server|[ ,.;:-]+)+$", "")
    c = F.regexp_replace(c, "^(.+), ((?:[^, ]+ )*(?:of|for|on|in|the))$", "$2 $1")
    return F.trim(F.regexp_replace(c, "^the ", ""))


def edits(c: Column) -> Column:
    n = F.length(c)
    return F.when(n < SHORT, 0).when(n < LONG, 2).otherwise(3)


def reference_keys(venues: DataFrame) -> DataFrame:
    """venue_id, kind (name or host), key, name: one row for each distinct way a listed venue is written."""
    names = venues.select("venue_id", F.explode(F.array("venue_name", "short_name", "former_name")).alias("name")).where("name is not null")
    names = names.select("venue_id", F.lit("name").alias("kind"), plain(F.col("name")).alias("name"))
    names = names.select("venue_id", "kind", "name", compact(F.regexp_replace("name", "^the ", "")).alias("key"))
    hosts = venues.where("host is not null").select("venue_id", F.lit("host").alias("kind"), F.lower("host").alias("name"), F.lower("host").alias("key"))
    return names.unionByName(hosts).where("key != ''").dropDuplicates(["kind", "key", "venue_id"])


def match_values(values: DataFrame, venues: DataFrame) -> DataFrame:
    """raw, venue_id for every distinct raw value: 0 where no listed venue is meant.

    values has one string column, raw. Null and blank values give no row. Equal keys win over abbreviations, and
    those over edits; then fewer edits, then the lower venue_id decide. The reference list is counted, and broadcast up
    to BROADCAST_REFS names; a longer one is joined by shuffles. An empty list gives 0 for every value.
    """
    refs = materialise(reference_keys(venues), "refs")
    few = refs.count() <= BROADCAST_REFS
    values = values.select("raw").where("raw is not null").distinct().withColumn("p", plain(F.col("raw"))).where("p != ''")
    inner = F.regexp_extract("p", "\\((?:now |formerly |ex )?([^()]+)\\)\\s*$", 1)
    keyed = values.select("raw", "p", host(F.col("p")).alias("h"), F.array_distinct(F.array("p", unwrapped(F.col("p")), unwrapped(F.regexp_replace("p", "[.;,: -]+$", "")), inner)).alias("forms"))
    keyed = materialise(keyed, "values")  # a row for each distinct value: read by every step below

    by_host = keyed.where("h != ''").join(_side(refs.where("kind = 'host'").select("key", "venue_id"), few), F.col("h") == F.col("key")).select("raw", "venue_id", F.lit(0).alias("cost"))
    texts = keyed.where("h = '' or not p like 'http%'").select("raw", F.explode("forms").alias("form")).where("form != ''")
    texts = texts.select("raw", "form", F.regexp_replace(compact(F.col("form")), "^the(?=.)", "").alias("key")).where("key != ''").distinct()
    names = refs.where("kind = 'name'").select("key", "venue_id", "name")
    equal = texts.join(_side(names.select("key", "venue_id"), few), "key").select("raw", "venue_id", F.lit(0).alias("cost"))
    sure = by_host.unionByName(equal)

    open_texts = materialise(texts.join(sure.select("raw").distinct(), "raw", "left_anti"), "open")
    initials = lambda ws: F.array_join(F.transform(ws, lambda w: F.substring(w, 1, 1)), "")
    full = names.select("venue_id", words(F.col("name")).alias("full")).where("size(full) > 1").withColumn("initials", initials(F.col("full")))
    short = open_texts.select("raw", words(F.col("form")).alias("short")).where("size(short) > 1").withColumn("initials", initials(F.col("short"))).distinct()
    begins = F.forall(F.arrays_zip("short", "full"), lambda z: F.startswith(z["full"], z["short"]) & (F.length(z["short"]) > 0))
    abbreviated = short.join(_side(full, few), "initials").where(begins & F.exists("short", lambda w: F.length(w) > 2)).select("raw", "venue_id", F.lit(0.5).alias("cost"))

    near = pigeonhole_join(open_texts.select("raw", "key"), refs.where("kind = 'name'").select("venue_id", F.col("key").alias("ref")), few)
    found = sure.select("raw", "venue_id", F.col("cost").cast("double").alias("cost")).unionByName(abbreviated.select("raw", "venue_id", F.col("cost").cast("double").alias("cost")))
    found = found.unionByName(near.select("raw", "venue_id", F.col("distance").cast("double").alias("cost")))
    best = found.groupBy("raw").agg(F.min_by("venue_id", F.struct("cost", "venue_id")).alias("venue_id"))
    none = keyed.select("raw").join(best.select("raw"), "raw", "left_anti").select("raw", F.lit(0).alias("venue_id"))
    return best.unionByName(none)


def _side(refs: DataFrame, few: bool) -> DataFrame:
    """The list's side of a join: broadcast where it was counted to be short, else shuffled."""
    return F.broadcast(refs) if few else refs.hint("merge")


def pigeonhole_join(values: DataFrame, refs: DataFrame, few: bool = False) -> DataFrame:
    """raw, venue_id, distance for values (raw, key) and references (venue_id, ref) within the edits a reference allows.

    few: whether the references are short enough to be broadcast. All joins are on equality."""
    shaped = refs.select("venue_id", "ref", F.length("ref").alias("len"), edits(F.col("ref")).alias("k")).where("k > 0")
    start = F.expr("cast(floor(i * len / (k + 1)) as int)")
    cut = shaped.select("*", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("i")).withColumn("at", start).withColumn("to", F.expr("cast(floor((i + 1) * len / (k + 1)) as int)"))
    segments = cut.select("venue_id", "ref", "len", "k", "at", F.expr("to - at").alias("size"), F.expr("substring(ref, at + 1, to - at)").alias("segment"))
    # Which substrings a value has to offer depends on the shapes of the references alone.
    shapes = segments.select("len", "k", "at", "size").distinct().withColumn("n", F.explode(F.expr("sequence(len - k, len + k)")))
    offers = values.select("raw", "key", F.length("key").alias("n")).join(_side(shapes, few), "n")
    offers = offers.select("raw", "key", "len", "at", "size", F.explode(F.expr("sequence(greatest(at - k, 0), at + k)")).alias("p")).where("p + size <= n")
    offers = offers.select("raw", "key", "len", "at", "size", F.expr("substring(key, p + 1, size)").alias("segment"))
    pairs = offers.join(_side(segments, few), ["len", "at", "size", "segment"]).select("raw", "key", "venue_id", "ref", "k").distinct()
    return pairs.withColumn("distance", F.levenshtein("key", "ref")).where("distance <= k").groupBy("raw", "venue_id").agg(F.min("distance").alias("distance"))


def map_candidates(metadata: DataFrame, venues: DataFrame) -> DataFrame:
    """provider_record_id, cand_pos, candidate, venue_id for every candidate that is neither null nor blank."""
    rows = metadata.select("provider_record_id", F.posexplode("venue_candidates").alias("cand_pos", "candidate")).where("candidate is not null").distinct()
    matched = match_values(rows.select(F.col("candidate").alias("raw")), venues)
    return rows.join(matched, rows.candidate == matched.raw).select("provider_record_id", "cand_pos", "candidate", "venue_id")


def unmatched(metadata: DataFrame, venues: DataFrame) -> DataFrame:
    """candidate, times: the values that mean no listed venue, each with how often it stands."""
    return map_candidates(metadata, venues).where("venue_id = 0").groupBy("candidate").agg(F.count("*").alias("times"))
