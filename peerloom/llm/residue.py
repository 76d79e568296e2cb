"""Problem 1: template residue and error-page text.

Method: lines are normalised and counted by host. Lines that stand in a large share of their host's records are the
form's boilerplate and are subtracted; a record is excluded when its residual holds an unfilled slot, filler, a failed
page or a demand to switch scripts on, or when nothing but subtracted evidence was there. The counts also tell machine
text whose wording is not listed: people don't type the same notice again and again, so a line that recurs on its host
and speaks of a machine's parts and states is a notice of a failed page. Text that talks about such things, quotes them
or uses brackets in the ordinary way is left alone.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialise

#: A line is the form's own from this share of its host's records on; it recurs from that share on; both in so many records.
FORM_SHARE, RECURRENT_SHARE, RECURRENT_LEAST = 0.05, 0.0005, 20
#: Beyond so many recurrent lines (17 bytes each) they are joined by a shuffle.
BROADCAST_ROWS = 500_000

# How unfilled slots are written.
SLOTS = [
    r"\{\{[^{}\n]+\}\}",
    r"\$\{[^{}\n]+\}",
    r"(?<![\w}\\])\{\p{L}[\p{L}\d._]+\}",
    r"<%[^%\n]+%>",
    r"<<[\p{L}_][\w. ]*>>",
    r"(?<![\w%])%[\p{L}][\p{L}_.]+%(?!\w)",
    r"(?<!\w)__\p{L}[\w.]*?__(?!\w)",
    r"@@\p{L}[\w.]*@@",
    r"(?<![\w#])#\p{Lu}[\p{Lu}_.]+#",
    r"\[(?:(?:[Ii]nsert|INSERT|[Aa]dd|ADD|[Ee]nter|ENTER|[Ss]elect|SELECT|[Cc]hoose|[Tt]ype|[Ww]rite|[Ff]ill in|[Yy]our|YOUR|[Nn]ame of|NAME OF|[Tt]itle of|[Ee]scrib[ae]|ESCRIBA|[Ii]nsert[ae]r?|[Ii]nsira|[Tt]ítulo d[eo]|TÍTULO D[EO]|[Nn]ombre d[ee]l?|[Nn]ome d[oae]|[Nn]om d[eu']|[Tt]itre d[eu']) ?(?:[^\[\]\s]++\s*+){0,9}|[àÀ] (?:compléter|COMPLÉTER|remplir)|(?:a|por) (?:completar|preencher))\]",
    r"(?<!\w)X{4,}(?!\w)",
    r"(?<!\w)TBD(?!\w)",
]
# Nouns that name a slot instead of leaving it open.
MENTION = r"(?:slot|placeholder|variable|token|tag|macro|string|notation|syntax|template)s?"

# Demands for scripts.
SCRIPTS = [
    r"(?:enable|activate|allow|turn(?:ed)? on|switch(?:ed)? on|activer|activar|ative|activez|active|habilit\w+|requires?|need)\b.{0,40}\b(?:java ?scripts?|(?:client-side )?script(?:s|ing)|cookies)\b",
    r"\b(?:java ?script|scripts?|scripting)\b.{0,30}\b(?:disabled|blocked|off|required|désactivé\w*|desactivad\w+|desativad\w+)\b",
]
# A part of every pattern of the last one.
DEMAND_WORDS = ["nable", "activ", "ativ", "allow", "turn", "switch", "habilit", "requir", "need", "blocked", "disabled", "off"]
# Sentences of failed pages, wherever they stand.
FAILURES = [
    r"page (?:you are looking for|you requested) does not exist",
    r"temporarily down for maintenance",
    r"checking your (?:connection|browser)",
    r"\b(?:you do not have|you don't have) permission to (?:view|access) this (?:page|resource|content)",
    r"unexpected error occurred",
    r"your session has expired",
    r"ocorreu um erro inesperado",
    r"se ha producido un error inesperado|ha ocurrido un error inesperado",
    r"la page demandée est introuvable",
    r"une erreur inattendue s'est produite",
    r"traceback \(most recent call last\)",
    r"\b\w+(?:error|exception): .{0,80}",
    r"cannot read propert(?:y|ies) of (?:undefined|null)",
]
# What failed calls leave, also in quotes.
FAILED_DATA = [r"""\{ ?"(?:status|error|code|message)" ?:""", r"\[object object\]", r"upstream request failed"]
# Parts that a line must have, all of one row, for a pattern of the last two to hold in it.
FAILURE_PARTS = [
    ["page", "exist"], ["temporarily", "maintenance"], ["checking", "your"], ["permission", "this"], ["unexpected", "error"], ["session", "expired"], ["inesperado"],
    ["introuvable"], ["inattendue"], ["traceback"], ["error:"], ["exception:"], ["cannot", "propert"], ["{", '"'], ["[object"], ["upstream"],
]
# Whole lines of failed pages.
FAILED_LINES = [
    r"(?:http |error |erro |erreur |error:? )?[45]\d\d(?:[ :-]+(?:not found|forbidden|unauthori[sz]ed|bad request|bad gateway|service (?:temporarily )?unavailable|internal server error|too many requests|gateway time-?out))?",
    r"(?:error|erro|erreur)[ :#]+[45]\d\d",
    r"(?:404|page|página|seite) (?:not found|no encontrada|não encontrada|nicht gefunden)",
    r"(?:access|acceso|acesso|accès) (?:denied|denegado|negado|refusé)",
    r"(?:not found|forbidden|bad gateway|service unavailable|internal server error|gateway time-?out|too many requests)",
]
# Whole lines that only fill space.
FILLER_LINES = [
    r"x{3,}",
    r"(?:asdf ?)+|(?:qwerty ?)+|(?:abc ?){2,}|(?:test ?)+\d*|(?:foo|bar|baz)(?: (?:foo|bar|baz))*",
    r"undefined|null|nan|none|\[object object\]",
    r"(?:type|write|enter|insert|add) (?:your )?(?:review|comment|text|answer|response|content)s? here",
    r"click here to (?:add|enter|edit) (?:text|comment|content)",
    r"(?:comment|review|text|content)(?: body| text)? goes here",
    r"placeholder(?: text)?(?: ?[-–:] ?do not publish)?",
    r"(?:sample|dummy|example|filler|default) text",
    r"texto de (?:ejemplo|exemplo|muestra|amostra)|texte (?:à remplacer|d'exemple|de remplissage)",
]
# The words of pseudo-Latin filler.
LATIN = (
    "lorem ipsum dolor sit amet consectetur adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad "
    "minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit "
    "esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum"
).split()
LATIN_RUN = 4
# Parts of a machine, states of it, and what it asks for. A recurrent line with two of the three is a notice.
MACHINE = [
    ["page", "página", "seite", "website", "server", "servidor", "serveur", "browser", "navegador", "navigateur", "script", "cookie", "application", "connection", "conexión", "conexão", "connexion", "request", "session", "captcha", "plugin", "widget", "database"],
    ["error", "erro ", "erreur", "fehler", "failed", "failure", "unable", "unavailable", "not available", "no disponible", "indisponível", "indisponible", "cannot", "could not", "couldn't", "denied", "disabled", "blocked", "not found", "expired", "timed out", "overloaded", "loading", "maintenance"],
    ["reload", "refresh", "try again", "retry", "enable", "sign in", "log in", "logged in", "administrator", "please wait", "come back later", "inténtelo", "tente novamente", "réessayer"],
]
# Blanks beside those that a pattern calls blank.
BLANKS = "\u00a0\u2009\u202f\u3000"


def as_text(c: Column) -> Column:
    """Markup off, entities that stand for signs resolved."""
    markup = F.regexp_replace(c, r"(?i)</?(?:p|div|br|span|b|i|em|strong|ul|ol|li|h\d|a|u|sup|sub|blockquote)(?:\s[^<>]*)?/?>", "\n")
    c = F.when(F.contains(c, F.lit("<")), markup).otherwise(c)
    resolved = c
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        resolved = F.replace(resolved, F.lit(name), F.lit(sign))
    return F.when(F.contains(c, F.lit("&")), resolved).otherwise(c)


def normal_line(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(c), BLANKS, " " * len(BLANKS)), r"\s+", " "))


def line_hash(low: Column) -> Column:
    """Equal for lines in lower case that differ in blanks only."""
    return F.xxhash64(F.translate(low, " \t" + BLANKS, ""))


def _unquoted(c: Column) -> Column:
    return F.regexp_replace(c, "(?<!\\w)\"[^\"\n]+\"(?!\\w)|“[^”\n]+”|«[^»\n]+»|„[^“\n]+“|(?<!\\w)‘[^’\n]+’", " ")


def _any(patterns: list[str]) -> str:
    return "(?:" + "|".join(patterns) + ")"


def _whole(patterns: list[str]) -> str:
    """One of the patterns as a whole line in lower case, whatever marks and blanks stand around it and between its words."""
    some = rf"[\s{BLANKS}]"
    inner = _any(patterns).replace("[ ", rf"[\s{BLANKS}").replace(" ?", some + "*").replace(" ", some + "+")
    return rf"^[\s{BLANKS}\"'*_>#-]*{inner}[\s{BLANKS}\"'*_.!…;:-]*$"


def _has(c: Column, parts: list[str]) -> Column:
    return reduce(or_, [F.contains(c, F.lit(x)) for x in parts])


def evidence(line: Column, low: Column) -> Column:
    """slot, filler, failure or script for a line of as_text (low: it in lower case) that holds such residue, else null.

    Each group of patterns is behind a plain search for what all of them need.
    """
    slots = _any(SLOTS)
    named = rf"(?i:\b{MENTION}\b)(?:\s+\p{{L}}+){{0,2}}?\s+[\"“«'‘]?{slots}|{slots}(?:\s+\p{{L}}+){{0,2}}?\s+(?i:{MENTION})\b|[\"“«‘']{slots}[\"”»’']"
    plain = F.regexp_replace(line, named, " ")
    spoken = normal_line(_unquoted(line))
    latin = rf"(?:\b{_trie(LATIN)}\b[\s{BLANKS},.;:!?]*+){{{LATIN_RUN}}}"
    return (
        F.when(_has(line, ["{", "<", "%", "__", "@@", "#", "[", "XXXX", "TBD"]) & line.rlike(slots) & plain.rlike(slots), "slot")
        .when(low.rlike(_whole(FILLER_LINES)) | low.rlike(latin), "filler")
        .when(low.rlike(_whole(FAILED_LINES)), "failure")
        .when(reduce(or_, [reduce(and_, [F.contains(low, F.lit(x)) for x in parts]) for parts in FAILURE_PARTS]) & (spoken.rlike(_any(FAILURES)) | normal_line(line).rlike(_any(FAILED_DATA))), "failure")
        .when(_has(low, ["script", "cookie"]) & _has(low, DEMAND_WORDS) & low.rlike(r"(?<![\p{L}\p{N}_])script|java.?script|cookie") & spoken.rlike(_any(SCRIPTS)), "script")
    )


def notice(low: Column) -> Column:
    """Whether a line in lower case speaks of two of a machine's parts, its states and what it asks for."""
    return sum(_has(low, words).cast("int") for words in MACHINE) >= 2


def _trie(words: list[str]) -> str:
    """An alternation of the words that shares their beginnings, so that most places fail at one letter."""
    heads: dict[str, list[str]] = {}
    for w in words:
        if w:
            heads.setdefault(w[0], []).append(w[1:])
    parts = [h + _trie(tails) for h, tails in heads.items()]
    return ("(?:" + "|".join(parts) + ")" + "?" * ("" in words)) if parts else ""


def records(reviews: DataFrame, comments: DataFrame) -> DataFrame:
    """record_kind, record_key, host, text: once for each key and content; null keys and texts give no row."""
    host = lambda c: F.coalesce(F.regexp_extract(F.lower(c), r"^[a-z]+://([^/:]+)", 1), F.lit(""))
    rows = reviews.select(F.lit("review").alias("record_kind"), F.col("review_id").alias("record_key"), host(F.col("record_url")).alias("host"), F.col("comment").alias("text"))
    rows = rows.unionByName(comments.select(F.lit("discussion").alias("record_kind"), F.col("comment_id").alias("record_key"), host(F.col("record_url")).alias("host"), F.col("content").alias("text")))
    return rows.where("record_key is not null and text is not null")


def residue(rows: DataFrame) -> DataFrame:
    """record_kind, record_key, kinds, left_lines for the records of rows to be kept out.

    kinds: what residue a record holds, sorted; left_lines: how many of its lines are neither residue nor boilerplate.
    A line of its host's form is subtracted whatever it holds; only where no other line is left does the evidence in it
    count. rows has record_kind, record_key, host and text; other columns are ignored. Blank texts hold no residue, a
    record given several times counts once (its lines once for each time), and an empty table gives an empty result.
    """
    lines = rows.select("record_kind", "record_key", "host", F.explode(F.split(as_text(F.col("text")), r"[\n\r]+")).alias("line")).where(r"line rlike '\\S'")
    lines = lines.withColumn("low", F.lower("line")).withColumn("hash", line_hash(F.col("low")))
    recurrent, small = recurrent_lines(lines, rows)
    lines = lines.join(F.broadcast(recurrent) if small else recurrent, ["host", "hash"], "left")
    kind = F.coalesce(evidence(F.col("line"), F.col("low")), F.when(F.col("form").isNotNull() & notice(F.col("low")), "failure"))
    seen = lines.select("record_kind", "record_key", F.coalesce("form", F.lit(False)).alias("form"), F.col("form").isNotNull().alias("recurs"), kind.alias("kind"))
    held = seen.groupBy("record_kind", "record_key").agg(
        F.array_sort(F.collect_set(F.when(~F.col("form"), F.col("kind")))).alias("kinds"), F.array_sort(F.collect_set(F.when(F.col("form"), F.col("kind")))).alias("taken"),
        F.count_if(~F.col("form")).alias("residual"), F.count_if(F.col("kind").isNull() & ~F.col("recurs")).alias("left_lines"),
    )
    held = held.select("record_kind", "record_key", F.when(F.col("residual") == 0, F.col("taken")).otherwise(F.col("kinds")).alias("kinds"), "left_lines")
    # Filtered after the grouping: a filter on the evidence itself would be pushed down and worked out again for each use of low.
    return held.where(F.size("kinds") > 0)


def recurrent_lines(lines: DataFrame, rows: DataFrame) -> tuple[DataFrame, bool]:
    """host, hash, form of the lines that recur (form: so often that they are the form's own), and whether they are few
    enough to be broadcast."""
    counts = lines.groupBy("host", "hash").agg(F.count("*").alias("n"))
    totals = rows.groupBy("host").agg(F.count("*").alias("records"))
    often = counts.where(F.col("n") >= RECURRENT_LEAST).join(totals, "host").where(F.col("n") >= RECURRENT_SHARE * F.col("records"))
    often = materialise(often.select("host", "hash", (F.col("n") >= FORM_SHARE * F.col("records")).alias("form")), "recurrent")
    return often, often.count() <= BROADCAST_ROWS


def found(reviews: DataFrame, comments: DataFrame) -> DataFrame:
    return residue(records(reviews, comments)).select("record_kind", "record_key")


def kept_out(reviews: DataFrame, comments: DataFrame) -> DataFrame:
    """How many records each kind of residue keeps out, and in how many of them nothing else is left."""
    held = residue(records(reviews, comments)).withColumn("kinds", F.array_join("kinds", "+"))
    return held.groupBy("record_kind", "kinds").agg(F.count("*").alias("records"), F.count_if(F.col("left_lines") == 0).alias("nothing_left"))
