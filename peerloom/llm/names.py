"""Problem 6: variant spellings of names typed by people.

Method: noisy-channel attribution. Spellings that differ only in case, accents, order, titles or blanks are one form.
Forms are ranked by how complete and how frequent they are; every form is a candidate canonical one for those below
it, and only a higher one can be attached to, so that no attachments form a ring. For a pair the channel gives a likelihood (initials, nicknames, dropped middle names and surname halves, one slip of
the keyboard), the frequency of the candidate gives the prior, and each form is attached to its maximum posterior.
Following the attachments upwards ends at the canonical form of a person or organisation.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise

# What stands before and behind names.
TITLES = ["dr", "prof", "professor", "mr", "mrs", "ms", "mx", "sir", "dra", "ing", "dipl"]
SUFFIX = re.compile(r"(?:\s+Ph\.?D|,\s*(?:Ph\.?D|M\.?D|M\.?Sc|MPH|DPhil|B\.?Sc|MBA|Jr|Sr|FRS|RN))\.?$")
SUFFIXES = ["phd", "md", "msc", "ma", "mph", "dphil", "bsc", "mba", "jr", "sr", "ii", "iii", "frs", "rn"]
# Words of organisations, by the beginning that their abbreviations share.
ORGANISATION = "univ inst dep dept coll club jc lab cent soc group team network hosp school fac council committee acad found res rev consort collab assoc".split()
ORGANISATION_WORD = re.compile(
    r"^(?:univ(?:ersit\w+)?|inst(?:itut\w*)?|dep(?:t|artment\w*)?|coll(?:ege|ective)?|clubs?|jc|lab(?:orator\w+)?|cent(?:er|re|ro)?|soc(?:iety)?|groups?|teams?|networks?|hosp(?:ital)?|schools?|fac(?:ulty)?"
    r"|council|committee|acad(?:emy)?|found(?:ation)?|consortium|collaboration|assoc(?:iation)?|journal|res(?:earch)?|rev(?:iew)?|open|marine|stat(?:istics)?|science|studies|working)$"
)
ORGANISATION_SIGN = re.compile(r"\b(?:univ(?:ersit\w+)?|institut\w*|inst|dept|department\w*|college|collective|coll|club|jc|laborator\w+|society|consortium|committee|network|group)\b")
SMALL_WORDS = ["the", "of", "for", "and", "in", "at", "de", "la", "du", "der", "die", "für", "e", "y"]
# Nicknames and the names they stand for.
NICKNAMES = {
    "abby": "abigail", "alex": "alexander", "andy": "andrew", "annie": "anne", "beppe": "giuseppe", "peppe": "giuseppe", "becky": "rebecca", "ben": "benjamin",
    "bill": "william", "billy": "william", "will": "william", "bob": "robert", "bobby": "robert", "rob": "robert", "cathy": "catherine", "charlie": "charles",
    "chris": "christopher", "chuck": "charles", "cindy": "cynthia", "dan": "daniel", "danny": "daniel", "dave": "david", "debbie": "deborah", "deb": "deborah",
    "dick": "richard", "rick": "richard", "rich": "richard", "dima": "dmitri", "dora": "theodora", "ed": "edward", "eddie": "edward", "ted": "edward", "ned": "edward",
    "fred": "frederick", "gabi": "gabriela", "gus": "gustavo", "hank": "henry", "hans": "johannes", "harry": "henry", "jack": "john", "jen": "jennifer", "jenny": "jennifer",
    "jim": "james", "jimmy": "james", "joe": "joseph", "jon": "jonathan", "kate": "katherine", "katie": "katherine", "kathy": "katherine", "kay": "katherine",
    "katya": "ekaterina", "ken": "kenneth", "kim": "kimberly", "larry": "lawrence", "len": "leonard", "liz": "elizabeth", "beth": "elizabeth", "betty": "elizabeth",
    "lola": "dolores", "lupe": "guadalupe", "maggie": "margaret", "peggy": "margaret", "meg": "margaret", "manolo": "manuel", "matt": "matthew", "max": "maximilian",
    "mike": "michael", "mick": "michael", "misha": "mikhail", "nacho": "ignacio", "nick": "nicholas", "paco": "francisco", "pancho": "francisco", "pam": "pamela",
    "pat": "patricia", "patty": "patricia", "pepe": "jose", "pete": "peter", "ray": "raymond", "ron": "ronald", "sally": "sarah", "sam": "samuel", "sandy": "sandra",
    "sasha": "alexander", "sergio": "sergio", "steve": "stephen", "sue": "susan", "susi": "susanne", "susie": "susanne", "tania": "tatiana", "tanya": "tatiana", "theo": "theodore",
    "tim": "timothy", "tom": "thomas", "tommy": "thomas", "toni": "antonio", "tony": "anthony", "trudy": "gertrude", "val": "valentina", "vicky": "victoria", "vika": "victoria",
    "vova": "vladimir", "wally": "walter", "zeke": "ezekiel",
}

#: Log likelihoods of what the channel does.
INITIAL, NICKNAME, NO_MIDDLE, HALF, HALF_INITIAL, SLIP = -1.5, -1.5, -0.7, -2.5, -2.0, -4.5


def fold(text: str) -> str:
    """Lower case without accents; letters that have no decomposition by their usual transcription."""
    text = unicodedata.normalize("NFKD", text.casefold().replace("ł", "l").replace("ø", "o").replace("đ", "d").replace("ı", "i").replace("æ", "ae"))
    return "".join(c for c in text if not unicodedata.combining(c))


def parse(name: str) -> tuple[str, list[str], list[str], bool]:
    """(kind, given tokens, surname tokens, sure): kind is person, organisation or none; sure if the order is told by the
    writing itself. Where it isn't, the first token is given and the rest the surname."""
    name = SUFFIX.sub("", re.sub(r"\s+", " ", name).strip(" *†‡"))
    text = re.sub(r"\s+", " ", fold(name)).strip()
    if ORGANISATION_SIGN.search(text.replace(".", " ")):
        tokens = [t for t in re.findall(r"[^\W_]+", text) if t not in SMALL_WORDS]
        tokens = [u for t in tokens for u in (("journal", "club") if t == "jc" else (t,))]
        common = sorted({t[:3] for t in tokens if ORGANISATION_WORD.match(t)})
        own = [t for t in tokens if not ORGANISATION_WORD.match(t)]
        return "organisation", ["+".join(common)], own or ["-"], True
    text = re.sub(r"\([^()]*/[^()]*\)|[*†‡§]+|\d+", " ", text)
    text = re.sub(r"\([^()]*\)|\"[^\"]*\"|“[^”]*”", " ", text).strip(" ,;.")
    parts = [p.split() for p in text.split(",")]
    parts = [[t for t in p if t.strip(".") not in TITLES] for p in parts]
    parts = [p for k, p in enumerate(parts) if p and not (k and all(t.replace(".", "") in SUFFIXES for t in p))]
    if not parts:
        return "none", [], [], True
    if len(parts) > 1:
        return "person", _given(parts[1]), _surname(parts[0]), True
    tokens = parts[0]
    while len(tokens) > 2 and tokens[-1].replace(".", "") in SUFFIXES:
        tokens = tokens[:-1]
    if len(tokens) == 1:
        return "person", [], _surname(tokens), True
    # Initials and the capitals of the original tell the order.
    short = [bool(re.fullmatch(r"(?:[^\W\d_]\.-?)+|[^\W\d_]", t)) for t in tokens]
    last = re.sub(r"\s+", " ", name).strip(" ,;.*").split(" ")[-1]
    if not short[0] and (short[-1] or len(tokens) == 2 and re.fullmatch(r"[^\W\d_]{2,3}", last) and last.isupper() and not name.isupper()):
        return "person", list(tokens[-1].replace(".", "").replace("-", "")), _surname(tokens[:-1]), True
    k = 0
    while k < len(tokens) - 1 and (short[k] or k == 0):
        k += 1
    return "person", _given(tokens[:k]), _surname(tokens[k:]), any(short)


def _given(tokens: list[str]) -> list[str]:
    out: list[str] = []
    for t in tokens:
        if re.fullmatch(r"(?:[^\W\d_]\.-?)+[^\W\d_]?\.?", t) or len(t) == 1:
            out += re.findall(r"[^\W\d_]", t)
        elif t.strip("."):
            out.append(t.strip("."))
    return out


def _surname(tokens: list[str]) -> list[str]:
    return [h for t in tokens for h in t.split("-") if h]


def one_slip(x: str, y: str) -> bool:
    """Whether one letter added, left out, changed or swapped with its neighbour turns x into y."""
    if abs(len(x) - len(y)) > 1 or x == y:
        return False
    a = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
    if len(x) == len(y):
        return x[a + 1 :] == y[a + 1 :] or (x[a : a + 2] == y[a : a + 2][::-1] and x[a + 2 :] == y[a + 2 :])
    x, y = sorted((x, y), key=len)
    return x[a:] == y[a + 1 :]


def likelihood(v: tuple[str, str, str], c: tuple[str, str, str]) -> float | None:
    """Log likelihood that the canonical form c (given, middle, surname) comes out as v; null where it can't."""
    score, slips = 0.0, 0
    (vg, vm, vs), (cg, cm, cs) = v, c
    if vs != cs:
        vh, ch = vs.split("-"), cs.split("-")
        if one_slip(vs, cs):
            slips += 1
        elif len(ch) > 1 and len(vh) <= len(ch):
            if len(vh) == 1:
                score += HALF
            elif len(vh[1]) == 1 and ch[1].startswith(vh[1]):
                score += HALF_INITIAL
            else:
                return None
            if vh[0] != ch[0]:
                if not one_slip(vh[0], ch[0]):
                    return None
                slips += 1
        else:
            return None
    if vg != cg:
        if not vg or not cg:
            return None
        if len(vg) == 1:
            if cg[0] != vg:
                if not any(n[0] == vg and full == cg for n, full in NICKNAMES.items()):
                    return None
                score += NICKNAME
            score += INITIAL
        elif len(cg) == 1:
            return None
        elif NICKNAMES.get(vg) == cg:
            score += NICKNAME
        elif one_slip(vg, cg):
            slips += 1
        else:
            return None
    if vm != cm:
        if vm and cm and not (vm[0] == cm[0] and 1 in (len(vm), len(cm))):
            return None
        score += NO_MIDDLE
    if slips > 1:
        return None
    return score + SLIP * slips


def _cuts(word: str) -> set[str]:
    """word with one letter left out: two words one slip apart share one of these, or one is among the other's."""
    return {word[:i] + word[i + 1 :] for i in range(len(word))} | {word}


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        p = [parse(n) for n in b["name"]]
        yield pd.DataFrame({
            "name": b["name"], "n": b["n"], "kind": [x[0] for x in p], "sure": [x[3] for x in p],
            "given": [x[1] for x in p], "surname": [x[2] for x in p],
        })


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys of a form as a variant (role v) and as a candidate (role c); only forms with an equal key are compared.

    A surname of halves is met by its first half and by both written together."""
    for b in batches:
        out = []
        for form, given, surname in zip(b["form"], b["given"], b["surname"], strict=True):
            heads = {surname.split("-")[0], surname.replace("-", "")}
            cuts = {x for head in heads for x in _cuts(head)}
            full = NICKNAMES.get(given, given)
            if len(given) == 1:
                v = {f"{k}|{given}|{x}" for k in "ij" for x in cuts}
                c = {f"j|{given}|{x}" for x in cuts}
            else:
                v = {f"g|{full}|{x}" for x in cuts} | {f"h|{head}|{x}" for head in heads for x in _cuts(given)}
                c = {f"g|{given}|{x}" for x in cuts} | {f"h|{head}|{x}" for head in heads for x in _cuts(given)}
                first = {given[:1]} | {n[0] for n, f in NICKNAMES.items() if f == given}
                c |= {f"i|{i}|{x}" for i in first for x in cuts}
            out += [(form, "v", k) for k in v] + [(form, "c", k) for k in c]
        yield pd.DataFrame(out, columns=["form", "role", "key"])


def _scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        scores = []
        for v, c, cn in zip(b["v"], b["c"], b["cn"], strict=True):
            p = likelihood(tuple(v.split("|")[1:]), tuple(c.split("|")[1:]))
            scores.append(None if p is None else p + log(cn))
        b["score"] = pd.Series(scores, dtype="float64")
        yield b[["v", "c", "score"]][b["score"].notna()]


def spellings(*tables: DataFrame) -> DataFrame:
    """name, n: every distinct string in creators of the tables and the number of rows it stands in."""
    rows = [t.select(F.explode("creators").alias("name")) for t in tables]
    union = rows[0]
    for r in rows[1:]:
        union = union.unionByName(r)
    return union.where("name is not null and trim(name) != ''").groupBy("name").agg(F.count("*").alias("n"))


def link(names: DataFrame) -> DataFrame:
    """name, entity, n for every spelling of names (name, n): spellings with the same entity mean the same.

    Null and blank names give no row; a name given twice is one spelling; names of one token only ever join equal
    forms. Ties go to the more complete, then the lower form. An empty table gives an empty result. All joins are by
    shuffle: every side of them grows with the spellings.
    """
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = names.where("name is not null and trim(name) != ''").groupBy("name").agg(F.sum("n").alias("n"))
    parsed = names.repartition(tasks, "name").mapInPandas(_parsed, "name string, n long, kind string, sure boolean, given array<string>, surname array<string>")
    parsed = materialise(parsed.where("kind != 'none'"), "parsed")

    # A token is a given name as often as the writing says so; where it doesn't, the better of both ends is taken.
    sure = parsed.where("sure and kind = 'person'")
    told = sure.select(F.try_element_at("given", F.lit(1)).alias("token"), F.lit(1).alias("g")).where("length(token) > 1")
    told = told.unionByName(sure.select(F.explode("surname").alias("token"), F.lit(-1).alias("g")))
    told = told.groupBy("token").agg(F.sum("g").alias("g")).where("g > 0")
    known = parsed.sparkSession.createDataFrame([(x,) for x in sorted({*NICKNAMES, *NICKNAMES.values()})], "token string").withColumn("g", F.lit(3))
    told = told.unionByName(known).groupBy("token").agg(F.sum("g").alias("g"))
    ends = parsed.withColumn("first", F.when(~F.col("sure"), F.try_element_at("given", F.lit(1)))).withColumn("last", F.when(~F.col("sure"), F.try_element_at("surname", F.lit(-1))))
    known_as = [told.select(F.col("token").alias(end), F.col("g").alias(f"g_{end}")).hint("merge") for end in ("first", "last")]
    ends = ends.join(known_as[0], "first", "left").join(known_as[1], "last", "left")
    turn = ~F.col("sure") & (F.coalesce("g_last", F.lit(0)) > F.coalesce("g_first", F.lit(0)))
    given = F.when(turn, F.array("last")).otherwise(F.col("given"))
    surname = F.when(turn, F.concat("given", F.slice("surname", 1, F.size("surname") - 1))).otherwise(F.col("surname"))
    ends = ends.select("name", "n", "kind", given.alias("given"), surname.alias("surname"))
    part = lambda i: F.coalesce(F.try_element_at("given", F.lit(i)), F.lit(""))
    formed = ends.select("name", "n", F.concat_ws("|", F.substring("kind", 1, 1), part(1), part(2), F.array_join("surname", "-")).alias("form"))
    formed = materialise(formed, "formed")

    forms = formed.groupBy("form").agg(F.sum("n").alias("n"))
    bits = F.split("form", "\\|")
    forms = forms.withColumn("given", bits[1]).withColumn("surname", bits[3])
    whole = (F.length("given") > 1).cast("int") + (F.length(bits[2]) > 0).cast("int") + F.size(F.filter(F.split("surname", "-"), lambda h: F.length(h) > 1))
    # Abbreviations look up to what they abbreviate, slips to what is more frequent.
    forms = forms.withColumn("rank", F.struct(F.when(F.length("given") < 2, 0).when(F.col("given").isin(list(NICKNAMES)), 1).otherwise(2).alias("a"), F.size(F.filter(F.split("surname", "-"), lambda h: F.length(h) > 1)).alias("b"), F.col("n").alias("c"), whole.alias("d"), F.col("form").alias("e")))
    forms = materialise(forms, "forms")
    keys = forms.select("form", "given", "surname").repartition(tasks, "form").mapInPandas(_keys, "form string, role string, key string")
    keys = materialise(keys, "keys")
    v, c = (keys.where(f"role = '{r}'").select(F.col("form").alias(r), F.concat(F.substring(F.col("form"), 1, 1), "key").alias("key")) for r in "vc")
    met = v.join(c.hint("merge"), "key").where("v != c").select("v", "c").distinct()
    ranks = [forms.select(F.col("form").alias(r), F.col("n").alias(f"{r}n"), F.col("rank").alias(f"{r}r")).hint("merge") for r in "vc"]
    met = met.join(ranks[0], "v").join(ranks[1], "c").where("cr > vr").select("v", "c", "cn")
    scored = met.mapInPandas(_scored, "v string, c string, score double")
    best = scored.groupBy("v").agg(F.max_by("c", F.struct("score", "c")).alias("up"))
    return _follow(formed, best)


def _follow(formed: DataFrame, best: DataFrame) -> DataFrame:
    """name, entity, n: every form (formed: name, form, n) with the top of its attachments (best: v, up).

    Each round doubles the steps taken, until none moves or more steps than attachments are taken. After those only
    rings move; link makes none, and where best is given with one, its members and all below it meet at its least form.
    """
    up = materialise(best.select("v", "up", F.col("v").alias("low")), "up")
    moving, rounds = True, up.count().bit_length() + 1
    while moving and rounds:
        further = up.select(F.col("v").alias("up"), F.col("up").alias("next"), F.col("low").alias("next_low")).hint("merge")
        moved = up.join(further, "up", "left").select("v", F.coalesce("next", "up").alias("up"), F.least("low", "next_low").alias("low"), F.col("next").isNotNull().alias("moves"))
        moved = materialise(moved, "up")
        up, moving, rounds = moved.select("v", "up", "low"), bool(moved.where("moves").limit(1).count()), rounds - 1
    if moving:
        ring = up.select(F.col("v").alias("up"), F.col("low").alias("ring")).hint("merge")
        up = up.join(ring, "up", "left").select("v", F.coalesce("ring", "up").alias("up"))
    return formed.join(up.hint("merge"), formed.form == up.v, "left").select("name", F.coalesce("up", "form").alias("entity"), "n")


def pairs(linked: DataFrame) -> DataFrame:
    """name_a, name_b for every two spellings of one entity, name_a lower by code points."""
    x, y = (linked.select("entity", F.col("name").alias(f"name_{k}")) for k in "ab")
    return x.join(y.hint("merge"), "entity").where("name_a < name_b").select("name_a", "name_b")
