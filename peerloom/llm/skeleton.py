"""Problem 5: visually identical text with different characters.

Method: confusables skeleton. Each text is decomposed, every character is replaced by its prototype in a look-alike
table and the result is decomposed again; originals with equal skeletons form one group. Within a group all
originals get one ordinary form, and an original that differs from it is an altered one.

The ordinary form has accented letters as single characters, usual width, plain spaces and hyphens, nothing
invisible and the letters of each word in one script. Case, cut marks, curly quotes, dashes and Greek letters in
terms stay as they are.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import materialise

# Look-alike letters of other scripts and their Latin prototypes (of the public Unicode confusables data,
# UTS 39, those letters that look like one plain Latin letter or digit).
CYRILLIC = dict(zip("аеорсухіјѕһԁԛԝѵүӏАВЕЗІЈКМНОРСТУХЅԌѴҮԚԜ", "aeopcyxijshdqwvylABE3IJKMHOPCTYXSGVYQW", strict=True))
GREEK = dict(zip("οναγιυκρτϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ovayiukptcjABEZHIKMNOPTYXCJ", strict=True))
ARMENIAN = dict(zip("զհյոսցօԼՍՏՕ", "qhjnugoLUSO", strict=True))
CHEROKEE = dict(zip("ᎠᎡᎢᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏔᏙᏚᏞᏟᏢᏦᏴ", "DRTAJEWMHYGZ4WVSLCPKB", strict=True))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
# Letters of the Latin script itself that look like plain ones. The dotless i is a letter of its own.
LATIN = dict(zip("ɑɡɩʋʏᴄᴏᴜᴠᴡᴢꜱ", "agiuycouvwzs", strict=True))
# The first and last code points of scripts.
SCRIPTS = {
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "cyrillic": [(0x400, 0x52F)], "armenian": [(0x531, 0x58A)],
    "cherokee": [(0x13A0, 0x13FF), (0xAB70, 0xABBF)], "lisu": [(0xA4D0, 0xA4FF)], "latin": [(0, 0x24F), (0x1E00, 0x1EFF)],
}

# Code points that are not seen at all.
INVISIBLE = [
    0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F,
    0x202A, 0x202B, 0x202C, 0x202D, 0x202E, 0x2060, 0x2061, 0x2062, 0x2063, 0x2064, 0x2066, 0x2067, 0x2068, 0x2069,
    0x206A, 0x206B, 0x206C, 0x206D, 0x206E, 0x206F, 0xFEFF,
]
# Code points of blanks that look like a space, and of hyphens that look like the plain one.
SPACES = [0x00A0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x202F, 0x205F, 0x3000]
HYPHENS = [0x2010, 0x2011, 0x2043, 0xFE63]

_INVISIBLE = dict.fromkeys(INVISIBLE)
_BLANKS = {**dict.fromkeys(SPACES, " "), **dict.fromkeys(HYPHENS, "-")}
_LATIN_OF = {**CYRILLIC, **GREEK, **ARMENIAN, **CHEROKEE, **LISU}
#: script -> Latin letter -> the script's letter that looks like it; of several the first of the table.
_BACK = {
    script: {latin: letter for letter, latin in reversed(letters.items()) if latin.isalpha()}
    for script, letters in {"cyrillic": CYRILLIC, "greek": GREEK, "armenian": ARMENIAN, "cherokee": CHEROKEE, "lisu": LISU}.items()
}
_TO_LATIN = str.maketrans({**_LATIN_OF, **LATIN})
# A look-alike of the Latin script beside another letter; alone it is a sign of its own.
_LATIN_ALIKE = re.compile(rf"(?<=[^\W\d_])[{''.join(LATIN)}]|[{''.join(LATIN)}](?=[^\W\d_])")
_WORD = re.compile(r"[^\W\d_]+")
# Ligatures and digraphs, letter-like signs and Roman numerals, half- and full-width forms, styled letters.
_COMPOSITE = re.compile("[\ufb00-\ufb06\u0132\u0133\u01c4-\u01cc\u01f1-\u01f3\u2160-\u217f\uff01-\uffee\U0001d400-\U0001d7ff]")
# Greek letters that stand alone as terms; only those that name nothing are taken for Latin look-alikes.
_GREEK_TERMS = set("αβγδεζηθικλμνξπρσςτυφχψωΑΒΓΔΕΖΗΘΙΚΛΜΝΞΠΡΣΤΥΦΧΨΩ")


def skeleton(text: str | None) -> str | None:
    """Decompose, map every character to its prototype, decompose again. Null gives null."""
    if text is None:
        return None
    text = text.translate(_INVISIBLE).translate(_BLANKS)
    text = unicodedata.normalize("NFD", _COMPOSITE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text))
    return unicodedata.normalize("NFD", text.translate(_TO_LATIN))


class _Scripts(dict):
    """letter -> its script, worked out once for each letter."""

    def __missing__(self, ch: str) -> str:
        code = ord(ch)
        script = self[ch] = next((s for s, ranges in SCRIPTS.items() if any(a <= code <= b for a, b in ranges)), "other")
        return script


_script = _Scripts().__getitem__


def _in_script(word: str, script: str) -> str | None:
    """The word with each letter moved to script, or null where a letter has no look-alike there."""
    out = []
    for ch in unicodedata.normalize("NFD", word):
        if unicodedata.combining(ch) or _script(ch) == script:
            out.append(ch)
        else:
            latin = _LATIN_OF.get(ch, ch)
            to = latin if script == "latin" else _BACK.get(script, {}).get(latin)
            if to is None or _script(to) != script:
                return None
            out.append(to)
    return unicodedata.normalize("NFC", "".join(out))


def ordinary_form(text: str | None) -> str | None:
    """The text as it is ordinarily written; equal-looking texts differ after this only where a whole word could be
    in either of two scripts. Null gives null."""
    if text is None:
        return None
    text = text.translate(_INVISIBLE).translate(_BLANKS)
    text = _COMPOSITE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text)
    text = unicodedata.normalize("NFC", text)
    if text.isascii():
        return text
    text = _LATIN_ALIKE.sub(lambda m: LATIN[m[0]], text)
    kinds = [(m, {_script(c) for c in m[0]}) for m in _WORD.finditer(text)]
    pure: dict[str, int] = {}
    for m, scripts in kinds:
        if len(scripts) == 1:
            (s,) = scripts
            pure[s] = pure.get(s, 0) + len(m[0])
        else:  # a mixed word speaks for the script its letters without look-alike belong to
            for c in m[0]:
                if c not in _LATIN_OF and not any(c in back for back in _BACK.values()):
                    pure[_script(c)] = pure.get(_script(c), 0) + 1
    main = max(pure, key=lambda s: (pure[s], s == "latin")) if pure else "latin"
    out, at = [], 0
    for m, scripts in kinds:
        word = m[0]
        new = word
        if len(scripts) > 1:
            order = [main] + [s for s in ("latin", *_BACK) if s != main]
            new = next((w for s in order if (w := _in_script(word, s))), word)
        elif scripts != {main} and main != "other" and scripts <= {"latin", *_BACK}:
            term = scripts == {"greek"} and len(word) == 1 and word in _GREEK_TERMS
            if not term and (w := _in_script(word, main)):
                new = w
        out += [text[at : m.start()], new]
        at = m.end()
    return "".join(out) + text[at:]


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["skeleton"] = [skeleton(t) for t in b["__text"]]
        b["ordinary"] = [ordinary_form(t) for t in b["__text"]]
        yield b


def unify(df: DataFrame, text: str | Column) -> DataFrame:
    """df with skeleton, ordinary (one form for each skeleton) and altered.

    Of the ordinary forms under one skeleton the most frequent is taken, ties going to the lower by code points.
    Null text has null skeleton, ordinary and altered; an empty text is its own form. Rows are kept as they are,
    repeated ones too. Columns named skeleton, ordinary or altered in df are replaced.
    """
    text = F.col(text) if isinstance(text, str) else text
    df = df.drop("skeleton", "ordinary", "altered").withColumn("__text", text.cast("string"))
    seen = df.groupBy("__text").agg(F.count("*").alias("__n")).where(F.col("__text").isNotNull())
    made = materialise(seen.mapInPandas(_forms, "__text string, __n long, skeleton string, ordinary string"), "forms")  # read twice
    votes = made.groupBy("skeleton", "ordinary").agg(F.sum("__n").alias("__v"))
    best = votes.groupBy("skeleton").agg(F.min_by("ordinary", F.struct(-F.col("__v"), "ordinary")).alias("ordinary"))
    named = made.select("__text", "skeleton").join(best, "skeleton")
    return df.join(named, "__text", "left").withColumn("altered", F.col("__text") != F.col("ordinary")).drop("__text")


def titles(reviews: DataFrame, metadata: DataFrame) -> DataFrame:
    """record_kind, record_key, title, skeleton, ordinary, altered: once for each key that has a title."""
    rows = reviews.select(F.lit("review").alias("record_kind"), F.col("review_id").alias("record_key"), F.col("title_hint").alias("title")).unionByName(
        metadata.select(F.lit("provider").alias("record_kind"), F.col("provider_record_id").cast("string").alias("record_key"), "title")
    )
    return unify(rows.where("record_key is not null and title is not null").distinct(), "title")
