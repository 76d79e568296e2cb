"""Problem 9: sentence boundaries across languages and scripts.

Method: cascading segmentation rule tables. Each rule is a pair of regular expressions, for what stands before and
after a place in the text, and says break or no break; the rules of the text's language come before the common ones
and the first that matches decides. Places inside quotations and brackets are closed before the rules are asked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .once import once

END = r"[.!?…。！？．｡؟۔।॥]"
CLOSERS = r"[\"'”’»›)\]）】」』〕》]"
_UNCASED = "֐-ࣿऀ-෿฀-๿一-鿿぀-ヿ가-힯"
_LOWER = r"[a-zà-öø-ÿœа-яёα-ωά-ώ]"

# Abbreviations of each language that go on, whatever follows.
GOING_ON = {
    "en": "dr mr ms mrs prof profs st fig figs sec secs approx cf suppl vs eq eqs ref refs vol ed eds dept univ inc esp viz resp e.g i.e",
    "de": "dr prof vgl abb tab ca bzw evtl sog nr hr fr bd ggf inkl z.b d.h",
    "fr": "dr prof mme mlle fig vol chap env cf éd fasc p.ex",
    "es": "sr sra dr dra prof aprox pág págs fig núm art cap ud uds p.ej",
    "pt": "sr sra dr dra prof aprox pág págs fig núm art cap p.ex",
    "ru": "разд табл рис см стр гл проф акад доц им напр т.е т.к т.д т.п ср",
    "hi": "डॉ पृ श्री प्रो सं उदा",
    "ar": "د أ م ص",
}
# Abbreviations that go on before a number only.
BEFORE_NUMBER = {"en": ["no", "nos", "p", "pp"], "de": ["s", "art", "kap"], "fr": ["p", "pp", "art"], "es": ["p", "pp", "art", "cap"], "pt": ["p", "pp", "art", "cap"], "ru": ["№", "с"]}
# Abbreviations that may end a sentence; they do before a capital.
MAY_END = {"en": ["etc", "al", "a.m", "p.m", "jr", "co", "ltd"], "de": ["usw", "u.a", "ff"], "fr": ["etc"], "es": ["etc"], "pt": ["etc"], "ru": ["г", "гг", "др", "пр"]}
# Words of a language that another one has as an abbreviation; before a capital they end.
WORDS = {"en": ["art", "tab", "cap", "no"], "de": ["art", "im", "tab"], "fr": ["sec", "art", "cap", "tab", "vol", "ca", "est"], "es": ["no", "vol", "sec"], "pt": ["no", "ed", "sec"]}


def _words(ws: list[str]) -> str:
    return "|".join(re.escape(w) for w in sorted(ws, key=len, reverse=True))


_UPPER = r"[A-ZÀ-ÖØ-ÞŒА-ЯЁ¿¡«„“]"


def _abbreviations(going_on: list[str], before_number: list[str], may_end: list[str]) -> list[tuple[bool, str, str]]:
    """The rules of a table of abbreviations."""
    rules = [(False, rf"(?i:(?<!\w)(?:{_words(going_on)}))\.", r"\s")] if going_on else []
    rules += [(False, rf"(?i:(?<!\w)(?:{_words(before_number)}))\.", r"\s+\d")] if before_number else []
    if may_end:
        rules.append((False, rf"[{_UNCASED}][^.]*(?i:(?<!\w)(?:{_words(may_end)}))\.", rf"\s+[{_UNCASED}]"))
        rules += [(True, r"(?i:(?<!\w)(?:etc|usw))\.", r"\s+\d")] if {"etc", "usw"} & set(may_end) else []
        rules.append((False, rf"(?i:(?<!\w)(?:{_words(may_end)}))\.", rf"\s+(?:{_LOWER}|[\d(（\[])"))
        rules.append((True, rf"(?i:(?<!\w)(?:{_words(may_end)}))\.", r"\s+\S"))
    return rules


# Rules: (break?, before, after). before is matched up to the place, after from it on, blanks included.
# The marks come first, then the table of the text's language, then those of all languages (a text may hold a second one,
# or have a wrong tag), then what single letters and everything else that ends say.
MARKS = [
    # Marks that go on: decimals, hosts, an ellipsis in mid-sentence, a mark before a comma.
    (False, rf"{END}{CLOSERS}*", r"\s*[,;:，、；：،؛]"),
    (False, r"(?:\.{2,}|(?<!…)…)", rf"\s+{_LOWER}"),
    (False, rf"[!?]{CLOSERS}+", rf"\s+{_LOWER}"),
    (False, rf"\.{CLOSERS}*[\"”»’]{CLOSERS}*", rf"\s+{_LOWER}"),
    (True, r"…{2,}", r"\s*\S"),
    # Scripts whose marks need no blank behind them; a quotation that ends within its sentence goes on.
    (False, r"[。！？｡][”’」』〕》]+", r"\S"),
    (True, r"[。！？｡][）】〕]*", r"\s*\S"),
    (True, r"[。！？｡][”’」』）】〕》]+", r"\s"),
    (True, r"[।॥؟۔]", r"\s*\S"),
    (False, rf"{END}{CLOSERS}*[\"”»]{CLOSERS}*", r"\s+[؀-ۿऀ-ॿ]"),
    (True, rf"[।॥؟۔]{CLOSERS}+", r"\s"),
]
REST = [
    (True, r"\b(?:do|did|am|than|as|so|would|could|should|can|will) I\.", r"\s"),
    (False, r"(?<![\w.])[^\W\d_]\.", r"\s+[^\W\d_(]"),
    (False, r"(?<![\w.])[^\W\d_]\.", r"\s+\d"),
    (False, r"(?<![\w.])[^\W\d_]\.\s?[^\W\d_]\.", r"\s+\("),
    (False, r"(?<!\w)(?:[^\W\d_]\.){2,}", rf"\s+{_LOWER}"),
    # Everything else that ends.
    (True, rf"{END}{CLOSERS}*", r"\s"),
    (True, rf"[.!?…]{CLOSERS}*", r"[一-鿿぀-ヿ฀-๿]"),
    # A blank that was left out.
    (True, rf"(?:[^\W\d_]{{2}}|\d|[)\]”»\"])[.!?]{CLOSERS}*", r"[A-ZÀ-ÖØ-ÞА-ЯЁ][^.]{3}"),
]
# Words before a German ordinal number.
_ORDINAL = r"(?:[Aa]m|[Ii]m|[Dd](?:er|ie|as|em|en)|[Vv]om|[Zz]um|[Zz]ur|[Bb]eim|[Bb]is|[Aa]b|[Ss]eit|[Uu]nd)"
# A run of three or more Latin words that ends in a mark is a sentence of its own, unless it is a cited name.
_LATIN_SENTENCE = r"\s+(?=[\"“(]?[A-Za-z])(?!(?:[^\s฀-๿]+\s+){1,3}et\s+al\.\s+[฀-๿])(?:[^\s฀-๿]+\s+){2,}[^\s฀-๿]*"
BY_LANGUAGE = {
    "de": [(False, rf"{END}“", rf"\s+{_LOWER}"), (True, rf"{END}“", r"\s"), (False, rf"\b{_ORDINAL}\s+\d{{1,2}}\.", r"\s")],
    "th": [(True, r"[฀-๿]", r"\s+[฀-๿]"), (True, r"[฀-๿]", _LATIN_SENTENCE)],
    # Guillemets with a blank inside.
    "fr": [(False, rf"{END}\s?»", rf"\s+{_LOWER}"), (True, rf"{END}\s?»", r"\s")],
    # An opening mark begins a sentence where one has ended, with or without a blank.
    "es": [(True, r"[!?…]", r"\s*[¿¡]")],
}
#: Where a rule may decide at all.
PLACES = {"de": re.compile(rf"{END}+(?:“|{CLOSERS})*"), "fr": re.compile(rf"{END}+(?:\s?»|{CLOSERS})*"), "th": re.compile(rf"{END}+{CLOSERS}*|(?<=[฀-๿])(?=\s)")}
_PLACE = re.compile(rf"{END}+{CLOSERS}*")
_WINDOW = 32

# What opens -> what closes it, and what must not stand between.
_PAIRS = {'"': ('"', ""), "“": ("”", "“"), "„": ("“”", "„"), "«": ("»", ""), "「": ("」", ""), "『": ("』", ""), "(": (")", "("), "（": ("）", "（"), "[": ("]", "[")}
_OPENERS = re.compile("[" + re.escape("".join(_PAIRS)) + "]")
_NEXT = {k: re.compile("[" + re.escape(close + stop) + "]") for k, (close, stop) in _PAIRS.items()}
_BLANK_LINE = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+|\r\n[^\S\n]*\r\n|[ ]")
_LINE = re.compile(r"[^\n]+")
HEADING_CHARS, HEADING_WORDS = 60, 7


def _every(tables: dict) -> list[str]:
    return list(dict.fromkeys(w for ws in tables.values() for w in (ws.split() if isinstance(ws, str) else ws)))


def _of(table: dict, language: str) -> list[str]:
    ws = table.get(language, [])
    return ws.split() if isinstance(ws, str) else ws


def _rules_of(language: str) -> list[tuple[bool, re.Pattern, re.Pattern, bool]]:
    """The cascade of a language."""
    own = [(True, rf"(?i:(?<!\w)(?:{_words(WORDS[language])}))\.", rf"\s+{_UPPER}")] if language in WORDS else []
    own += _abbreviations(*(_of(x, language) for x in (GOING_ON, BEFORE_NUMBER, MAY_END)))
    rules = BY_LANGUAGE.get(language, []) + MARKS + own + _abbreviations(*([w for w in _every(x) if w not in _of(x, language)] for x in (GOING_ON, BEFORE_NUMBER, MAY_END))) + REST
    # Whether what stands before reaches beyond the last blank.
    far = re.compile(r"\\s| |\[\^\.\]")
    return [(b, re.compile(rf"(?:{before})\Z"), re.compile(after), bool(far.search(before))) for b, before, after in rules]


LANGUAGES = ["en", "de", "fr", "es", "pt", "ru", "hi", "ar", "th", "zh", "ja", ""]
_RULES = {language: _rules_of(language) for language in LANGUAGES}
# Scripts that tell a language, and frequent words of languages in the Latin script.
_BY_SCRIPT = {"th": "[฀-๿]", "ja": "[぀-ヿ]", "zh": "[一-鿿]", "hi": "[ऀ-ॿ]", "ar": "[؀-ۿ]", "ru": "[а-яё]"}
_BY_SCRIPT_ = {language: re.compile(letters) for language, letters in _BY_SCRIPT.items()}
_BY_WORDS = {
    language: re.compile(rf"\b(?:{'|'.join(ws.split())})\b")
    for language, ws in {
        "de": "und der die das ist nicht für wurde wurden begann", "en": "the and of is are was were that this with", "fr": "les des est une dans pour sont avec que du",
        "es": "los las el una está para con por del y", "pt": "os uma não são para com por em do da",
    }.items()
}


def language_of(text: str, tag: str | None) -> str:
    """The language whose rules a text takes: by its script where that tells, German by its words, another by its tag,
    and without a known tag the one of whose frequent words it holds most."""
    if _BY_SCRIPT_["th"].search(text):
        return "th"
    if _BY_WORDS["de"].search(text):
        return "de"
    known = (tag or "").lower()[:2]
    if known in _RULES and known:
        return known
    for language, letters in _BY_SCRIPT_.items():
        if letters.search(text):
            return language
    counts = {language: len(ws.findall(text)) for language, ws in _BY_WORDS.items()}
    most = max(counts, key=counts.get)
    return most if counts[most] else ""


def _quotations(paragraph: str) -> list[tuple[int, int]]:
    """(start, end) of the quotations and brackets of a paragraph, however long; in one pass, as the next mark of a kind is kept."""
    out, at, nexts = [], 0, {}
    for m in _OPENERS.finditer(paragraph):
        p, kind = m.start(), m.group()
        if p < at or kind == '"' and not paragraph[p + 1 : p + 2].strip():
            continue
        if nexts.get(kind, -1) <= p:
            found = _NEXT[kind].search(paragraph, p + 1)
            nexts[kind] = found.start() if found else len(paragraph)
        end = nexts[kind]
        if p + 1 < end < len(paragraph) and paragraph[end] in _PAIRS[kind][0]:
            at = end + 1
            out.append((p, at))
    return out


def _headings(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """(start, end) of the lines in a paragraph that are headings: short, first or after a finished line, without a mark."""
    out, fresh = [], True
    lines = [(m.start() + start, m.group()) for m in _LINE.finditer(text[start:end])]
    for k, (at, line) in enumerate(lines):
        bare = line.strip()
        marked = bool(re.search(rf"{END}{CLOSERS}*$|[,;:，；：、،]$", bare))
        prose = re.search(r"://|[,;，；、،]|[.!?]\s", re.sub(r"^(?:\d+\.)+\s*", "", bare))
        if fresh and not marked and not prose and k + 1 < len(lines) and bare and len(bare) <= HEADING_CHARS and len(bare.split()) <= HEADING_WORDS:
            nxt = lines[k + 1][1].strip()
            wide = max(len(x) for _, x in lines)
            # A wrapped line is filled until the next word does not fit; a heading leaves room for it.
            first = nxt.split()[0] if nxt.split() else ""
            if len(bare) + 1 + len(first) < max(40, min(wide, 100)) and not re.match(_LOWER + r"[^\d]*$", first[:1]) or len(bare) <= 24:
                out.append((at, at + len(line)))
                fresh = True
                continue
        fresh = marked
    return out


def boundaries(text: str, tag: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of every sentence of text, as code-point offsets without surrounding white space."""
    language = language_of(text, tag)
    rules, place = _RULES[language], PLACES.get(language, _PLACE)
    spans, at = [], 0
    for gap in [*_BLANK_LINE.finditer(text), None]:
        spans.append((at, gap.start() if gap else len(text)))
        at = gap.end() if gap else at
    out = []
    for start, end in spans:
        paragraph = text[start:end]
        if not paragraph.strip():
            continue
        headings = [(a - start, b - start) for a, b in _headings(text, start, end)]
        cuts = [b for _, b in headings]
        closed = sorted(_quotations(paragraph) + [(a, b + 1) for a, b in headings])
        k, filled = 0, len(paragraph.rstrip())
        for m in place.finditer(paragraph):
            p = m.end()
            while k < len(closed) and closed[k][1] <= m.start():
                k += 1
            # Inside a quotation or bracket no place is open; its closing marks belong to the place behind it.
            if k < len(closed) and closed[k][0] < p < closed[k][1]:
                continue
            if p >= filled:
                continue
            # What stands before is looked for from _WINDOW letters before the mark on, which is more than any word of the rules has.
            low = max(0, m.start() - _WINDOW)
            near = max(low, paragraph.rfind(" ", low, m.start()) + 1)
            for breaks, b, a, far in rules:
                if a.match(paragraph, p) and b.search(paragraph, low if far else near, p):
                    if breaks:
                        cuts.append(p)
                    break
        at = 0
        for c in [*sorted(set(cuts)), len(paragraph)]:
            piece = paragraph[at:c]
            bare = piece.strip()
            if bare:
                s = start + at + piece.index(bare[0])
                out.append((s, s + len(bare)))
            at = c
    return out


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(i, k, s, e, t[s:e]) for i, t, lang in zip(b["doc_id"], b["text"], b["lang"], strict=True) for k, (s, e) in enumerate(boundaries(t, lang))]
        yield pd.DataFrame(rows, columns=["doc_id", "position", "start_char", "end_char", "sentence"])


def sentences(documents: DataFrame) -> DataFrame:
    """doc_id, position (from 0), start_char, end_char, sentence for every sentence of every document, in order.

    Null ids and null and blank texts give no row; a null or unknown lang takes the common rules and those its script tells; a
    document given twice is split once. An empty table gives an empty result; other columns are ignored.
    """
    rows, _ = once(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("doc_id is not null and text is not null"), "doc_id")
    return rows.mapInPandas(_split, "doc_id long, position int, start_char int, end_char int, sentence string")
