import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peerloom.llm import sentences

from .helpers import documents, rows_of

CASES = [
    ("en", ["Compared with Nivvort et al. (2023), the estimate is 7.4 rather than 2.4.", "bunoxin8 data cover soil, e.g. by site.", "Why?", "Dr. Lazzuv (cf. Suppl. Note 2.8) saw 0.68 vs. 4.4."]),
    ("en", ['"Is it really stable?" asks the second reader, and so do I.', "As Segmen argued, it cannot be."]),
    ("en", ['The authors write, "We saw no drift. None at all." and leave it there.', "This was first shown by Rekkon et al.", "The list includes filters, tubes, etc.", "The file at https://data.example/D-3.csv holds 2 rows."]),
    ("en", ["J. K. Rebsis and L. Pudfes ran it at 9 a.m. on Tuesdays.", "The value rose from 6.4 to 6.9 ... and then nothing else is said.", "(See the remark under Table 2.)", "Version 8.7.1 was used."]),
    ("de", ["Am 1. Mai 2006 begann die Messung, d. h. vor der Freigabe.", "Im 2. Versuch fehlten ca. 309 Proben.", "Nach Ripzurt u. a. (2019) gilt das nicht.", "Dr. Vas schreibt: „Es bleibt stabil. Immer.“ und belegt das nicht.", "Das ist überzeugend, usw.", "Für NIF ist es knapp, vgl. Abb. 2 und S. 37."]),
    ("fr", ["« LOK est-il stable ? », demande le texte.", "M. Navpus obtient 8,7, env. 477 fois.", "Quel résultat !"]),
    ("es", ["¡Qué resultado tan claro!", "El Dr. Sildus obtuvo 5,76, aprox. 585 veces.", "«¿Es estable?», pregunta el texto."]),
    ("ru", ["В разд. 1.7 указано 3,5, т. е. больше, чем в табл. 2.", "По данным А. П. Kultal и др., тема не связана.", "Авторы пишут: «Сдвига нет. Совсем нет» и не дают чисел.", "Почему они были исключены в 2006 г. без объяснений?"]),
    ("hi", ["यह परिणाम चौंकाने वाला है!", "डॉ. Livgel के अनुसार संबंध नहीं है।", 'लेखक कहते हैं, "बदलाव नहीं है। बिल्कुल नहीं।" पर प्रमाण नहीं देते।']),
    ("ar", ["هل ZIK ثابتة حقا؟", "يرى د. Summal أن حرارة المدن لا تفسر.", "كتب المؤلفون: «لا تغير. أبدا.» ولم يقدموا دليلا."]),
    ("th", ["ควรเพิ่มตัวอย่างอีก 330 ตัวอย่างจึงจะสรุปได้", "งานวิจัยของ Rakmis et al. ไม่ได้กล่าวถึงการประเมินแบบเปิดเลย", "เราเห็นว่ากลุ่มควบคุมเข้าใจยาก"]),
]
JOINED = [
    ("zh", ["这个结果实在令人惊讶！", "“它真的稳定吗？”这个问题一直没有回答。", "作者写道：“没有变化。完全没有。”但没有给出数据。", "建议补充9个样本……", "Kefpin et al.（1999）认为如此。"]),
    ("ja", ["「本当に安定か？」という疑問が残ります。", "これは驚くべき結果です！", "第1.4節では1.30とあります。"]),
]


@pytest.mark.parametrize("language, parts", CASES)
def test_languages(language, parts):
    for blank in (" ", "  ", "\n"):
        text = blank.join(parts)
        assert [text[a:b] for a, b in sentences.boundaries(text, language)] == parts


@pytest.mark.parametrize("language, parts", JOINED)
def test_scripts_without_blanks(language, parts):
    text = "".join(parts)
    assert [text[a:b] for a, b in sentences.boundaries(text, language)] == parts


def test_headings_wraps_and_missing_blanks():
    text = "Summary\nThe authors should revisit\nthe design. Fine.\n\n1. Methods\nThe section is short.Nobody knows.\n\n  \n主要问题\n结果很好。"
    assert [text[a:b] for a, b in sentences.boundaries(text, None)] == ["Summary", "The authors should revisit\nthe design.", "Fine.", "1. Methods", "The section is short.", "Nobody knows.", "主要问题", "结果很好。"]


@given(st.text(alphabet="ab. !?\n\"'()«»。！“”ก1A…", max_size=80), st.sampled_from(["en", "th", "de", None]))
def test_pieces_cover_all_but_white_space(text, language):
    found = sentences.boundaries(text, language)
    at = 0
    for a, b in found:
        assert a >= at and a < b and not text[at:a].strip() and text[a:b] == text[a:b].strip()
        at = b
    assert not text[at:].strip()


def test_table(spark):
    long = "A fine sentence. " * 50000
    rows = [(1, "One. Two.", "en", "s"), (1, "One. Two.", "en", "s"), (2, None, "en", "s"), (3, "  \n ", "en", "s"), (4, "Ein Satz.", None, "s"), (5, long, "xx", "s")]
    df = documents(spark, rows).withColumn("position", F.lit("clash")).withColumn("sentence", F.lit(1))
    got = sentences.sentences(df)
    assert rows_of(got.where("doc_id < 5").select("doc_id", "position", "start_char", "end_char", "sentence")) == [(1, 0, 0, 4, "One."), (1, 1, 5, 9, "Two."), (4, 0, 0, 9, "Ein Satz.")]
    assert got.where("doc_id = 5").count() == 50000
    assert sentences.sentences(documents(spark, [])).count() == 0


@pytest.mark.parametrize("marks", ["“”", "()", "«»", '""', "„“", "[]"])
def test_long_quotations_and_brackets_stay_whole(marks):
    said = ("One thing was said. " * 40).rstrip(". ")
    text = f"The authors wrote {marks[0]}{said}{marks[1]} in the end. Then they left."
    cut = text.index(" Then")
    assert sentences.boundaries(text, "en") == [(0, cut), (cut + 1, len(text))]
    # Marks that are never closed take time in proportion.
    assert sentences._quotations("(«“" * 100_000) == []


@pytest.mark.parametrize(
    ("text", "lang", "pieces"),
    [
        ("This is state of the art. We agree, see Sec. 3 and no. 7 of vol. 2.", "en", 2),
        ("Auf diese Art. Danach folgt Art. 5 und vgl. Abb. 3.", "de", 2),
        ("« Quel résultat ! » Il faut le dire.", "fr", 2),
        ("« Quel résultat ! » dit-elle alors. Bien.", "fr", 2),
        ("Le climat est sec. Les sols aussi, cf. chap. 3.", "fr", 2),
        ("¡Qué bien!¿Y ahora? El art. 5 dice que no. Vale, pág. 3.", "es", 4),
        ("O texto diz que não. A Dra. Souza viu a pág. 7.", "pt", 2),
        ("Это было в 2019 г. Потом, т. е. позже, см. табл. 3.", "ru", 2),
        ("यह ठीक है। डॉ. शर्मा ने पृ. 3 पर लिखा।", "hi", 2),
        ("هذا جيد. يرى د. سالم ذلك؟ نعم.", "ar", 3),
        ("这很好。他说：“对。”然后走了。", "zh", 2),
        ("Nothing here. It is the end of a text with no tag, see Fig. 2.", None, 2),
    ],
)
def test_tables_of_languages(text, lang, pieces):
    assert len(sentences.boundaries(text, lang)) == pieces, [text[s:e] for s, e in sentences.boundaries(text, lang)]


def test_a_text_without_a_known_tag_is_read_by_its_words():
    of = sentences.language_of
    assert [of("The aim of the study is clear and sound", t) for t in (None, "xx", "en-US")] == ["en"] * 3
    assert of("Les sols sont dans une zone pour les oiseaux", None) == "fr" and of("Сезон дождей", "") == "ru" and of("12 + 3", None) == ""


def test_long_runs_of_marks_hide_no_abbreviation_and_no_end():
    text = "It goes on" + "." * 300 + " and on. The end" + "!" * 300 + " Yes."
    assert [text[s:e][:8] for s, e in sentences.boundaries(text, "en")] == ["It goes ", "The end!", "Yes."]
    said = "He said “" + "So it is. " * 22 + "That is all.” and left. We left too."
    assert len(sentences.boundaries(said, "en")) == 2
