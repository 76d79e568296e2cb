import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st

from peerloom.llm import skeleton

from .helpers import METADATA, reviews

ALTERED = {
    "Ѕeasonal recovery of soil": "Seasonal recovery of soil",
    "Ｏｐｅｎ ｓｃｉｅｎｃｅ： ａ ｓｔｕｄｙ": "Open science: a study",
    "Low-​dose trans­fer": "Low-dose transfer",
    "working memory　study": "working memory study",
    "agent‑based model": "agent-based model",
    "a ﬁeld study": "a field study",
    unicodedata.normalize("NFD", "región de Peñalúz"): "región de Peñalúz",
    "Oценка памяти у подростков": "Оценка памяти у подростков",
    "Оценка памяти y подростков": "Оценка памяти у подростков",
    "niños у niñas": "niños y niñas",
    "H επίδραση της ξηρασίας": "Η επίδραση της ξηρασίας",
    "Rapid screening οf soil": "Rapid screening of soil",
    "Open reviewոf sօil": "Open reviewnf soil",
    "ᎪBC of ᏟODE": "ABC of CODE",
    "ꓢoil ꓮnd sand": "Soil And sand",
    "ɡene reɡulɑtion": "gene regulation",
}
OTHER_SCRIPTS = {
    "հայոց լեզու": "հայոց լեզու",
    "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ": "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ",
    "the vowel ɑ": "the vowel ɑ",
    "kırmızı toprak": "kırmızı toprak",
}
ORDINARY = ["γ-band rhythms in Δ9-type enzymes", "dose–response “living” dataset…", "Über die Wirkung großer Städte", "Сезонная динамика осадков и её прогноз", "Μελέτη του ύπνου σε 88 παιδιά", "Revisiting: Оценка памяти", "plain", ""]


@pytest.mark.parametrize("text", ALTERED)
def test_altered(text):
    assert skeleton.ordinary_form(text) == ALTERED[text]
    assert skeleton.skeleton(text) == skeleton.skeleton(ALTERED[text])


@pytest.mark.parametrize("text", ORDINARY)
def test_ordinary(text):
    assert skeleton.ordinary_form(text) == text


@pytest.mark.parametrize("text", OTHER_SCRIPTS)
def test_other_scripts_stay(text):
    assert skeleton.ordinary_form(text) == text


@given(st.text(max_size=40))
def test_forms_are_stable(text):
    once = skeleton.ordinary_form(text)
    assert skeleton.skeleton(skeleton.skeleton(text)) == skeleton.skeleton(text)
    assert skeleton.ordinary_form(once) == once


def test_one_form_for_each_skeleton(spark):
    df = spark.createDataFrame([(1, "a study", "x"), (2, "а study", "x"), (3, "a study", "x"), (4, None, "x"), (5, "", "x"), (5, "", "x")], "id int, t string, skeleton string")
    got = {r.id: (r.ordinary, r.altered) for r in skeleton.unify(df, "t").collect()}
    assert got == {1: ("a study", False), 2: ("a study", True), 3: ("a study", False), 4: (None, None), 5: ("", False)}
    assert skeleton.unify(df, "t").count() == 6


def test_titles(spark):
    r = reviews(spark, [("r1", None, "а study", []), ("r1", None, "а study", []), ("r2", None, None, []), (None, None, "x", []), ("r3", None, "long ​" * 9000, [])])
    m = spark.createDataFrame([(1, "t", "p", "a study", None, None, None, None, None)], METADATA)
    got = {(x.record_kind, x.record_key): x.altered for x in skeleton.titles(r, m).collect()}
    assert got == {("review", "r1"): True, ("review", "r3"): True, ("provider", "1"): True}
    assert skeleton.titles(reviews(spark, []), spark.createDataFrame([], METADATA)).count() == 0
