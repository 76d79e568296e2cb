import hashlib

import pytest
from pyspark.sql import functions as F

from peerloom.functions import columns as C
from peerloom.functions import texts as X


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in inputs.items())
    return spark.createDataFrame([tuple(v for _, v in inputs.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("raw, want", [
    ("https://doi.org/10.1234/AB.C_1", "10.1234/ab.c_1"), ("doi: 10.1234/x).", "10.1234/x"), ("http://dx.doi.org/10.1234/x", "10.1234/x"),
    ("10.12/x", ""), ("text 10.1234/x", ""), (None, ""), ("", ""),
])
def test_doi(spark, raw, want):
    assert value(spark, C.doi(F.col("x")), x=("string", raw)) == want


@pytest.mark.parametrize("raw, want", [("10.1/a.v2", ("doi:10.1/a", 2)), ("10.1/a_V12", ("doi:10.1/a", 12)), ("10.1/a/v3", ("doi:10.1/a", 3)), ("10.1/a-version4", ("doi:10.1/a", 4)), ("10.1/av2", ("doi:10.1/av2", None))])
def test_family_and_version(spark, raw, want):
    assert tuple(value(spark, F.struct(C.family(F.col("x")), C.version(F.col("x"))), x=("string", raw))) == want


@pytest.mark.parametrize("raw, want", [("arXiv:2420.00171v1", ("2420.00171", 1)), ("2420.00164", ("2420.00164", None)), ("math.GT/0309136v2", ("math.gt/0309136", 2)), ("no", ("", None))])
def test_arxiv(spark, raw, want):
    assert tuple(value(spark, F.struct(C.arxiv_id(F.col("x")), C.arxiv_version(F.col("x"))), x=("string", raw))) == want


def test_orcids(spark):
    values = ["https://orcid.example/9900-0000-1000-787x", None, "", "9900-0000-1000-787X", "1-2"]
    assert value(spark, C.orcids(F.col("x")), x=("array<string>", values)) == ["9900-0000-1000-787X"]
    assert value(spark, C.orcids(F.col("x")), x=("array<string>", None)) == []


def test_small_functions(spark):
    assert value(spark, C.body_hash(F.col("x")), x=("string", " A\n\t b ")) == hashlib.sha256(b"a b").hexdigest()
    assert value(spark, C.iso_date(F.col("x")), x=("string", "2024-99-99")) is True
    assert value(spark, C.iso_date(F.col("x")), x=("string", None)) is False
    assert value(spark, C.leading_year(F.col("x")), x=("string", "2021-03")) == "2021"
    assert value(spark, C.has_markup(F.col("x")), x=("string", "a < b and c > d")) is False
    assert value(spark, C.has_markup(F.col("x")), x=("string", "x<P class='q'>y")) is True
    assert value(spark, C.name_keys(F.col("x")), x=("array<string>", ["Bo, Ann", None, "ann bo", "!"])) == ["ann bo"]
    assert value(spark, C.first_seen(F.col("x")), x=("array<string>", ["b", " ", "a", None, "b "])) == ["b", "a"]
    assert value(spark, C.word_jaccard(F.col("x"), F.col("y")), x=("string", "A b c"), y=("string", "b, C d")) == 0.5
    assert value(spark, C.word_jaccard(F.col("x"), F.col("y")), x=("string", None), y=("string", "b")) == 1.0
    table = [("bioq", "B"), ("q", "Q")]
    assert [value(spark, C.first_match(F.col("x"), table), x=("string", v)) for v in ("a bioq", "q", "z")] == ["B", "Q", ""]
    assert value(spark, C.first_match(F.col("x"), table, "startswith"), x=("string", "a q")) == ""
    assert value(spark, C.seeded("s", F.col("x")), x=("string", "k")) == hashlib.sha256(b"s\0k").hexdigest()


def test_plain_text():
    assert X.plain_text("&amp;lt;p&amp;gt;One&amp;lt;/p&amp;gt;\n\n\n two  x") == "One\n\ntwo x"
    assert X.plain_text('<p>a</p><script>var t="</p>"</script><p>b</p>') == "a\nb"
    assert X.plain_text("see <https://x.example/a b> now") == "see https://x.example/ab now"
    assert X.plain_text(None) == "" and X.plain_text("a &lt; b") != ""


def test_titles_and_comments():
    assert X.clean_title("Vitamin B 12 , a <i>cis</i> -acting ( new ) / old - study") == "Vitamin B12, a cis-acting (new) old-study"
    assert X.clean_comment("one\ntwo\n\n.\n\nThis record is kept\n\nthree", ("this record",)) == "one two\n\nthree"
    assert X.comment_hash_text("Ａ  b\n\nC") == "a b c"


def test_unwrap():
    assert X.unwrap("The re-\nsults are fine.\nNext line\n\nEnd") == "The results are fine. Next line\n\nEnd"
    assert X.unwrap("under\nstand it", frozenset({"understand"})) == "understand it"
    assert X.unwrap(None) == ""


def test_own_answers():
    review = "The authors should report the baseline model and add a larger sample before making claims about sleep."
    answer = "We agree with this remark and have added a second cohort of two hundred people to the study."
    got = X.own_answers(f"Responses of the authors: {review} {answer}", review)
    assert got == f"Responses of the authors\n\nAuthor response 1: {answer}"
    assert X.own_answers("short", review) == "short" and X.own_answers(None, None) == ""


def test_similarity_and_keys():
    assert X.title_similarity("Soil fungi", "Soil fungi!") == 1.0 and X.title_similarity("", "x") == 1.0
    assert X.title_similarity("abc def", "xyz qrs") < 0.5
    assert X.person_key("Müller, Jörg") == X.person_key("jorg MULLER") == "jorg muller"


def test_mapped_runs_once_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id int, x string")
    got = X.mapped(df, lambda x: f"<{x}>", ["x"], "y").where("y is not null").collect()
    assert {r.id: r.y for r in got} == {1: "<None>", 2: "<a>"}
    assert "EvalPython" not in X.mapped(df, len, ["x"], "y")._jdf.queryExecution().toString()
