import pytest

from peerloom.llm import residue

from .helpers import comments, reviews, rows_of

CASES = [
    ("The paper by {{paper_title}} asks a timely question.", "slot"),
    ("If the model overfits, <<summary>> the control arm cannot hold.", "slot"),
    ("Dear ${name}, thank you for TBD.", "slot"),
    ("Score: __review.body__", "slot"),
    ("the estimate is XXXX rather than 2.1", "slot"),
    ("[INSERT date here]", "slot"),
    ("[à compléter]", "slot"),
    ("{comment_text}", "slot"),
    ("%REVIEW_BODY%", "slot"),
    ("@@date@@", "slot"),
    ("<p>&lt;&lt;doi&gt;&gt;</p>", "slot"),
    ("Duis cupidatat aute nulla nisi do duis nulla est.", "filler"),
    ("asdf asdf", "filler"),
    ("We saw that lorem\u00a0ipsum\u00a0dolor\u00a0sit there.", "filler"),
    ("lorem\u2009ipsum\u202fdolor\u3000sit", "filler"),
    ("The page\u00a0you are looking for does not exist", "failure"),
    ("The page\tyou are looking for does not exist", "failure"),
    ("Ocorreu um erro\u00a0inesperado", "failure"),
    ("Scripts are switched\u00a0off", "script"),
    ("Type your review here", "filler"),
    ("null", "filler"),
    ("503 Service Unavailable", "failure"),
    ('{"status": 403, "message": "upstream request failed"}', "failure"),
    ("Página no encontrada\nError 429", "failure"),
    ("We are checking your connection before you proceed. Ray 9f", "failure"),
    ("Please enable JavaScript to view this page.", "script"),
    ("Scripts are blocked; the editor could not be loaded.", "script"),
    ("Veuillez activer JavaScript pour afficher les commentaires.", "script"),
]
ORDINARY = [
    "The prompt in Appendix 8 contains the slot {{name}} on purpose, and its effect should be tested.",
    'In one condition a message read "Please enable scripts", as shown in Fig. 9.',
    'The word "undefined" appears in the codebook.',
    "The link to the repository returns a 404 page, so please repair it.",
    "The online survey needed JavaScript to be switched on, which may have excluded some.",
    "I left a TODO list in the annotated file.",
    "As control text the authors used lorem ipsum strings of 628 characters.",
    r"The equation \frac{5}{101} and the set {a, b, 9} are standard [4].",
    'The authors quote "we we [sic] measured it" from the older draft. My main concern is the error model: no.',
    "[Edited] fine now",
    "+1",
    "Nice work!",
    "",
    "   \n ",
]


@pytest.fixture(scope="module")
def kinds(spark):
    rows = [(f"r{i}", t, None, []) for i, (t, _) in enumerate(CASES)] + [(f"o{i}", t, None, []) for i, t in enumerate(ORDINARY)]
    rows += [("n", None, None, []), (None, "null", None, []), ("r0", CASES[0][0], None, [])]
    rows += [("long", "A fine sentence about methods. " * 20000 + "\n\nJavaScript is disabled.", None, [])]
    found = residue.residue(residue.records(reviews(spark, rows), comments(spark, [("r0", "Nice work!"), ("c1", "null")])))
    return {(r.record_kind, r.record_key): r.kinds for r in found.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_residue_is_found(kinds, i):
    assert CASES[i][1] in kinds.get(("review", f"r{i}"), []), CASES[i]


@pytest.mark.parametrize("i", range(len(ORDINARY)))
def test_talk_about_residue_is_kept(kinds, i):
    assert ("review", f"o{i}") not in kinds, ORDINARY[i]


def test_keys_and_long_texts(kinds):
    assert ("review", "n") not in kinds and ("review", None) not in kinds
    assert ("discussion", "c1") in kinds and ("discussion", "r0") not in kinds
    assert kinds[("review", "long")] == ["script"]


def test_recurrent_lines_are_boilerplate_unless_they_are_residue(spark):
    rows = [(f"a{i}", f"Is the aim clear?\nYes, see note {i}.", None, []) for i in range(60)]
    rows += [(f"b{i}", "Is the aim clear?\nJavaScript is disabled.", None, []) for i in range(40)]
    found = {r.record_key: (r.kinds, r.left_lines) for r in residue.residue(residue.records(reviews(spark, rows), comments(spark, []))).collect()}
    assert set(found) == {f"b{i}" for i in range(40)}
    assert found["b0"] == (["script"], 0)


def test_empty_tables(spark):
    assert rows_of(residue.found(reviews(spark, []), comments(spark, []))) == []


def keys(spark, rows):
    return {r.record_key for r in residue.residue(residue.records(reviews(spark, rows), comments(spark, []))).collect()}


UNLISTED = "The server could not load this document, please retry."


def test_the_counts_by_host_tell_notices_of_unlisted_wording(spark, monkeypatch):
    rows = [(f"n{i}", f"{UNLISTED}", None, []) for i in range(25)] + [("once", "The browser was unable to show the second figure.", None, [])]
    rows += [(f"a{i}", f"Could you share the code?\nThe aim is clear, see note {i}.", None, []) for i in range(600)]
    assert keys(spark, rows) == {f"n{i}" for i in range(25)}
    monkeypatch.setattr(residue, "RECURRENT_LEAST", 10**9)
    assert keys(spark, rows) == set()


def test_lines_of_the_form_are_subtracted_beside_real_text(spark, monkeypatch):
    """A caption of the form that reads like a slot stands in every third record; where nothing else is left it counts."""
    rows = [(f"a{i}", f"[Add a comment]\nThe aim is clear, see note {i}.", None, []) for i in range(40)] + [(f"b{i}", f"The design is sound ({i}).", None, []) for i in range(80)]
    rows += [("empty", "[Add a comment]", None, []), ("both", "[Add a comment]\nDear ${name}, thank you.", None, [])]
    assert keys(spark, rows) == {"empty", "both"}
    monkeypatch.setattr(residue, "RECURRENT_LEAST", 10**9)
    assert len(keys(spark, rows)) == 42


def test_long_lines_of_filler_and_long_slots(spark):
    rows = [("test", "test " * 40, None, []), ("page", "  *** 503   Service Unavailable " + "!" * 200, None, []), ("slot", "Dear {{" + "n" * 300 + "}}, thank you.", None, [])]
    rows += [("said", 'They print "' + "so it goes on and on, " * 20 + 'please enable JavaScript" in Fig. 2.', None, [])]
    assert keys(spark, rows) == {"test", "page", "slot"}
