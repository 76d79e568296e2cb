import pytest

from peerloom.llm import names

GROUPS = [
    ["Theodora Fiferust", "THEODORA FIFERUST", "T. Fiferust", "Fiferust T", "Fiferust, Theodora", "Fiferust Theodora", "Theodora Fifrust", "Dora Fiferust", "Dr. Theodora Fiferust", "Theodora  Fiferust", "Theodora Fiferust, PhD", "Theodora Fiferust (she/her)", "Fifreust, T.", "Theodora Fiferust *", "Theodora (Dora) Fiferust"],
    ["Robert Fiferust", "Bob Fiferust", "R. Fiferust"],
    ["Xiomara A. Lifomand", "X. A. Lifomand", "Lifomand, X.", "Xiomara Lifomand", "Lifomand XA"],
    ["Hélène Dupezask-Depesust", "Helene Dupezask Depesust", "Dupezask, Hélène", "Hélène Dupezask-D.", "H. Dupezask-Depesust"],
    ["Łukasz Zosagond", "Lukasz Zosagond", "Zosagond, Ł."],
    ["Journal Club of Lekunoia University", "Lekunoia Univ. Journal Club", "JC, Univ. Lekunoia", "Univ of Lekunoia journal club"],
    ["Department of Statistics, Farozaia College", "Farozaia College - Statistics Dept", "Farozaia College, Dept Stat."],
    ["The Farozaia Open Review Collective", "Farozaia Open Rev. Coll."],
    ["Cher"],
]


@pytest.fixture(scope="module")
def linked(spark):
    rows = [(n, 9 - min(k, 8)) for g in GROUPS for k, n in enumerate(g)] + [(None, 3), ("  ", 2), ("Cher", 1), ("x" * 20000, 1), (", .", 1)]
    rows += [(f"Anna {s}", 1) for s in ("Bo", "Ce", "Du")] + [("Ma, Theodora", 1), ("Mi, Theodora", 1)]
    return {r.name: r.entity for r in names.link(spark.createDataFrame(rows, "name string, n long")).collect()}


@pytest.mark.parametrize("i", range(len(GROUPS)))
def test_spellings_of_one_entity_meet(linked, i):
    assert len({linked[n] for n in GROUPS[i]}) == 1, {n: linked[n] for n in GROUPS[i]}


def test_entities_stay_apart(linked):
    assert len({linked[g[0]] for g in GROUPS}) == len(GROUPS)


def test_odd_names(linked):
    assert None not in linked and "  " not in linked and ", ." not in linked
    assert len([n for n in linked if n == "Cher"]) == 1 and "x" * 20000 in linked


def test_slips():
    assert all(names.one_slip("zosagond", x) for x in ("zosagnd", "zosaagond", "zosugond", "zosgaond", "osagond", "zosagon"))
    assert not any(names.one_slip("zosagond", x) for x in ("zosagond", "zosgand", "gozaond", "zosagondxx"))


def test_pairs_and_empty_tables(spark):
    rows = spark.createDataFrame([("Ann Bolo", 2), ("ANN BOLO", 1), ("Ann Bolo", 1), ("Carl Dunn", 1)], "name string, n long")
    assert [tuple(r) for r in names.pairs(names.link(rows)).collect()] == [("ANN BOLO", "Ann Bolo")]
    empty = spark.createDataFrame([], "creators array<string>, name int")
    assert names.pairs(names.link(names.spellings(empty, empty))).count() == 0
    some = spark.createDataFrame([(["Ann Bolo", None, " "], 1), (None, 2), ([], 3)], "creators array<string>, name int")
    assert [tuple(r) for r in names.spellings(some, empty).collect()] == [("Ann Bolo", 1)]


@pytest.mark.parametrize("two", [["Smith-Jones, Ana", "Smithjones, Ana"], ["Lopez Ga, Eva", "Lopez G, Eva"]])
def test_halves_written_together_or_cut_are_linked(spark, two):
    for counts in ((5, 1), (1, 5), (1, 1)):
        rows = spark.createDataFrame(list(zip(two, counts)), "name string, n long")
        assert len({r.entity for r in names.link(rows).collect()}) == 1


def test_chains_and_rings_of_attachments_end(spark):
    up = [("A", "B"), ("B", "C"), ("C", "A"), ("d", "C"), ("e", "d"), ("p", "q"), ("q", "r"), ("r", "s"), ("x", "y"), ("y", "x")]
    formed = spark.createDataFrame([(f"name {f}", f, 1) for f in "ABCdepqrsxyz"], "name string, form string, n long")
    got = {r.name[-1]: r.entity for r in names._follow(formed, spark.createDataFrame(up, "v string, up string")).collect()}
    assert got == dict.fromkeys("ABCde", "A") | dict.fromkeys("pqrs", "s") | dict.fromkeys("xy", "x") | {"z": "z"}
