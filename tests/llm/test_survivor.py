import random

from pyspark.sql import functions as F

from peerloom.llm import survivor

from .helpers import METADATA, day, rows_of

FULL = "Adaptive mapping of soil in films: a scoping review"


def run(spark, rows, providers=(("A", 1), ("B", 2), ("C", 3)), extra=False):
    df = spark.createDataFrame(rows, METADATA)
    if extra:
        df = df.withColumn("trust", F.lit(9)).withColumn("layer", F.lit("x")).withColumn("people", F.lit(1))
    return survivor.survivors(df, spark.createDataFrame(list(providers), "provider string, trust_rank int"))


def row(i, provider, title, authors, year, fields, at, target="10.1/x"):
    return (i, target, provider, title, authors, year, None, fields, day(at) if at is not None else None)


ROWS = [
    row(1, "A", FULL, ["Ann Bo", "Cy Do"], "2020", ["Physics", "Ecology"], 1),
    row(2, "B", FULL[:20], ["Ann Bo", "et al."], "20", ["Physics"], 5, "https://doi.example/10.1/X."),
    row(3, "C", "Untitled", ["A. Bo", "C. Do"], "2021", ["Physics", "Physics", "n/a"], 7, "doi: 10.1/x"),
    row(3, "C", "Untitled", ["A. Bo", "C. Do"], "2021", ["Physics", "Physics", "n/a"], 7, "doi: 10.1/x"),
]


def picked(df):
    return {(r.target_value, r.field_name): r.provider_record_id for r in df.collect()}


def test_each_field_from_the_latest_whole_answer(spark):
    got = picked(run(spark, ROWS))
    assert got == {("10.1/x", "title"): 1, ("10.1/x", "authors"): 1, ("10.1/x", "year"): 3, ("10.1/x", "fields"): 1}
    assert got == picked(run(spark, ROWS, extra=True))


def test_ties_go_to_trust_then_to_the_lower_id(spark):
    same = [row(5, "B", FULL, ["Ann Bo"], "2020", ["X1"], 3), row(6, "A", FULL, ["Ann Bo"], "2020", ["X1"], 3), row(4, "A", FULL, ["Ann Bo"], "2020", ["X1"], 3)]
    assert set(picked(run(spark, same)).values()) == {4}


def test_marks_prefixes_and_lookalikes(spark):
    rows = [row(1, "A", FULL[:25] + "…", [], None, [], 9), row(2, "A", FULL.replace("a", "а"), None, "0000", None, 2), row(3, "B", "Revisiting: " + FULL[:30], ["Unknown"], "n.d.", ["General"], 8)]
    assert picked(run(spark, rows)) == {("10.1/x", "title"): 2}


def test_a_final_dot_is_no_cut(spark):
    rows = [row(1, "A", FULL, None, None, None, 5), row(2, "A", FULL + ".", None, None, None, 4)]
    assert picked(run(spark, rows)) == {("10.1/x", "title"): 1}


def test_single_answers_nulls_and_empty_tables(spark):
    assert picked(run(spark, ROWS[:1])) == {}
    odd = [row(1, None, None, None, None, None, None), row(2, "Z", "", [None], "", [""], None), (None, "10.1/x", "A", FULL, [], "2020", None, [], day(1)), (9, None, "A", FULL, [], "2020", None, [], day(1))]
    assert picked(run(spark, odd)) == {}
    assert rows_of(run(spark, [])) == []
    assert picked(run(spark, ROWS, providers=[])) == picked(run(spark, ROWS))


def test_a_hot_target_brings_few_answers_together(spark):
    rows = [row(i, "ABC"[i % 3], FULL, ["Ann Bo"], "2020", ["X1"], i) for i in range(300)]
    met = survivor.layers(survivor.answers(spark.createDataFrame(rows, METADATA), spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "provider string, trust_rank int")))
    assert [len(r.met) for r in met.collect()] == [3]
    assert {m.layer for r in met.collect() for m in r.met} == {0}  # the later, the less trusted
    assert set(picked(run(spark, rows)).values()) == {299}


def test_merged_record(spark):
    got = survivor.merged(spark.createDataFrame(ROWS, METADATA), spark.createDataFrame([("A", 1)], "provider string, trust_rank int")).collect()
    assert [(r.title, r.year, r.year_from) for r in got] == [(FULL, "2021", 3)]


def met_rows(spark, answers):
    """answers: (id, whole fields as a mask, day, trust); the table that layers reads."""
    rows = [("t", i, trust, day(at), *(bool(mask & 2**k) for k in range(4))) for i, mask, at, trust in answers]
    return spark.createDataFrame(rows, "target_value string, provider_record_id long, trust int, retrieved_at timestamp, " + ", ".join(f"whole_{f} boolean" for f in survivor.FIELDS))


def peeled(answers):
    """Brute force: skyline after skyline is taken off."""
    left, out, layer = {a[0]: a[1:] for a in answers}, {}, 0
    while left:
        over = lambda x, y: x != y and x[0] & y[0] == y[0] and x[1] >= y[1] and x[2] <= y[2]
        sky = [i for i, y in left.items() if not any(over(x, y) for x in left.values())]
        out |= dict.fromkeys(sky, layer)
        for i in sky:
            del left[i]
        layer += 1
    return out


def test_layers_are_those_of_peeling(spark):
    rng = random.Random(4)
    for _ in range(6):
        # One answer for each mask and trust, as the reduction leaves them.
        answers = [(k, m, rng.randrange(6), t) for k, (m, t) in enumerate(rng.sample([(m, t) for m in range(16) for t in range(4)], 25))]
        (met,) = survivor.layers(met_rows(spark, answers)).collect()
        got = {m.id: m.layer for m in met.met}
        assert got == peeled(answers) and max(got.values()) > 1


def test_the_skyline_decides_between_equally_late_and_trusted_answers(spark, monkeypatch):
    rows = [row(4, "A", FULL, None, None, None, 3), row(9, "A", FULL, ["Ann Bo"], "2020", ["X1"], 3)]
    assert set(picked(run(spark, rows)).values()) == {9}
    real = survivor.layers
    monkeypatch.setattr(survivor, "layers", lambda r: real(r).select("target_value", F.array_sort(F.transform("met", lambda m: F.struct(m["older"].alias("older"), m["trust"].alias("trust"), m["id"].alias("id"), m["mask"].alias("mask")))).alias("met")))
    assert picked(run(spark, rows))["10.1/x", "title"] == 4


def test_what_the_skyline_lacks_comes_from_the_next_layer(spark):
    """Layers given by hand: the first has the year alone, the second the title too."""
    met = spark.createDataFrame([("t", [(0, -9, 1, 3, 4, 1), (1, -8, 1, 2, 5, 2), (2, -7, 1, 0, 15, 3)])], "target_value string, met array<struct<layer:int,older:bigint,trust:int,missing:int,mask:int,id:bigint>>")
    assert {r.field_name: r.provider_record_id for r in survivor._picks(met).collect()} == {"title": 2, "authors": 3, "year": 1, "fields": 3}


def test_cut_titles_of_any_length(spark):
    titles = ["a", "ab", "abc", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqr", "abcdefghijklmnop", "abcdefghijklmno", "b", "zz", "zy", "q"]
    got = {r.bare for r in survivor.cut_short(spark.createDataFrame([("t", x) for x in titles] + [("u", "qq")], "target_value string, bare string")).collect()}
    assert got == {x for x in titles if any(y != x and y.startswith(x) for y in titles)}
