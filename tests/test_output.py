"""The output, its constraints, its stages, and orders that hot groups must not slow down."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from peerloom.functions import columns as C
from peerloom.functions import texts as X
from peerloom.operators import dedup, merge, papers, rounds, sampling, threads, validate
from peerloom.plans import pipeline, stages

EVENT = "family_key string, value string, kind string, event_id string, review_id string, position int"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_shape_of_a_table(spark):
    df = spark.createDataFrame([(1, "x")], "b int, a string")
    assert rows_of(validate.shape(df, ["b", "a"], 1)) == []
    assert {r.constraint for r in validate.shape(df, ["a", "b"], 2).collect()} == {"column_order", "row_count"}
    assert {(r.constraint, r.record_key) for r in validate.shape(df, ["b", "c"]).collect()} == {("column_missing", "c"), ("column_unexpected", "a")}


def test_papers_and_what_is_wrong_with_them(spark):
    versions = spark.createDataFrame([("f1", "10.1/a.v1", 1), ("f1", "10.1/a.v2", 2), ("f2", "10.1/b", None), ("f3", "10.1/a.v3", 3)], "family_key string, value string, version int")
    merged = spark.createDataFrame([("10.1/a.v2", "On <i>soil</i>", "p", ["Ann", " "], "p", "2020", "p"), ("10.1/b", "Fine", "p", ["Bo"], "q", "1066", "q")], "target_value string, title string, title_from string, authors array<string>, authors_from string, year string, year_from string")
    targets = spark.createDataFrame([("10.1/a.v2", "10.1234/a.v2"), ("10.1/b", None), ("10.1/a.v3", "10.1234/a.v3")], "target_value string, doi string")
    made = papers.papers(versions, merged, targets)
    assert made.columns == papers.COLUMNS and {(r.family_key, r.target_value, r.rounds) for r in made.collect()} == {("f1", "10.1/a.v2", 2), ("f2", "10.1/b", 1), ("f3", "10.1/a.v3", 1)}
    issues = {(r.record_key, r.constraint) for r in validate.breaches(made, "family_key", validate.paper_constraints(1900, 2030)).collect()}
    assert issues == {("f1", "title_markup"), ("f1", "author_blank"), ("f2", "doi_shape"), ("f2", "year_range"), ("f3", "title_missing"), ("f3", "year_shape"), ("f3", "authors_missing")}
    assert rows_of(validate.repeated_families(made)) == [("family_repeated", "doi:10.1234/a", "2")]


def test_rounds_and_their_timelines(spark):
    good = [("f", "v", "review", "r1", "r1", 1), ("f", "v", "response", "a1", "r1", 2)]
    assert rows_of(validate.round_shape(spark.createDataFrame(good, EVENT))) == []
    bad = good + [("f", "w", "discussion", "d1", "r1", 1), ("f", "v", "response", "a1", "r1", 5), ("f", "v", "discussion", "d2", "r9", 4)]
    assert {(r.constraint, r.record_key, r.detail) for r in validate.round_shape(spark.createDataFrame(bad, EVENT)).collect()} == {
        ("round_without_review", "f w", ""), ("event_twice", "f v", "a1"), ("reply_outside_round", "f w", "d1"), ("reply_outside_round", "f v", "d2"), ("timeline_positions", "f v", "5"),
    }
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "event_id string")
    assert rows_of(validate.coverage(ids("a", "b"), ids("b", "c"), "event_id", "timeline")) == [("timeline_missing", "a", ""), ("timeline_unexpected", "c", "")]


def test_audit_by_position(spark):
    audit = spark.createDataFrame([(1, "10.1234/a", "doi:10.1234/a", {"title": "p"}), (2, "10.1234/b", "doi:10.1234/x", {"title": None}), (3, "", "any", {"title": "p"}), (4, "10.1234/d", "doi:10.1234/d", {})], "position int, doi string, family_key string, provenance map<string,string>")
    rows = spark.createDataFrame([(1, "10.1234/a"), (2, "10.1234/c"), (3, ""), (5, "10.1234/e")], "position int, doi string")
    got = {(r.record_key, r.constraint) for r in validate.audit_against_rows(audit, rows).collect()}
    assert got == {(2, "doi_differs"), (2, "family_differs"), (2, "field_without_source"), (4, "row_missing"), (5, "audit_missing")}
    assert rows_of(validate.audit_against_rows(audit.limit(0), rows.limit(0))) == []


def test_whole_details(spark):
    df = spark.createDataFrame([("k", "x" * 500)], "k string, t string")
    assert len(validate.breaches(df, "k", [("c", F.lit(True), F.col("t"))]).first().detail) == 500


@pytest.mark.parametrize("seed", [1, 2])
def test_positions_are_those_of_one_window(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["g", "h", None]), rng.choice(["", "2024-01-01", "2024-01-02", None]), rng.random() < 0.5, f"id{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, day string, reply boolean, id string")
    got = {(r.id, r.p) for r in rounds.positions(df, ["g"], ["day", "reply", "id"], "p").collect()}
    want = set()
    for g in ("g", "h", None):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or "", r[2], r[3]))
        want |= {(r[3], k) for k, r in enumerate(mine, 1)}
    assert got == want
    assert rounds.positions(df.limit(0), ["g"], ["day", "id"], "p").count() == 0


def test_numbers_of_a_global_order(spark):
    df = spark.createDataFrame([(f"k{i:03}",) for i in random.Random(3).sample(range(300), 300)], "k string")
    assert [(r.k, r.n) for r in sampling.numbered(df, ["k"], "n").orderBy("n").collect()] == [(f"k{i:03}", i + 1) for i in range(300)]


def test_a_hot_round_is_nested_in_parts(spark, monkeypatch):
    monkeypatch.setattr(threads, "PART_EVENTS", 10)
    review = "review_id string, target struct<family_key string, value string, version int>, comment string, review_date string, creators array<string>, creator_orcids array<string>, harvested_at timestamp"
    reply = "{0}_id string, target_review_id string, family_key string, content string, {0}_date string, creators array<string>, creator_orcids array<string>, harvested_at timestamp"
    reviews = spark.createDataFrame([(f"r{i:02}", ("f", "v", 1), f"text {i}", f"2024-01-{i % 28 + 1:02}", ["A"], [], None) for i in range(35)], review)
    responses = spark.createDataFrame([("a1", "r00", "f", "thanks", "2024-02-01", ["B"], [], None)], reply.format("response"))
    comments = spark.createDataFrame([], reply.format("comment"))
    parts = sorted(threads.threads(reviews, responses, comments).collect(), key=lambda r: r.part)
    assert [(r.part, len(r.timeline), len(r.comments), len(r.responses)) for r in parts] == [(1, 10, 10, 0), (2, 10, 10, 0), (3, 10, 10, 0), (4, 6, 5, 1)]
    line = [e.event_id for r in parts for e in r.timeline]
    assert len(set(line)) == 36 and line[-1] == "a1"
    assert threads.threads(reviews.limit(0), responses, comments).count() == 0


def test_the_second_provider_may_be_asked_first(spark):
    schema = "target_value string, provider_record_id long, provider string, title string, authors array<string>, author_orcids array<string>, year string, venue_candidates array<string>, fields array<string>"
    rows = [(t, i, p, f"by {p}", ["A"], None, "2020", ["Quarry"], None) for t in ("10.1/x", "10.2/x") for i, p in ((1, "C"), (2, "D"))]
    providers = spark.createDataFrame([("C", 1), ("D", 2)], "provider string, trust_rank int")
    answers = merge.ranked_answers(spark.createDataFrame(rows, schema), providers, (["10.2/"], "C", "D"))
    used = merge.contributing(answers, merge.has_venue([], ["quarry"]))
    assert {r.target_value: r.title for r in merge.merge_answers(used).collect()} == {"10.1/x": "by C", "10.2/x": "by D"}
    # Without a venue the later answer still counts; with one told by the identifier it doesn't.
    assert merge.contributing(answers, merge.has_venue([], ["other"])).count() == 4
    assert merge.contributing(answers, merge.has_venue([("10.1/", "Q")], ["other"])).count() == 3
    none = spark.createDataFrame([("t", 1, "C", None, [], None, "x", None, None)], schema)
    assert [r.found for r in merge.found(merge.merge_answers(merge.ranked_answers(none, providers))).collect()] == [False]


def test_identifiers(spark):
    one = lambda c: spark.range(1).select(c.alias("c")).first().c
    assert one(C.encoded(F.lit("10.1/a b(c)*~"))) == "10.1%2Fa%20b%28c%29%2A~"
    assert one(C.doi(F.lit("10.1234/a&#x2F;b"))) == "10.1234/a/b"
    assert one(C.output_family(F.lit("https://doi.org/10.1234/A.v2"))) == "doi:10.1234/a" and one(C.output_family(F.lit("x"))) == ""
    assert one(C.arxiv_id(F.lit("https://arxiv.org/abs/2401.00001v3"))) == "2401.00001" and one(C.arxiv_version(F.lit("https://arxiv.org/abs/2401.00001v3"))) == 3
    assert one(C.arxiv_id(F.lit("report 2401.00001"))) == ""


def test_quotations_are_found_wherever_they_stand():
    a, b = (" ".join(f"{w}{i}" for i in range(15)) for w in ("alpha", "beta"))
    mine = "We thank the reviewer and have rewritten this part so that it says what was done in the field."
    assert X.own_answers(f"{b.upper()}. {mine} {a}", f"{a} {b}") == f"Author response 1: {mine}"
    assert X.own_answers(f"We are the authors of this work and here is what we say to all of it. {a} {mine}", a).startswith("We are the authors of this work")
    long = "word " * 60000 + a
    assert X.own_answers(f"{long} {mine}", long).endswith(mine)


def test_stages_are_read_where_nothing_changed(spark, tmp_path):
    where, built = stages.places(str(tmp_path)), []

    def collect():
        built.append("reviews")
        return spark.createDataFrame([("r1",), ("r2",)], "review_id string")

    def enrich(reviews):
        built.append("metadata")
        if len(built) == 2:
            raise RuntimeError("broken off")
        return reviews.withColumn("found", F.lit(True))

    run = lambda s=stages.Settings(): [
        stages.run_stage(spark, where["reviews"], "reviews", s, {}, collect),
        stages.run_stage(spark, where["metadata"], "metadata", s, {"reviews": where["reviews"]}, enrich),
    ]
    with pytest.raises(RuntimeError):
        run()
    assert run()[1].count() == 2 and built == ["reviews", "metadata", "metadata"]
    run()
    assert len(built) == 3
    run(stages.Settings(seed="other"))
    assert built[3:] == ["reviews", "metadata"]
    assert stages.write_report(spark, where["report"], spark.createDataFrame([("c", "k", "")], "constraint string, record_key string, detail string")) is False
    assert json.loads((tmp_path / "report.json").read_text())["issues"] == {"c": 1}


def test_a_partial_stage_is_refused_unless_the_settings_allow_it(spark, tmp_path):
    where = stages.places(str(tmp_path))
    stages.run_stage(spark, where["reviews"], "reviews", stages.Settings(), {}, lambda: spark.range(2), complete=False)
    build = lambda reviews: reviews
    with pytest.raises(ValueError):
        stages.run_stage(spark, where["metadata"], "metadata", stages.Settings(), {"reviews": where["reviews"]}, build)
    assert stages.run_stage(spark, where["metadata"], "metadata", stages.Settings(allow_partial=True), {"reviews": where["reviews"]}, build).count() == 2


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no tables here")
def test_the_whole_run(spark, tmp_path):
    tables, out = "/root/testdata/sf0.001", str(tmp_path / "out")
    clean = pipeline.run(spark, tables, out)
    report = json.loads((tmp_path / "out/report.json").read_text())
    assert report["passed"] is clean is (report["issues"] == {})
    written = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert written == ["01_reviews", "02_metadata", "03_papers", "04_issues"]
    before = (tmp_path / "out/03_papers/manifest.json").read_text()
    assert pipeline.main([tables, out]) == int(not clean) and (tmp_path / "out/03_papers/manifest.json").read_text() == before


def test_shapes_of_rounds(spark):
    one = "array<struct<event_date:string,event_id:string>>"
    rows = spark.createDataFrame([("f", "v", 1, 2, 1, [("2024-01-01", "r1")], [], [], [("2024-01-01", "r1")])], f"family_key string, value string, version int, round int, part int, comments {one}, responses {one}, discussions {one}, timeline {one}")
    strict, extended = (json.loads(threads.shaped(rows, e).first().round_json) for e in (False, True))
    assert set(strict) == {"Round", "Comments", "Response", "Discussion", "Timeline"} and set(extended) - set(strict) == {"Target_DOI", "Part"}
    assert strict["Round"] == 2 and strict["Comments"][0]["event_id"] == "r1"


def test_survivors_are_those_that_are_marked(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["f", None]), f"id{i}", str(rng.randrange(3)), rng.choice(["A b", "a  B", "c", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "fam string, id string, day string, text string")
    marked = dedup.mark_duplicates(df, ["fam"], "id", ["day"], "text").where("id = kept").select("fam", "body_hash", "id", "copies")
    assert {tuple(r) for r in dedup.survivors(df, ["fam"], "id", ["day"], "text").select("fam", "body_hash", "id", "copies").collect()} == {tuple(r) for r in marked.collect()}
