import hashlib
import random

import pytest
from pyspark.sql import functions as F

from peerloom.operators import dedup, links, merge, rounds, sampling, threads, validate


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_mark_duplicates(spark):
    rows = [("f", None, "b", "2024-02-01", "Same  text"), ("f", None, "a", "2024-02-01", "same text"), ("f", None, "c", "2023-01-01", "SAME text "), ("g", 1, "d", "", None), ("g", 1, "e", "", "")]
    df = spark.createDataFrame(rows, "fam string, v int, id string, day string, text string")
    got = {(r.id, r.kept, r.copies) for r in dedup.mark_duplicates(df, ["fam", "v"], "id", ["day"], "text").collect()}
    assert got == {("a", "c", 3), ("b", "c", 3), ("c", "c", 3), ("d", "d", 2), ("e", "d", 2)}
    assert dedup.mark_duplicates(df.limit(0), ["fam"], "id", ["day"], "text").count() == 0


def test_links_do_not_depend_on_order(spark):
    reviews = spark.createDataFrame([("r1", "x"), ("r1", "x"), ("r2", "y")], "review_id string, value string")
    inter = [("i1", "r1"), ("i2", "r1"), ("i2", "r2"), ("i3", "zz"), ("i4", "r2"), ("i4", "zz")]
    for rows in (inter, inter[::-1]):
        df = spark.createDataFrame(rows, "id string, link string")
        found = links.resolve_links(df, "id", "link", reviews, "review_id", ["value"])
        assert rows_of(found) == [("i1", "r1", "x"), ("i4", "r2", "y")]
        assert {r.id for r in links.unresolved(df, "id", found).collect()} == {"i2", "i3"}


def test_pending_and_reconcile(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("a", "resolved"), ("b", "missing")], "k string, status string")
    assert rows_of(links.pending(wanted, done, "k")) == [("c",)]
    assert rows_of(links.pending(wanted, done, "k", retry="resolved")) == [("b",), ("c",)]
    assert rows_of(links.reconcile(wanted, done.withColumn("k", F.concat("k", F.when(F.col("k") == "b", "x").otherwise("")))
                                   , "k")) == [("b", "missing"), ("bx", "unexpected"), ("c", "missing")]


def test_rounds_and_latest_version(spark):
    rows = [("f", "t-none", None, "2020-01-01", 1), ("f", "t1", 1, "2024-01-01", 1), ("f", "t2", 2, "2023-01-01", 1)]
    v = spark.createDataFrame(rows, "family_key string, value string, version int, first_date string, reviews int")
    assert {r["value"]: r["round"] for r in rounds.number_rounds(v).collect()} == {"t1": 1, "t2": 2, "t-none": 3}
    assert rows_of(rounds.latest_versions(v)) == [("f", "t2")]
    assert validate.consecutive(rounds.number_rounds(v), "family_key", "round", "c").count() == 0
    gap = spark.createDataFrame([("f", 1), ("f", 3), ("g", 1)], "g string, n int")
    assert rows_of(validate.consecutive(gap, "g", "n", "c")) == [("c", "f", "3")]


def test_representative_ties_go_to_the_first_seen(spark):
    rows = [("g", "x", 3), ("g", "y", 1), ("g", "x", 5), ("g", "y", 4), ("g", " ", 0), ("g", None, 0), ("h", None, 1)]
    df = spark.createDataFrame(rows, "g string, v string, pos int")
    assert rows_of(rounds.representative(df, "g", "v", ["pos"])) == [("g", "y", 2)]


def test_timeline_puts_reviews_first(spark):
    df = spark.createDataFrame([("g", "discussion", "a", "2024-01-01"), ("g", "review", "z", "2024-01-01"), ("g", "response", "b", "2023-01-01")], "g string, kind string, event_id string, event_date string")
    assert [r.event_id for r in rounds.timeline(df, "g").orderBy("position").collect()] == ["b", "z", "a"]
    assert rounds.out_of_order(df, "g", "event_id", "event_date").count() == 1


@pytest.fixture(scope="module")
def placed(spark):
    rng = random.Random(1)
    rows = [(f"k{i}", rng.choice([None, None, "x", "y"]), i % 2) for i in range(3000)]
    df = sampling.ordered(spark.createDataFrame(rows, "key string, reason string, t int"), "key", "seed", F.col("t"))
    order = sorted(rows, key=lambda r: (r[2], hashlib.sha256(f"seed\0{r[0]}".encode()).hexdigest()))
    return df, order


def test_sample_and_rejections(placed):
    df, order = placed
    accepted = [r[0] for r in order if r[1] is None]
    got = [r.key for r in sampling.first_accepted(df, F.col("reason").isNull(), 10).collect()]
    assert got == accepted[:10]
    for limit in (1, 7, 900, 10**6):
        want, seen = {}, 0
        for _, reason, _t in order:
            if seen >= limit:
                break
            if reason is None:
                seen += 1
            else:
                want[reason] = want.get(reason, 0) + 1
        assert dict(rows_of(sampling.turned_down(df, "reason", limit))) == want


def test_fingerprint_depends_on_content_only(placed):
    df, _ = placed
    one = sampling.order_fingerprint(df, "key").first()
    assert one == sampling.order_fingerprint(df.repartition(7), "key").first() and one["keys"] == 3000
    assert one.fingerprint != sampling.order_fingerprint(df.where("key != 'k7'"), "key").first().fingerprint


META = "target_value string, provider_record_id long, provider string, title string, authors array<string>, author_orcids array<string>, year string, venue_candidates array<string>, fields array<string>"


def test_merge_stops_early_and_keeps_provenance(spark):
    rows = [
        ("DOI: T.", 1, "A", "Title", None, None, None, ["v1"], ["f1"]),
        ("https://r.example/t", 2, "B", " ", ["Ann", "Ann "], ["9900-0000-1000-0001"], "2020", ["v2"], ["f1", "f2"]),
        ("t", 3, "C", "Other", ["Bob"], ["9900-0000-1000-0002"], "2021", ["v3"], ["f3"]),
        ("u", 4, "Z", None, None, None, "20", None, None),
    ]
    answers = merge.ranked_answers(spark.createDataFrame(rows, META), spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "provider string, trust_rank int"))
    got = {r.target_value: r for r in merge.merge_answers(merge.contributing(answers, merge.has_venue([], ["v1"]))).collect()}
    t = got["t"]
    assert (t.title, t.title_from, t.authors, t.authors_from, t.year, t.year_from) == ("Title", "A", ["Ann"], "B", "2020", "B")
    assert (t.sources, t.venue_candidates, t.fields, t.author_orcids) == (["A", "B"], ["v1", "v2"], ["f1", "f2"], ["9900-0000-1000-0001"])
    assert (got["u"].title, got["u"].authors, got["u"].year) == (None, None, None)


REVIEW = "review_id string, target struct<family_key string, value string, version int>, comment string, review_date string, creators array<string>, creator_orcids array<string>, harvested_at timestamp"
RESPONSE = "response_id string, target_review_id string, family_key string, content string, response_date string, creators array<string>, creator_orcids array<string>, harvested_at timestamp"
COMMENT = RESPONSE.replace("response_id", "comment_id").replace("response_date", "comment_date")


def test_threads_follow_the_survivor(spark):
    reviews = spark.createDataFrame([("r1", ("f", "t1", 1), "Same", "2024-01-02", [], [], None), ("r2", ("f", "t1", 1), "same ", "2024-01-01", [], [], None), ("r3", ("f", "t2", 2), "Other", None, [], [], None)], REVIEW)
    responses = spark.createDataFrame([("a1", "r1", "f", "Thanks", "2024-01-03", [], [], None), ("a2", "zz", "f", "Lost", "2024-01-03", [], [], None)], RESPONSE)
    comments = spark.createDataFrame([("c1", "r2", "f", "Hm", "2024-01-01", [], [], None)], COMMENT)
    got = {r.value: r for r in threads.threads(reviews, responses, comments).collect()}
    assert [got[v]["round"] for v in ("t1", "t2")] == [1, 2]
    assert [c.event_id for c in got["t1"].comments] == ["r2"] and [c.review_id for c in got["t1"].responses] == ["r2"]
    assert [e.event_id for e in got["t1"].timeline] == ["r2", "c1", "a1"]
    assert threads.threads(reviews.limit(0), responses, comments).count() == 0


def test_constraints_name_what_is_broken(spark):
    good = ("k", "fine", "2024-01-01", ["9900-0000-1000-0001"], ["Ann"], "https://x")
    bad = {"text_empty": (1, " "), "date_shape": (2, "2024"), "markup_in_text": (1, "<b>x</b>"), "orcid_shape": (3, ["1"]), "no_creator": (4, []), "url_missing": (5, "")}
    rows = [good] + [(name, *[v if i == p else x for i, x in enumerate(good)][1:]) for name, (p, v) in bad.items()]
    df = spark.createDataFrame(rows, "id string, text string, day string, creator_orcids array<string>, creators array<string>, record_url string")
    found = validate.breaches(df, "id", validate.record_constraints("text", "day")).collect()
    assert {(r.constraint, r.record_key) for r in found} == {(n, n) for n in bad}
    nulls = validate.breaches(spark.createDataFrame([("n", None, None, None, None, None)], df.schema), "id", validate.record_constraints("text", "day"))
    assert {r.constraint for r in nulls.collect()} == {"text_empty", "date_shape", "no_creator", "url_missing"}


def test_relations_between_records(spark):
    known = spark.createDataFrame([("r", "2024-01-05")], "rid string, rday string")
    rows = spark.createDataFrame([("a", "r", "2024-01-04"), ("b", "zz", "2024-01-09"), ("c", None, "bad"), ("c", "r", "bad")], "id string, link string, day string")
    assert {r.record_key for r in validate.dangling(rows, "id", "link", known, "rid", "x").collect()} == {"b"}
    assert {r.record_key for r in validate.too_early(rows, "id", "day", "link", known, "rid", "rday", "x").collect()} == {"a"}
    assert rows_of(validate.repeated_keys(rows, "id", "x")) == [("x", "c", "2")]
