import json

import pytest
from pyspark.sql import functions as F

from peerloom.operators import ingest
from peerloom.operators.links import resolve_links


def records(spark, *rows):
    df = spark.createDataFrame([(str(k), json.dumps(r) if isinstance(r, dict) else r) for k, r in enumerate(rows)], "record_id string, record string")
    return ingest.parsed(df)


def related(*items):
    return {"metadata": {"related_identifiers": [dict(zip(("relation", "identifier", "resource_type"), i, strict=False)) for i in items]}}


TARGETS = [
    (related(("reviews", "https://doi.org/10.1234/Ab.v2")), ("10.1234/ab.v2", "doi:10.1234/ab", 2), "ok"),
    (related(("Reviews", "10.1234/a", {"type": "preprint"}), ("cites", "10.1234/b")), ("10.1234/a", "doi:10.1234/a", None), "ok"),
    (related(("reviews", "10.1234/a", "dataset")), None, "none"),
    (related(("reviews", "10.1234/a.v1"), ("reviews", "10.1234/a.v10"), ("reviews", "10.1234/a")), ("10.1234/a.v10", "doi:10.1234/a", 10), "multiple_same_family"),
    (related(("reviews", "10.1234/a"), ("reviews", "10.1234/b")), None, "ambiguous"),
    (related(("reviews", "https://host.example/10.1234/x")), ("10.1234/x", "doi:10.1234/x", None), "ok"),
    (related(("reviews", "arXiv:2420.00171v3")), ("2420.00171", "arxiv:2420.00171", 3), "ok"),
    ({}, None, "none"),
    ("no json", None, "none"),
    ({"metadata": "text"}, None, "none"),
]


def test_targets(spark):
    got = {r.record_id: r for r in ingest.targets(records(spark, *[t[0] for t in TARGETS])).collect()}
    for k, (_, want, reason) in enumerate(TARGETS):
        r = got[str(k)]
        assert (r.reason, r.target and (r.target["value"], r.target["family_key"], r.target["version"])) == (reason, want), k


def test_keys_and_people(spark):
    rows = [
        {"pids": {"doi": {"identifier": "bad"}}, "metadata": {"doi": "10.1234/A", "creators": [{"name": " Ann  Bo", "orcid": "https://orcid.example/9900-0000-1000-787x"}, "Cy", {"name": "Ann Bo"}], "subjects": [{"term": "Soil"}, "Soil", ""], "publication_date": "2024-02-03T00:00"}},
        {"created": "2020-01-01T10:00:00", "metadata": {"creators": None}},
        "broken",
    ]
    df = ingest.people(ingest.record_keys(records(spark, *rows), "10.9/depot."))
    got = {r.record_id: r for r in df.collect()}
    assert (got["0"].review_id, got["0"].creators, got["0"].creator_orcids, got["0"].subjects, got["0"].record_date) == ("10.1234/a", ["Ann Bo", "Cy"], ["9900-0000-1000-787X"], ["Soil"], "2024-02-03")
    assert (got["1"].review_id, got["1"].creators, got["1"].record_date) == ("10.9/depot.1", [], "2020-01-01")
    assert (got["2"].review_id, got["2"].record_date) == ("10.9/depot.2", "")


@pytest.mark.parametrize("turned", [False, True])
def test_a_comment_may_come_before_its_review(spark, turned):
    rows = [related(("cites", "10.1234/r"), ("isResponseTo", "doi:10.1234/r"), ("references", "10.1234/other")), related(("reviews", "10.1234/r"))]
    df = ingest.links(records(spark, *(rows[::-1] if turned else rows)))
    reviews = spark.createDataFrame([("10.1234/r", "t")], "review_id string, value string")
    assert [r.review_id for r in resolve_links(df, "record_id", "link", reviews, "review_id", ["value"]).collect()] == ["10.1234/r"]


def test_bodies(spark):
    df = records(spark, {"metadata": {"description": "D"}}, {"metadata": {"description": " "}}, {})
    files = spark.createDataFrame([("0", "html", "H"), ("1", "html", "H"), ("1", "pdf", "P"), ("2", "pdf", " ")], "record_id string, kind string, text string")
    got = lambda *order: {r.record_id: (r.body, r.body_source) for r in ingest.bodies(df, files, order=order).collect()}
    assert got("description", "html") == {"0": ("D", "description"), "1": ("H", "html"), "2": ("", "")}
    assert got("pdf", "html", "description")["1"] == ("P", "pdf") and got("html", "description")["0"] == ("H", "html")


def test_registry_answers(spark):
    works = {"message": {"title": ["On  soil"], "author": [{"given": "Ann", "family": "Bo", "ORCID": "9900-0000-1000-0001"}, {"name": "Soil Group"}], "posted": {"date-parts": [[2021, 3]]}, "published": {"date-parts": [[2020]]}, "container-title": ["Quarry"], "URL": "https://q.example", "subject": ["Soil", "Soil"]}}
    dois = {"data": {"attributes": {"titles": [{}, {"title": "Two"}], "creators": [{"givenName": "Cy", "familyName": "Do", "nameIdentifiers": [{"nameIdentifier": "https://orcid.example/9900-0000-1000-0002"}]}], "publicationYear": "x", "published": "2019-05", "publisher": "P", "subjects": [{"subject": "S"}, "T"]}}}
    graph = {"display_name": "Three", "authorships": [{"author": {"display_name": "Ed Fu", "orcid": None}}], "publication_year": 2018, "primary_topic": {"display_name": "A"}, "topics": [{"display_name": "A"}, {"display_name": "B"}]}
    rows = [("t1", "works", json.dumps(works)), ("t2", "dois", json.dumps(dois)), ("t3", "graph", json.dumps(graph)), ("t4", "works", "{}"), ("t5", "dois", "bad")]
    df = ingest.parsed(spark.createDataFrame(rows, "target_value string, provider string, record string"))
    got = {r.target_value: r for r in ingest.registry_answers(df).collect()}
    assert (got["t1"].title, got["t1"].authors, got["t1"].author_orcids, got["t1"].year, got["t1"].venue_candidates, got["t1"].fields) == ("On soil", ["Ann Bo", "Soil Group"], ["9900-0000-1000-0001"], "2021", ["Quarry", "https://q.example"], ["Soil"])
    assert (got["t2"].title, got["t2"].authors, got["t2"].author_orcids, got["t2"].year, got["t2"].venue_candidates, got["t2"].fields) == ("Two", ["Cy Do"], ["9900-0000-1000-0002"], "2019", ["P"], ["S", "T"])
    assert (got["t3"].title, got["t3"].authors, got["t3"].year, got["t3"].fields) == ("Three", ["Ed Fu"], "2018", ["A", "B"])
    assert (got["t4"].title, got["t4"].authors, got["t4"].year, got["t5"].title) == ("", [], "", "")
    assert df.select(F.col("v").isNull().alias("x")).where("x").count() == 1
