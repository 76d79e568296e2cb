import json

import pytest
from pyspark.sql import functions as F

from peerloom.sources import cache, files, registries
from peerloom.sources.http import Fetcher
from peerloom.streaming import streams


def pages(folder, total, *hits):
    for n, rows in enumerate(hits, 1):
        (folder / f"page-{n}.json").write_text(json.dumps({"hits": {"hits": rows, "total": total}}))


def test_paged_scan(spark, tmp_path):
    spark.dataSource.register(files.PageSource)
    pages(tmp_path, {"value": 3}, [{"id": 1, "t": "a"}, {"id": 2}], [{"id": 2}, {"recid": 3}, {"x": 1}])
    df = spark.read.format("pages").option("path", str(tmp_path)).load()
    got = files.scan(df).orderBy("record_id").collect()
    assert [(r.record_id, r.page, r.pos) for r in got] == [("1", 1, 0), ("2", 1, 1), ("3", 2, 1)]
    assert got[0].record and spark.createDataFrame([(got[0].record,)], "r string").select(F.try_variant_get(F.parse_json("r"), "$.t", "string")).first()[0] == "a"
    assert tuple(files.scan_report(df).first()) == (5, 3, 2, 3, True)
    empty = spark.read.format("pages").option("path", str(tmp_path / "none")).load()
    assert empty.count() == 0 and files.scan_report(empty).first().complete is False


def test_fetcher_retries():
    waits, answers = [], [(429, {"Retry-After": "7"}, b""), (429, {}, b""), (500, {}, b""), (200, {}, b"ok")]
    f = Fetcher(lambda url: answers.pop(0), sleep=waits.append)
    assert f.fetch("https://api.example/x") == b"ok"
    assert waits == [7.0, 2.0, 3.0] and f.requests == {"api.example": 4}
    assert Fetcher(lambda url: (404, {}, b""), sleep=waits.append).fetch("https://a/b") is None
    with pytest.raises(RuntimeError):
        Fetcher(lambda url: (403, {}, b""), sleep=waits.append).fetch("https://a/b")
    tries = Fetcher(lambda url: (_ for _ in ()).throw(OSError("down")), tries=3, sleep=waits.append)
    with pytest.raises(OSError):
        tries.fetch("https://a/b")
    assert tries.requests == {"a": 3}


def test_cache_remembers_what_is_missing(spark, tmp_path):
    def fetch(namespace, key):
        if key == "bad":
            raise ValueError("broken")
        return None if key == "gone" else f"{namespace}/{key}"

    path = str(tmp_path / "cache")
    wanted = spark.createDataFrame([("n", "a"), ("n", "a"), ("n", "gone"), ("n", "bad")], "namespace string, key string")
    first = cache.fetch_missing(wanted, cache.read(spark, path), fetch, 2)
    first.write.mode("append").parquet(path)
    assert {(r.key, r.status, r.payload) for r in spark.read.parquet(path).collect()} == {("a", "found", "n/a"), ("gone", "not_found", None), ("bad", "error", None)}
    assert [r.key for r in cache.fetch_missing(wanted, cache.read(spark, path), fetch, 2).collect()] == ["bad"]
    assert cache.fetch_missing(wanted, cache.read(spark, path, refresh=("n",)), fetch, 2).count() == 3


def test_feed(spark):
    xml = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>On soil</title><author><name>Ann</name></author><author><name>Bo</name></author><published>2020-01-02</published></entry></feed>'
    r = files.entries_of_feed(spark.createDataFrame([(xml,)], "x string"), "x").first()
    assert (r.title, r.authors, r.published) == ("On soil", ["Ann", "Bo"], "2020-01-02")


def test_csv_comes_back_as_it_was(spark, tmp_path):
    rows = [("a", ' "q", \n\\" x ', ["1", 'b"']), ("b", "", []), ("c", None, None)]
    df = spark.createDataFrame(rows, "k string, t string, l array<string>")
    files.write_csv(df, str(tmp_path / "csv"))
    got = {r.k: (r.t, r.l) for r in files.read_csv(spark, str(tmp_path / "csv"), df.columns).collect()}
    assert got == {"a": (rows[0][1], json.dumps(rows[0][2], separators=(",", ":"))), "b": ("", "[]"), "c": ("", "")}
    assert files.export_csv(df, str(tmp_path / "one.csv")) == 3
    assert (tmp_path / "one.csv").read_bytes().startswith(b"\xef\xbb\xbfk,t,l\r\n")
    assert [p.name for p in tmp_path.iterdir() if p.name.endswith(".part")] == []


def test_stage_tables_are_gated(spark, tmp_path):
    path = str(tmp_path / "stage")
    files.write_table(spark.range(3), path, "scan", complete=False)
    with pytest.raises(ValueError):
        files.read_table(spark, path, "scan")
    with pytest.raises(ValueError):
        files.read_table(spark, path, "merge", allow_partial=True)
    assert files.read_table(spark, path, "scan", allow_partial=True).count() == 3
    files.write_table(spark.range(5), path, "scan")
    assert files.read_table(spark, path, "scan").count() == 5
    assert len([p for p in (tmp_path / "stage").iterdir() if p.name.startswith("data-")]) == 1
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, str(tmp_path / "none"), "scan")
    files.write_json({"a": "é"}, str(tmp_path / "x/report.json"))
    assert files.read_json(spark, str(tmp_path / "x/report.json")).first().a == "é"


def test_streams(spark, tmp_path):
    folder = str(tmp_path)
    rows = spark.sql("select id % 5 as k, timestamp '2024-01-01 00:00:00' + make_dt_interval(0, id) as at from range(50)")
    rows.write.parquet(f"{folder}/ticks.parquet")
    stream = streams.stream_of(spark, folder, "ticks")
    assert sorted(r.k for r in streams.drain(streams.unique_within(stream, "k", "at", "30 days")).collect()) == [0, 1, 2, 3, 4]
    counts = streams.drain(streams.counts_by_window(stream, "at", "k", "1 day", "1 hour"), "complete").collect()
    assert sum(r.n for r in counts) == 50 and len(counts) == 12
    # By windows that are over, an hour after which nothing of them can come: all but the last day.
    closed = streams.drain(streams.counts_by_window(stream, "at", "k", "1 day", "1 hour")).collect()
    assert sum(r.n for r in closed) == 48 and len(closed) == 10


def test_late_rows_are_dropped_and_state_forgotten(spark, tmp_path):
    """One file a batch: what comes behind the watermark is left out, and a key that was forgotten counts as new."""
    folder = str(tmp_path / "in")
    for i, rows in enumerate([[("a", 1), ("b", 1)], [("c", 10)], [("e", 10)], [("late", 2), ("d", 10)], [("a", 11)]]):
        df = spark.createDataFrame(rows, "k string, day int").selectExpr("k", "make_timestamp(2024, 1, day, 0, 0, 0) as at")
        df.coalesce(1).write.mode("append").parquet(f"{folder}/part={i}")
    paths = spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/*")
    got = sorted(r.k for r in streams.drain(streams.unique_within(paths, "k", "at", "2 days")).collect())
    assert "late" not in got and got.count("a") == 2 and {"b", "c", "d"} <= set(got)


def test_a_batch_that_is_tried_again_is_written_once(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("a",), ("b",)], "target_value string").coalesce(1).write.parquet(folder)
    broken = []

    def resolve(rows):
        rows = rows.withColumn("status", F.lit("resolved"))
        if not broken:
            broken.append(rows.write.parquet(f"{out}/batch=q0-0"))  # as if of a query with another state
        return rows

    for _ in range(2):
        stream = spark.readStream.schema("target_value string").parquet(folder)
        streams.enrich_new(stream, out, resolve, str(tmp_path / "s1")).awaitTermination()
    assert sorted(r.target_value for r in spark.read.parquet(out).where("batch != 'q0-0'").collect()) == ["a", "b"]


def test_second_enrichment_adds_only_new_targets(spark, tmp_path):
    folder, out, seen = str(tmp_path / "in"), str(tmp_path / "out"), []
    spark.createDataFrame([("a",), ("b",)], "target_value string").write.parquet(folder)

    def resolve(rows):
        seen.append(rows.count())
        return rows.withColumn("status", F.lit("resolved"))

    for state in ("s1", "s2"):
        stream = spark.readStream.schema("target_value string").parquet(folder)
        streams.enrich_new(stream, out, resolve, str(tmp_path / state)).awaitTermination()
        spark.createDataFrame([("c",), ("a",)], "target_value string").write.mode("append").parquet(folder)
    assert sorted(r.target_value for r in spark.read.parquet(out).collect()) == ["a", "b", "c"] and seen == [2, 1]


def test_lookups_in_registries(spark):
    def opener(url):
        return (200, {}, url.encode()) if "gone" not in url else (404, {}, b"")

    fetch = registries.asker(opener, {"works": "https://a.example/works/{key}"}, delay=0)
    got = cache.fetch_missing(spark.createDataFrame([("works", "10.1/a b"), ("works", "gone"), ("other", "x")], "namespace string, key string"), spark.createDataFrame([], cache.SCHEMA), fetch, 1)
    assert {(r.key, r.status, r.payload) for r in got.collect()} == {("10.1/a b", "found", "https://a.example/works/10.1%2Fa%20b"), ("gone", "not_found", None), ("x", "error", None)}


def test_small_files(spark, tmp_path):
    files.write_bytes(b"The\nsoil \n\n3x\n", str(tmp_path / "a/words.txt"))
    assert files.word_list(spark, str(tmp_path / "a/words.txt")) == {"the", "soil"} and files.word_list(spark, str(tmp_path / "none")) == frozenset()
    assert files.read_json(spark, str(tmp_path / "none.json")) is None
