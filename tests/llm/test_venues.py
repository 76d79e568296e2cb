import pytest
from pyspark.sql import functions as F

from peerloom.llm import venues

from .helpers import METADATA

LIST = [
    (1, "Quarry", None, None, "quarry.example"),
    (2, "BioQuarry", None, None, None),
    (13, "Journal of Inland Hydrology", "JIH", "Transactions on Lakes and Rivers", None),
    (19, "Frontier Soil & Root Science", "FSRS", None, None),
    (24, "Zeitschrift für Werkstoffkunde", "ZWK", None, None),
    (14, "International Review of Classroom Studies", "IRCS", None, None),
]
CASES = {
    "Quarry": 1, "QUARRY.": 1, "Qurary": 1, "https://www.quarry.example/content/1a": 1, "quarry.example": 1, "Bio-Quarry": 2, "Bio Quarry": 2, "BieQuarry": 2,
    "Inland Hydrology, Journal of": 13, "J. Inland Hydrol.": 13, "J of Inland Hydrol": 13, "J.I.H.": 13, "Transactions on Lakes and Rivers (now Journal of Inland Hydrology)": 13,
    "The Journal of Inland Hydrology, vol. 3": 13, "Posted on Journal  of  Inland Hydrology": 13, "Journal of Inland Hyurology": 13, "Journal of Inland Hydrology (JIH)": 13,
    "Frontier Soil &amp; Root Science: posted content": 19, "frontier soil and root science preprint server": 19, "Zeitschrift fur Werkstoffkunde": 24, "Z. Werkstoffkunde": 24,
    "Int. Rev. Classroom Stud.": 14, "Gazette of Railway History": 0, "n/a": 0, "-": 0, "https://files.other.example/q": 0, "JIX": 0, "Quarterly": 0,
}


def reference(spark, rows=LIST):
    return spark.createDataFrame(rows, "venue_id int, venue_name string, short_name string, former_name string, host string")


@pytest.fixture(scope="module")
def mapped(spark):
    rows = [(i, "t", "p", None, None, None, [v, None, " ", v], None, None) for i, v in enumerate(CASES)]
    rows += [(0, "t", "p", None, None, None, [next(iter(CASES)), None, " ", next(iter(CASES))], None, None), (900, "t", "p", None, None, None, None, None, None), (901, "t", "p", None, None, None, [], None, None), (902, "t", "p", None, None, None, ["Quarry " * 3000], None, None)]
    df = spark.createDataFrame(rows, METADATA).withColumn("venue_id", F.lit("clash")).withColumn("raw", F.lit(1))
    return {(r.provider_record_id, r.cand_pos): r.venue_id for r in venues.map_candidates(df, reference(spark)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_values_find_their_venue(mapped, i):
    value = list(CASES)[i]
    assert (mapped[(i, 0)], mapped[(i, 3)]) == (CASES[value], CASES[value]), value


def test_nulls_blanks_and_long_values(mapped):
    assert not {k for k in mapped if k[1] in (1, 2)} and (900, 0) not in mapped and (901, 0) not in mapped
    assert mapped[(902, 0)] == 0
    assert len(mapped) == 2 * len(CASES) + 1


def test_empty_tables(spark):
    values = spark.createDataFrame([("Quarry",), (None,)], "raw string")
    assert [tuple(r) for r in venues.match_values(values, reference(spark, [])).collect()] == [("Quarry", 0)]
    assert venues.map_candidates(spark.createDataFrame([], METADATA), reference(spark)).count() == 0


def test_pigeonhole_finds_what_brute_force_finds(spark):
    refs = [(1, "inlandhydrology"), (2, "frontiersoilscience"), (3, "bioquarry")]
    made = {x[:i] + c + x[j:] for _, x in refs for i in range(len(x)) for j in (i, i + 1, i + 2) for c in ("", "z", "ab")}
    values = spark.createDataFrame([(m, m) for m in made], "raw string, key string")
    frame = spark.createDataFrame(refs, "venue_id int, ref string")
    got = {(r.raw, r.venue_id, r.distance) for r in venues.pigeonhole_join(values, frame).collect()}
    brute = values.crossJoin(frame).withColumn("d", F.levenshtein("key", "ref")).where(F.col("d") <= venues.edits(F.col("ref")))
    assert got == {(r.raw, r.venue_id, r.d) for r in brute.collect()}
