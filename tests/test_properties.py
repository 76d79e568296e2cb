"""What must not depend on the order of rows or on being done twice."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from peerloom.functions import texts as X
from peerloom.operators import dedup, rounds, sampling

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@given(st.text(alphabet="ab <>&;/p.\n-", max_size=60))
def test_cleaning_twice_changes_nothing_more(text):
    once = X.plain_text(text)
    assert "\n\n\n" not in once and once == once.strip()
    assert X.unwrap(X.unwrap(text)).split() == X.unwrap(X.unwrap(X.unwrap(text))).split()
    title = X.clean_title(text)
    assert "\n" not in title and "  " not in title


@FEW
@given(st.randoms(use_true_random=False))
def test_survivors_do_not_depend_on_row_order(spark, random):
    rows = [(f"f{random.randrange(2)}", f"id{i}", str(random.randrange(3)), random.choice(["A b", "a  B", "c", None])) for i in range(30)]
    schema = "fam string, id string, day string, text string"
    mark = lambda r: {(x.id, x.kept) for x in dedup.mark_duplicates(spark.createDataFrame(r, schema), ["fam"], "id", ["day"], "text").collect()}
    one = mark(rows)
    random.shuffle(rows)
    assert mark(rows) == one


@FEW
@given(st.randoms(use_true_random=False))
def test_rounds_and_samples_do_not_depend_on_row_order(spark, random):
    rows = [(f"f{i % 3}", f"v{i}", random.choice([None, 1, 2]), f"2024-01-0{random.randrange(1, 5)}", 1) for i in range(20)]
    schema = "family_key string, value string, version int, first_date string, reviews int"

    def both(r):
        df = spark.createDataFrame(r, schema)
        numbers = {(x["value"], x["round"]) for x in rounds.number_rounds(df).collect()}
        return numbers, [x["value"] for x in sampling.ordered(df, "value", "s").orderBy("tier", "place").collect()]

    one = both(rows)
    random.shuffle(rows)
    assert both(rows) == one
