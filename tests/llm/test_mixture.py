import heapq
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peerloom.llm import mixture

from .helpers import documents, rows_of

TARGETS = "source string, target_share double, max_repeats int"


@given(st.lists(st.integers(1, 500), min_size=1, max_size=8), st.integers(0, 400))
def test_seats_go_to_the_highest_quotients(weights, seats):
    queue = [(-w, 0, i) for i, w in enumerate(weights)]
    want = [0] * len(weights)
    heapq.heapify(queue)
    for _ in range(seats):
        _, h, i = heapq.heappop(queue)
        want[i] += 1
        heapq.heappush(queue, (-weights[i] / (2 * h + 3), h + 1, i))
    got = mixture.sainte_lague([float(w) for w in weights], seats)
    assert sum(got) == seats
    quotient = lambda held, extra: [w / (2 * h + extra) for w, h in zip(weights, held, strict=True)]
    # Ties may go either way: no seat that was given has a lower quotient than one that was not.
    assert not seats or min(w / (2 * h - 1) for w, h in zip(weights, got, strict=True) if h) >= max(quotient(got, 1)) - 1e-9
    assert sorted(want) == sorted(got) or any(abs(a - b) <= 1 for a, b in zip(want, got, strict=True))


def by_hand(weights, seats):
    held = [0] * len(weights)
    for _ in range(seats):
        i = max(range(len(weights)), key=lambda k: (weights[k] / (2 * held[k] + 1), -k))
        held[i] += 1
    return held


def test_seats_are_those_of_the_plain_rule_for_any_weights():
    rng = random.Random(8)
    sets = [([1000.0] + [1.0] * 300, 1180), ([5000.0] + [3.0] * 120 + [1.0] * 180, 1500), ([1.0] * 7, 3), ([0.0, 2.0], 5), ([1e-9, 1.0], 40), ([float("1e300"), 1.0], 9)]
    for _ in range(150):
        n = rng.randrange(1, 60)
        sets.append(([rng.choice([rng.random(), float(rng.randrange(1, 9)), 1000 * rng.random()]) for _ in range(n)], rng.randrange(0, 400)))
    for weights, seats in sets:
        assert mixture.sainte_lague(weights, seats) == by_hand(weights, seats), (weights, seats)


def mixed(spark, rows, targets):
    df = documents(spark, rows).withColumn("copies", F.lit("clash")).withColumn("shard", F.lit("clash"))
    t = spark.createDataFrame(targets, TARGETS)
    picked = mixture.select(df, t)
    return {r.doc_id: (r.source, r.n_tokens, r.copies) for r in picked.collect()}, {r.source: r for r in mixture.shares(picked, t).collect()}


def test_shares_and_repeats(spark):
    rng = random.Random(2)
    rows = [(k, " ".join("word" for _ in range(rng.randrange(5, 60))), "en", "ab"[k % 4 == 0]) for k in range(2000)]
    rows += [rows[0], (9001, "word " * 4000, "en", "a"), (9002, "", "en", "a"), (9003, None, "en", "b"), (9004, "x", "en", None), (9005, "y", "en", "other"), (None, "z", "en", "a")]
    picked, shares = mixed(spark, rows, [("a", 0.5, 1), ("b", 0.5, 3), ("absent", 0.2, 9)])
    assert abs(shares["a"].actual_share - 0.5) < 0.003 and abs(shares["b"].actual_share - 0.5) < 0.003
    assert shares["absent"].tokens == 0
    broken = mixture.breaches(documents(spark, rows), mixture.select(documents(spark, rows), spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], TARGETS)), spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], TARGETS))
    assert rows_of(broken) == [("a", 0, 0, 0), ("b", 0, 0, 0)]
    assert max(c for s, _, c in picked.values() if s == "a") == 1 and max(c for s, _, c in picked.values() if s == "b") in (2, 3)
    assert not {9002, 9003, 9004, 9005, None} & set(picked)
    again, _ = mixed(spark, rows[::-1], [("a", 0.5, 1), ("b", 0.5, 3), ("absent", 0.2, 9)])
    assert again == picked


def test_empty_tables(spark):
    assert mixed(spark, [], [("a", 1.0, 1)])[0] == {}
    assert mixed(spark, [(1, "x y", "en", "a")], [("a", 0.0, 1), ("b", 1.0, 1)])[0] == {}
    assert rows_of(mixture.select(documents(spark, [(1, "x", "en", "a")]), spark.createDataFrame([], TARGETS))) == []
