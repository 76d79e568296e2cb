import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from peerloom.llm import packing, tokens

from .helpers import documents

SIZES = "container_id int, capacity_tokens int"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))), "en", "s") for k in range(300)]
    return rows + [(900, "token " * 1200, "en", "s"), (901, "", "en", "s"), (902, None, "en", "s"), (None, "x", "en", "s"), rows[0], (903, "这个结果实在令人惊讶！" * 5, "zh", "s")]


def test_every_text_is_packed_whole(spark, texts):
    df = documents(spark, texts).withColumn("bin_id", F.lit("clash")).withColumn("shard", F.lit(1.5))
    sizes = spark.createDataFrame([(1, 256), (2, 1000), (3, None), (None, 5)], SIZES)
    got = packing.containers(df, sizes).toPandas()
    encode = tokens.encoder()
    n = {i: len(encode(t)) for i, t, *_ in texts if i is not None and t is not None}
    assert set(got.container_id) == {1, 2}
    for c, capacity in ((1, 256), (2, 1000)):
        mine = got[got.container_id == c]
        size = mine.end_token - mine.start_token
        assert size.groupby(mine.bin_id).sum().max() <= capacity
        assert dict(size.groupby(mine.doc_id).sum()) == n
        split = mine.groupby("doc_id").size()
        assert all(n[d] > capacity for d in split[split > 1].index)
        assert not mine.duplicated(["doc_id", "start_token"]).any() and not mine.duplicated(["bin_id", "position"]).any()
        assert mine.bin_id.nunique() <= 1.05 * -(-sum(n.values()) // capacity) + 1
    used = {r.container_id: r.used_share for r in packing.fill(packing.containers(df, sizes), sizes).collect()}
    assert min(used.values()) > 0.9


def test_neighbours_share_a_container():
    rng = random.Random(1)
    topics = [[f"{t}{i}" for i in range(30)] for t in "abcdef"]
    texts_ = [" ".join(rng.choice(topics[k % 6]) for _ in range(20)) for k in range(120)]
    index = packing.Index(texts_)
    bins = packing.pack(np.full(120, 10), np.arange(120), 100, index)
    same = sum(i % 6 == b[0] % 6 for b in bins for i in b)
    assert same > 100 and sorted(i for b in bins for i in b) == list(range(120))
    scores = index.scores(0)
    assert scores[6] > scores[1] == 0


def test_neighbours_come_first_where_the_seed_leaves_less_than_a_usual_text():
    """Seeds of 60 of 100, two neighbours of 20 for each, and texts of 40 on another subject that would fit at once."""
    rng = random.Random(2)
    topics = [[f"{t}{i}" for i in range(30)] for t in "abcdefz"]
    about = [k % 6 for k in range(60)] + [k % 6 for k in range(120)] + [6] * 60
    sizes = np.array([60] * 60 + [20] * 120 + [40] * 60)
    index = packing.Index([" ".join(rng.choice(topics[t]) for _ in range(20)) for t in about])
    bins = packing.pack(sizes, np.arange(240), 100, index)
    assert sorted(i for b in bins for i in b) == list(range(240))
    same = sum(about[i] == about[b[0]] for b in bins if b[0] < 60 for i in b[1:])
    assert same > 100 and len(bins) <= 90
    # With fillers of one exact size only, that size is found.
    assert packing._fillable(np.bincount([30, 10], minlength=101), 40, 1).nonzero()[0].tolist() == [9, 10, 29, 30, 39, 40]


def test_terms_and_empty_tables(spark):
    assert packing.terms("A Study of 这个结果 42") == ["study", "of", "这个", "个结", "结果", "42"]
    empty = packing.containers(documents(spark, []), spark.createDataFrame([(1, 10)], SIZES))
    assert empty.count() == 0
    assert packing.containers(documents(spark, [(1, "x", "en", "s")]), spark.createDataFrame([], SIZES)).count() == 0
