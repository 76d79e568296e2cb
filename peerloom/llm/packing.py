"""Problem 7: filling fixed-capacity containers with items.

Method: lexical retrieval packing. Texts are spread over shards; in each, a BM25 inverted index returns for a seed
text the unused texts nearest to it, which fill the seed's container in that order. While more is free than a usual
text takes (the 0.9 quantile of the sizes), the nearest that fits is taken; from then on the nearest after which the
container can still be filled, because it leaves next to nothing free or some other text would. Only where there is no
such neighbour the largest text that fits is taken. Only a text that alone exceeds the capacity is split.
Containers that stay too empty are dissolved and their pieces packed again, many shards together.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import materialise
from .once import once
from .tokens import VOCABULARY, encoder, shared_vocabulary

#: Texts in a shard, shards whose leftovers meet, and the share of a container below which it is packed again.
SHARD_TEXTS, SHARDS_TOGETHER, FULL = 4000, 40, 0.97
#: BM25's saturation and length parameters.
K1, B = 1.2, 0.75
#: Terms in more than one of so many texts of a shard have a row of their own.
DENSE = 10
#: Of the capacity, what may stay free in a container that counts as filled.
SLACK = 0.01

_TERM = re.compile(r"[^\W_㐀-鿿぀-ヿ฀-๿가-힯]{2,}|[㐀-鿿぀-ヿ฀-๿가-힯]+")


def terms(text: str) -> list[str]:
    """Words; of scripts without blanks the pairs of neighbouring letters."""
    out = []
    for t in _TERM.findall(text.lower()):
        if ord(t[0]) >= 0xE00 and len(t) > 1:
            out += [t[i : i + 2] for i in range(len(t) - 1)]
        else:
            out.append(t)
    return out


class Index:
    """A BM25 inverted index of a shard's texts."""

    def __init__(self, texts: list[str]):
        vocabulary: dict[str, int] = {}
        term, doc = [], []
        for d, text in enumerate(texts):
            ts = terms(text)
            term += [vocabulary.setdefault(t, len(vocabulary)) for t in ts]
            doc += [d] * len(ts)
        self.size = n = len(texts)
        term_, doc_ = np.array(term, dtype=np.int64), np.array(doc, dtype=np.int64)
        length = np.bincount(doc_, minlength=n).astype(np.float64)
        pair, tf = np.unique(term_ * n + doc_, return_counts=True)
        t, self.doc = pair // n, pair % n
        self.start = np.searchsorted(t, np.arange(len(vocabulary) + 1))
        df = np.diff(self.start)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * length[self.doc] / max(length.mean(), 1.0)) if n else 0.0
        self.weight = idf[t] * tf * (K1 + 1) / (tf + norm) if n else np.zeros(0)
        order = np.argsort(self.doc, kind="stable")
        self.terms_of = np.split(t[order], np.cumsum(np.bincount(self.doc, minlength=n))[:-1]) if n else []
        # The lists of frequent terms are kept as rows over all texts: adding rows is cheaper than adding up postings.
        frequent = np.flatnonzero(df * DENSE > n)
        self.row = np.full(len(vocabulary), -1, dtype=np.int64)
        self.row[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), n), dtype=np.float32)
        inside = self.row[t] >= 0
        self.rows[self.row[t[inside]], self.doc[inside]] = self.weight[inside]

    def scores(self, d: int) -> np.ndarray:
        """How near each text of the shard is to text d."""
        ts = self.terms_of[d]
        rows = self.row[ts]
        out = self.rows[rows[rows >= 0]].sum(axis=0)
        lists = [slice(self.start[t], self.start[t + 1]) for t in ts[rows < 0]]
        if lists:
            out = out + np.bincount(np.concatenate([self.doc[x] for x in lists]), np.concatenate([self.weight[x] for x in lists]), self.size)
        return out


def pack(sizes: np.ndarray, owner: np.ndarray, capacity: int, index: Index) -> list[list[int]]:
    """Item numbers of each container: items of the given sizes (none above capacity), owner[i] the text of item i."""
    order = np.argsort(-sizes, kind="stable")
    ranked = -sizes[order]
    after = list(range(len(order) + 1))  # after[i]: the first unused place from i on, by path halving

    def unused(i: int) -> int:
        while after[i] != i:
            after[i] = after[after[i]]
            i = after[i]
        return i

    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    free = np.ones(len(order), dtype=bool)
    by_owner: dict[int, list[int]] = {}
    for i, o in enumerate(owner):
        by_owner.setdefault(int(o), []).append(i)
    usual = float(np.quantile(sizes, 0.9)) if len(sizes) else 0.0
    slack = int(SLACK * capacity)
    left = np.bincount(sizes, minlength=capacity + 1)  # unused items of each size
    out = []
    while (seed := unused(0)) < len(order):
        bin_, gap, scores, near = [], capacity, None, None

        def take(i: int) -> None:
            bin_.append(int(order[i]))
            after[i] = i + 1
            free[i] = False
            left[sizes[order[i]]] -= 1

        take(seed)
        gap -= int(sizes[order[seed]])
        while gap > 0:
            i = unused(int(np.searchsorted(ranked, -gap)))
            if i == len(order):
                break
            if scores is None:
                scores = index.scores(int(owner[order[seed]]))
            if gap > usual:
                near = near or _Near(scores, by_owner)
                j = next((p for p in near if free[place[p]] and sizes[p] <= gap), None)
                if j is not None:
                    i = int(place[j])
                    take(i)
                    gap -= int(sizes[j])
                    continue
            # The nearest neighbour after which the container can be filled, else the largest that fits.
            fits = i + np.flatnonzero(free[i:])
            fits = fits[_fillable(left, gap, slack)[sizes[order[fits]]]]
            if len(fits):
                i = int(fits[np.argmax(scores[owner[order[fits]]])])
            take(i)
            gap -= int(sizes[order[i]])
        out.append(bin_)
    return out


def _fillable(left: np.ndarray, gap: int, slack: int) -> np.ndarray:
    """For each size up to gap: whether after an item of it at most slack is free, or would be after one other unused item."""
    size = np.arange(gap + 1)
    rest = gap - size
    upto = np.r_[0, np.cumsum(left[: gap + 1])]
    others = upto[rest + 1] - upto[np.maximum(rest - slack, 0)] - ((size <= rest) & (size >= rest - slack))
    return (rest <= slack) | (others > 0)


class _Near:
    """Items by falling nearness of their texts."""

    def __init__(self, scores: np.ndarray, by_owner: dict[int, list[int]]):
        self.docs, self.by_owner, self.k, self.items = np.argsort(-scores, kind="stable"), by_owner, 0, []

    def __iter__(self):
        return self

    def __next__(self) -> int:
        while not self.items:
            if self.k == len(self.docs):
                raise StopIteration
            self.items = list(self.by_owner.get(int(self.docs[self.k]), ()))
            self.k += 1
        return self.items.pop()


def _containers(pieces: pd.DataFrame, capacities: list[tuple[int, int]], shard: int, level: int, index: Index, owner_of: dict[int, int]) -> pd.DataFrame:
    """Contents of the containers of one shard; pieces: container_id, doc_id, start_token, end_token."""
    frames = []
    for container_id, capacity in capacities:
        mine = pieces[pieces["container_id"] == container_id].reset_index(drop=True)
        if not len(mine):
            continue
        sizes = (mine["end_token"] - mine["start_token"]).to_numpy(dtype=np.int64)
        owner = mine["doc_id"].map(owner_of).to_numpy(dtype=np.int64)
        bins = pack(sizes, owner, capacity, index)
        rows = np.array([i for b in bins for i in b], dtype=np.int64)
        got = mine.iloc[rows].copy()
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        got["bin_id"] = (level << 56) + (shard << 24) + number
        got["position"] = np.concatenate([np.arange(len(b)) for b in bins]).astype(np.int32)
        got["used"] = np.bincount(number, sizes[rows])[number].astype(np.int64)
        frames.append(got)
    columns = ["container_id", "bin_id", "position", "doc_id", "start_token", "end_token", "used"]
    return pd.concat(frames)[columns] if frames else pd.DataFrame({c: [] for c in columns})


def containers(documents: DataFrame, sizes: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """container_id, bin_id, position, doc_id, start_token, end_token: the contents of the containers of each capacity.

    Every text stands whole in one container of each container_id, unless it alone exceeds the capacity: then pieces
    of the full capacity come out, and the rest is packed as a text of its own. Empty texts take no room but stand in
    a container. Null ids and texts give no row, an id given twice is packed once, capacities below 1 are left out and
    an empty table gives an empty result. The capacities are a fixed table and are read to the driver.
    """
    capacities = [(r[0], r[1]) for r in sizes.where("container_id is not null and capacity_tokens > 0").select("container_id", "capacity_tokens").distinct().orderBy("container_id").collect()]
    vocabulary = shared_vocabulary(documents.sparkSession, vocabulary)
    texts, n = once(documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    shards = max(1, -(-n // SHARD_TEXTS))
    sharded = texts.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))

    def first(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        encode = encoder(vocabulary)
        pdf = pdf.sort_values("doc_id").reset_index(drop=True)
        n = [len(encode(t)) for t in pdf["text"]]
        pieces = [(c, d, s, min(s + size, k)) for c, size in capacities for d, k in zip(pdf["doc_id"], n, strict=True) for s in range(0, max(k, 1), size)]
        frame = pd.DataFrame(pieces, columns=["container_id", "doc_id", "start_token", "end_token"])
        return _containers(frame, capacities, int(key[0]), 0, Index(list(pdf["text"])), dict(zip(pdf["doc_id"], range(len(pdf)), strict=True)))

    schema = "container_id int, bin_id long, position int, doc_id long, start_token long, end_token long, used long"
    packed = materialise(sharded.groupBy("shard").applyInPandas(first, schema), "packed")
    limits = F.broadcast(sizes.sparkSession.createDataFrame(capacities or [(0, 1)], "container_id int, capacity int"))
    packed = packed.join(limits, "container_id")
    kept, loose = packed.where(F.col("used") >= FULL * F.col("capacity")), packed.where(F.col("used") < FULL * F.col("capacity"))
    loose = loose.select("container_id", "doc_id", "start_token", "end_token", F.floor(F.shiftright(F.col("bin_id"), 24) / SHARDS_TOGETHER).cast("int").alias("shard"))

    def second(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["container_id", "doc_id", "start_token"]).reset_index(drop=True)
        seen = pdf.drop_duplicates("doc_id")
        return _containers(pdf, capacities, int(key[0]), 1, Index(list(seen["text"])), dict(zip(seen["doc_id"], range(len(seen)), strict=True)))

    again = loose.join(texts, "doc_id").groupBy("shard").applyInPandas(second, schema)
    columns = ["container_id", "bin_id", "position", "doc_id", "start_token", "end_token"]
    return kept.select(columns).unionByName(again.select(columns))


def breaches(documents: DataFrame, contents: DataFrame, sizes: DataFrame) -> DataFrame:
    """container_id, missing, twice, overfull, gaps: for each capacity the documents that stand in no container, the pieces
    that stand twice, the containers above capacity and the pieces that don't begin where another ends. All are to be 0."""
    limits = F.broadcast(sizes.where("container_id is not null and capacity_tokens > 0").select("container_id", "capacity_tokens").distinct())
    wanted = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().agg(F.count("*").alias("wanted"))
    pieces = contents.groupBy("container_id", "doc_id").agg(F.count("*").alias("n"), F.countDistinct("start_token").alias("starts"), F.max("end_token").alias("end"), F.sum(F.col("end_token") - F.col("start_token")).alias("tokens"))
    texts = pieces.groupBy("container_id").agg(F.count("*").alias("texts"), F.sum(F.col("n") - F.col("starts")).alias("twice"), F.count_if(F.col("end") != F.col("tokens")).alias("gaps"))
    bins = contents.groupBy("container_id", "bin_id").agg(F.sum(F.col("end_token") - F.col("start_token")).alias("used")).join(limits, "container_id")
    over = bins.groupBy("container_id").agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("overfull"))
    rows = limits.select("container_id").join(texts, "container_id", "left").join(over, "container_id", "left").crossJoin(F.broadcast(wanted))  # one row
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.select("container_id", (F.col("wanted") - zero("texts")).alias("missing"), zero("twice").alias("twice"), zero("overfull").alias("overfull"), zero("gaps").alias("gaps"))


def fill(contents: DataFrame, sizes: DataFrame) -> DataFrame:
    """container_id, containers, tokens, used_share: how many containers of each capacity and how full they are."""
    n = contents.groupBy("container_id").agg(F.countDistinct("bin_id").alias("containers"), F.sum(F.col("end_token") - F.col("start_token")).alias("tokens"))
    return n.join(F.broadcast(sizes.select("container_id", "capacity_tokens").distinct()), "container_id").select("container_id", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("used_share"))
