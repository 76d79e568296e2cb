"""Problem 8: mixing sources to target weights.

Method: Sainte-Laguë apportionment. The mixture is cut into blocks of equal tokens; the blocks go to the sources by
highest quotients of their target shares, and each source's blocks to its shards by highest quotients of their tokens.
In a shard the documents stand in a seeded order, as often in a row as they may be used, and those that end within
the shard's quota of blocks are taken.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise
from .tokens import VOCABULARY, with_sizes

#: Tokens in a block and in a shard. A shard is of this size however many tokens there are; their number grows.
BLOCK, SHARD_TOKENS = 2048, 4_000_000
SEED = 17
#: Beyond so many quotas (about 40 bytes each) they are joined by a shuffle.
BROADCAST_ROWS = 200_000


def sainte_lague(weights: list[float], seats: int) -> list[int]:
    """Seats for each weight by the highest quotients weight / (2 x seats held + 1), ties to the earlier.

    A bar is sought above which there are no more quotients than seats, and hardly fewer: all of those get their seats at
    once, the few seats that are left go one by one to the highest quotients below the bar.
    """
    if seats <= 0 or not any(w > 0 for w in weights):
        return [0] * len(weights)

    def above(bar: float) -> list[int]:
        """How many quotients of each weight are higher than bar."""
        out = []
        for w in weights:
            h = int(w / bar + 1) // 2 if w > 0 else 0
            while h and w / (2 * h - 1) <= bar:
                h -= 1
            while w / (2 * h + 1) > bar:
                h += 1
            out.append(h)
        return out

    low, high = 0.0, max(weights)  # no quotient is higher than the largest weight
    for _ in range(100):
        bar = (low + high) / 2
        if not low < bar < high:
            break
        n = sum(above(bar))
        low, high = (low, bar) if n <= seats else (bar, high)
        if 0 <= seats - n <= 8:
            break
    held = above(high)
    queue = [(-w / (2 * h + 1), i) for i, (w, h) in enumerate(zip(weights, held, strict=True)) if w > 0]
    heapq.heapify(queue)
    for _ in range(seats - sum(held)):
        _, i = heapq.heappop(queue)
        held[i] += 1
        heapq.heappush(queue, (-weights[i] / (2 * held[i] + 1), i))
    return held


def _quotas(shards: list, targets: list) -> tuple[list[tuple], list[tuple]]:
    """(source, shard, quota in tokens, max_repeats) and (source, target_share, blocks) from the tokens of the shards."""
    tokens: dict[str, int] = {}
    by_source: dict[str, list[tuple[int, int]]] = {}
    for r in shards:
        tokens[r["source"]] = tokens.get(r["source"], 0) + r["tokens"]
        by_source.setdefault(r["source"], []).append((r["shard"], r["tokens"]))
    aims = {r["source"]: (r["target_share"], r["max_repeats"]) for r in targets}
    present = sorted(s for s, (share, repeats) in aims.items() if share > 0 and repeats > 0 and tokens.get(s, 0) > 0)
    whole = sum(aims[s][0] for s in present)
    if not present:
        return [], []
    # As large as the source that runs out first lets it be.
    size = min(tokens[s] * aims[s][1] * whole / aims[s][0] for s in present)
    block = BLOCK if size >= 1000 * BLOCK else max(1.0, size / 1000)
    seats = sainte_lague([aims[s][0] for s in present], int(size / block))
    quotas, report = [], []
    for s, n in zip(present, seats, strict=True):
        mine = sorted(by_source[s])
        for (shard, _), q in zip(mine, sainte_lague([float(t) for _, t in mine], n), strict=True):
            quotas.append((s, shard, float(q * block), aims[s][1]))
        report.append((s, float(aims[s][0]), n))
    return quotas, report


def select(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """source, doc_id, n_tokens, copies: the documents of the mixture and how often each is used, at most max_repeats.

    The mixture is as large as the targets allow. Sources without target, without tokens or with a share of 0 are left
    out, and the shares of the others keep their proportions; null ids, sources and texts and texts without tokens
    give no row, and an id given twice counts once. The targets are a fixed table and are read to the driver, and so
    are the sizes of the shards, a number for each SHARD_TOKENS tokens.
    """
    spark = documents.sparkSession
    texts = documents.where("doc_id is not null and source is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    sized = with_sizes(texts.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi"), vocabulary)
    # One row of an id given twice: the least, found without moving the text.
    sized = materialise(sized.groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens")).alias("r")).select("doc_id", "r.source", "r.n_tokens").where("n_tokens > 0"), "sizes")
    totals = {r["source"]: r["tokens"] for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).collect()}
    counts = spark.createDataFrame([(s, max(1, round(t / SHARD_TOKENS))) for s, t in totals.items()], "source string, shards int")
    sharded = sized.join(F.broadcast(counts), "source").withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.col("shards")).cast("int"))
    shards = sharded.groupBy("source", "shard").agg(F.sum("n_tokens").alias("tokens"))
    quotas, _ = _quotas(shards.collect(), targets.where("source is not null").collect())
    quota = spark.createDataFrame(quotas, "source string, shard int, quota double, max_repeats int")
    quota = F.broadcast(quota) if len(quotas) <= BROADCAST_ROWS else quota.hint("merge")
    order = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(SEED + 1), "doc_id"), "doc_id")
    within = sharded.join(quota, ["source", "shard"]).withColumn("end", F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    every = Window.partitionBy("source", "shard")
    within = within.withColumn("all", F.sum("n_tokens").over(every))
    # The k-th copy ends k x all + end tokens on; it is taken if that lies within the quota.
    copies = F.floor((F.col("quota") - F.col("end")) / F.col("all")) + 1
    within = within.withColumn("copies", F.least("max_repeats", F.greatest(F.lit(0), copies)).cast("int"))
    # What a long document at the end leaves free goes, in the same order, to the next ones that fit.
    within = within.withColumn("open", F.col("quota") - F.sum(F.col("copies") * F.col("n_tokens")).over(every)).withColumn("least", F.min("copies").over(every))
    fits = (F.col("copies") == F.col("least")) & (F.col("copies") < F.col("max_repeats")) & (F.col("n_tokens") <= F.col("open"))
    more = fits & (F.sum(F.when(fits, F.col("n_tokens")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)) <= F.col("open"))
    within = within.withColumn("copies", F.col("copies") + more.cast("int"))
    return within.where("copies > 0").select("source", "doc_id", "n_tokens", "copies")


def breaches(documents: DataFrame, selection: DataFrame, targets: DataFrame) -> DataFrame:
    """source, unknown, too_often, twice: of each source's chosen documents, how many are not among its documents, are used
    more often than max_repeats allows or not at all, and stand in more than one row. All are to be 0."""
    rows = selection.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.max("copies").alias("copies"))
    known = documents.select("source", F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("known", F.lit(True))
    rows = rows.join(known, ["source", "doc_id"], "left").join(F.broadcast(targets.select("source", "max_repeats")), "source", "left")
    often = F.coalesce((F.col("copies") > F.col("max_repeats")) | (F.col("copies") < 1), F.lit(True))
    got = rows.groupBy("source").agg(F.count_if(F.col("known").isNull()).alias("unknown"), F.count_if(often).alias("too_often"), F.count_if(F.col("n") > 1).alias("twice"))
    return targets.select("source").join(got, "source", "left").fillna(0)


def shares(selection: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, documents, tokens, actual_share, most_copies: what the selection reaches, every target listed."""
    got = selection.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    rows = targets.select("source", "target_share").join(got, "source", "left").fillna(0, ["documents", "tokens", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy())
    return rows.withColumn("actual_share", F.when(total > 0, F.col("tokens") / total)).select("source", "target_share", "documents", "tokens", "actual_share", "most_copies")
