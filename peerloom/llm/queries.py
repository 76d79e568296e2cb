"""Queries of the operators in this package: name -> function of the session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from ..storage import materialise
from . import mixture, names, near_dup, packing, residue, sentences, skeleton, survivor, venues

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _texts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return table(s, d, "reviews"), table(s, d, "discussion_comments")


@query
def p1_found(s: SparkSession, d: str) -> DataFrame:
    return residue.found(*_texts(s, d))


@query
def p1_kept_out(s: SparkSession, d: str) -> DataFrame:
    return residue.kept_out(*_texts(s, d))


@query
def p2_found(s: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(s, d, "provider_metadata"), table(s, d, "providers"))


@query
def p2_merged(s: SparkSession, d: str) -> DataFrame:
    return survivor.merged(table(s, d, "provider_metadata"), table(s, d, "providers"))


@query
def p3_found(s: SparkSession, d: str) -> DataFrame:
    return venues.map_candidates(table(s, d, "provider_metadata"), table(s, d, "venues")).select("provider_record_id", "cand_pos", "venue_id")


@query
def p3_unmatched(s: SparkSession, d: str) -> DataFrame:
    return venues.unmatched(table(s, d, "provider_metadata"), table(s, d, "venues"))


def _near(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return near_dup.near_duplicates(near_dup.texts_of(*_texts(s, d)))


@query
def p4_found(s: SparkSession, d: str) -> DataFrame:
    return near_dup.all_pairs(*_near(s, d))


@query
def p4_classes(s: SparkSession, d: str) -> DataFrame:
    return near_dup.links_per_record(*_near(s, d))


@query
def p5_found(s: SparkSession, d: str) -> DataFrame:
    return skeleton.titles(table(s, d, "reviews"), table(s, d, "provider_metadata")).where("altered").select("record_kind", "record_key")


@query
def p5_titles(s: SparkSession, d: str) -> DataFrame:
    return skeleton.titles(table(s, d, "reviews"), table(s, d, "provider_metadata"))


def _names(s: SparkSession, d: str) -> DataFrame:
    return names.link(names.spellings(*[table(s, d, t) for t in ("reviews", "author_responses", "discussion_comments")]))


@query
def p6_found(s: SparkSession, d: str) -> DataFrame:
    return names.pairs(_names(s, d))


@query
def p6_entities(s: SparkSession, d: str) -> DataFrame:
    return _names(s, d)


@query
def p7_containers(s: SparkSession, d: str) -> DataFrame:
    return packing.containers(table(s, d, "documents"), table(s, d, "container_sizes"))


@query
def p7_fill(s: SparkSession, d: str) -> DataFrame:
    sizes = table(s, d, "container_sizes")
    return packing.fill(packing.containers(table(s, d, "documents"), sizes), sizes)


@query
def p7_breaches(s: SparkSession, d: str) -> DataFrame:
    documents, sizes = table(s, d, "documents"), table(s, d, "container_sizes")
    return packing.breaches(documents, materialise(packing.containers(documents, sizes), "contents"), sizes)


@query
def p8_selection(s: SparkSession, d: str) -> DataFrame:
    return mixture.select(table(s, d, "documents"), table(s, d, "mixture_targets"))


@query
def p8_shares(s: SparkSession, d: str) -> DataFrame:
    targets = table(s, d, "mixture_targets")
    return mixture.shares(mixture.select(table(s, d, "documents"), targets), targets)


@query
def p8_breaches(s: SparkSession, d: str) -> DataFrame:
    documents, targets = table(s, d, "documents"), table(s, d, "mixture_targets")
    return mixture.breaches(documents, mixture.select(documents, targets), targets)


@query
def p9_found(s: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(s, d, "documents")).select("doc_id", "start_char", "end_char")


@query
def p9_sentences(s: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(s, d, "documents"))
