"""Sizes in tokens of a public tokenizer, read from the file its path names."""

from __future__ import annotations

import base64
import os
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: The vocabulary as ranks, one "base64 rank" pair a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the public pattern that cuts text before byte-pair merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _loaded() -> dict[str, Callable[[str], list[int]]]:
    """path -> encoder, in a module of its own: functions reach the workers by value, so their globals are a task's only."""
    return sys.modules.setdefault("_peerloom_encoders", types.ModuleType("_peerloom_encoders")).__dict__


def encoder(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    """A function from text to its token ids. Special tokens in a text are ordinary text.

    The file is the one of that name that the session sent to its executors (shared_vocabulary), else the path itself."""
    loaded = _loaded()
    if vocabulary not in loaded:
        import tiktoken
        from pyspark import SparkFiles

        sent = SparkFiles.get(os.path.basename(vocabulary)) if SparkFiles._root_directory else ""
        with open(sent if os.path.exists(sent) else vocabulary, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        loaded[vocabulary] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return loaded[vocabulary]


def shared_vocabulary(spark: SparkSession, vocabulary: str) -> str:
    """vocabulary, after its file was sent to the executors, which need no copy of their own."""
    spark.sparkContext.addFile(vocabulary)  # a file sent before is not sent again
    return vocabulary


def with_sizes(texts: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, source, n_tokens for texts (doc_id long, source string, text string)."""

    vocabulary = shared_vocabulary(texts.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for b in batches:
            n = pa.array([len(encode(t)) for t in b.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), n], names=["doc_id", "source", "n_tokens"])

    return texts.select("doc_id", "source", "text").mapInArrow(run, "doc_id long, source string, n_tokens long")
