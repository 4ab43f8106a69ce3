"""A training corpus from ``documents`` in five stages; each is written and read again before the next.

Quality rules drop documents that they reject; exact dedup keeps the row with
the largest id of equal texts; near-dedup keeps one document of each group of
near copies; mixing repeats and leaves out documents to meet each source's
target, in training order; the last stage encodes what is left.

Defined results of every stage: other columns stay as they are, whatever their
names; an empty table passes through as an empty one; rows without an id take
part like others (told apart by their text where an id would name them).  A
null or empty text is rejected by the quality rules, and where a stage meets
one all the same it has no words: exact dedup keeps one of them, near-dedup
keeps all, the mix takes none, BPE encodes it to no ids.
"""
from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import bpe, common, exact_dedup, mixing, near_dedup, quality
from feedlens.session import ScratchOfSteps

_steps = ScratchOfSteps()


def _stage(fn):
    """What the stage before left in the checkpoint folder goes when this one begins: its result is stored by then."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with _steps.next(spark):
            return fn(spark, docs, sf_dir)
    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that every quality rule keeps; equal texts share a verdict."""
    return quality.keep_good(docs)


@_stage
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the row with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id; documents without words stay."""
    return near_dedup.keep_first_of_group(docs)


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order; those of no words go."""
    return mixing.mix(docs)


@_stage
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix, repeats included: id, token count, digests of the ids and of the decoded text."""
    return bpe.round_trip(docs, common.tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact_copies), ("near-dedup", near_copies),
          ("source mix", source_mix), ("byte-level BPE", byte_bpe)]

#: Near-dedup and BPE can't be stated in SQL; ``tests/llm`` has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = common.written(docs, "pipeline")
    return docs
