"""Corpus pipeline: from raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; all but
the last return the columns of ``docs``. Rows follow the decision for their own text, whether their id is
null, repeated or neither. A stage's own intermediate tables are dropped when the next stage starts, so a
stage's result must have been written by then, as ``run`` does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilowatch.llm import mixing
from kilowatch.llm.common import prepare, stored, table
from kilowatch.llm.decontam import without_benchmark
from kilowatch.llm.langid import accepted_rows, train
from kilowatch.llm.neardup import without_near_duplicates
from kilowatch.llm.queries import tokenizer_file, vocabulary_file
from kilowatch.llm.tokenpack import read_documents, write_tokens
from kilowatch.session import drop_scratch, scratch_made, scratch_path

# What the stage before has stored for its own use. Its result is written when the next stage starts.
_LEFT: list[str] = []


def follows(stage: Callable) -> Callable:
    """A stage after the first: drops what the one before has stored."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, _LEFT)
        return opens(stage)(spark, docs, sf_dir)

    return run_stage


def opens(stage: Callable) -> Callable:
    """A stage whose stored tables the next one may drop."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = set(scratch_made())
        out = stage(spark, docs, sf_dir)
        _LEFT[:] = [path for path in scratch_made() if path not in before]
        return out

    return run_stage


@opens
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out texts without a letter and texts that look like none of the learned languages."""
    prepare(spark)
    return accepted_rows(docs, train(docs, vocabulary_file()))


@follows
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: shingles of five words, similarity of 0.8 or more."""
    prepare(spark)
    return without_near_duplicates(docs, size=5, percent=80)


@follows
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a benchmark item within the edit budget."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


@follows
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """60 percent of the tokens, as the last stage counts them, at the target weights; no document twice."""
    prepare(spark)
    return mixing.mixed_rows(
        docs, mixing.domain_of(F.col("source")), tokenizer_file(), mixing.WEIGHTS, percent=60
    )


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files; return doc_id, start, n_tokens and ids_crc32 as read back from them."""
    prepare(spark)
    drop_scratch(spark, _LEFT)
    _LEFT.clear()  # the token files are the result
    path = scratch_path(spark, "pipeline-tokens")
    write_tokens(docs, path, tokenizer_file(), end_id=2)
    return read_documents(spark, path)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

# Language scores, edit distances and token ids are beyond SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
