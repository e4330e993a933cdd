"""Corpus pipeline over ``documents``: (name, function) stages.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  A stage works on all that the one
before kept; ``run`` writes each stage's result below ``spark.checkpoint.dir``
and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martforge.llm import bpe, decontaminate, lines, quality, simhash
from martforge.llm.common import read, stage
from martforge.llm.queries import tokenizer_path


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (operator 4)."""
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one (operator 9).
    ``n_chars`` keeps the length of the original text."""
    return lines.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (operator 3)."""
    return simhash.keep_one(docs, words=3, max_bits=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 10)."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of ids and decoded text (operator 6)."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [
    ("quality", drop_low_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("bpe", tokenize),
]

#: SQL expresses neither the classifier nor the fuzzy joins nor the tokenizer;
#: tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
