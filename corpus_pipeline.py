"""Corpus pipeline: quality filter, exact dedup, near-duplicate removal, packing.

Each stage is one operator of ``riskloom.llm`` over all rows that the stage
before kept, read back from the Parquet table that it was written to.  All but
the last return the columns of ``documents``, extra ones included, whatever
their names.  Null texts count as empty; an empty table passes through every
stage as one; texts of any length are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import exact_dedup, ngram_join, packing, quality
from riskloom.llm.common import written
from riskloom.llm.queries import WORD_BPE, importable
from riskloom.sources.tables import read_table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.7.

    A null text scores as an empty one; rows that repeat, or have no id, are
    scored each; labels other than 0 and 1, and those of held-out or unknown
    ids, are not learnt from; without labels of both kinds all rows stay."""
    importable(spark)
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id.

    Null and empty texts are equal; a null id is the largest; of rows that
    repeat the smallest id of a text one stays."""
    importable(spark)
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies (five-word shingles, Jaccard similarity of
    0.8 or more), the document with the smallest id.

    Texts without words are near to none and stay; a null id is the largest;
    rows that share an id but not a text are told apart, and of rows that
    repeat wholly one stays."""
    importable(spark)
    return ngram_join.one_per_group(docs, percent=80, words=5)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents in sequences of 4096 tokens: a row per piece.

    Null and empty texts are pieces of their end id alone; null ids stay null;
    repeated rows are packed each; other columns go."""
    importable(spark)
    return packing.pack(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("best-fit packing", best_fit_packing),
]

#: A fitted model and a tokenizer library are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of what all filters keep of ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
