"""A training corpus in five stages, each over all that the one before kept.

    quality classifier -> exact dedup -> n-gram near dedup -> mix of sources -> packed sequences

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result to the
shared folder and reads it back, so a lost executor costs no more than the stage it was lost in. All
stages but the last return the columns of documents. Nulls, empty and repeated rows follow the
operators' docstrings; an empty table goes through as an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larder.llm import exact_dedup, ngram_join
from larder.llm.common import drop_written, materialize, table
from larder.llm.mil_quality import quality_scores
from larder.llm.mixing import mix_documents
from larder.llm.packing import pack
from larder.llm.queries import tokenizer_file


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good; it learns from the labels outside fold 0."""
    return quality_scores(docs, table(spark, sf_dir, "labels"), keep=True)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest."""
    return exact_dedup.keep_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the document with the smallest id."""
    return ngram_join.keep_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return pack(docs, tokenizer_file())


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        after = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if number:
            drop_written(docs)
        docs = after
    return docs
