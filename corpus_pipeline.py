"""A corpus, cleaned and packed for training, stage by stage.

Each stage works on what the one before kept. All but the last return rows of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, language_id, packing, passages, simhash_dedup
from tidemark.llm.stage import Run, bounded_batches

#: Probability from which on a document counts as written in the language found.
MIN_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned; others, and texts without a letter, go."""
    bounded_batches(spark)
    return language_id.accepted(docs, language_id.fit(docs), MIN_SCORE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, by an index that starts empty."""
    run = Run(spark, "pipeline-exact")
    return exact_dedup.kept(run, docs, exact_dedup.fresh(run))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return simhash_dedup.kept(Run(spark, "pipeline-near"), docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents of smaller id have."""
    return passages.without_passages(Run(spark, "pipeline-passages"), docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of the documents goes."""
    return packing.packed(Run(spark, "pipeline-packing"), docs, public_tokenizers.path(packing.TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact copies", exact),
    ("near copies", near),
    ("repeated passages", repeats),
    ("sequences", sequences),
]

# No SQL: fingerprints, chains, the language model and token ids are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents of ``sf_dir``; each is written before the next reads it."""
    written = Run(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        docs = written.written(stage(spark, docs, sf_dir), f"stage-{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
