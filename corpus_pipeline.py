"""A training corpus from ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet
below ``spark.checkpoint.dir`` and hands the written table to the next stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparesledger.llm import exact_dedup, language_id, near_dedup, packing, substring_dedup
from sparesledger.llm.common import read_documents, stored


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found: not those without letters, nor those on which no
    language has at least half of the posterior. The labels are learned from the corpus itself."""
    return language_id.keep_identified(docs, public_tokenizers.path("piece_bpe_32k.model"), least=0.5)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (A-Z lower-cased): the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, similarity 0.8."""
    return near_dedup.drop_near_copies(docs, words=5, percent=80)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 35-word windows that stand more than once."""
    return substring_dedup.drop_repeated(docs, window=35)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, with their ids, in sequences of at most 2048."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", identified), ("exact_dedup", exact), ("near_dedup", near), ("substring_dedup", passages),
          ("packing", packed)]

#: No SQL for language models, MinHash or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
