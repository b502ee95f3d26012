"""The corpus pipeline: documents to packed training sequences in five stages, each over all the one before kept."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import langid, linededup, mixing, nearjoin, packing
from sheaf.llm.common import scratch_folder
from sheaf.llm.queries import held_out, tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language the model knows; rejected ones go, so do those without text or letter.

    The model is fitted on the labelled documents of this stage's input, those held out for measuring apart.
    """
    model = langid.fit(docs.select("doc_id", "text", "lang").where(~held_out()))
    return langid.identified_only(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; one goes if that leaves it no word."""
    return linededup.remaining_documents(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return nearjoin.distinct_documents(docs, percent=80)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("lines", without_repeated_lines),
    ("near_duplicates", one_of_near_duplicates),
    ("mixture", mixed_sources),
    ("packing", packed),
]

# SimHash, MinHash and random rounding have no counterpart in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{scratch_folder(spark)}/pipeline-{uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
