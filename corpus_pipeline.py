"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import stored, table
from lodeplane.llm.decontam import clean_of_benchmark
from lodeplane.llm.langid import in_known_language
from lodeplane.llm.ngram_join import one_of_each
from lodeplane.llm.packing import pack, tokenizer_file
from lodeplane.llm.pii import without_personal_data
from lodeplane.session import bounded_batches


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the models know; what they reject goes."""
    return in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return clean_of_benchmark(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what discloses it taken out of their texts."""
    return without_personal_data(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 tokens."""
    pieces = pack(docs.select("doc_id", "text"), tokenizer_file(), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    """The stage, in a session with a bound of its Arrow batches."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language_id", _bounded(language)),
    ("ngram_jaccard_join", _bounded(near_duplicates)),
    ("benchmark_decontamination", _bounded(decontamination)),
    ("pii", _bounded(personal_data)),
    ("packing", _bounded(packing)),
]

#: Language models, MinHash groups and packing aren't expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
