"""From documents to token files: five stages, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from epilake.llm.decontaminate import clean_documents
from epilake.llm.minhash import NearDuplicates, distinct_documents
from epilake.llm.mixing import Mixture, mixed_documents
from epilake.llm.quality import accepted_documents
from epilake.llm.queries import byte_tokenizer
from epilake.llm.tables import stored, table
from epilake.llm.token_files import TokenFiles, token_output


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels of ``docs``, accepts."""
    return accepted_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return distinct_documents(docs, NearDuplicates())


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten words in a row of a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixed_documents(docs, Mixture())


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    return token_output(docs, TokenFiles(byte_tokenizer(), added=True))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("token files", token_files),
]

#: A fitted classifier, MinHash and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
