"""From raw documents to token files, in five stages.

Each stage takes all documents that its predecessor kept and returns those it
keeps, with the columns of ``documents``; the last returns what its token files
hold. Stages are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparkmine.llm import decontaminate, language, mixing, simhash, tokens
from sparkmine.llm.queries import TOKENIZER
from sparkmine.llm.tables import file_place, prepare, table
from sparkmine.plans.workspace import materialize, new_path


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches; text without a letter goes."""
    prepare(spark)
    return language.recognised(docs, language.learn(docs))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    prepare(spark)
    return simhash.keep_one(docs, file_place())


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without(docs, table(prepare(spark), sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    return mixing.mixed(docs, file_place())


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and what they hold per document."""
    root = new_path(prepare(spark), "tokens")
    return tokens.read(tokens.write(docs, root, public_tokenizers.path(TOKENIZER)), root)


STAGES = [
    ("language", known_languages),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
    ("tokens", token_files),
]

# Fingerprints, classifiers and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
