"""The corpus pipeline: five stages from the table of documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``docs``, whatever they are. A stage reads all that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenantflow.llm import exact_dedup, minhash, packing, pii, quality
from tenantflow.llm.inputs import default_tokenizer, read_table
from tenantflow.llm.queries import ship_package
from tenantflow.session import staged

#: Words that a worker of the last stage remembers; the workers of the other stages live beside it.
PACK_WORDS = 400_000


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the table of labels."""
    ship_package(spark)
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, white space aside."""
    return exact_dedup.first_of_each(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return minhash.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    ship_package(spark)
    return pii.mask_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with their tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, default_tokenizer(), with_ids=True, max_known=PACK_WORDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: SQL cannot score, tokenise or pack; the tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
