"""Corpus pipeline: five operators in a row, from documents to packed sequences.

1. ``language_id``: documents in no known language go; ``lang`` is the predicted one.
2. ``near_duplicates``: of each group of near-duplicates the document of least id stays.
3. ``repeated_passages``: passages of over 50 words that stand elsewhere too are cut out.
4. ``personal_data``: personal data is replaced by its kind in brackets.
5. ``packing``: what is left is tokenized and packed into sequences of 2048 tokens.

Each stage reads all that its predecessor kept. All but the last return the columns of
``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import jaccard_join, langid, packing, pii, suffix_dedup
from folio.llm.common import staged
from folio.session import read_table


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.known(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(spark, docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(suffix_dedup.removed(
        spark, docs, length=suffix_dedup.PASSAGE, unit=suffix_dedup.Words))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.redact(spark, docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: No stage but the checksums could be told in SQL; tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
