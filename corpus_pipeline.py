"""From documents to packed training sequences, in five stages of llm operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from factloom.llm import mixing, near_dedup, packing, quality_rules, secrets
from factloom.llm.common import read, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go. Null text has no words and goes; repeated rows are judged alike; no rows give none."""
    return quality_rules.filter_documents(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8. Texts without words and rows without an id stay; of rows that repeat an id one stays."""
    return near_dedup.keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; all documents stay, with null texts as they are. Without a match of the fixed patterns nothing is learned and nothing cut."""
    return secrets.redact_secrets(docs, secrets.fit(docs))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate draws it, in random order; copies are equal rows. A null source is one of its own. A column of any name in docs stays."""
    number = "copy"
    while number in docs.columns:
        number += "_"
    return mixing.mix(docs, copy_column=number).drop(number)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of 2048 tokens; null text is the end id alone, and each copy of a document has pieces of its own."""
    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER), table_chunks=packing.SMALL_TABLE_CHUNKS)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources", mixed_sources),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, "pipeline-stage")
    return docs


#: Tagging by a fitted model and tokenizing are beyond SQL; tests hold the stages against a brute-force version.
ORACLE_SQL = None
