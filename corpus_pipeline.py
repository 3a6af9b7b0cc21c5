"""The corpus pipeline: five stages over ``documents``, each on all that its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All stages but
the last return the columns of documents. ``run`` writes each stage as Parquet under the shared
checkpoint folder and reads it again for the next one, which cuts lineage and survives lost executors.

Every stage passes rows with null columns, empty and very long texts, repeated rows and extra columns
through its operator; an empty table stays empty. What an operator does with each case stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm import dartminhash, decontaminate, mixing, toxicity
from tagweave.llm.common import fresh, materialize, table
from tagweave.llm.queries import encode_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the compression-distance classifier does not call toxic.

    All labelled documents among ``docs`` may be learnt from: the stage filters, nothing is measured on it.
    """
    return toxicity.clean_documents(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id; rows without a doc_id stay.

    Rows with the same doc_id are one document and stay or go together.
    """
    key = fresh(docs, "gone")
    gone = materialize(dartminhash.near_duplicates(docs).where(~F.col("kept")).select(
        F.col("doc_id").alias(key)).distinct(), "near-duplicates")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(key), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark item in their text."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated to the target mixture of sources, in shuffled order."""
    number = fresh(docs, "copy_no")
    return mixing.mix_sources(docs, copy_column=number).drop(number)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all texts, read back: ``(doc_id, start, n_tokens, ids_crc32)`` for each row."""
    return encode_documents(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix),
    ("token_shards", encode),
]

#: The trained classifier and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
