"""The corpus pipeline: stages that each take the documents the stage before has kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Each result is written as Parquet to the shared folder and
read again as the next stage's documents. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.llm import langid, neardup, packing, quality, repeats
from tradelake.llm.queries import word_tokenizer
from tradelake.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, of which no language can be told. `lang` stays as it was."""
    found, name = langid.predict(docs, langid.fit(docs))
    return found.where(F.col(f"{name}.has_letters")).select(*docs.columns)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or come from a host most of whose documents fail.

    A null text has no words and so fails. Rows that agree are judged alike; an empty table gives an empty table.
    """
    found, name = quality.judge(docs)
    return found.where(F.col(f"{name}.kept")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of likeness 0.8 over 5 words.

    Rows without an id or without words stay. A row goes by its id and text, so where an id is on several texts, those
    that repeat nothing stay; rows that agree in both stay or go together. An empty table gives an empty table.
    """
    return neardup.keep_first(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated strings of bytes out of the texts; `n_chars` follows the text. No row is dropped."""
    found, name = repeats.remove_repeats(docs)
    return found.drop(name)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens from all documents, in pieces; a null text is packed as an empty one."""
    return packing.pack(docs, word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("quality", check_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", remove_repeats),
    ("packing", pack),
]

# SQL cannot express the stages: they learn models, hash and tokenize.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, from all stages one after another."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = materialize(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
