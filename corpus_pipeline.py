"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

Language identification drops texts of no known language, near-duplicate groups keep one document, repeated byte
strings are cut, documents with benchmark passages go, and what is left is encoded to ids.

Defined cases: a text that is null, empty or without a letter has no known language and goes in the first stage, as does
one whose best language has a pooled probability below 0.35. Rows without an id are in no near-duplicate group and keep
their repeated strings. Rows that share an id stay or go together as duplicates, and each keeps its own text. Columns
beside those of documents pass through all stages but the last, whatever they are called. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.llm import decontaminate, language, minhash, pieces, repeats
from narrata.llm.common import stage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, *language.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word shingles of five, similarity 0.8."""
    return minhash.remove(docs, size=5, threshold=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeats.remove(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("benchmark_passages", benchmark_passages),
    ("sentence_pieces", sentence_pieces),
]

#: Models, exact byte spans and tokenizer ids have no SQL form; tests/llm holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
