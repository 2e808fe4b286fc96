"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
back as the next stage's docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, language, lines, mixing, simhash
from tidemark.llm.common import stored
from tidemark.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or a likely language go, null
    and empty texts among them. Repeated rows stay or go together; an empty table stays empty."""
    return language.keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier line repeats or nearly repeats."""
    return lines.deduplicated(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (null first). Null
    and empty texts are one group, repeated rows one document; an empty table stays empty."""
    return simhash.keep_one(docs, words_per_shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares of sources, languages and topics meet the targets. Null sources
    and languages are categories; repeated rows are drawn alike; an empty table stays empty."""
    return mixing.sampled(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the token ids of its whole text."""
    return bpe.encode(docs, tokenizer_path())


STAGES = [("language ID", language_id), ("line dedup", line_dedup),
          ("SimHash near-dedup", simhash_dedup), ("mixing", mix), ("BPE", encode)]

#: Learned models, hashed candidates and tokenizer files: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each stored before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
