"""From raw documents to packed token sequences: five stages, each written before the next reads it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import language_id, mixing, ngram_join, packing, suffix_dedup
from plumbline.session import checkpoint_folder


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go."""
    return language_id.known_language(docs)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles stays."""
    return ngram_join.one_of_each(docs, k=5, percent=80)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that occur twice are cut out."""
    return suffix_dedup.without_repeats(docs, length=200)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut down or repeated to their target weights."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(docs, length=2048)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_near_duplicates),
    ("suffix-array dedup", remove_repeated_strings),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None  # the language models, suffix sorting and the tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{i}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{i}")
    return docs
