"""Vocabulary and sparse bag-of-words corpus as two tables under one path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VOCAB_SCHEMA = "term string, term_id int, df bigint"
CORPUS_SCHEMA = "mid bigint, term_id int, cnt bigint"


def write_corpus(vocab: DataFrame, corpus: DataFrame, path: str) -> None:
    vocab.write.parquet(f"{path}/vocab")
    corpus.write.parquet(f"{path}/corpus")


def read_corpus(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    read = spark.read
    return read.schema(VOCAB_SCHEMA).parquet(f"{path}/vocab"), read.schema(CORPUS_SCHEMA).parquet(f"{path}/corpus")
