"""Training-data pipeline: each stage is one of the package's operators applied to all that the last one kept.

A null text is an empty one for every stage, and stays null where a document passes.  Repeated rows are
near duplicates of each other, so one of them stays.  An empty table passes all stages.  Texts are whole,
whatever their length.  Other columns travel along, also under names that operators use inside, up to the last
stage, which returns ids and token ids only.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.llm import automaton, boosting, bpe, chosen_path, pii
from letterloom.llm.common import drop_stage, short_batches, stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _packed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and all other columns in one, where no operator's columns can clash with them."""
    short_batches(docs.sparkSession)
    others = [F.col(name) for name in docs.columns if name not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("rest"))


def _unpacked(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in their order."""
    return packed.select(*[F.col(n) if n in ("doc_id", "text") else F.col("rest")[n].alias(n) for n in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled ones among ``docs``."""
    trees = boosting.fit(docs, table(spark, sf_dir, "labels"))
    scored = boosting.score(_packed(docs), trees)
    return _unpacked(scored.where(F.col("quality_score") >= boosting.THRESHOLD), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-copy links connect, the one with the least id."""
    return _unpacked(chosen_path.keep_one(_packed(docs)), docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    found = automaton.hits(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(found.where(~F.col("contaminated")), docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark of its kind in place of each personal span."""
    return _unpacked(pii.redact(pii.find(_packed(docs), pii.fit(docs))), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token count and token ids, as bytes of little-endian 32-bit integers, of every document."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_documents(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("private_data", private_data),
    ("tokens", tokens),
]
ORACLE_SQL = None  # a learned model has no SQL form; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    written: list[DataFrame] = []
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        drop_stage(*written)
        written = [docs]
    return docs
