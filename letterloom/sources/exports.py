"""Sinks: feature tables, predictions and edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterloom.operators.baselines import printed_predictions
from letterloom.operators.reshape import relabel

RATIO_COLUMNS = ("OUT_ratio", "OUT_ratio_recent", "IN_ratio", "IN_ratio_recent")


def write_features(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def read_features(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Feature table written by ``write_features``; the schema is never inferred."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_predictions(ranked: DataFrame, path: str) -> None:
    """CSV ``mid,recipients`` with recipients space-joined in rank order."""
    printed_predictions(ranked).write.option("header", True).csv(path)


def write_edge_list(edges: DataFrame, ids: DataFrame, path: str) -> None:
    """Text lines ``from to weight`` with dense node ids from ``ids`` (user, id)."""
    named = relabel(relabel(edges, "src", ids), "dst", ids)
    named.select(F.concat_ws(" ", "src", "dst", "weight")).write.text(path)
