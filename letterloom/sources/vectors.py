"""Text vectors: a header line ``count dim``, then ``id v1 .. vd`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.operators.reshape import name_back
from letterloom.operators.vectors import l2_unit


def write_vectors(vectors: DataFrame, path: str) -> None:
    """``vectors`` is (id, vector)."""
    header = vectors.agg(F.count(F.lit(1)).alias("_n"), F.max(F.size("vector")).alias("_d"))
    lines = vectors.select(F.concat_ws(" ", F.col("id").cast("string"), F.col("vector").cast("array<string>")).alias("value"))
    header.select(F.concat_ws(" ", "_n", "_d").alias("value")).union(lines).write.text(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """(id, vector) with unit-length rows; the header is the line of two whole numbers.

    Fields are split at any white space.  Numbers of vectors of length 1 need a decimal
    point, as ``write_vectors`` gives them, to be told from the header.
    """
    fields = F.filter(F.split("value", r"\s+"), lambda x: x != "")
    rows = spark.read.text(path).select(fields.alias("_f")).where(
        (F.size("_f") > 2) | ((F.size("_f") == 2) & ~F.get("_f", F.lit(1)).rlike("^[0-9]+$"))
    )
    vector = F.slice("_f", 2, F.size("_f") - 1).cast("array<float>").cast("array<double>")
    return rows.select(F.get("_f", F.lit(0)).cast("bigint").alias("id"), l2_unit(vector).alias("vector"))


def read_named_vectors(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """(user, vector): ids replaced by the names in ``ids`` (user, id)."""
    return name_back(read_vectors(spark, path), "id", ids).withColumnRenamed("id", "user")
