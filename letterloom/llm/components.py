"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``child, parent`` with the least node of the component for every other node of it.

    ``edges`` has columns ``child, parent`` in any direction; loops, repeated rows and rows
    with a null are left out.  Each round is written to the shared folder, so a lost executor
    costs no more than a round.  A node's neighbours are only ever reduced to their minimum.
    """
    pairs = edges.where("child <> parent")
    current = c.stage(
        pairs.select(F.greatest("child", "parent").alias("child"), F.least("child", "parent").alias("parent")).distinct(),
        "components",
    )
    before = None
    while (now := _state(current)) != before:
        before = now
        both = current.unionByName(current.select(F.col("parent").alias("child"), F.col("child").alias("parent")))
        least = both.groupBy("child").agg(F.min("parent").alias("m")).select("child", F.least("child", "m").alias("m"))
        large = both.join(least, "child").where("parent > child").select(F.col("parent").alias("child"), F.col("m").alias("parent"))
        large = large.where("child <> parent").distinct()
        least = large.groupBy("child").agg(F.min("parent").alias("m"))
        small = large.join(least, "child").select(F.explode(F.array("child", "parent")).alias("child"), F.col("m").alias("parent"))
        following = c.stage(small.where("child <> parent").distinct(), "components")
        c.drop_stage(current)
        current = following
    return current
