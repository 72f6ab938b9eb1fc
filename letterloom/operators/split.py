"""Chronological train/dev split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.operators.skew import rank_within


def chrono_split(messages: DataFrame, percent: float = 0.2, small_groups: str = "dev") -> DataFrame:
    """Adds ``part``: each sender's last ``int(n * percent)`` messages are dev.

    Where that is 0, the whole group goes to ``small_groups``: "dev" as in the
    original slicing rule, or "train".
    """
    if small_groups not in ("dev", "train"):
        raise ValueError(f"small_groups must be dev or train, not {small_groups}")
    ranked = rank_within(messages, ["sender"], ["date", "mid"], rank="_rank", size="_n")
    n_dev = F.floor(F.col("_n") * F.lit(float(percent)))
    late = F.col("_rank") > F.col("_n") - n_dev
    if small_groups == "dev":
        late = late | (n_dev == 0)
    return ranked.withColumn("part", F.when(late, "dev").otherwise("train")).drop("_rank", "_n")
