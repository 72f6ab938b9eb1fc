"""Exploding, time axes, ids, sampling and pivoting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.operators.skew import rank_within, skew_join

DAY_SECONDS = 86400


def explode_list(df: DataFrame, col: str, new_col: str, cast: str | None = None) -> DataFrame:
    """One row per non-null element of ``col``; other columns are kept."""
    element = F.col("_e").cast(cast) if cast else F.col("_e")
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(col).alias("_e")).where("_e IS NOT NULL").select(*rest, element.alias(new_col))


def explode_computed(df: DataFrame, keep: Sequence[str | Column], array: Column | str, name: str, pos: str | None = None) -> DataFrame:
    """Explode of an array that is costly to compute and holds no nulls.

    For an inner explode Spark first filters on the array's size, which would compute
    the array a second time; an outer explode and a null test do not.
    """
    made = F.posexplode_outer(array).alias(pos, name) if pos else F.explode_outer(array).alias(name)
    return df.select(*keep, made).where(F.col(name).isNotNull())


def relative_time(log: DataFrame, mode: str = "seconds_of_day", date: str = "date", time: str = "time") -> DataFrame:
    """Whole seconds since the log's first date.

    ``elapsed`` counts all of them, ``seconds_of_day`` leaves whole days out.
    """
    if mode not in ("seconds_of_day", "elapsed"):
        raise ValueError(f"unknown time mode {mode}")
    origin = log.agg(F.min(date)).scalar()
    seconds = F.timestamp_diff("SECOND", origin, F.col(date))
    return log.withColumn(time, seconds if mode == "elapsed" else F.pmod(seconds, F.lit(DAY_SECONDS)))


def time_before(log: DataFrame, end: Column | int, time: str = "time") -> DataFrame:
    return log.where(F.col(time) < end)


def time_between(log: DataFrame, begin: Column | int, end: Column | int, time: str = "time") -> DataFrame:
    return log.where((F.col(time) >= begin) & (F.col(time) < end))


def dense_ids(values: DataFrame, col: str, id_col: str = "id") -> DataFrame:
    """Distinct values numbered 0..n-1 in sorted order."""
    ranked = rank_within(values.select(col).distinct(), [], [col], rank=id_col)
    return ranked.withColumn(id_col, F.col(id_col) - 1)


def relabel(df: DataFrame, col: str, ids: DataFrame, id_col: str = "id", name_col: str = "user") -> DataFrame:
    """Replace names in ``col`` by their dense id."""
    names = ids.select(F.col(name_col).alias(col), F.col(id_col).alias("_id"))
    out = skew_join(df, names, [col], spread=df.columns)
    return out.withColumn(col, F.col("_id")).select(*df.columns)


def name_back(df: DataFrame, col: str, ids: DataFrame, id_col: str = "id", name_col: str = "user") -> DataFrame:
    """Replace dense ids in ``col`` by the names they stand for."""
    return relabel(df, col, ids.select(F.col(name_col).alias(id_col), F.col(id_col).alias(name_col)), id_col, name_col)


def seeded_order(*cols: str, seed: int) -> Column:
    """Sort key that shuffles rows the same way on every run and engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def shuffle_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows drawn without replacement, in shuffled order."""
    return df.orderBy(seeded_order(key, seed=seed), key).limit(n)


def flatten_topics(scores: DataFrame, n_topics: int, key: str = "mid") -> DataFrame:
    """Long (key, topic, score) to one column per topic, 0 where a topic is missing."""
    one = [
        F.coalesce(F.max(F.when(F.col("topic") == t, F.col("score"))), F.lit(0.0)).alias(f"topic_{t}")
        for t in range(n_topics)
    ]
    return scores.groupBy(key).agg(*one)
