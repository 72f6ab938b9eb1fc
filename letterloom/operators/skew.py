"""Building blocks that keep hot keys spread over many tasks.

One sender, recipient or term may own a third of all rows.  A plain window
partitioned by such a key would sort that third in one task, and a plain join
would build it in one task.  The helpers here avoid both.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

_local_root: dict[str, str] = {}


def stage_root(spark: SparkSession) -> str:
    """This application's folder for stage tables, under the shared ``spark.checkpoint.dir``.

    Where that is unset, a local session, of which driver and executors are one process, gets
    a folder of its own that goes with the process; a cluster must set it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/letterloom-{sc.applicationId}"
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _local_root:
        _local_root[sc.applicationId] = tempfile.mkdtemp(prefix="letterloom-")
        atexit.register(shutil.rmtree, _local_root[sc.applicationId], ignore_errors=True)
    return _local_root[sc.applicationId]


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and go on from the written table.

    Cuts the lineage, survives lost executors, and lets several readers see the
    very same rows.  ``drop_stages`` removes the tables.  Spark deletes what was shuffled for a table when the
    driver collects its garbage; a driver of small plans hardly ever does, so it is told to.
    """
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    let_go(df.sparkSession)
    return staged


def let_go(spark: SparkSession) -> None:
    """Collects the driver's garbage, twice, as what refers to shuffles goes first and they themselves go next."""
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.05)


def drop_path(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    with contextlib.suppress(Exception):  # a folder that is gone is no fault
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stage(staged: DataFrame) -> None:
    """Deletes one stage table, once nothing that is still to run reads it."""
    for file in staged.inputFiles()[:1]:
        drop_path(staged.sparkSession, file.rsplit("/", 1)[0])


def drop_stages(spark: SparkSession) -> None:
    """Deletes all stage tables of this application; call it when the results were read."""
    drop_path(spark, stage_root(spark))


def spread_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by ``keys`` over all shuffle partitions, which adaptive execution then leaves as they are.

    It merges partitions by their packed bytes, and millions of small rows make little of those.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


AUTO = "auto"


def hot_keys(df: DataFrame, keys: Sequence[str], slices: str = "_slices") -> DataFrame:
    """Keys that own more than one shuffle partition's fair share of the rows.

    Each comes with the number of fair shares it fills.  By pigeonhole there are
    fewer hot keys than shuffle partitions, whatever the data size, so the table
    is safe to broadcast.  Counts and the filter run in parallel; only hot keys move on.
    ``df`` is read once more for it, so give a narrow table with the same keys where there is one.
    """
    fan = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * fan > total).select(*keys, F.ceil(F.col("_n") * fan / total).cast("int").alias(slices))


def _deal(df: DataFrame, keys: list[str], hot: DataFrame, slices: str, place: str, by: Sequence[str]) -> DataFrame:
    """Rows with their slice, by a hash of ``by``; cold keys have one slice."""
    joined = df.join(F.broadcast(hot), keys, "left")
    n = F.coalesce(F.col(slices), F.lit(1))
    return joined.withColumn(place, F.pmod(F.xxhash64(*by), n).cast("int")).drop(slices)


def _repeat(df: DataFrame, keys: list[str], hot: DataFrame, slices: str, place: str) -> DataFrame:
    """Rows once for each slice of their key."""
    joined = df.join(F.broadcast(hot), keys, "left")
    last = F.coalesce(F.col(slices), F.lit(1)) - 1
    return joined.withColumn(place, F.explode(F.sequence(F.lit(0), last))).drop(slices)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    hot: DataFrame | str = AUTO,
    right_spread: Sequence[str] | None = None,
) -> DataFrame:
    """Equi join with hot keys on either side, as one plan.

    Left rows of a hot key are dealt over its slices by a hash of ``spread``, and right rows
    are repeated for each slice.  With ``right_spread`` (inner joins) right rows of keys that are
    hot on the right are dealt over slices of their own, so that the two deals make a grid;
    without it the right side has one row, or few, per key.  Cold keys take slice 0.
    ``hot`` is the result of ``hot_keys`` for the left side.  It may come from a narrower table, and
    may be keyed by some of the keys only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how} would repeat unmatched right rows")
    if right_spread and how != "inner":
        raise ValueError("right rows are dealt out in inner joins only")
    keys = list(keys)
    hot = hot_keys(left, keys) if isinstance(hot, str) else hot
    measured = hot.columns[:-1]
    if not set(measured) <= set(keys):
        measured, hot = keys, hot.toDF(*keys, "_slices")
    on = [*keys, "_slice"]
    dealt = _deal(left, measured, hot, "_slices", "_slice", spread)
    repeated = _repeat(right, measured, hot, "_slices", "_slice")
    if right_spread:
        right_hot = hot_keys(right, keys, "_right_slices")
        repeated = _deal(repeated, keys, right_hot, "_right_slices", "_right_slice", right_spread)
        dealt = _repeat(dealt, keys, right_hot, "_right_slices", "_right_slice")
        on.append("_right_slice")
    return dealt.join(repeated, on, how).drop("_slice", "_right_slice")


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    rank: str = "rank",
    size: str | None = None,
) -> DataFrame:
    """1-based rank of each row in its key group, for groups of any size.

    Rows are range-partitioned on (keys, order), so a hot group becomes many
    contiguous slices.  Rows are numbered inside their slice, and the row counts
    of earlier slices of the group (one small row per slice and key) are added.
    The ranged rows are staged since both steps must see the same slices.
    ``size`` also returns the group's row count.  Rows with null keys form a group.
    """
    keys = list(keys)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    ranged = (
        df.repartitionByRange(*[F.col(k) for k in keys], *order)
        .withColumn("_slice", F.spark_partition_id())
    )
    ranged = stage(ranged, "ranged")
    per_slice = ranged.groupBy("_slice", *keys).agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        "_slice",
        *keys,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(group).alias(size or "_size"),
    )
    if not keys:
        offsets = F.broadcast(offsets)  # one row per slice
    local = Window.partitionBy("_slice", *keys).orderBy(*order)
    renamed = {k: f"_key{i}" for i, k in enumerate(["_slice", *keys])}
    offsets = offsets.withColumnsRenamed(renamed)
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(other)) for k, other in renamed.items()])
    out = ranged.withColumn("_local", F.row_number().over(local)).join(offsets, same)
    out = out.withColumn(rank, F.col("_before") + F.col("_local"))
    return out.drop("_slice", "_local", "_before", "_size", *renamed.values())


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per group.

    The ``rank <= k`` filter right on the window lets Spark cut each group to k
    rows before the shuffle, so a hot group sends k rows per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
