"""Frequency and recency features of (user, contact) pairs.

Input is a flat log (sender, recipient, mid, time) with whole-second times, one
sender and one time per message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from letterloom.operators.contacts import last_time, pair_messages, user_messages
from letterloom.operators.skew import skew_join, stage

# Seconds per time block.  A user has at most this many distinct seconds in a
# block and one row per block of the log's life, so no window group grows with
# the number of messages.
BLOCK_SECONDS = 1 << 16
RECENT_ALPHA = 2

OUT, IN = ("sender", "recipient"), ("recipient", "sender")


def _roles(df: DataFrame, direction: tuple[str, str]) -> DataFrame:
    user, contact = direction
    return df.withColumnsRenamed({user: "user", contact: "contact"})


def _ratio(flat: DataFrame, horizon: Column | int, direction: tuple[str, str], name: str) -> DataFrame:
    early = flat.where(F.col("time") < horizon)
    pairs = _roles(pair_messages(early, "_pair"), direction)
    totals = user_messages(early, direction[0], "_all").withColumnRenamed(direction[0], "user")
    joined = skew_join(pairs, totals, ["user"], spread=["contact"])
    return joined.select("user", "contact", (F.col("_pair") / F.col("_all")).alias(name))


def out_ratio(flat: DataFrame, horizon: Column | int) -> DataFrame:
    """Share of the user's messages before ``horizon`` that went to the contact."""
    return _ratio(flat, horizon, OUT, "OUT_ratio")


def in_ratio(flat: DataFrame, horizon: Column | int) -> DataFrame:
    """Share of the user's received messages before ``horizon`` that the contact sent."""
    return _ratio(flat, horizon, IN, "IN_ratio")


def user_profile(flat: DataFrame, horizon: Column | int, role: str) -> DataFrame:
    """(user, time, since, early, all) for each second a user has messages in.

    ``since`` counts the user's messages in [time, horizon), ``early`` all before
    the horizon, ``all`` every one.  Messages are first counted per second.  The
    running count from the end is then the count inside the time block plus the
    totals of later blocks.
    """
    before = F.when(F.col("time") < horizon, F.col("_all")).otherwise(F.lit(0))
    per_second = (
        flat.groupBy(F.col(role).alias("user"), "time")
        .agg(F.count_distinct("mid").alias("_all"))
        .withColumn("_early", before)
        .withColumn("_block", F.floor(F.col("time") / BLOCK_SECONDS))
    )
    whole = Window.partitionBy("user")
    later = whole.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        per_second.groupBy("user", "_block")
        .agg(F.sum("_all").alias("_all"), F.sum("_early").alias("_early"))
        .select(
            "user",
            "_block",
            F.coalesce(F.sum("_early").over(later), F.lit(0)).alias("_later"),
            F.sum("_early").over(whole).alias("early"),
            F.sum("_all").over(whole).alias("all"),
        )
    )
    inside = (
        Window.partitionBy("user", "_block").orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        per_second.withColumn("_inside", F.sum("_early").over(inside))
        .join(blocks, ["user", "_block"])
        .select("user", "time", (F.col("_inside") + F.col("_later")).alias("since"), "early", "all")
    )


def _with_profile(pairs: DataFrame, profile: DataFrame) -> DataFrame:
    """Pairs with their user's counts as of the pair's last time."""
    profile = profile.withColumnRenamed("time", "last_time")
    return skew_join(pairs, profile, ["user", "last_time"], spread=["contact"])


def count_since_last(flat: DataFrame, horizon: Column | int, direction: tuple[str, str] = OUT) -> DataFrame:
    """(user, contact, last_time, n): the user's messages since the pair's last one.

    Outgoing counts what the user sent since it last wrote to the contact, incoming
    what it received since the contact last wrote.  A last time at or after the
    horizon counts 0.
    """
    last = _roles(last_time(flat), direction)
    joined = _with_profile(last, user_profile(flat, horizon, direction[0]))
    return joined.select("user", "contact", "last_time", F.col("since").alias("n"))


def _recent(flat: DataFrame, horizon: Column | int, direction: tuple[str, str], name: str) -> DataFrame:
    last = _roles(last_time(flat), direction)
    joined = _with_profile(last, user_profile(flat, horizon, direction[0]))
    return joined.select("user", "contact", (F.col("since") / (RECENT_ALPHA * F.col("all"))).alias(name))


def out_recent(flat: DataFrame, horizon: Column | int) -> DataFrame:
    """Messages sent since the last one to the contact, over twice all sent.

    Last time and total are not limited by the horizon.
    """
    return _recent(flat, horizon, OUT, "OUT_ratio_recent")


def in_recent(flat: DataFrame, horizon: Column | int) -> DataFrame:
    return _recent(flat, horizon, IN, "IN_ratio_recent")


def out_in(flat: DataFrame, horizon: Column | int) -> DataFrame:
    """Outgoing and incoming ratios side by side (full outer join), nulls kept."""
    return out_ratio(flat, horizon).join(in_ratio(flat, horizon), ["user", "contact"], "full")


def time_features(flat: DataFrame, horizon: Column | int) -> DataFrame:
    """(user, contact, OUT_ratio, OUT_ratio_recent, IN_ratio, IN_ratio_recent).

    Users who never sent get 1 in both OUT columns, users who never received get
    1 in both IN columns, everything else that is missing is 0.  Pair counts and
    last times are aggregated once and serve both directions; one profile per
    direction holds the running count and both totals.  Both are staged, as hot keys are counted on them: one plan
    would hold them many times over.
    """
    early_mid = F.when(F.col("time") < horizon, F.col("mid"))
    pairs = (
        flat.groupBy("sender", "recipient")
        .agg(F.count_distinct(early_mid).alias("_met"), F.max("time").alias("last_time"))
        .where("_met > 0")
    )
    pairs = stage(pairs, "time-pairs")

    def side(direction: tuple[str, str], names: tuple[str, str], flag: str) -> DataFrame:
        user, other = direction
        others = flat.select(F.col(other).alias("user")).distinct().withColumn(flag, F.lit(True))
        profile = stage(user_profile(flat, horizon, user), "time-profile")
        profile = stage(skew_join(profile, others, ["user"], spread=["time"], how="left"), "time-profile")
        joined = _with_profile(_roles(pairs, direction), profile)
        return joined.select(
            "user",
            "contact",
            (F.col("_met") / F.col("early")).alias(names[0]),
            (F.col("since") / (RECENT_ALPHA * F.col("all"))).alias(names[1]),
            F.coalesce(flag, F.lit(False)).alias(flag),
        )

    outgoing = side(OUT, ("OUT_ratio", "OUT_ratio_recent"), "_gets")
    incoming = side(IN, ("IN_ratio", "IN_ratio_recent"), "_sends")
    table = outgoing.join(incoming, ["user", "contact"], "full")

    def filled(name: str, other_role: str) -> Column:
        # a row without this side comes from the other one, which knows both roles
        return F.coalesce(name, F.when(F.col(other_role), 0.0).otherwise(1.0)).alias(name)

    return table.select(
        "user",
        "contact",
        filled("OUT_ratio", "_sends"),
        filled("OUT_ratio_recent", "_sends"),
        filled("IN_ratio", "_gets"),
        filled("IN_ratio_recent", "_gets"),
    )
