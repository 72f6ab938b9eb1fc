"""Model-free rankings: (mid, rank, contact) rows, and their printed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.operators.contacts import address_book_head
from letterloom.operators.reshape import seeded_order
from letterloom.operators.skew import hot_keys, rank_within, skew_join, stage, top_k


def hash_long(*parts: Column | str, seed: int, tag: str) -> Column:
    """Non-negative 60-bit number from an md5, the same in every engine."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    text = F.concat_ws("|", F.lit(f"{seed}{tag}"), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def ring_stride(mid: str, size: Column, draws: Column, seed: int) -> Column:
    """Step for ``draws`` picks from a ring of ``size``: start + i * step never meets itself."""
    room = F.greatest(F.floor((size - 1) / F.greatest(draws - 1, F.lit(1))), F.lit(1))
    return 1 + hash_long(mid, seed=seed, tag="step") % room


def frequency_baseline(train_flat: DataFrame, messages: DataFrame, k: int = 10) -> DataFrame:
    """The sender's k most frequent recipients, for each message."""
    book = address_book_head(train_flat, k).select("sender", "rank", F.col("recipient").alias("contact"))
    asked = messages.select("mid", "sender")
    return skew_join(asked, book, ["sender"], spread=["mid"]).select("mid", "rank", "contact")


def random_baseline(messages: DataFrame, users: DataFrame, k: int = 10, seed: int = 42) -> DataFrame:
    """k different users per message, drawn from all users.

    Users are shuffled and numbered once; a message picks numbers around that
    ring with its own start and step and looks them up, so messages never meet
    all users.
    """
    ring = rank_within(users, [], [seeded_order("user", seed=seed), F.col("user")], rank="_idx")
    ring = stage(ring.select((F.col("_idx") - 1).alias("_idx"), F.col("user").alias("contact")), "user-ring")
    size = ring.agg(F.count(F.lit(1))).scalar()
    draws = (
        messages.select("mid", size.alias("_size"))
        .withColumn("_picks", F.least(F.col("_size"), F.lit(k).cast("bigint")))
        .withColumn("_step", ring_stride("mid", F.col("_size"), F.col("_picks"), seed))
        .withColumn("_start", hash_long("mid", seed=seed, tag="start"))
        .where("_picks > 0")
        .withColumn("rank", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_picks"))))
        .withColumn("_idx", (F.col("_start") % F.col("_size") + (F.col("rank") - 1) * F.col("_step")) % F.col("_size"))
    )
    return draws.join(ring, "_idx").select("mid", "rank", "contact")


def topic_address_book(flat: DataFrame, scores: DataFrame) -> DataFrame:
    """(sender, recipient, topic, score): topic scores summed over the pair's messages."""
    return (
        flat.select("sender", "recipient", "mid")
        .join(scores, "mid")
        .groupBy("sender", "recipient", "topic")
        .agg(F.sum("score").alias("score"))
    )


def topic_book_ranked(book: DataFrame) -> DataFrame:
    return rank_within(book, ["sender", "topic"], [F.desc("score"), F.asc("recipient")])


def topic_rank(messages: DataFrame, scores: DataFrame, book: DataFrame, k: int = 10) -> DataFrame:
    """Top k recipients by the product of book score and message score, summed over topics.

    The topic count is small and fixed, so book and scores are joined as one
    array per pair and per message.
    """

    def vector(df: DataFrame, keys: list[str], name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("topic", "score"))).alias(name))

    asked = messages.select("mid", "sender").join(vector(scores, ["mid"], "_m"), "mid")
    pairs = vector(book, ["sender", "recipient"], "_b")
    dot = F.aggregate(
        F.map_entries("_b"), F.lit(0.0),
        lambda acc, e: acc + e["value"] * F.coalesce(F.element_at(F.col("_m"), e["key"]), F.lit(0.0)),
    )
    hot = hot_keys(messages, ["sender"])
    scored = skew_join(asked, pairs, ["sender"], spread=["mid"], hot=hot, right_spread=["recipient"]).select(
        "mid", F.col("recipient").alias("contact"), F.round(dot, 9).alias("score")
    )
    return top_k(scored, ["mid"], [F.desc("score"), F.asc("contact")], k)


def printed_predictions(ranked: DataFrame) -> DataFrame:
    """(mid, recipients): contacts joined by spaces in rank order, at most k per message."""
    return (
        ranked.groupBy("mid")
        .agg(F.sort_array(F.collect_list(F.struct("rank", F.col("contact").cast("string").alias("contact")))).alias("_r"))
        .select("mid", F.array_join(F.col("_r.contact"), " ").alias("recipients"))
    )
