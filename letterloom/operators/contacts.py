"""Who wrote to whom: counts, books, contact sets, graphs and candidates.

All take a flat log (sender, recipient, mid, ...) unless they say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.operators.skew import hot_keys, rank_within, skew_join, spread_out, top_k

LIST = 10_000  # contacts that a message meets as one list


def pair_messages(flat: DataFrame, n: str = "n") -> DataFrame:
    """Distinct messages per (sender, recipient).

    Rows are hardly ever repeated, so they are counted where they were moved to and not before: a hash table of a
    join's rows takes many times their size.  They go to all shuffle partitions, since small rows are
    otherwise merged into few.
    """
    keys = ["sender", "recipient"]
    spread = spread_out(flat.select(*keys, "mid"), [*keys, "mid"])
    once = spread.groupBy(*keys, "mid").agg(F.max(F.when(F.col("mid").isNotNull(), 1).otherwise(0)).cast("bigint").alias("_one"))
    return once.groupBy(*keys).agg(F.sum("_one").alias(n))


def user_messages(flat: DataFrame, role: str = "sender", n: str = "n") -> DataFrame:
    """Distinct messages per sender, or per recipient."""
    return flat.groupBy(role).agg(F.count_distinct("mid").alias(n))


def last_time(flat: DataFrame) -> DataFrame:
    return flat.groupBy("sender", "recipient").agg(F.max("time").alias("last_time"))


def address_counts(flat: DataFrame) -> DataFrame:
    """How often each sender wrote to each recipient; repeats in a message count."""
    return flat.groupBy("sender", "recipient").agg(F.count(F.lit(1)).alias("n"))


def address_book(flat: DataFrame) -> DataFrame:
    """Address counts with the recipient's place in the sender's book."""
    return rank_within(address_counts(flat), ["sender"], [F.desc("n"), F.asc("recipient")])


def address_book_head(flat: DataFrame, k: int) -> DataFrame:
    """The first ``k`` entries of every book, without ranking the rest."""
    return top_k(address_counts(flat), ["sender"], [F.desc("n"), F.asc("recipient")], k)


def contacts_sent(flat: DataFrame) -> DataFrame:
    """(user, contact): everybody a user ever wrote to."""
    return flat.select(F.col("sender").alias("user"), F.col("recipient").alias("contact")).distinct()


def contacts_all(flat: DataFrame) -> DataFrame:
    """(user, contact): everybody a user wrote to or heard from."""
    back = flat.select(F.col("recipient").alias("user"), F.col("sender").alias("contact"))
    return flat.select(F.col("sender").alias("user"), F.col("recipient").alias("contact")).union(back).distinct()


def all_users(flat: DataFrame) -> DataFrame:
    return flat.select(F.col("sender").alias("user")).union(flat.select("recipient")).distinct()


def messages_in_order(flat: DataFrame, keys: list[str]) -> DataFrame:
    """Message list of each group as keyed rows (group, pos, mid); repeats are kept.

    A list of rows instead of an array, since one group may hold a third of the log.
    """
    return rank_within(flat.select(*keys, "mid"), keys, ["mid"], rank="pos")


def edges(flat: DataFrame) -> DataFrame:
    """Directed graph: weight is the number of times src wrote to dst."""
    return address_counts(flat).select(
        F.col("sender").alias("src"), F.col("recipient").alias("dst"), F.col("n").alias("weight")
    )


def edge_dates(flat: DataFrame) -> DataFrame:
    """Every date of every edge in order: (src, dst, occ, seq, date)."""
    rows = flat.select(F.col("sender").alias("src"), F.col("recipient").alias("dst"), "date", "mid")
    ranked = rank_within(rows, ["src", "dst"], ["date", "mid"], rank="seq", size="occ")
    return ranked.select("src", "dst", "occ", "seq", "date")


def neighbors(edge_rows: DataFrame, directed: bool = False) -> DataFrame:
    """(user, contact): successors, or both ends' neighbours when undirected."""
    out = edge_rows.select(F.col("src").alias("user"), F.col("dst").alias("contact"))
    if not directed:
        out = out.union(edge_rows.select("dst", "src"))
    return out.distinct()


def candidates(messages: DataFrame, contacts: DataFrame) -> DataFrame:
    """Each message with every contact of its sender; unknown senders get none.

    A heavy sender's messages, and the contacts of one with many, are dealt over slices.
    """
    right = contacts.withColumnRenamed("user", "sender")
    return skew_join(messages, right, ["sender"], spread=["mid"], right_spread=["contact"])


def contacts_minus_recipients(messages: DataFrame, contacts: DataFrame, flat: DataFrame) -> DataFrame:
    """(mid, contact): contacts of the sender that did not get the message.

    A message takes the list of its recipients along and meets lists of up to about ``LIST`` contacts, so neither its candidates
    nor what is left of them move.  A contact is in the list that its hash says, and a message's recipients go
    with it in lists by the same hash.  ``contacts`` has a pair once.
    """
    contacts = contacts.select(F.col("user").alias("sender"), "contact")
    lists = contacts.groupBy("sender").agg(F.ceil(F.count(F.lit(1)) / LIST).cast("int").alias("_lists")).where("_lists > 1")
    lists = F.broadcast(lists)  # of them there are fewer than contacts / LIST

    def place(contact: Column) -> Column:
        return F.pmod(F.xxhash64(contact), F.col("_lists")).cast("int")

    held = contacts.join(lists, "sender", "left").na.fill(1, ["_lists"]).withColumn("_list", place(F.col("contact")))
    held = held.groupBy("sender", "_list").agg(F.collect_list(F.struct("contact")).alias("_contacts"))  # a struct, as lists leave out nulls

    same = F.col("recipient").cast(contacts.schema["contact"].dataType).alias("recipient")
    got = flat.select("mid", same).where("recipient is not null").groupBy("mid").agg(F.collect_set("recipient").alias("_got"))
    asked = messages.select("sender", "mid").join(got, "mid", "left").join(lists, "sender", "left").na.fill(1, ["_lists"])
    asked = asked.withColumn("_list", F.explode(F.sequence(F.lit(0), F.col("_lists") - 1)))
    own = F.when(F.col("_lists") > 1, F.filter("_got", lambda c: place(c) == F.col("_list"))).otherwise(F.col("_got"))
    none = F.array().cast(got.schema["_got"].dataType)
    asked = asked.select("sender", "_list", "mid", F.coalesce(own, none).alias("_got"))
    met = skew_join(asked, held, ["sender", "_list"], spread=["mid"], hot=hot_keys(messages, ["sender"]))
    return met.select("mid", F.explode(F.array_except(F.col("_contacts.contact"), "_got")).alias("contact"))


def messages_to_user(nested: DataFrame, user: str) -> DataFrame:
    return nested.where(F.array_contains("recipients", user))


def keep_messages(df: DataFrame, kept: DataFrame) -> DataFrame:
    return df.join(kept.select("mid"), "mid", "left_semi")


def users_without(flat: DataFrame, role: str) -> DataFrame:
    """Users of the log that never appear in ``role`` (sender or recipient)."""
    other = "recipient" if role == "sender" else "sender"
    seen = flat.select(F.col(other).alias("user")).distinct()
    return seen.join(flat.select(F.col(role).alias("user")).distinct(), "user", "left_anti")
