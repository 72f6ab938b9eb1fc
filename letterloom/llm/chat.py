"""Chat formatting with relational steps and SQL expressions only.

Turns are collected as structs, sorted, runs of one role are merged, and the merged
blocks are concatenated::

    <s>[ROLE]user[/ROLE]text[TURN]text</s><s>[ROLE]assistant[/ROLE]text</s>

A block of adjacent turns of one role has one role mark; ``[TURN]`` keeps its texts apart, so
every turn can be read back.  Inside roles and texts a backslash follows the first character
of each control string, and backslashes are doubled, which ``unescape`` undoes.

A conversation becomes one row of output, so its turns meet in one row by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, END, ROLE, ROLE_END, TURN = "<s>", "</s>", "[ROLE]", "[/ROLE]", "[TURN]"
# Control strings of this template and of others that a reader of the output may know.
_CONTROL = r"([<\[])(?=(?:/?s>|/?ROLE\]|TURN\]|/?INST\]|</?SYS>>|unk>|pad>))"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(\\)|\\", "$1")


def merge_runs(turns: Column) -> Column:
    """Adjacent turns of one role as one (role, texts) block, in linear time.

    A block starts where the role differs from the one before; it ends before the next start.
    """
    starts = F.filter(
        F.transform(turns, lambda t, i: F.when((i == 0) | (F.get(turns, i - 1)["role"] != t["role"]), i)),
        lambda i: i.isNotNull(),
    )
    return F.transform(
        starts,
        lambda at, k: F.struct(
            turns[at]["role"].alias("role"),
            F.transform(
                F.slice(turns, at + 1, F.coalesce(F.get(starts, k + 1), F.size(turns)) - at), lambda t: t["text"]
            ).alias("texts"),
        ),
    )


def format_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, blocks, formatted`` of (conv_id, turn, role, text) rows.

    Rows are ordered by turn, then role and text, so ties and repeated rows have one order
    and all stay; a null turn comes first, a null role or text is empty, and rows with a
    null conv_id form a conversation.  Other columns are left out.
    """
    row = F.struct(
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    merged = sorted_turns.select("conv_id", merge_runs(F.col("turns")).alias("blocks"))
    texts = F.transform(
        "blocks",
        lambda b: F.concat(
            F.lit(BEGIN + ROLE), escape(b["role"]), F.lit(ROLE_END),
            F.array_join(F.transform(b["texts"], escape), TURN), F.lit(END),
        ),
    )
    return merged.select("conv_id", "blocks", F.array_join(texts, "").alias("formatted"))


def parse(formatted: Column) -> Column:
    """Array of (role, text, loss) turns read back from the output; loss marks assistant texts."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")

    def turns(block: Column) -> Column:
        body = F.substr(block, F.lit(1 + len(BEGIN + ROLE)))
        role = unescape(F.substring_index(body, ROLE_END, 1))
        text = F.substr(body, F.instr(body, ROLE_END) + len(ROLE_END))
        return F.transform(
            F.split(text, r"\[TURN\]", -1),
            lambda t: F.struct(role.alias("role"), unescape(t).alias("text"), (role == LOSS_ROLE).alias("loss")),
        )

    return F.flatten(F.transform(blocks, turns))


def chat_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: what reading the formatted string back gives."""
    read = format_conversations(turns).select("conv_id", "formatted", parse(F.col("formatted")).alias("read"))
    loss = F.array_join(F.transform(F.filter("read", lambda t: t["loss"]), lambda t: t["text"]), "")
    all_turns = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", "formatted", "read", loss.alias("loss_text"), all_turns.alias("all_turns")).select(
        "conv_id",
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2("all_turns", 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
