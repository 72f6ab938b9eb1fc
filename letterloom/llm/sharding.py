"""Shards that all have the mixture of sources of the whole table, by proportional stratified interleaving.

Rows are shuffled by a seeded digest and ranked within their source.  Rank r of n rows becomes the
fraction (2r - 1) / 2n, so each source is spread evenly over 0 to 1.  All rows in order of their
fraction are cut into shards whose row counts are at most one apart.  Up to any cut a source has
within half a row of its share, so no shard is more than a row off, besides the cut's own rounding.

Both ranks come from range partitions: rows are numbered inside a slice, and the row counts of
earlier slices are added.  So no task holds a source, whatever its share.  Only keys and sizes
are sorted, no texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c
from letterloom.operators.skew import rank_within

SHARDS = 40
SEED = 11
ROW_BYTES = 16  # of a row besides its text


def _facts(docs: DataFrame, row: Column) -> DataFrame:
    """``doc_id, source, size, text_crc32, row`` of each row, written once."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("source", F.lit("")).alias("source"),
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        row.alias("row"),
    )
    return c.stage(narrow, "shard-facts")


def _placed(facts: DataFrame, shards: int, seed: int) -> DataFrame:
    """``facts`` with ``shard`` and ``slot``."""
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    facts = facts.withColumn("digest", F.md5(F.concat_ws(":", F.lit(seed), id_text, "size", "text_crc32")))
    ranked = rank_within(facts, ["source"], ["digest", "doc_id", "row"], rank="nth", size="of")
    ranked = ranked.withColumn("fraction", (2 * F.col("nth") - 1) / (2 * F.col("of"))).drop("digest", "of")
    placed = rank_within(ranked, [], ["fraction", "source", "nth"], rank="place", size="total")
    placed = placed.withColumn("shard", F.expr(f"int((place - 1) * {shards} div total)"))
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return placed.withColumn("slot", F.col("place") - 1 - first)


def shard_report(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row, under the law ``rows``.

    ``size`` is the text's UTF-8 bytes plus 16, a null text has none.  A null source is a source
    named ''.  Repeated rows are rows of their own, whose places may be swapped; a null doc_id
    is an id like any other.  An empty table gives no rows, fewer rows than shards leave shards
    empty.  Long texts cost their digest only; other columns play no part, whatever they are named.
    """
    placed = _placed(_facts(docs, F.monotonically_increasing_id()), shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes all columns of ``docs`` under ``path/shard=N``, in files that follow each other in slot order."""
    row, packed = "row", F.struct(*[F.col(n) for n in docs.columns]).alias("all")
    kept = c.stage(docs.select(F.monotonically_increasing_id().alias(row), packed), "shard-rows")
    facts = kept.select(row, *[F.col("all")[n].alias(n) for n in ("doc_id", "source", "text")])
    placed = _placed(_facts(facts, F.col(row)), shards, seed).select(row, "shard", "slot")
    joined = placed.join(kept, row).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    taken = {n.lower() for n in docs.columns}
    if "shard" in taken:
        raise ValueError("the column shard names the folders; rename the one that documents have")
    joined.select("shard", *[F.col("all")[n].alias(n) for n in docs.columns]).write.partitionBy("shard").parquet(path)
    c.drop_stage(kept)
