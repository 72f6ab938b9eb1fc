"""CSV records that span lines, read by as many tasks as the file has byte ranges.

Lines are read by Spark's text source, which cuts files at any byte and gives each line to the range
that it starts in.  Whether a range starts inside a quoted field follows from the parity of the
quotes before it.  So a first pass counts lines and quotes per range, running sums over the ranges of a file
give each range its state, and a second pass numbers the records.  A record of one line, as most are, is
parsed where it is; only the lines of longer ones are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from letterloom.operators.skew import stage

MAX_LINES = 100_000  # a longer record has lost its closing quote; it counts as malformed
RANGE = ["file", "block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value", quotes.cast("long").alias("quotes"),
    )


def _range_counts(lines: DataFrame) -> DataFrame:
    """(file, block, n, quotes, even): a range's lines, quotes, and lines before which it has an even number of quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, seen, even = None, 0, 0, 0
        out: list[tuple] = []
        for batch in batches:
            files, blocks, quotes = batch.column(0).to_pylist(), np.asarray(batch.column(1)), np.asarray(batch.column(2))
            changes = [i for i in range(1, len(files)) if blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
            for a, b in zip([0, *changes], [*changes, len(files)]):
                if a == b:
                    continue
                if (files[a], int(blocks[a])) != now:
                    if now:
                        out.append((*now, n, seen, even))
                    now, n, seen, even = (files[a], int(blocks[a])), 0, 0, 0
                before = seen + np.cumsum(quotes[a:b]) - quotes[a:b]
                even += int((before % 2 == 0).sum())
                n, seen = n + b - a, seen + int(quotes[a:b].sum())
        if now:
            out.append((*now, n, seen, even))
        columns = list(zip(*out)) or [()] * 5
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=[*RANGE, "n", "quotes", "even"])

    return lines.select(*RANGE, "quotes").mapInArrow(run, "file string, block long, n long, quotes long, even long")


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(file, record, lines, text): the records of quoted CSV files in order, without headers and empty lines.

    Quotes inside fields are doubled.  ``text`` is null for a record of more than ``MAX_LINES`` lines.
    """
    lines = _lines(spark, path)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # ranges, not rows
    ranges = _range_counts(lines).withColumn("open", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    ranges = ranges.withColumn("starts", F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("n") - F.col("even")))
    ranges = ranges.withColumn("base", F.coalesce(F.sum("starts").over(earlier), F.lit(0)))
    ranges = stage(ranges.select(*RANGE, "open", "base"), "csv-ranges")
    inside = Window.partitionBy(*RANGE).orderBy("at")
    before = F.col("open") + F.sum("quotes").over(inside) - F.col("quotes")
    placed = lines.join(ranges, RANGE).withColumn("starts", (before % 2 == 0).cast("long"))
    placed = placed.withColumn("record", F.col("base") + F.sum("starts").over(inside))
    placed = placed.where("record > 1") if header else placed
    whole = placed.where("starts = 1 and quotes % 2 = 0").select("file", "record", F.lit(1).cast("long").alias("lines"), F.col("value").alias("text"))
    parts = placed.where("starts = 0 or quotes % 2 = 1")
    sizes = parts.groupBy("file", "record").agg(F.count(F.lit(1)).alias("lines"))
    long = sizes.where(F.col("lines") > MAX_LINES).select("file", "record", "lines", F.lit(None).cast("string").alias("text"))
    parts = parts.join(long.select("file", "record"), ["file", "record"], "left_anti")
    pieces = F.array_sort(F.collect_list(F.struct("block", "at", "value")))
    joined = parts.groupBy("file", "record").agg(F.count(F.lit(1)).alias("lines"), F.array_join(F.transform(pieces, lambda x: x["value"]), "\n").alias("text"))
    every = whole.unionByName(joined).unionByName(long)
    every = every.withColumn("text", F.regexp_replace("text", "\r$", ""))
    return every.where("text is null or text <> ''")


def read_multiline_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Rows of ``schema``; fields may span lines.  Malformed records have nulls where they do not fit, as in Spark's own reader."""
    return parse_records(read_records(spark, path, header), schema).select(*schema.fieldNames())


def parse_records(records: DataFrame, schema: T.StructType) -> DataFrame:
    """``records`` with the columns of ``schema`` and ``malformed``: too long, or not of these fields and types."""
    bad = "_bad"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    row = F.from_csv("text", F.lit(wide.toDDL()), options)
    parsed = records.withColumn("_row", row)
    malformed = F.col("text").isNull() | F.col("_row")[bad].isNotNull()
    return parsed.select("file", "record", *[F.col("_row")[n].alias(n) for n in schema.fieldNames()], malformed.alias("malformed"))
