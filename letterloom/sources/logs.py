"""Message logs from CSV: index (sender, ids) and info (mid, date, body, recipients)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterloom.functions import addresses as ad
from letterloom.operators.reshape import explode_list
from letterloom.sources.multiline import read_multiline_csv

INDEX_SCHEMA = T.StructType([T.StructField("sender", T.StringType()), T.StructField("mids", T.StringType())])
TEST_INFO_SCHEMA = T.StructType(
    [T.StructField("mid", T.LongType()), T.StructField("date", T.StringType()), T.StructField("body", T.StringType())]
)
INFO_SCHEMA = T.StructType([*TEST_INFO_SCHEMA.fields, T.StructField("recipients", T.StringType())])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Quoted CSV with a header and doubled quotes.

    With ``multi_line`` fields may span lines; a large file is still read by many tasks.
    """
    if multi_line:
        return read_multiline_csv(spark, path, schema)
    return spark.read.schema(schema).option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, INDEX_SCHEMA, multi_line=False)  # ids hold no line breaks


def read_info(spark: SparkSession, path: str, with_recipients: bool = True) -> DataFrame:
    return read_csv(spark, path, INFO_SCHEMA if with_recipients else TEST_INFO_SCHEMA)


def split_index(index: DataFrame, row: Column | None = None) -> DataFrame:
    """Index rows to (sender, mid, row, pos): one row per listed id.

    ``row`` orders the index rows among each other, by default by their first id.
    """
    ids = index.select(
        "sender",
        ad.split_ids(F.col("mids")).alias("_ids"),
        (row if row is not None else F.element_at(ad.split_ids(F.col("mids")), 1)).alias("row"),
    )
    return ids.select("sender", "row", F.posexplode("_ids").alias("pos", "mid"))


def dedupe_first(log: DataFrame) -> DataFrame:
    """One row per (sender, body, date, recipients): the first in (row, pos) order.

    ``min_by`` merges on the map side, so a large group of copies never has to
    meet in one task.
    """
    subset = ["sender", "body", "date", "recipients"]
    first = log.groupBy(*subset).agg(F.min(F.struct("row", "pos", "mid")).alias("_first"))
    return first.select(*subset, "_first.row", "_first.pos", "_first.mid")


def load_log(index: DataFrame, info: DataFrame, train: bool = True, flat: bool = False) -> DataFrame:
    """Index and info to a clean log, nested or (``flat``) one row per recipient.

    Dates are repaired before duplicates are dropped.  Test logs (``train=False``)
    keep duplicates and have no recipients.
    """
    log = split_index(index).join(info, "mid").withColumn("date", ad.repair_date(F.col("date")))
    cols = ["sender", "mid", "date", "body"]
    if train:
        log = dedupe_first(log).withColumn("recipients", ad.glue_recipients(F.col("recipients")))
        cols.append("recipients")
    log = log.select(*cols).withColumn("date", F.to_timestamp_ntz(F.col("date")))
    if train and flat:
        log = explode_list(log, "recipients", "recipient")
    return log


def stack_bodies(*infos: DataFrame) -> DataFrame:
    """Bodies of several info tables under each other, by mid."""
    out = infos[0].select("mid", "body")
    for info in infos[1:]:
        out = out.unionByName(info.select("mid", "body"))
    return out
