"""Helpers shared by the text operators: keys, stage tables, Arrow batches and digests."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.operators.skew import stage_root

BATCH_ROWS = 1_000
NULL_ID = 2**63 - 1  # a null doc_id sorts after every other id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and goes on from the written table."""
    spark = df.sparkSession
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(*staged: DataFrame) -> None:
    """Deletes stage tables that later steps no longer read."""
    for df in staged:
        sc = df.sparkSession.sparkContext
        for file in df.inputFiles()[:1]:
            folder = sc._jvm.org.apache.hadoop.fs.Path(file).getParent()
            with contextlib.suppress(Exception):
                folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows at most in this session, as a text is a long row.

    A session that has a lesser setting keeps it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any table; a null text is an empty one, other columns are left out."""
    short_batches(df.sparkSession)
    return df.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def row_key() -> list[Column]:
    """Two 64-bit hashes of (doc_id, text).

    They stand for a row in joins: repeated rows share a key and so a result, rows with
    one doc_id and other texts are told apart, and a null doc_id has a key like any other.
    """
    return [
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64(F.lit(7), "text", "doc_id").alias("k2"),
    ]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {x.lower() for x in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def order_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column), F.lit(NULL_ID))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def give_back() -> None:
    """Hands memory that a task no longer uses back to the system, as the worker stays for the next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


BatchFn = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def map_rows(df: DataFrame, per_row: Callable[[dict], tuple], schema: str) -> DataFrame:
    """``per_row`` on each row as a dict, in Arrow batches; it returns the values of ``schema``."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = arrow_types(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i) for i in range(batch.num_columns)]
            keys = batch.schema.names
            out = []
            for i in range(batch.num_rows):
                out.append(per_row({k: c[i].as_py() for k, c in zip(keys, columns)}))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)
        give_back()

    return df.mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(),
    "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
}


def arrow_types(schema: str) -> list[pa.DataType]:
    return [_ARROW[f.split()[1]] for f in schema.split(", ")]
