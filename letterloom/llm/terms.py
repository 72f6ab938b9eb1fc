"""Terms of texts as bytes, and their counts by group with a combine inside each task."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c

FLUSH_TERMS = 300_000  # distinct terms a task holds before it sends their counts


def split_table(digits: bool) -> bytes:
    """Byte map that lowers A-Z and turns every ASCII byte that no term holds into a blank.

    Terms are runs of ASCII letters, of all characters beyond ASCII and, on demand, of digits.
    UTF-8 writes characters beyond ASCII with bytes of 128 and more only, so bytes can be mapped alone.
    """
    kept = bytes(range(128, 256)) + bytes(range(97, 123)) + (bytes(range(48, 58)) if digits else b"")
    return bytes(b if b in kept else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


LETTERS, WORDS = split_table(digits=False), split_table(digits=True)


def terms(text: str | None, table: bytes) -> list[bytes]:
    """All terms in order; a null or empty text has none."""
    return c.utf8(text).translate(table).split()


def term_counts(docs: DataFrame, keys: list[str], table: bytes) -> DataFrame:
    """(keys, term, tf, df) over string ``keys`` and ``text``, summed over all rows.

    ``tf`` counts occurrences and ``df`` rows that hold the term.  Each occurring key has a row with a
    null term, whose ``tf`` counts all terms and whose ``df`` counts rows with one or more.
    A task sends one row per distinct key and term that it has gathered, not one per occurrence.
    """
    names = [*keys, "term", "tf", "df"]
    types = [*[pa.string() for _ in keys], pa.string(), pa.int64(), pa.int64()]

    def packed(tf: dict[tuple, Counter], df: dict[tuple, Counter]) -> pa.RecordBatch:
        rows = [(key, term, n, df[key][term]) for key, counts in tf.items() for term, n in counts.items()]
        columns = [pa.array([r[0][k] for r in rows], pa.string()) for k in range(len(keys))]
        found = pa.array([r[1] for r in rows], pa.binary()).cast(pa.string())
        counts = [pa.array([r[k] for r in rows], pa.int64()) for k in (2, 3)]
        return pa.RecordBatch.from_arrays([*columns, found, *counts], schema=pa.schema(list(zip(names, types))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tf: dict[tuple, Counter] = {}
        df: dict[tuple, Counter] = {}
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(len(keys))]
            for row, text in enumerate(batch.column(len(keys)).to_pylist()):
                key = tuple(col[row] for col in columns)
                found = terms(text, table)
                if key not in tf:
                    tf[key], df[key] = Counter(), Counter()
                tf[key].update(found)
                df[key].update(set(found))
                tf[key][None] += len(found)
                df[key][None] += bool(found)
            if sum(map(len, tf.values())) > FLUSH_TERMS:
                yield packed(tf, df)
                tf, df = {}, {}
        if tf:
            yield packed(tf, df)

    c.short_batches(docs.sparkSession)
    schema = ", ".join([*[f"`{k}` string" for k in keys], "term string, tf long, df long"])
    parts = docs.select(*keys, "text").mapInArrow(run, schema)
    return parts.groupBy(*keys, "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
