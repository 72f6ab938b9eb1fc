"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown in numpy on a bounded sample of labelled rows, then flattened into arrays
that map tasks walk for a whole batch and all trees at once.
"""

from __future__ import annotations

import operator
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c

SAMPLE_ROWS = 20_000  # labelled rows a fit reads at most
THRESHOLD = 0.3

_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~{}[]=+/\\_", np.uint8)
_POINTS = np.frombuffer(b".,;:!?", np.uint8)
FEATURES = (
    "log_bytes", "log_words", "log_lines", "word_bytes", "distinct_words", "top_word", "repeated_next", "distinct_lines",
    "symbols", "points", "exclamations", "bars", "digits", "upper", "non_ascii", "spaces", "long_words", "line_words",
    "words_in_distinct_lines", "distinct_pairs",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, whatever its length; all zero for an empty text."""
    data = c.utf8(text)
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, count = len(data), np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    m = len(words)
    lines = [x for x in data.split(b"\n") if x]
    distinct_lines = set(lines)
    top = max(Counter(words).values())
    repeated = sum(map(operator.eq, words, words[1:]))
    sizes = np.fromiter(map(len, words), np.int64, m)
    letters = int(sizes.sum())
    pairs = len(set(zip(words, words[1:]))) / max(m - 1, 1)
    return [
        np.log1p(n), np.log1p(m), np.log1p(len(lines)), letters / m, len(set(words)) / m, top / m, repeated / m,
        len(distinct_lines) / max(len(lines), 1), count[_SYMBOLS].sum() / letters, count[_POINTS].sum() / letters,
        count[33] / letters, count[124] / letters, count[48:58].sum() / letters, count[65:91].sum() / letters,
        count[128:].sum() / letters, 1 - letters / n, float((sizes > 20).mean()), m / max(len(lines), 1),
        sum(map(len, distinct_lines)) / n, pairs,
    ]


@dataclass
class Trees:
    """Complete binary trees of one depth as arrays: split feature and threshold per node, value per leaf."""

    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        margin = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        if inner and len(self.feature):
            rows, tree = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            while node[0, 0] < inner if len(node) else False:
                right = x[rows, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            margin = margin + self.leaf[tree, node - inner].sum(1)
        return 1 / (1 + np.exp(-margin))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0
) -> Trees:
    """Boosted trees on logistic loss; every level's splits come from one histogram per node.

    Without rows, or with one class only, the score is a constant.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if len(np.unique(y)) < 2:
        return Trees(feature[:0], threshold[:0], leaf[:0], base)
    n, f = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(f)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    flat = code + np.arange(f) * bins  # one histogram holds all features
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (f * bins) + flat).ravel()
            g = np.bincount(cell, np.repeat(grad, f), width * f * bins).reshape(width, f, bins).cumsum(2)
            h = np.bincount(cell, np.repeat(hess, f), width * f * bins).reshape(width, f, bins).cumsum(2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < 1e-3) | (h_all - h < 1e-3)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    feature[t, first + k], threshold[t, first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > threshold[t, node])
        at = node - inner
        leaf[t] = rate * np.bincount(at, grad, leaves) / (np.bincount(at, hess, leaves) + ridge)
        margin += leaf[t, at]
    return Trees(feature, threshold, leaf, base)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id is in fold 0, which is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)), F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fits on at most ``sample_rows`` labelled documents outside fold 0, picked by the hash of their id.

    An id with several labels takes their rounded mean; null labels do not count.  Repeated rows of a
    labelled id each count, up to twice as many rows as labels; texts are whole, whatever their length.
    """
    marked = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold() != 0))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.round(F.avg("quality")).alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    picked = c.documents(docs).join(F.broadcast(marked), "doc_id")  # at most sample_rows small rows
    stats = c.map_rows(
        picked, lambda r: (r["doc_id"], r["_label"], statistics(r["text"])), "doc_id long, label double, stats array<double>"
    )
    stats = stats.orderBy(F.xxhash64("doc_id"), "doc_id", "stats").limit(2 * sample_rows)
    rows = sorted((r["doc_id"], r["label"], tuple(r["stats"])) for r in stats.collect())
    x = np.array([r[2] for r in rows], float).reshape(len(rows), len(FEATURES))
    return fit_trees(x, np.array([r[1] for r in rows], float))


def score(docs: DataFrame, trees: Trees, column: str = "quality_score") -> DataFrame:
    """``docs`` with the score of its ``text`` column as ``column``; all other columns stay.

    A null or empty text is scored too, as a text without words.
    """
    docs = docs.drop(column)
    schema = docs.withColumn(column, F.lit(0.0)).schema
    sent = docs.sparkSession.sparkContext.broadcast(trees)  # 80 trees of depth 4: some 20 kB

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            x = np.array([statistics(t.as_py()) for t in texts], float).reshape(batch.num_rows, len(FEATURES))
            scores = pa.array(sent.value.score(x), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, column])
        c.give_back()

    return docs.mapInArrow(run, schema)


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, whether it was held out, score and predicted label.

    Repeated rows have equal results; columns besides id and text play no part.
    """
    scored = score(c.documents(docs), fit(docs, labels), "score")
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
