"""Exact ranked search of many items over all documents at once, by two trees.

An item is a vector of term weights, a document one of term impacts, and a score their product.  Both
sides are put into trees whose nodes hold, per term, the largest value below them.  The product
of two nodes bounds the score of every item and document below them.  A pair of nodes whose
bound does not reach the weakest of its items' ten best scores so far is left out with all that lies
below; the others are opened, down to leaves, where scores are exact whole numbers.

Each task grows trees over its own documents, some thousands at a time, and keeps the best of
each item from tree to tree.  It sends at most ``top`` rows per item, which a window merges.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from letterloom.llm import common as c
from letterloom.llm.terms import WORDS, term_counts, terms

TOP = 10
LEAF, FAN = 16, 4  # rows of a leaf, and children of a node
CELLS = 4_000_000  # cells of the matrix of one tree
BLOCK_CHARS = 2_000_000  # characters of the items that one pass over the documents takes on
EXACT = 2**53  # whole numbers below it are exact in doubles


@dataclass
class Tree:
    """``levels`` run from the leaves to the root: the largest value per term of each node; ``order`` sorts rows into leaves."""

    order: np.ndarray
    levels: list[np.ndarray]


def _maxima(rows: np.ndarray, fan: int) -> np.ndarray:
    return np.maximum.reduceat(rows, np.arange(0, len(rows), fan), axis=0)


def grow(rows: np.ndarray, weight: np.ndarray) -> Tree:
    """Tree over ``rows``; rows whose heaviest terms agree lie side by side, so that maxima stay low."""
    shown, at = rows * weight, np.arange(len(rows))
    first = shown.argmax(1)
    shown[at, first] = 0
    order = np.lexsort((shown.argmax(1), first))
    levels = [_maxima(rows[order], LEAF)]
    while len(levels[-1]) > 1:
        levels.append(_maxima(levels[-1], FAN))
    return Tree(order, levels)


class Best:
    """The ``top`` best documents of each item: higher scores first, then lesser ids."""

    def __init__(self, n_items: int, top: int):
        self.score = np.zeros((n_items, top), np.int64)
        self.doc = np.full((n_items, top), c.NULL_ID, np.int64)
        self.top = top

    def weakest(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, items: np.ndarray, docs: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of each of ``items`` with each of ``docs``."""
        score = np.concatenate([self.score[items], scores], 1)
        doc = np.concatenate([self.doc[items], np.broadcast_to(docs, scores.shape)], 1)
        order = np.lexsort((doc, -score), axis=1)[:, : self.top]
        self.score[items], self.doc[items] = np.take_along_axis(score, order, 1), np.take_along_axis(doc, order, 1)


def search(items: np.ndarray, item_tree: Tree, impact: np.ndarray, docs: np.ndarray, doc_tree: Tree, best: Best) -> int:
    """Brings ``best`` up to date with the documents of one tree; returns the pairs of leaves that were scored.

    ``items`` and ``impact`` are matrices of doubles that hold whole numbers, with one column per term.
    """
    scored = 0
    whole = float(items.sum(1).max(initial=0) * impact.max(initial=0)) < EXACT
    slack = 1 if whole else 1 + 1e-9
    a, b = len(item_tree.levels) - 1, len(doc_tree.levels) - 1
    left, right = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        leaf_kth = np.minimum.reduceat(best.weakest()[item_tree.order], np.arange(0, len(items), LEAF))
        kth = leaf_kth
        for _ in range(a):
            kth = np.minimum.reduceat(kth, np.arange(0, len(kth), FAN))
        bound = np.empty(len(left))
        for node in np.unique(left):  # one product per item node and all document nodes that it still meets
            at = np.flatnonzero(left == node)
            bound[at] = doc_tree.levels[b][right[at]] @ item_tree.levels[a][node]
        keep = (bound * slack >= kth[left]) & (bound > 0)
        left, right, bound = left[keep], right[keep], bound[keep]
        if not len(left) or (a == 0 and b == 0):
            break
        if a and (a >= b):
            left, right = _open(left, right, len(item_tree.levels[a - 1]))
            a -= 1
        else:
            right, left = _open(right, left, len(doc_tree.levels[b - 1]))
            b -= 1
    for k in np.argsort(-bound, kind="stable"):  # likely pairs first, so that the others fall to better scores
        rows = item_tree.order[left[k] * LEAF : (left[k] + 1) * LEAF]
        if bound[k] * slack < best.weakest()[rows].min():
            continue
        columns = doc_tree.order[right[k] * LEAF : (right[k] + 1) * LEAF]
        some = np.flatnonzero(item_tree.levels[0][left[k]])
        x, y = items[np.ix_(rows, some)], impact[np.ix_(columns, some)]
        scores = (x @ y.T).astype(np.int64) if whole else x.astype(np.int64) @ y.astype(np.int64).T
        best.add(rows, docs[columns], scores)
        scored += 1
    return scored


def _open(nodes: np.ndarray, others: np.ndarray, n_below: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of all children of ``nodes`` with what each node was paired with."""
    below = nodes[:, None] * FAN + np.arange(FAN)
    real = below < n_below
    return below[real], np.repeat(others, FAN).reshape(-1, FAN)[real]


_KEEP: dict[str, tuple] = {}


def _prepared(key: str, rows: list[tuple]) -> tuple:
    """Term numbers, item keys, item matrix and item tree of a block; kept by the worker while it serves the block."""
    if key not in _KEEP:
        _KEEP.clear()
        number: dict[bytes, int] = {}
        for _, found, _ in rows:
            for term in found:
                number.setdefault(term.encode(), len(number))
        matrix = np.zeros((len(rows), max(1, len(number))))
        for k, (_, found, weights) in enumerate(rows):
            for term, weight in zip(found, weights):
                matrix[k, number[term.encode()]] = weight
        _KEEP[key] = number, [r[0] for r in rows], matrix, grow(matrix, np.ones(matrix.shape[1]))
    return _KEEP[key]


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 8 * m)."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def _doc_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """100 - 75 + ((75 * n * n_docs) div n_terms), in whole numbers of any size."""
    return np.array([25 + 75 * int(x) * n_docs // n_terms for x in n.tolist()], np.int64)


def search_block(docs: DataFrame, rows: list[tuple], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``item, doc_id, score`` of each task's best documents for items (key, terms, weights)."""
    sent, key = docs.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, keys, items, item_tree = _prepared(key, sent.value)
        best, weight = Best(len(keys), top), items.max(0, initial=0)
        step = max(LEAF, CELLS // items.shape[1])
        tf: list[tuple[int, int, int]] = []
        ids: list[int] = []
        sizes: list[int] = []

        def flush() -> None:
            if ids:
                row, column, n = np.array(tf, np.int64).reshape(-1, 3).T
                impact = np.zeros((len(ids), items.shape[1]))
                impact[row, column] = impacts(n, _doc_norm(np.array(sizes), n_docs, n_terms)[row])
                search(items, item_tree, impact, np.array(ids), grow(impact, weight), best)
                tf.clear(), ids.clear(), sizes.clear()

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms(text, WORDS)
                met = Counter(map(number.get, found))
                met.pop(None, None)
                if met:
                    tf.extend((len(ids), t, n) for t, n in met.items())
                    ids.append(c.NULL_ID if doc is None else doc)
                    sizes.append(len(found))
                if len(ids) >= step:
                    flush()
        flush()
        item, place = np.nonzero(best.score)
        columns = [pa.array(x, pa.int64()) for x in (np.array(keys, np.int64)[item], best.doc[item, place], best.score[item, place])]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each row of ``items`` with a score above 0.

    A null or empty text has no terms, so it is no document of the counts and no item.  Rows of
    ``items`` that agree in id and text are one item; rows that share an id only are ranked one by
    one, as are items without an id.  Repeated documents each take a place; a null doc_id comes
    after all others of its score.  Items go in blocks of ``BLOCK_CHARS`` characters, each one pass over the
    documents; texts are whole, whatever their length, and other columns play no part.
    """
    spark = docs.sparkSession
    docs = c.documents(docs)
    counts = c.stage(term_counts(docs, [], WORDS), "search-counts")
    whole = counts.where("term is null").agg(F.sum("df").alias("n"), F.sum("tf").alias("l")).first()
    n_docs, n_terms = whole["n"] or 0, whole["l"] or 0
    asked = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    asked = c.stage(asked.withColumn("item", F.xxhash64("item_id", "text")), "search-items")
    used = _item_terms(asked).join(counts.where("term is not null").select("term", "df"), "term")
    vectors = used.groupBy("item").agg(F.collect_list(F.struct("term", "n", "df")).alias("terms"))
    vectors = c.stage(vectors, "search-vectors")
    chars = vectors.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda acc, x: acc + F.octet_length(x["term"]) + 16)).alias("n")).first()["n"] or 0
    blocks = -(-chars // BLOCK_CHARS)
    found = []
    for k in range(blocks):
        block = vectors.where(F.pmod(F.xxhash64(F.lit(5), "item"), F.lit(blocks)) == k)
        rows = []
        for r in block.collect():  # BLOCK_CHARS characters or so
            weights = [t["n"] * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * t["df"] + 1))) for t in r["terms"]]
            rows.append((r["item"], [t["term"] for t in r["terms"]], weights))
        found.append(search_block(docs, sorted(rows), n_docs, n_terms, top))
    if not found:
        return asked.where("false").select("item_id", F.lit(1).alias("rank"), F.lit(1).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("score"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    place = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    first = every.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
    ids = asked.select("item", "item_id")
    doc = F.when(F.col("doc_id") != c.NULL_ID, F.col("doc_id"))
    return first.join(ids, "item").select("item_id", "rank", doc.alias("doc_id"), "score")


def _item_terms(asked: DataFrame) -> DataFrame:
    """``item, term, n`` of all items, in SQL expressions."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    return asked.select("item", F.explode(found).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("n"))
