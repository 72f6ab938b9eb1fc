"""Removal of repeated word windows by prefix-partitioned suffix trees.

Suffixes of the word sequences, taken at the anchors of ``repeats``, are split by prefixes of
variable length into groups of bounded size.  Each group's subtree is held in its array form:
the suffixes in order, and between neighbours the depth of their lowest common node.  A
stretch of leaves whose neighbours meet at depth d or deeper is an internal node of that
depth; nodes at least as deep as the rest of a window are the repeats.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from letterloom.llm import common as c
from letterloom.llm.repeats import Members, Orders, Reader, depths, merged_spans, with_spans

WINDOW_WORDS = 20
PREFIX_WORDS = 5


def words_of(text: str) -> list[bytes]:
    return c.utf8(text).split()  # on space and U+0009 to U+000D


def _ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _leaves(key: np.ndarray, rows: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of the groups' subtrees in order, and the depth at which each meets the one before."""
    matrix = np.zeros((len(rows), width), np.uint64)
    sizes = np.array([len(r) for r in rows])
    matrix[np.arange(width) < sizes[:, None]] = np.concatenate(rows) if sizes.any() else []
    order = np.lexsort((*matrix.T[::-1], key)) if width else np.argsort(key, kind="stable")
    return order, depths(order, key, matrix) if width else np.append(-1, np.where(np.diff(key[order]) == 0, 0, -1))


def subtrees(members: Members) -> Orders:
    ids = [_ids(t.split()) for t in members.text]
    high, low = members.high.tolist(), members.low.tolist()
    right, right_depth = _leaves(members.key, [x[h:] for x, h in zip(ids, high)], WINDOW_WORDS - min(low))
    left, left_depth = _leaves(members.key, [x[:h][::-1] for x, h in zip(ids, high)], max(high))
    return Orders(right, right_depth, left, left_depth)


READER = Reader(
    width=WINDOW_WORDS, gram=PREFIX_WORDS, parse=words_of, symbols=_ids,
    cut=lambda words, a, b: b" ".join(words[a:b]), order=subtrees,
)


def kept_words(text: str, spans: list[int]) -> list[bytes]:
    words = words_of(text)
    for start, end in reversed(list(zip(spans[::2], spans[1::2]))):
        del words[start:end]
    return words


def substring_report(docs: DataFrame) -> DataFrame:
    """One row per document: words, removed words and a digest of the kept ones.

    Null and empty texts have no words.  Words are compared by 64-bit hashes.  Texts are whole; very long
    ones are taken in overlapping segments with the same result.  Columns besides id and text play no part.
    """

    def digest(row: dict) -> tuple:
        spans = merged_spans(row["spans"])
        removed = sum(spans[1::2]) - sum(spans[::2])
        kept = kept_words(row["text"], spans)
        return row["doc_id"], len(kept) + removed, removed, c.sha(b" ".join(kept))

    found, _ = with_spans(docs, READER)
    return c.map_rows(
        found.select("doc_id", "text", "spans"), digest, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
