"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes of the UTF-8 bytes, taken at the anchors of ``repeats``, are sorted by most
significant digits of eight bytes, and only as far as a window of ``WINDOW_BYTES`` reaches.
After each pass a suffix that is alone in its group is done; what still shares a group at a
window's depth is a repeated window.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from letterloom.llm import common as c
from letterloom.llm.repeats import Members, Orders, Reader, depths, merged_spans, with_spans

WINDOW_BYTES = 100
PREFIX_BYTES = 24
DIGIT = 8


def radix_order(key: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Rows by key and then by the bytes of ``matrix``, a digit per pass, most significant first."""
    width = -(-matrix.shape[1] // DIGIT) * DIGIT
    padded = np.zeros((len(matrix), width), np.uint8)
    padded[:, : matrix.shape[1]] = matrix
    digits = padded.view(">u8").astype(np.uint64)
    order = np.argsort(key, kind="stable")
    start = np.append(True, key[order][1:] != key[order][:-1])
    for k in range(digits.shape[1]):
        alone = start & np.append(start[1:], True)
        active = np.flatnonzero(~alone)
        if not len(active):
            break
        group = np.cumsum(start)[active]
        rows = order[active]
        rows = rows[np.lexsort((digits[rows, k], group))]
        order[active] = rows
        digit = digits[rows, k]
        start[active[1:]] |= digit[1:] != digit[:-1]
    return order


def _bytes_of(texts: list[bytes], first: np.ndarray, step: int, size: np.ndarray, width: int) -> np.ndarray:
    """Matrix of ``size`` bytes of each text from ``first`` on, forwards or backwards; zeros behind them."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum([0, *(len(t) for t in texts)])[:-1] + first
    column = np.arange(width)
    inside = column < size[:, None]
    out = np.zeros(inside.shape, np.uint8)
    out[inside] = flat[(begin[:, None] + step * column)[inside]]
    return out


def radix_orders(members: Members) -> Orders:
    high, size = members.high, np.array([len(t) for t in members.text])
    right = _bytes_of(members.text, high, 1, size - high, WINDOW_BYTES - int(members.low.min()))
    left = _bytes_of(members.text, high - 1, -1, high, int(high.max()))
    by_right, by_left = radix_order(members.key, right), radix_order(members.key, left)
    return Orders(by_right, depths(by_right, members.key, right), by_left, _left_depths(by_left, members.key, left))


def _left_depths(order: np.ndarray, key: np.ndarray, left: np.ndarray) -> np.ndarray:
    if left.shape[1]:
        return depths(order, key, left)
    return np.append(-1, np.where(np.diff(key[order]) == 0, 0, -1))


READER = Reader(
    width=WINDOW_BYTES, gram=PREFIX_BYTES, parse=c.utf8,
    symbols=lambda data: np.frombuffer(data, np.uint8).astype(np.uint64),
    cut=lambda data, a, b: data[a:b], order=radix_orders,
)


def kept_bytes(text: str, spans: list[int]) -> bytes:
    data = c.utf8(text)
    edges = [0, *spans, len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def byte_string_report(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, removed bytes and runs, and a digest of what is left.

    A null text is empty.  A cut may fall inside a character, so what is left is bytes.  Texts are whole; very
    long ones are taken in overlapping segments with the same result.  Columns besides id and text play no part.
    """

    def digest(row: dict) -> tuple:
        spans = merged_spans(row["spans"])
        kept = kept_bytes(row["text"], spans)
        removed = sum(spans[1::2]) - sum(spans[::2])
        return row["doc_id"], len(kept) + removed, removed, len(spans) // 2, c.sha(kept)

    found, _ = with_spans(docs, READER)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return c.map_rows(found.select("doc_id", "text", "spans"), digest, schema)
