"""Finding windows of symbols that also start earlier, for texts of any size.

Two operators share the steps here and differ in what a symbol is and in how the suffixes of
a group are ordered.

1. Every window of ``width`` symbols has an *anchor*: the leftmost position inside it whose
   gram of ``gram`` symbols has the least hash.  Equal windows have equal anchors at equal
   offsets, so only suffixes at anchors are ordered, a few per window width.  Grams that
   occur once in all texts cannot lie in a repeated window, and their suffixes end here.
2. The other suffixes go, with the text of the windows they stand for, to the group of
   their prefix.  A prefix has ``gram`` symbols; where one group would exceed its share of a
   partition, the prefix is as long as the window.
3. Inside a group the suffixes are ordered to the right and the reversed texts to the left of
   the anchor.  A window is a stretch to both sides, so two windows are equal when they lie
   below one node of either order, and all but the earliest are removed.

Before each shuffle a task sends one record per distinct gram, and one per distinct
surrounding text; what it knows to be repeated is settled where it is.  So a passage that
a third of all texts share gives as many records as there are tasks, not as there are texts.

A position is (doc_id, start).  Rows that share doc_id and start are ties: neither is
earlier than the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c

CHUNK = 1_000_000  # symbols handled at once
SEGMENT = 8_000_000  # longest part of a text handled at once
FLUSH_RECORDS, FLUSH_BYTES = 400_000, 48_000_000  # what a task gathers before it sends
GROUP_ROWS = 40_000  # suffixes ordered at once, unless one group has more
HOT_SHARE, HOT_ROWS = 8, 3_000  # a gram is hot with more rows than both a share of a partition and this

_u64 = np.uint64


@dataclass(frozen=True)
class Reader:
    """What the symbols of a text are.

    ``symbols`` gives one 64-bit value per symbol; ``cut`` the bytes of symbols [a, b);
    ``order`` sorts groups of suffixes given as bytes.
    """

    width: int
    gram: int
    parse: Callable[[str], object]
    symbols: Callable[[object], np.ndarray]
    cut: Callable[[object, int, int], bytes]
    order: Callable[[Members], Orders]


@dataclass
class Members:
    """Suffixes of one or more groups: anchor position, windows at offsets ``low`` to ``high``, and their text."""

    key: np.ndarray
    doc: np.ndarray
    tag: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    text: list[bytes]

    def take(self, rows: np.ndarray) -> Members:
        cols = (self.key, self.doc, self.tag, self.at, self.low, self.high)
        return Members(*(x[rows] for x in cols), [self.text[i] for i in rows.tolist()])


@dataclass
class Orders:
    """For both sides: rows in order, and the symbols each shares with the row before it (-1: another group)."""

    right: np.ndarray
    right_depth: np.ndarray
    left: np.ndarray
    left_depth: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit hash of 64-bit values."""
    x = x ^ (x >> _u64(31))
    x = x * _u64(0x7FB5D329728EA185)
    x = x ^ (x >> _u64(27))
    x = x * _u64(0x81DADEF4BC2DD44D)
    return x ^ (x >> _u64(33))


def gram_hashes(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` symbols, by doubling."""
    factors = mix(np.arange(1, 130, dtype=_u64)) | _u64(1)
    out, have = None, 0
    power, span, level = mix(symbols + _u64(1)), 1, 0
    while True:
        if size & span:
            if out is None:
                out, have = power, span
            else:  # the part so far stands to the right of this one
                n = len(symbols) - have - span + 1
                out, have = power[:n] * factors[64 + level] + out[span : span + n], have + span
        if 2 * span > size:
            break
        n = len(power) - span
        power, span, level = power[:n] * factors[level] + power[span:], 2 * span, level + 1
    return mix(out)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    return np.minimum(x[:n], x[width - span : width - span + n])


@dataclass
class Anchors:
    """Anchors of some pieces: piece, position in its text, first and last window start, and gram hash."""

    piece: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray


def find_anchors(parts: list[np.ndarray], offsets: list[int], width: int, gram: int) -> Anchors:
    """Anchors of pieces of texts that start at ``offsets``; no window crosses pieces."""
    sizes = np.array([len(p) for p in parts])
    ends = sizes.cumsum()
    symbols = np.concatenate(parts)
    begin = ends - sizes
    starts = np.flatnonzero(np.repeat(ends, sizes) - np.arange(len(symbols)) >= width) if len(symbols) else np.zeros(0, int)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, none.astype(_u64))
    hashes = gram_hashes(symbols, gram)
    place = _u64((1 << 24) - 1)
    least = _sliding_min((hashes & ~place) | np.arange(len(hashes), dtype=_u64), width - gram + 1)
    anchor = (least[starts] & place).astype(np.int64)
    new = np.flatnonzero(np.diff(anchor, prepend=-1))
    last = np.append(new[1:], len(anchor)) - 1
    piece = np.searchsorted(ends, anchor[new], side="right")
    shift = np.array(offsets)[piece] - begin[piece]
    return Anchors(piece, anchor[new] + shift, starts[new] + shift, starts[last] + shift, hashes[anchor[new]])


def _chunks(rows: Iterator[tuple], reader: Reader) -> Iterator[tuple[list[tuple], Anchors]]:
    """Rows (doc, tag, text, ...) with their parsed text first, and the anchors of about ``CHUNK`` symbols."""
    pieces, parts, offsets, size = [], [], [], 0
    for row in rows:
        parsed = reader.parse(row[2])
        symbols = reader.symbols(parsed)
        for start in range(0, len(symbols) - reader.width + 1, SEGMENT):
            part = symbols[start : start + SEGMENT + reader.width - 1]
            pieces.append((parsed, *row))
            parts.append(part)
            offsets.append(start)
            size += len(part)
            if size >= CHUNK:
                yield pieces, find_anchors(parts, offsets, reader.width, reader.gram)
                pieces, parts, offsets, size = [], [], [], 0
    if pieces:
        yield pieces, find_anchors(parts, offsets, reader.width, reader.gram)


_LAYOUT = {"u8": "<u8", "i8": "<i8", "u4": "<u4", "u1": "u1"}


def pack(*arrays: tuple[str, np.ndarray]) -> bytes:
    """Columns one after another, compressed."""
    n = len(arrays[0][1])
    body = b"".join(x.astype(_LAYOUT[kind]).tobytes() for kind, x in arrays)
    return zstandard.compress(n.to_bytes(8, "little") + body, 3)


def unpack(data: bytes, kinds: tuple[str, ...]) -> tuple[list[np.ndarray], bytes]:
    """Columns of ``pack`` and the bytes behind them."""
    data = zstandard.decompress(data)
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        out.append(np.frombuffer(data, _LAYOUT[kind], n, at))
        at += n * int(_LAYOUT[kind][-1])
    return out, data[at:]


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            yield tuple(x[i].as_py() for x in columns)


def _blobs(part: np.ndarray, make: Callable[[np.ndarray], bytes]) -> pa.RecordBatch:
    order = np.argsort(part, kind="stable")
    parts, starts = np.unique(part[order], return_index=True)
    blobs = [make(rows) for rows in np.split(order, starts[1:])]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())], names=["part", "blob"])


_GRAM = ("u8", "i8", "i8", "u4", "u1")  # gram, doc, tag, position, state
_ONCE, _SEVERAL, _KNOWN = 0, 1, 2  # in this batch: once; several times, the first; several times, another
MARKS = "doc long, tag long, at long, gram long"


def alive_marks(docs: DataFrame, reader: Reader, parts: int) -> DataFrame:
    """(doc, tag, at) of anchors whose gram occurs more than once, and rows of hot grams.

    ``docs`` has ``doc, tag, text``.  Hot rows have a ``gram`` and nothing else; there are at most
    ``HOT_SHARE`` of them per part.
    """

    def send(batches):
        held, n = [], 0
        for pieces, a in _chunks(_rows(batches), reader):
            doc = np.array([p[1] for p in pieces], np.int64)[a.piece] if len(a.piece) else a.piece
            tag = np.array([p[2] for p in pieces], np.int64)[a.piece] if len(a.piece) else a.piece
            held.append((a.gram, doc, tag, a.at))
            n += len(a.at)
            if n >= FLUSH_RECORDS:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def flush(held):
        gram, doc, tag, at = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(gram, kind="stable")
        ranked = gram[order]
        first = np.append(True, ranked[1:] != ranked[:-1])
        many = ~(first & np.append(first[1:], True))
        state = np.empty(len(gram), np.uint8)
        state[order] = np.where(first, np.where(many, _SEVERAL, _ONCE), _KNOWN)
        part = np.where(state == _KNOWN, mix(tag.view(_u64)), gram) % _u64(parts)
        return _blobs(part, lambda r: pack(("u8", gram[r]), ("i8", doc[r]), ("i8", tag[r]), ("u4", at[r]), ("u1", state[r])))

    def settle(table: pa.Table) -> pa.Table:
        columns = [unpack(b, _GRAM)[0] for b in table.column("blob").to_pylist()]
        gram, doc, tag, at, state = (np.concatenate(x) for x in zip(*columns))
        known = np.flatnonzero(state == _KNOWN)
        asked = np.flatnonzero(state != _KNOWN)
        order = asked[np.argsort(gram[asked], kind="stable")]
        ranked = gram[order]
        start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(order) else np.zeros(0, int)
        size = np.diff(np.append(start, len(order)))
        several = np.add.reduceat(state[order].astype(np.int64), start) if len(start) else size
        alive = order[np.repeat((size > 1) | (several > 0), size)]
        hot = ranked[start][size > max(HOT_ROWS, len(order) // HOT_SHARE)] if len(start) else ranked
        rows = np.concatenate([known, alive])
        blank, none = pa.nulls(len(hot), pa.int64()), pa.nulls(len(rows), pa.int64())
        columns = [pa.concat_arrays([pa.array(x[rows].astype(np.int64)), blank]) for x in (doc, tag, at)]
        columns.append(pa.concat_arrays([none, pa.array(hot.view(np.int64))]))
        return pa.table(columns, names=["doc", "tag", "at", "gram"])

    sent = docs.mapInArrow(send, "part long, blob binary")
    return sent.groupBy("part").applyInArrow(settle, MARKS)


_MEMBER = ("u8", "i8", "i8", "u4", "u4", "u4", "u4")  # key, doc, tag, position, low, high, text bytes


def removed_spans(marked: DataFrame, reader: Reader, parts: int, hot: np.ndarray) -> DataFrame:
    """Spans [start, end) per text that windows which start earlier elsewhere cover, one a row.

    ``marked`` has ``doc, tag, text, marks`` with the positions of ``alive_marks``; ``span`` is
    start * 2^32 + end, as no text has 2^31 symbols.
    """
    width = reader.width
    hot = np.sort(hot)

    def send(batches):
        held, size = [], 0
        for pieces, a in _chunks((r for r in _rows(batches) if r[3]), reader):
            border = np.searchsorted(a.piece, np.arange(len(pieces) + 1))
            for i, p in enumerate(pieces):
                lo, hi = border[i], border[i + 1]
                live = np.zeros(int(a.at[hi - 1]) + 1 if hi > lo else 0, bool)
                marks = np.array(p[4])
                live[marks[marks < len(live)]] = True
                keep = lo + np.flatnonzero(live[a.at[lo:hi]])
                is_hot = hot[np.minimum(np.searchsorted(hot, a.gram[keep]), len(hot) - 1)] == a.gram[keep] if len(hot) else np.zeros(len(keep), bool)
                for k, wide in zip(keep.tolist(), is_hot.tolist()):
                    at, first, last = int(a.at[k]), int(a.first[k]), int(a.last[k])
                    if wide:  # the prefix of each window is the window itself
                        for s in range(first, last + 1):
                            text = reader.cut(p[0], s, s + width)
                            held.append((_whole_key(text), p[1], p[2], s, 0, 0, text))
                            size += len(text)
                    else:
                        text = reader.cut(p[0], first, last + width)
                        held.append((int(a.gram[k]), p[1], p[2], at, at - last, at - first, text))
                        size += len(text)
            if size >= FLUSH_BYTES or len(held) >= FLUSH_RECORDS:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    def flush(held):
        """One record per distinct text around an anchor; the later ones are settled and become spans."""
        earliest: dict[tuple, tuple[int, int]] = {}
        for key, doc, _, at, _, high, text in held:
            known = earliest.get((key, high, text))
            if known is None or (doc, at) < known:
                earliest[key, high, text] = doc, at
        later = np.array([(doc, at) > earliest[key, high, text] for key, doc, _, at, _, high, text in held], bool)
        key = np.array([h[0] for h in held], _u64)
        doc, tag, at, low, high = (np.array([h[k] for h in held], np.int64) for k in range(1, 6))
        part = np.where(later, mix(tag.view(_u64)), key) % _u64(parts)

        def make(rows):
            texts = [b"" if later[r] else held[r][6] for r in rows.tolist()]
            head = [("u8", key[rows]), ("i8", doc[rows]), ("i8", tag[rows]), ("u4", at[rows]), ("u4", low[rows]), ("u4", high[rows])]
            sizes = np.array([len(t) for t in texts])
            n = len(rows)
            body = b"".join(x.astype(_LAYOUT[kind]).tobytes() for kind, x in [*head, ("u4", sizes)])
            return zstandard.compress(n.to_bytes(8, "little") + body + b"".join(texts), 3)

        return _blobs(part, make)

    def settle(table: pa.Table) -> pa.Table:
        columns, texts = [], []
        for blob in table.column("blob").to_pylist():
            cols, rest = unpack(blob, _MEMBER)
            ends = np.cumsum(cols[6]).tolist()
            texts += [rest[a:b] for a, b in zip([0, *ends], ends)]
            columns.append(cols)
        key, doc, tag, at, low, high, size = (np.concatenate(x) for x in zip(*columns))
        at, low, high = at.astype(np.int64), low.astype(np.int64), high.astype(np.int64)
        done = np.flatnonzero(size == 0)
        spans = [(doc[done], tag[done], at[done] - high[done], at[done] - low[done] + width)]
        order = np.flatnonzero(size)
        order = order[np.argsort(key[order], kind="stable")]
        start = np.flatnonzero(np.append(True, np.diff(key[order]) != 0)) if len(order) else np.zeros(0, int)
        sizes = np.diff(np.append(start, len(order)))
        order = order[np.repeat(sizes > 1, sizes)]  # a prefix that turned out to be alone
        every = Members(key, doc, tag, at, low, high, texts)
        for rows in _group_slices(key[order]):
            spans.append(later_windows(every.take(order[rows]), reader))
        doc, tag, a, b = (np.concatenate(x) for x in zip(*spans))
        return pa.table([pa.array(doc), pa.array(tag), pa.array(a << 32 | b)], names=["doc", "tag", "span"])

    sent = marked.select("doc", "tag", "text", "marks").mapInArrow(send, "part long, blob binary")
    return sent.groupBy("part").applyInArrow(settle, "doc long, tag long, span long")


def _whole_key(text: bytes) -> int:
    return int.from_bytes(bytes.fromhex(c.sha(text)[:16]), "little")


def _group_slices(key: np.ndarray) -> Iterator[slice]:
    """Slices of sorted keys of about ``GROUP_ROWS`` rows that break at group borders only."""
    n, start = len(key), 0
    while start < n:
        end = min(n, start + GROUP_ROWS)
        if end < n:
            left = int(np.searchsorted(key, key[end], side="left"))
            end = left if left > start else int(np.searchsorted(key, key[end], side="right"))
        yield slice(start, end)
        start = end


def later_windows(members: Members, reader: Reader) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, tag, start, end) spans of windows that a member earlier in (doc, start) order has too.

    For the offset o of a window's anchor, two windows are equal if their members lie below
    one node of depth ``width - o`` to the right and one of depth o to the left.
    """
    n, width = len(members.key), reader.width
    orders = reader.order(members)
    by_place = np.lexsort((members.at, members.doc))
    new = (np.diff(members.doc[by_place], prepend=0) != 0) | (np.diff(members.at[by_place], prepend=0) != 0)
    rank = np.empty(n, np.int64)
    rank[by_place] = np.cumsum(new)
    hits: list[tuple[np.ndarray, np.ndarray]] = []
    node = np.empty(n, np.int64)
    other = np.empty(n, np.int64)
    for o in range(int(members.low.min()), int(members.high.max()) + 1):
        rows = np.flatnonzero((members.low <= o) & (o <= members.high))
        if len(rows) < 2:
            continue
        node[orders.right] = np.cumsum(orders.right_depth < width - o)
        other[orders.left] = np.cumsum(orders.left_depth < o)
        pair = node[rows] * (n + 1) + other[rows]
        order = np.lexsort((rank[rows], pair))
        pair, place = pair[order], rank[rows][order]
        first = np.append(True, pair[1:] != pair[:-1])
        late = place > place[np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]
        if late.any():
            hit = rows[order[late]]
            hits.append((hit, np.full(len(hit), o)))
    if not hits:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    row, o = (np.concatenate(x) for x in zip(*hits))
    order = np.lexsort((o, row))
    row, o = row[order], o[order]
    breaks = np.append(True, (row[1:] != row[:-1]) | (o[1:] != o[:-1] + 1))
    head = np.flatnonzero(breaks)
    tail = np.append(head[1:], len(row)) - 1
    row = row[head]
    return members.doc[row], members.tag[row], members.at[row] - o[tail], members.at[row] - o[head] + width


def depths(order: np.ndarray, key: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Leading columns of ``matrix`` that each row in ``order`` shares with the one before; -1 at group borders."""
    rows, before = matrix[order[1:]], matrix[order[:-1]]
    other = rows != before
    depth = np.where(other.any(1), other.argmax(1), matrix.shape[1])
    return np.append(-1, np.where(key[order[1:]] == key[order[:-1]], depth, -1))


def with_spans(docs: DataFrame, reader: Reader, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``doc_id, doc, tag, text, spans`` of every row, and the stage table to drop when it was read.

    ``docs`` has ``doc_id`` and ``text``.  ``parts`` groups of suffixes are dealt out, by default
    as many as there are shuffle partitions.
    """
    spark = docs.sparkSession
    parts = parts or c.shuffle_partitions(spark)
    keyed = c.documents(docs).select("doc_id", c.order_id().alias("doc"), F.xxhash64("text").alias("tag"), "text")
    marks = c.stage(alive_marks(keyed.select("doc", "tag", "text"), reader, parts), "repeat-marks")
    grams = marks.where(F.col("gram").isNotNull()).select("gram").collect()  # at most HOT_SHARE per part
    hot = np.array([r["gram"] for r in grams], np.int64).view(_u64)
    grouped = marks.where(F.col("gram").isNull()).groupBy("doc", "tag").agg(F.collect_list("at").alias("marks"))
    marked = keyed.join(grouped, ["doc", "tag"], "left").select("doc", "tag", "text", "marks", "doc_id")
    spans = removed_spans(marked, reader, parts, hot).groupBy("doc", "tag").agg(F.collect_list("span").alias("spans"))
    return keyed.join(spans, ["doc", "tag"], "left").select("doc_id", "doc", "tag", "text", "spans"), marks


def merged_spans(spans: list[int] | None) -> list[int]:
    """Flat span list, merged and in order, of one text's spans."""
    out: list[int] = []
    for span in sorted(spans or ()):
        start, end = span >> 32, span & 0xFFFFFFFF
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out
