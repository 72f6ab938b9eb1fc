"""Byte-level BPE encoding and decoding by a rank queue with a hierarchical bitmap.

The byte pairs of a pre-token wait in buckets, one per merge rank, as positions of a linked
list.  A bitmap of three levels tells which buckets are filled, and find-first-set on it
gives the next rank without any sorting.  An entry whose pair was changed by a merge at a
neighbour is stale and skipped.  A pre-token of n bytes takes O(n log n) steps at worst, so
one without any break, a million bytes long, is no special case.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.llm import common as c

CACHE_ENTRIES = 400_000  # short pre-tokens a worker remembers
CACHE_CHARS = 40  # longer pre-tokens are encoded each time


class RankQueue:
    """Buckets of list positions by merge rank; ``pop`` gives the leftmost one of the lowest rank.

    A bucket is a heap of positions.  Bit r of the bitmap's lowest level marks a filled
    bucket; each bit of a higher level marks a word of 64 bits below it that is not zero.
    """

    def __init__(self, ranks: int):
        self.buckets: list[list[int]] = [[] for _ in range(ranks)]
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets[rank]
        if bucket:
            heapq.heappush(bucket, at)
            return
        bucket.append(at)
        word, block = rank >> 6, rank >> 12
        self.low[word] |= 1 << (rank & 63)
        self.mid[block] |= 1 << (word & 63)
        self.top |= 1 << block

    def pop(self) -> tuple[int, int] | None:
        top = self.top
        if not top:
            return None
        block = (top & -top).bit_length() - 1
        bits = self.mid[block]
        word = (block << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heapq.heappop(bucket)
        bits &= bits - 1
        self.low[word] = bits
        if not bits:
            self.mid[block] = bits = self.mid[block] & ~(1 << (word & 63))
            if not bits:
                self.top = top & (top - 1)
        return rank, bucket.pop()


class BytePairEncoder:
    """Encoder and decoder for one table of ranks, which must hold all 256 single bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}  # ids of two neighbours -> id, and rank, of what they merge to
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    self.pairs[left, right] = rank
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.queue = RankQueue(max(ranks.values()) + 1)  # empty between calls

    def merge(self, data: bytes) -> list[int]:
        """Token ids of one pre-token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        pairs, queue, n = self.pairs, self.queue, len(data)
        ids: list[int] = [self.byte_ids[b] for b in data]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        for i in range(n - 1):
            rank = pairs.get((ids[i], ids[i + 1]))
            if rank is not None:
                queue.push(rank, i)
        while (entry := queue.pop()) is not None:
            rank, at = entry
            right = after[at]
            if ids[at] < 0 or right >= n or pairs.get((ids[at], ids[right])) != rank:
                continue  # stale: a merge changed this pair
            ids[at], ids[right] = rank, -1
            following = after[at] = after[right]
            if following < n:
                before[following] = at
                rank = pairs.get((ids[at], ids[following]))
                if rank is not None:
                    queue.push(rank, at)
            previous = before[at]
            if previous >= 0:
                rank = pairs.get((ids[previous], ids[at]))
                if rank is not None:
                    queue.push(rank, previous)
        return [x for x in ids if x >= 0]

    def encode(self, pieces: list[str]) -> bytes:
        """Ids of all pre-tokens as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        for piece in pieces:
            ids = known.get(piece)
            out.append(self._encode_new(piece) if ids is None else ids)
        return b"".join(out)

    def _encode_new(self, piece: str) -> bytes:
        """Encodes a pre-token that is not in the newer half of the cache; the older half goes when that is full."""
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.merge(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
            if len(piece) > CACHE_CHARS:
                return ids
        self.known[piece] = ids
        if len(self.known) >= CACHE_ENTRIES // 2:
            self.older = dict(self.known)
            self.known.clear()
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}


_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _ranges(kind: str, end: int) -> str:
    """Code points below ``end`` of a general category, as ranges of a character class."""
    inside = [unicodedata.category(chr(x))[0] == kind for x in range(end)] + [False]
    edges = [x for x in range(end + 1) if inside[x] != (x > 0 and inside[x - 1])]
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


@cache
def _compiled(pattern: str, end: int) -> re.Pattern:
    r"""``pattern`` for the standard engine: ``\p{L}``, ``\p{N}`` and white space as ranges up to ``end``."""
    letter, number = _ranges("L", end), _ranges("N", end)
    out = pattern.replace("[^\\s\\p{L}\\p{N}]", f"[^{_WHITE}{letter}{number}]")
    out = out.replace("\\p{L}", f"[{letter}]").replace("\\p{N}", f"[{number}]")
    return re.compile(out.replace("\\S", f"[^{_WHITE}]").replace("\\s", f"[{_WHITE}]"))


def split(pattern: str, text: str) -> list[str]:
    """All matches of ``pattern``.  Classes without code points beyond 16 bits are much the faster."""
    plain = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
    return _compiled(pattern, 0x10000 if plain else sys.maxunicode + 1).findall(text)


_encoders: dict[str, BytePairEncoder] = {}


def _encoder(file: str) -> BytePairEncoder:
    if file not in _encoders:
        _encoders.clear()
        _encoders[file] = BytePairEncoder(read_ranks(SparkFiles.get(file)))
    return _encoders[file]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids of its ``text`` as bytes of 32-bit integers in column ``ids``.

    Every match of ``pattern`` is encoded by itself and there are no special tokens.  A null
    or empty text has no ids.  The rank file is sent to the executors with the job.
    ``decoded`` names a column for the bytes the ids decode to.  Columns of these two names
    are replaced, all others stay.
    """
    spark: SparkSession = docs.sparkSession
    new = [n for n in (ids, decoded) if n]
    docs = docs.drop(*new)
    spark.sparkContext.addFile(ranks_path)
    file = ranks_path.rsplit("/", 1)[-1]
    schema = docs.withColumns({n: F.lit(bytearray()) for n in new}).schema

    def run(batches):
        encoder = _encoder(file)
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            encoded = [encoder.encode(split(pattern, t.as_py() or "")) for t in texts]
            columns = [*batch.columns, pa.array(encoded, pa.binary())]
            if decoded:
                columns.append(pa.array([encoder.decode(x) for x in encoded], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *new])
        c.give_back()

    return docs.mapInArrow(run, schema)


def tokenize_report(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """One row per document: token count, and digests of the ids and of what they decode to.

    A null text is empty and has no ids; repeated rows have equal results; texts are whole, whatever
    their length; columns besides id and text play no part.
    """
    docs.sparkSession.sparkContext.addFile(ranks_path)
    file = ranks_path.rsplit("/", 1)[-1]

    def digest(row: dict) -> tuple:
        encoder = _encoder(file)
        ids = encoder.encode(split(pattern, row["text"]))
        return row["doc_id"], len(ids) // 4, c.sha(ids), c.sha(encoder.decode(ids))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return c.map_rows(c.documents(docs), digest, schema)
