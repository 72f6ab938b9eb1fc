"""Benchmark decontamination with a generalised suffix automaton.

The items' normalised words feed one automaton.  A document's words run through it, and
at each word the automaton knows the longest stretch of words ending there that occurs in
some item.  A stretch of ``window`` words or more is a hit, and so is the whole of an item
shorter than that.

The items are a stated query set: they are cut into blocks of at most ``block_chars``
characters, each block's automaton is sent to the tasks, and the documents stream through
block after block in map steps, without any shuffle.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c

WINDOW = 13
MAX_WORDS, MAX_SHARE = 20, 0.05  # words of a span, and share of a text's words, beyond which spans are removed
BLOCK_CHARS = 2_000_000

_KEEP = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def normal_words(text: str | None) -> list[bytes]:
    """Words of letters, digits and all characters beyond ASCII; A-Z in lower case."""
    return c.utf8(text).translate(_NORMAL).split()


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of words.

    ``items`` are distinct word sequences.  ``window_items[state]`` are the items that hold
    the window of ``window`` words that ends in the state; ``short_items[state]`` are the
    (length, item) pairs of shorter items that end in the state or one of its suffixes.
    """

    def __init__(self, items: list[list[bytes]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.length, self.link = [0], [-1]
        for words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.window_items: dict[int, list[int]] = {}
        ends: dict[int, list[tuple[int, int]]] = {}
        for item, words in enumerate(items):
            state = 0
            for n, word in enumerate(words, 1):
                state = self.next[state][word]
                if n >= window:
                    found = self.window_items.setdefault(self._window_state(state), [])
                    if not found or found[-1] != item:
                        found.append(item)
            if 0 < len(words) < window:
                ends.setdefault(state, []).append((len(words), item))
        self.short_items: dict[int, list[tuple[int, int]]] = {}
        if ends:
            for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
                found = ends.get(state, []) + self.short_items.get(self.link[state], [])
                if found:
                    self.short_items[state] = found

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, word)
        state = self._add(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
            return state
        target = self.next[at][word]
        if self.length[target] != self.length[at] + 1:
            target = self._split(at, target, word)
        self.link[state] = target
        return state

    def _add(self, length: int, transitions: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(0)
        self.next.append(transitions)
        return len(self.length) - 1

    def _split(self, at: int, target: int, word: bytes) -> int:
        """The suffixes of ``target`` no longer than ``at`` plus a word get a state of their own."""
        copy = self._add(self.length[at] + 1, dict(self.next[target]))
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _window_state(self, state: int) -> int:
        length, link = self.length, self.link
        while length[link[state]] >= self.window:
            state = link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Merged word spans [start, end) inside occurrences, and the items found."""
        following, length, link, window = self.next, self.length, self.link, self.window
        window_items, short_items = self.window_items, self.short_items
        spans: list[list[int]] = []
        found: set[int] = set()
        state = size = 0
        for at, word in enumerate(words):
            to = following[state].get(word)
            if to is None:
                while state:
                    state = link[state]
                    to = following[state].get(word)
                    if to is not None:
                        size = length[state] + 1
                        break
                else:
                    size = 0
                    continue
                state = to
            else:
                state = to
                size += 1
            reach = 0
            if size >= window:
                reach = window
                up = state
                while length[link[up]] >= window:
                    up = link[up]
                found.update(window_items[up])
            if short_items:
                for n, item in short_items.get(state, ()):
                    if n <= size:
                        found.add(item)
                        reach = max(reach, n)
            if reach:
                start = at + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, at + 1])
        return spans, found


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[str, str]]]:
    """(item_id, text) lists of about ``block_chars`` characters at most, one at a time on the driver."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = 1 if size <= block_chars else -(-2 * size // block_chars)
    for block in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield [(r["item_id"], r["text"]) for r in part.collect()]


_built: dict[str, tuple[SuffixAutomaton, list[list[str]]]] = {}


def _automaton(key: str, rows: list[tuple[str, str]], window: int) -> tuple[SuffixAutomaton, list[list[str]]]:
    """The automaton of a block and the ids of each of its distinct items; a worker keeps the last one."""
    if key not in _built:
        ids: dict[tuple[bytes, ...], list[str]] = {}
        for item_id, text in rows:
            if words := tuple(normal_words(text)):
                ids.setdefault(words, []).extend([] if item_id is None else [item_id])
        _built.clear()
        _built[key] = SuffixAutomaton([list(w) for w in ids], window), list(ids.values())
    return _built[key]


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``hit_spans``, ``n_words`` and ``hit_items`` for every row.

    ``docs`` has a ``text`` column; its other columns stay, but for any of these three names.
    ``hit_spans`` are word positions [start, end, start, end, ...), merged and in order.
    A null or wordless text has no words and no hits; repeated rows get equal results; of
    items with equal words each id is found; an item with a null id counts for the spans only.
    """
    spark = docs.sparkSession
    out = docs.withColumns(
        {
            "hit_spans": F.array().cast("array<bigint>"),
            "hit_items": F.array().cast("array<string>"),
            "n_words": F.lit(0).cast("bigint"),
        }
    )
    schema = out.schema
    for rows in _blocks(items, block_chars):
        sent, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

        def run(batches, sent=sent, key=key):
            automaton, ids = _automaton(key, sent.value, window)
            for batch in batches:
                names = batch.schema.names
                texts, spans_in, items_in = (batch.column(names.index(n)) for n in ("text", "hit_spans", "hit_items"))
                spans_out, items_out, words_out = [], [], []
                for i in range(batch.num_rows):
                    words = normal_words(texts[i].as_py())
                    spans, found = automaton.scan(words)
                    words_out.append(len(words))
                    spans_out.append(_merge(spans_in[i].as_py(), spans) if spans else spans_in[i].as_py())
                    items_out.append(items_in[i].as_py() + [x for k in found for x in ids[k]] if found else items_in[i].as_py())
                new = {
                    "hit_spans": pa.array(spans_out, pa.list_(pa.int64())),
                    "hit_items": pa.array(items_out, pa.list_(pa.string())),
                    "n_words": pa.array(words_out, pa.int64()),
                }
                yield pa.RecordBatch.from_arrays([new.get(n, batch.column(k)) for k, n in enumerate(names)], names=names)

        out = out.mapInArrow(run, schema)
    return out


def _merge(flat: list[int], spans: list[list[int]]) -> list[int]:
    """Union of a flat span list and further spans, in order."""
    out: list[int] = []
    for start, end in sorted([*zip(flat[::2], flat[1::2]), *map(tuple, spans)]):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_share: float = 0.05) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``hit_spans``, ``hit_items`` and ``contaminated`` to ``docs``.

    A document is contaminated if it has hits and they cover ``min_share`` of its words or more.
    """
    covered = F.aggregate(
        "hit_spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("sign")),
        lambda acc, x: F.struct((acc["n"] + acc["sign"] * x).alias("n"), (-acc["sign"]).alias("sign")),
    )["n"]
    found = scan(docs, items, window).withColumn("n_hit", covered)
    inverse = round(1 / min_share)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * inverse >= F.col("n_words")))


def cut_spans(text: str, spans: list[int]) -> str:
    """``text`` without the hit words and what stands between words of one span."""
    if not spans:
        return text
    at = [m.span() for m in _WORD.finditer(text)]
    out, last = [], 0
    for start, end in zip(spans[::2], spans[1::2]):
        out.append(text[last : at[start][0]])
        last = at[end - 1][1]
    return "".join([*out, text[last:]])


def remove_spans(found: DataFrame, max_words: int = MAX_WORDS, max_share: float = MAX_SHARE) -> DataFrame:
    """``hits`` rows whose text lost hit spans, with ``n_cut``, the number of words that went.

    A span of more than ``max_words`` words goes, and every span of a text goes whose hits cover more than
    ``max_share`` of its words.  Other texts stay as they are.
    """
    schema = found.withColumn("n_cut", F.lit(0).cast("bigint")).schema

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts, spans, sizes, n_hit = (batch.column(names.index(n)) for n in ("text", "hit_spans", "n_words", "n_hit"))
            out, counts = [], []
            for i in range(batch.num_rows):
                text, flat = texts[i].as_py(), spans[i].as_py()
                every = n_hit[i].as_py() > max_share * sizes[i].as_py() + 1e-9
                cut = [x for a, b in zip(flat[::2], flat[1::2]) if every or b - a > max_words for x in (a, b)]
                out.append(cut_spans(text, cut) if cut else text)
                counts.append(sum(cut[1::2]) - sum(cut[::2]))
            columns = [pa.array(out, pa.string()) if n == "text" else batch.column(k) for k, n in enumerate(names) if n != "n_cut"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=schema.names)

    return found.drop("n_cut").mapInArrow(run, schema)


def decontamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items found, the verdict at 13 words and 5 %, and what is cut.

    ``n_cut`` counts the words of spans beyond the limits of ``remove_spans``; ``cut_sha256`` is the digest of
    the text without them.
    """
    ids = F.array_sort(F.array_distinct("hit_items"))
    return remove_spans(hits(c.documents(docs), items)).select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated",
        "n_cut", F.sha2(F.encode("text", "UTF-8"), 256).alias("cut_sha256"),
    )
