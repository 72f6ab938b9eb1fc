"""Personal data: exact patterns, plus spans found by a character BiLSTM-CRF.

The tagger is trained in numpy on a bounded sample of windows around spans that the patterns
label, some of them rewritten into forms that the patterns do not know, and of windows without
any.  The whole text is tagged, since a rewritten address holds neither digit nor @.  It is cut
into overlapping windows; each character takes the scores of the window in which it lies most
central, and one Viterbi path over the whole text reconciles them.
"""

from __future__ import annotations

import bisect
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c
from letterloom.llm.tagger import KINDS, N_TAGS, WINDOW, Tagger, classes, tag_spans, train

SAMPLE_WINDOWS = 1500  # labelled windows a fit reads at most
REACH = 30  # surroundings of digits and @ in the windows of the fit
WIDE, MARGIN = 512, 20  # characters of a window when tagging, and how many at each end its neighbours serve
PIECE = 2000  # characters of a stretch decoded at once
SURE = 0.9  # least mean marginal of an added span
BATCH_WINDOWS, BATCH_STEPS = 512, 20_000  # windows scored, and characters decoded, at once
PART_CHARS = 1_000_000  # characters of the texts tagged at once, unless one text has more

Span = tuple[int, int, int]  # kind index, start, end
_ANCHOR = re.compile("[0-9@]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile("[^0-9]")


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(2 * int(x) - 9 * (x > "4") for x in even)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the exact patterns, sorted by start and kind; linear in the text's length."""
    if not _ANCHOR.search(text):
        return []
    out: list[Span] = []
    free = 0  # end of the last address
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                out.append((0, start, m.end()))
                free = m.end()
    for m in _IP.finditer(text):
        if all(len(part := x.lstrip("0")) <= 3 and int(part or 0) <= 255 for x in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 12 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and _luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                out.append((3, *m.span()))
    out.sort(key=lambda s: (s[1], s[0]))
    return out


def stretches(text: str) -> list[tuple[int, int]]:
    """Merged surroundings of all digits and @ signs."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


Window = tuple[int, int]  # text, start


def _windows_of(length: int) -> range:
    """Starts of the windows of a text; of two that share characters each serves the half more central in it."""
    return range(0, max(1, length - 2 * MARGIN), WIDE - 2 * MARGIN) if length else range(0)


def _scored(tagger: Tagger, codes: list[np.ndarray], windows: list[Window]) -> Iterator[tuple[list[tuple], np.ndarray]]:
    """Batches of (text, its first character served, row, steps served) with the tag scores (steps, tags, rows)."""
    size = lambda w: min(WIDE, len(codes[w[0]]) - w[1])
    windows = sorted(windows, key=size)  # neighbours in a batch have like lengths
    for at in range(0, len(windows), BATCH_WINDOWS):
        some = windows[at : at + BATCH_WINDOWS]
        rows, served = np.zeros((len(some), size(some[-1])), np.int64), []
        for k, (i, start) in enumerate(some):
            n = size((i, start))
            rows[k, :n] = codes[i][start : start + n]
            first = MARGIN if start else 0
            served.append((i, start + first, k, slice(first, n if start + n == len(codes[i]) else n - MARGIN)))
        yield served, tagger.emissions(rows)


def _server(position: int, starts: range) -> int:
    """Number of the window that serves a character."""
    return min(len(starts) - 1, max(0, (position - MARGIN) // starts.step))


def _possible(first: np.ndarray, later: np.ndarray, leave: float) -> list[tuple[int, int]]:
    """Stretches that hold every span of the best tag path of a whole text.

    ``first`` and ``later`` bound what a character adds to a path, against outside, as the first
    and as a later one between two outside ones, and ``leave`` what going back outside adds.  A run
    whose bounds sum to less than 0 is worse than none, so characters that no better run covers are outside.
    """
    total = np.cumsum(later, dtype=np.float64)
    best = np.maximum.accumulate(total[::-1])[::-1] - np.minimum.accumulate(total - first)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], best + leave >= 0, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def tag(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """Sure spans per text of its best tag path; all but addresses hold a digit or an @.

    A text starts and ends outside.  One pass over all windows bounds what each character can
    gain; the windows around stretches that can hold a span are scored again, and the path is
    searched there alone, which gives the path of the whole text.
    """
    codes = [classes(t).astype(np.uint8) for t in texts]
    bounds = tagger.bounds()
    gains = [np.zeros((2, len(code)), np.float32) for code in codes]
    for served, e in _scored(tagger, codes, [(i, a) for i, code in enumerate(codes) for a in _windows_of(len(code))]):
        most = [np.ascontiguousarray(((e[:, 1:] + bound[:, None]).max(1) - e[:, 0]).T) for bound in bounds[:2]]
        for i, start, k, steps in served:
            for gain, found in zip(gains[i], most):
                gain[start : start + steps.stop - steps.start] = found[k, steps]
    jobs: list[tuple[int, int, int, np.ndarray]] = []
    of_text: dict[int, list[tuple]] = {}
    for i, gain in enumerate(gains):
        for a, b in _possible(*gain, bounds[2]):
            jobs.append((i, a, b, np.zeros((b - a, N_TAGS))))
            of_text.setdefault(i, []).append(jobs[-1])
    wanted = set()
    for i, a, b, _ in jobs:
        starts = _windows_of(len(codes[i]))
        wanted.update((i, starts[k]) for k in range(_server(a, starts), _server(b - 1, starts) + 1))
    for served, e in _scored(tagger, codes, list(wanted)):
        for i, start, k, steps in served:
            end = start + steps.stop - steps.start
            ends = [job[2] for job in of_text[i]]
            for _, a, b, grid in of_text[i][bisect.bisect_right(ends, start) :]:
                if a >= end:
                    break
                lo, hi = max(a, start), min(b, end)
                grid[lo - a : hi - a] = e[steps.start + lo - start : steps.start + hi - start, :, k]
    out: list[list[Span]] = [[] for _ in texts]
    for i, a, tags, sure in _paths(tagger, jobs):
        for kind, start, end in _read_spans(tags):
            anchored = kind == 0 or _ANCHOR.search(texts[i], a + start, a + end)
            if anchored and sure[start:end].mean() >= SURE:
                out[i].append((kind, a + start, a + end))
    return [sorted(spans, key=lambda s: s[1]) for spans in out]


def _paths(tagger: Tagger, jobs: list[tuple]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Text, start, best tags and their marginals of each stretch, with an outside character before and after it.

    A stretch of over ``PIECE`` characters is decoded piece by piece.  A piece ends at the last outside character
    of its path before its lap; one that has none grows until it has one.
    """
    todo = [(i, a, grid, PIECE) for i, a, _, grid in jobs]
    while todo:
        todo.sort(key=lambda j: min(len(j[2]), j[3]))
        longest = min(len(todo[0][2]), todo[0][3])
        n = 1
        while n < len(todo) and (n + 1) * (longest := max(longest, min(len(todo[n][2]), todo[n][3]))) <= BATCH_STEPS:
            n += 1
        now, todo = todo[:n], todo[n:]
        sizes = [min(len(grid), piece) for _, _, grid, piece in now]
        block = np.full((n, max(sizes) + 2, N_TAGS), -1e4)
        block[:, :, 0] = 0
        for row, size, (_, _, grid, piece) in zip(block, sizes, now):
            row[1 : size + 1] = grid[:size]
            if size < len(grid):
                row[size + 1 :] = 0  # what follows is open
        tags, sure = tagger.decode(block)
        for k, (size, (i, a, grid, piece)) in enumerate(zip(sizes, now)):
            path, marginal = tags[k, 1 : size + 1], sure[k, 1 : size + 1]
            if size < len(grid):
                outside = np.flatnonzero(path[: size - size // 10] == 0)
                if not len(outside):
                    todo.append((i, a, grid, 2 * piece))
                    continue
                cut = int(outside[-1]) + 1
                todo.append((i, a + cut, grid[cut:], PIECE))
                path, marginal = path[:cut], marginal[:cut]
            yield i, a, path, marginal


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in parts of ``PART_CHARS`` characters or a text."""
    part: list[str] = []
    size = 0
    for text in texts:
        if part and size + len(text) > PART_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _read_spans(tags: np.ndarray) -> list[Span]:
    out, at, hits = [], 0, np.flatnonzero(tags)
    while at < len(hits):
        start = int(hits[at])
        kind, end = (int(tags[start]) - 1) // 2, start + 1
        while end < len(tags) and tags[end] == 2 + 2 * kind:
            end += 1
        out.append((kind, start, end))
        at = int(np.searchsorted(hits, end))
    return out


def all_spans(base: list[Span], tagged: list[Span]) -> list[Span]:
    """Base spans, and tagged ones that touch none of them."""
    added = [s for s in tagged if all(s[2] <= b[1] or b[2] <= s[1] for b in base)] if base else tagged
    return sorted([*base, *added], key=lambda s: (s[1], s[0]))


def _rewrite(kind: int, span: str, rng: random.Random) -> str:
    """A span in a form that the patterns do not know."""
    if kind == 0:
        return span.replace("@", rng.choice((" at ", "(at)", " (at) ", "[at]")))
    if kind == 3:
        digits = span.lstrip("+")
        return rng.choice((f"00{digits}", digits.replace(" ", "-", 1), digits.partition(" ")[2] or digits))
    return span


def _windows(text: str, rng: random.Random) -> list[tuple[str, list[int]]]:
    """Up to three labelled windows of a text, each with a random part of its surroundings."""
    base = base_spans(text)
    out = []
    for a, b in stretches(text)[:3]:
        a, b = max(0, a - rng.randrange(20)), min(len(text), b + rng.randrange(20))
        spans = [(k, s, e) for k, s, e in base if a <= s and e <= b]
        piece, tags, last = "", [], a
        for kind, s, e in spans:
            if s < last:
                continue
            shown = _rewrite(kind, text[s:e], rng) if rng.random() < 0.4 else text[s:e]
            piece += text[last:s] + shown
            tags += [0] * (s - last) + tag_spans(len(shown), [(kind, 0, len(shown))]).tolist()
            last = e
        piece, tags = piece + text[last:b], tags + [0] * (b - last)
        cut = max(0, min(len(piece) - WINDOW, rng.randrange(max(1, len(piece) - WINDOW + 1))))
        out.append((piece[cut : cut + WINDOW], tags[cut : cut + WINDOW]))
    at = rng.randrange(max(1, len(text) - WINDOW + 1))
    if not _ANCHOR.search(text, at, at + WINDOW):  # what plain text looks like
        out.append((text[at : at + WINDOW], [0] * len(text[at : at + WINDOW])))
    return out


def fit(docs: DataFrame, sample_windows: int = SAMPLE_WINDOWS) -> Tagger | None:
    """A tagger from at most ``sample_windows`` labelled windows; None without any.

    Windows are dealt over that many slots by a hash, and each slot keeps the one with the least
    hash, so a task sends one window per slot and the driver gets no more.
    """

    def run(batches):
        for batch in batches:
            keys, texts, tags = [], [], []
            for text in batch.column(0).to_pylist():
                if _ANCHOR.search(text):
                    for piece, tag_row in _windows(text, random.Random(zlib.crc32(c.utf8(text)))):
                        texts.append(piece)
                        tags.append(tag_row)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(tags, pa.list_(pa.int64()))], names=["piece", "tags"])

    pieces = c.documents(docs).select("text").mapInArrow(run, "piece string, tags array<bigint>")
    slot = F.pmod(F.xxhash64("piece"), F.lit(sample_windows)).alias("slot")
    least = F.min(F.struct(F.xxhash64(F.lit(1), "piece").alias("h"), "piece", "tags")).alias("w")
    picked = pieces.groupBy(slot).agg(least).select("w.*").orderBy("h", "piece", "tags").collect()
    if not picked:
        return None
    codes = np.zeros((len(picked), WINDOW), np.int64)
    labels = np.zeros_like(codes)
    for k, row in enumerate(picked):
        codes[k, : len(row["piece"])] = classes(row["piece"])
        labels[k, : len(row["tags"])] = row["tags"]
    return train(codes, labels)


def find(docs: DataFrame, tagger: Tagger | None, base: str = "base_spans", every: str = "pii_spans") -> DataFrame:
    """``docs`` with flat span lists [kind, start, end, ...] of the patterns and of patterns and tagger.

    Positions are code points of the whole ``text``; a null or empty text has no spans.
    Columns of these two names are replaced, all others stay.
    """
    docs = docs.drop(base, every)
    schema = docs.withColumns({n: F.array().cast("array<bigint>") for n in (base, every)}).schema
    sent = docs.sparkSession.sparkContext.broadcast(tagger)  # a few thousand weights

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index("text")).to_pylist()]
            exact = [base_spans(t) for t in texts]
            model, once = sent.value, list(dict.fromkeys(texts))
            known = {t: spans for part in _parts(once) for t, spans in zip(part, tag(model, part) if model else [[] for _ in part])}
            tagged = [known[t] for t in texts]
            both = [all_spans(x, y) for x, y in zip(exact, tagged)]
            lists = [pa.array([[v for s in spans for v in s] for spans in rows], pa.list_(pa.int64())) for rows in (exact, both)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], names=[*batch.schema.names, base, every])
        c.give_back()

    return docs.mapInArrow(run, schema)


def redact(found: DataFrame, every: str = "pii_spans") -> DataFrame:
    """``find`` rows whose ``text`` has ``<KIND>`` in place of each span; overlapping spans become one."""
    schema = found.schema

    def cut(text: str | None, flat: list[int]) -> str | None:
        if not flat:
            return text
        out, last = [], 0
        for kind, start, end in zip(flat[::3], flat[1::3], flat[2::3]):
            if start >= last:
                out += [text[last:start], f"<{KINDS[kind].upper()}>"]
            last = max(last, end)
        return "".join([*out, text[last:]])

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            texts, spans = batch.column(names.index("text")), batch.column(names.index(every))
            new = pa.array([cut(t.as_py(), s.as_py()) for t, s in zip(texts, spans)], pa.string())
            yield pa.RecordBatch.from_arrays([new if n == "text" else batch.column(k) for k, n in enumerate(names)], names=names)

    return found.mapInArrow(run, schema)


def _shown(flat: str):
    """``kind:start:end`` of a flat list, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    at = F.when(F.size(flat) > 0, F.sequence(F.lit(0), F.size(flat) - 1, F.lit(3)))
    one = F.transform(at, lambda i: F.concat_ws(":", F.get(kinds, F.get(flat, i).cast("int")), F.get(flat, i + 1), F.get(flat, i + 2)))
    return F.coalesce(F.array_join(one, ","), F.lit(""))


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per document: pattern spans by kind and as a digest, and all spans as text."""
    docs = c.documents(docs)
    found = find(docs, fit(docs)).withColumn("spans", _shown("pii_spans")).withColumn("base", _shown("base_spans"))
    counts = [F.regexp_count("base", F.lit(f"{k}:")).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")
