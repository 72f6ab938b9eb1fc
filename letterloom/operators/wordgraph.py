"""Graphs of words: co-occurrence edges, centralities and the weights built on them.

Documents are rows (mid, tokens).  One document is one row, so everything up to
the counts stays on the document's own task after a single move by ``mid``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.operators.reshape import explode_computed

CENTRALITIES = ("degree", "w_degree", "closeness", "w_closeness")
ROWS_PER_FRAME = 50_000
DOCS_AT_ONCE = 200
TOKENS_AT_ONCE = 200_000
NARROW_CELLS = 1 << 19  # places times documents of one sweep
LEVEL_CELLS = 1 << 15  # 64-bit words of one level
RANKS = 8  # edges of a word that are followed one by one
FAR = 1 << 40  # length of an edge that is not there
LONGEST_LEVEL = 64  # edges up to this length go level by level
HISTORY_BYTES = 1 << 26  # memory for the levels of some documents


def _round5(value: Column) -> Column:
    """Five places by scaling; ``closeness`` rounds the same way."""
    return F.floor(value * 100_000 + 0.5) / 100_000


def _whole_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about ``TOKENS_AT_ONCE`` words from rows sorted by ``mid``; rows of one ``mid`` stay together."""
    held, words = [], 0
    for batch in batches:
        for at in range(0, len(batch), DOCS_AT_ONCE):
            part = batch.slice(at, DOCS_AT_ONCE)
            held.append(part)
            words += len(part["tokens"].flatten())
            if words < TOKENS_AT_ONCE:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            mid = table["mid"].combine_chunks().dictionary_encode("encode").indices
            cut = int(np.searchsorted(np.asarray(mid), len(pc.unique(mid)) - 1))  # the last one may go on
            if cut:
                yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            words = len(table.slice(cut)["tokens"].combine_chunks().flatten())
    if held:
        yield pa.Table.from_batches(held)


def _edges(table: pa.Table, window: int):
    """(mids, terms, a, b, weight, nodes): edges and words of all documents, numbered by ``mid`` * terms + term."""
    mid = table["mid"].combine_chunks().dictionary_encode("encode")
    tokens = table["tokens"].combine_chunks()
    term = tokens.flatten().dictionary_encode()
    code, n = np.asarray(term.indices).astype(np.int64), max(1, len(term.dictionary))
    lengths = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0)).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    code = np.asarray(mid.indices).astype(np.int64)[row] * n + code
    low, high = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for d in range(1, window):
        kept = (row[:-d] == row[d:]) & (lengths[row[d:]] > window) & ((code[:-d] != code[d:]) | (place[d:] < window))
        low.append(code[:-d][kept])
        high.append(code[d:][kept])
    low, high = np.concatenate(low), np.concatenate(high)
    edge, weight = np.unique(low * n + high % n, return_counts=True)
    a = edge // n
    return mid.dictionary, term.dictionary, a, a // n * n + edge % n, weight, np.unique(code)


def word_edges(docs: DataFrame, window: int = 3) -> DataFrame:
    """(mid, a, b, weight): directed edges, weighted by how often they occur.

    Counted some documents at a time, as a partition's edges are many times its text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_documents(batches):
            mids, terms, a, b, weight, _ = _edges(table, window)
            n = max(1, len(terms))
            columns = [mids.take(pa.array(a // n)), terms.take(pa.array(a % n)), terms.take(pa.array(b % n)), pa.array(weight.astype(np.int64))]
            yield from pa.table(columns, names=["mid", "a", "b", "weight"]).to_batches(max_chunksize=ROWS_PER_FRAME)

    return _by_document(docs, run, "a string, b string, weight bigint")


def _by_document(docs: DataFrame, run, columns: str) -> DataFrame:
    moved = docs.select("mid", "tokens").repartition("mid").sortWithinPartitions("mid")
    return moved.mapInArrow(run, f"mid {docs.schema['mid'].dataType.simpleString()}, {columns}")


def _degree(docs: DataFrame, window: int, weighted: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_documents(batches):
            mids, terms, a, b, weight, nodes = _edges(table, window)
            n = max(1, len(terms))
            ends, value = np.searchsorted(nodes, np.concatenate([a, b])), np.concatenate([weight, weight])
            total = np.bincount(ends, value if weighted else None, len(nodes)).astype(np.float64)
            others = np.bincount(nodes // n, minlength=len(mids))[nodes // n] - 1
            value = np.where(others > 0, np.floor(total / np.maximum(others, 1) * 100_000 + 0.5) / 100_000, 0.0)
            columns = [mids.take(pa.array(nodes // n)), terms.take(pa.array(nodes % n)), pa.array(value)]
            yield from pa.table(columns, names=["mid", "term", "value"]).to_batches(max_chunksize=ROWS_PER_FRAME)

    return _by_document(docs, run, "term string, value double")


def closeness_of_distinct(docs: DataFrame, window: int = 3) -> DataFrame:
    """Closeness when no token repeats: words d places apart are ceil(d / (w-1)) steps apart.

    The sum of steps to both ends has a closed form, so each word takes O(1).
    """
    n, reach = F.size("tokens"), F.lit(window - 1)

    def steps(length: Column) -> Column:
        full = F.floor(length / reach)
        return reach * full * (full + 1) / 2 + (length - full * reach) * (full + 1)

    nodes = explode_computed(docs, ["mid", n.alias("_n")], "tokens", "term", pos="_i")
    near = (F.col("_n") - 1) / (steps(F.col("_i")) + steps(F.col("_n") - 1 - F.col("_i")))
    value = F.when(F.col("_n") == 1, 0.0).when(F.col("_n") <= window, 1 / F.col("_n")).otherwise(near)
    return nodes.select("mid", "term", _round5(value).alias("value"))


def _graphs(tokens: np.ndarray, lengths: np.ndarray, window: int):
    """(words, sizes, a, b, weight) of the documents' undirected graphs under each other, parallel edges as the lightest.

    Words are numbered through all documents, each document's in the order of their first places; ``a`` < ``b``.
    """
    doc = np.repeat(np.arange(len(lengths)), lengths)
    word, names = pd.factorize(tokens)
    code, firsts = pd.factorize(doc * len(names) + word)
    sizes = np.bincount(firsts // max(1, len(names)), minlength=len(lengths))
    paired = lengths[doc] > window
    keys = [np.empty(0, np.int64)]
    for d in range(1, window):
        kept = (doc[:-d] == doc[d:]) & paired[d:] & (code[:-d] != code[d:])
        keys.append((code[:-d] * len(firsts) + code[d:])[kept])
    edge, weight = np.unique(np.concatenate(keys), return_counts=True)
    a, b = edge // len(firsts), edge % len(firsts)
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((weight, high, low))
    low, high, weight = low[order], high[order], weight[order]
    new = np.append(True, (np.diff(low) != 0) | (np.diff(high) != 0))[: len(low)]
    return names[firsts % max(1, len(names))], sizes, low[new], high[new], weight[new]


def _by_target(a: np.ndarray, b: np.ndarray):
    """(targets, their first edge, sources) of the edges in both directions, grouped by target."""
    target, source = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.argsort(target, kind="stable")
    linked, starts = np.unique(target[order], return_index=True)
    return linked, starts, source[order]


def _by_rank(a: np.ndarray, b: np.ndarray):
    """(steps, rest): each step has (targets, sources) with one edge of a target, and ``rest`` the others as ``_by_target``.

    Targets that are the first words of all are a slice.
    """
    linked, starts, source = _by_target(a, b)
    degree = np.diff(np.append(starts, len(source)))
    target, rank = np.repeat(linked, degree), np.arange(len(source)) - np.repeat(starts, degree)
    steps = []
    for k in range(min(RANKS, int(degree.max()))):
        some = rank == k
        to = target[some]
        steps.append((slice(0, len(to)) if to[-1] == len(to) - 1 else to, source[some]))
    more = rank >= RANKS
    rest, first = np.unique(target[more], return_index=True)
    return steps, (rest, first, source[more])


def _level_sums(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Distance sums for small whole-number lengths, by bit sets of reached words; documents of like size go together.

    ``past[-1]`` holds, for each word, the bits of all words of its document reached so far; an edge of
    length w hands on what its other end had w levels ago.  A document with edges is connected, as
    neighbours are joined, so it is done once all its bits are set; from time to time those done are left out.
    """
    n, width, longest = int(sizes.sum()), int(sizes.max()), int(weight.max())
    light = weight == weight.min()
    old = np.argsort(-np.bincount(np.concatenate([a[light], b[light]]), minlength=n), kind="stable")
    at = np.empty(n, np.int64)
    at[old] = np.arange(n)
    a, b = at[a], at[b]
    doc = np.repeat(np.arange(len(sizes)), sizes)[old]
    place, own = (np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes))[old], sizes[doc]
    block = max(64, min(width, HISTORY_BYTES // (n * (longest + 2)) * 8))
    sums = np.zeros(n)
    for first in range(0, width, block):
        some = np.flatnonzero((place >= first) & (place < first + block))
        bits = place[some] - first
        now = np.zeros((n, (min(block, width - first) + 63) // 64), dtype=np.uint64)
        now[some, bits // 64] = np.uint64(1) << (bits % 64).astype(np.uint64)
        rows, past, edges, groups = np.arange(n), [now], (a, b, weight), []
        wanted = np.clip(own - first, 0, block)
        while True:
            left = wanted - np.bitwise_count(past[-1]).sum(axis=1, dtype=np.int64)
            sums[rows] += left
            if not left.any():
                break
            if not groups or np.count_nonzero(left) * 3 < len(rows):
                going = np.bincount(doc[rows], left, len(sizes))[doc[rows]] > 0
                if not groups or np.count_nonzero(going) * 2 < len(rows):
                    number, kept = np.cumsum(going) - 1, going[edges[0]]
                    edges = number[edges[0][kept]], number[edges[1][kept]], edges[2][kept]
                    rows, wanted, past = rows[going], wanted[going], [p[going] for p in past]
                    groups = [(int(w), *_by_rank(*(x[edges[2] == w] for x in edges[:2]))) for w in np.unique(edges[2])]
                    found = np.empty_like(past[-1])
            new = past[-1].copy()
            for w, steps, (rest, starts, sources) in groups:
                if w > len(past):
                    break
                for to, source in steps:
                    got = np.take(past[-w], source, axis=0, out=found[: len(source)], mode="clip")
                    new[to] |= got
                if len(rest):
                    new[rest] |= np.bitwise_or.reduceat(past[-w][sources], starts, axis=0)
            past = [*past[len(past) - longest + 1 :], new] if len(past) >= longest else [*past, new]
    out = np.empty(n)
    out[old] = sums
    return out


def _far_sums(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Distance sums of one document for whole-number lengths of any size.

    As ``_level_sums``, but only levels at which something can arrive are visited, and a word hands on only the
    bits that are new to it.  A block is so small that what all words ever hand on fits ``HISTORY_BYTES``.
    """
    groups = [(int(w), *_by_target(a[weight == w], b[weight == w])) for w in np.unique(weight)]
    block = max(64, min(n, int((8 * HISTORY_BYTES / n) ** 0.5) // 64 * 64))
    sums = np.zeros(n)
    at = np.full(n, -1)
    for first in range(0, n, block):
        own = np.arange(first, min(first + block, n))
        reached = np.zeros((n, (len(own) + 63) // 64), dtype=np.uint64)
        reached[own, (own - first) // 64] = np.uint64(1) << ((own - first) % 64).astype(np.uint64)
        missing, level, due = (n - 1) * len(own), 0, {}
        rows, fresh = own, reached[own]
        while missing:
            at[rows] = np.arange(len(rows))
            for w, linked, starts, sources in groups:
                held = at[sources]
                some = np.flatnonzero(held >= 0)
                if len(some):
                    to = np.searchsorted(starts, some, side="right") - 1
                    new = np.flatnonzero(np.append(True, np.diff(to) != 0))
                    due.setdefault(level + w, []).append((linked[to[new]], new, held[some], fresh))
            at[rows] = -1
            level = min(due)
            came = due.pop(level)
            touched = np.unique(np.concatenate([x[0] for x in came]))
            before = reached[touched]
            for to, starts, held, bits in came:
                reached[to] |= np.bitwise_or.reduceat(bits[held], starts, axis=0)
            fresh = reached[touched] & ~before
            count = np.bitwise_count(fresh).sum(axis=1, dtype=np.int64)
            rows, fresh = touched[count > 0], fresh[count > 0]
            sums[rows] += level * count[count > 0]
            missing -= int(count.sum())
    return sums


def _narrow_steps(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of neighbours one and two places apart, where ``one`` and ``two`` are the lengths of their edges.

    Rows are places, columns documents.  No edge passes over two words, so a way between neighbours
    keeps to one side of them.
    """
    before, after = one.copy(), one.copy()
    for p in range(1, len(one)):
        before[p] = np.minimum(one[p], two[p - 1] + before[p - 1])
    for p in range(len(one) - 2, -1, -1):
        after[p] = np.minimum(one[p], two[p] + after[p + 1])
    one = np.minimum(before, after)
    return one, np.minimum(two, one[:-1] + one[1:])


def _narrow_before(sizes: np.ndarray, one: np.ndarray, two: np.ndarray, longest: int) -> np.ndarray:
    """For each word (places as rows, documents by falling size as columns) the sum of distances to all words before it.

    Two neighbours part the words before them from those after them, so all words before with the
    same difference of distances to the two go on as one number.
    """
    states = 2 * longest + 1
    shift = np.arange(states) - longest
    docs = np.arange(len(sizes))
    counts = np.zeros((len(sizes), states))
    counts[docs, longest + one[0]] += 1
    counts[docs, longest - one[0]] += 1
    sums = np.zeros((len(one) + 1, len(sizes)))
    sums[1] = one[0]
    active = np.searchsorted(-sizes, -np.arange(len(one) + 1), side="left")  # documents of more than p words
    for p in range(1, len(one)):
        m = active[p + 1]
        step = np.minimum(one[p, :m, None], two[p - 1, :m, None] - shift)
        sums[p + 1, :m] = sums[p, :m] + (counts[:m] * step).sum(axis=1)
        counts = np.bincount((docs[:m, None] * states + step + longest).ravel(), counts[:m].ravel(), m * states).reshape(m, states)
        counts[docs[:m], longest - one[p, :m]] += 1
    return sums


def _narrow_sums(sizes: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray):
    """(sums, done): distance sums of documents, by falling size, whose edges join words at most two places apart.

    Each word takes a fixed number of steps, whatever the length of the ways.  A document whose neighbours
    are over ``LONGEST_LEVEL`` apart is not done.
    """
    starts = np.cumsum(sizes) - sizes
    doc = np.searchsorted(starts, a, side="right") - 1
    one, two = (np.full((sizes[0] - k, len(sizes)), FAR, np.int64) for k in (1, 2))
    for k, table in ((1, one), (2, two)):
        some = b - a == k
        table[a[some] - starts[doc[some]], doc[some]] = weight[some]
    one, two = _narrow_steps(one, two)
    inside = np.arange(len(one))[:, None] < sizes - 1
    one, two = np.where(inside, one, 1), np.where(inside[1:], two, 1)
    done = one.max(axis=0) <= LONGEST_LEVEL
    one, two = np.where(done, one, 1), np.where(done, two, 1)
    longest = int(one.max())
    place, docs = np.arange(sizes[0])[:, None], np.arange(len(sizes))
    back_one, back_two = (t[np.maximum(sizes - 1 - k - place[: len(t)], 0), docs] for k, t in ((1, one), (2, two)))
    forth, back = _narrow_before(sizes, one, two, longest), _narrow_before(sizes, back_one, back_two, longest)
    sums = forth + back[np.maximum(sizes - 1 - place, 0), docs]
    return sums.T[(place < sizes).T], done


def _parts(sizes: np.ndarray, cells: int, wide: int) -> Iterator[np.ndarray]:
    """Documents by falling size, as many at once as fill ``cells``.

    A word takes a cell, or with ``wide`` one for each ``wide`` words of the document.
    """
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        n = int(sizes[order[at]])
        some = max(1, cells // (n * -(-n // wide) if wide else n))
        yield order[at : at + some]
        at += some


def _taken(docs: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray, first_edge: np.ndarray):
    """(words, a, b, weight) of some documents, in their order, renumbered; ``words`` are their old numbers."""
    starts, n = np.cumsum(sizes) - sizes, sizes[docs]
    words = np.repeat(starts[docs], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    m = first_edge[docs + 1] - first_edge[docs]
    some = np.repeat(first_edge[docs], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
    move = np.repeat(np.cumsum(n) - n - starts[docs], m)
    return words, a[some] + move, b[some] + move, weight[some]


def _distance_sums(tokens: np.ndarray, lengths: np.ndarray, window: int, weighted: bool):
    """(words, sizes, sums): all documents' words under each other, each with the sum of distances to
    all other words of its document; an unreachable word is n away."""
    words, sizes, a, b, weight = _graphs(tokens, lengths, window)
    if not weighted:
        weight = np.ones_like(weight)
    own = np.repeat(sizes, sizes).astype(np.float64)
    sums = (own - 1) * own
    first_edge = np.searchsorted(a, np.append(np.cumsum(sizes) - sizes, len(words)))
    linked = np.flatnonzero(np.diff(first_edge))
    if not len(linked):
        return words, sizes, sums
    starts = first_edge[linked]
    longest, span = np.maximum.reduceat(weight, starts), np.maximum.reduceat(b - a, starts)
    edges = (sizes, a, b, weight, first_edge)
    narrow, wide = linked[(span <= 2) & (longest <= LONGEST_LEVEL)], linked[(span > 2) & (longest <= LONGEST_LEVEL)]
    for part in _parts(sizes[narrow], NARROW_CELLS, 0):
        docs = narrow[part]
        nodes, *graph = _taken(docs, *edges)
        found, done = _narrow_sums(sizes[docs], *graph)
        sums[nodes] = found
        wide = np.append(wide, docs[~done])
    for length in np.unique(np.ceil(np.log2(longest))):
        alike = wide[np.isin(wide, linked[np.ceil(np.log2(longest)) == length])]
        for part in _parts(sizes[alike], LEVEL_CELLS, 64):
            nodes, *graph = _taken(alike[part], *edges)
            sums[nodes] = _level_sums(sizes[alike[part]], *graph)
    for doc in linked[longest > LONGEST_LEVEL]:
        nodes, *graph = _taken(np.array([doc]), *edges)
        sums[nodes] = _far_sums(len(nodes), *graph)
    return words, sizes, sums


def closeness(docs: DataFrame, window: int = 3, weighted: bool = False) -> DataFrame:
    """Closeness in any document's graph, edge counts as lengths when ``weighted``.

    Shortest paths have no expression form, so Arrow batches of documents go through
    a numpy helper, some documents of about ``TOKENS_AT_ONCE`` words together at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(pc.fill_null(pc.list_value_length(batch["tokens"]), 0)).astype(np.int64)
            mid, lengths = batch["mid"].filter(pa.array(lengths > 0)), lengths[lengths > 0]
            token = batch["tokens"].flatten().dictionary_encode("encode")
            ends = np.append(0, np.cumsum(lengths))
            share = ends[:-1] // TOKENS_AT_ONCE
            for k in np.unique(share):
                first, last = np.searchsorted(share, [k, k + 1])
                tokens = np.asarray(token.indices[ends[first] : ends[last]])
                words, sizes, sums = _distance_sums(tokens, lengths[first:last], window, weighted)
                n = np.repeat(sizes, sizes)
                value = np.floor(np.where(n > 1, (n - 1) / np.maximum(sums, 1), 0.0) * 100_000 + 0.5) / 100_000
                columns = [mid.take(pa.array(np.repeat(np.arange(first, last), sizes))), token.dictionary.take(pa.array(words)), pa.array(value)]
                yield from pa.table(columns, names=["mid", "term", "value"]).to_batches(max_chunksize=ROWS_PER_FRAME)

    columns = f"mid {docs.schema['mid'].dataType.simpleString()}, term string, value double"
    return docs.select("mid", "tokens").repartition("mid").mapInArrow(run, columns)


def centrality(docs: DataFrame, kind: str = "closeness", window: int = 3, distinct: bool = False) -> DataFrame:
    """(mid, term, value) for every distinct word; ``distinct`` promises that no token repeats."""
    if kind not in CENTRALITIES:
        raise ValueError(f"centrality {kind} is not one of {CENTRALITIES}")
    if kind == "degree":
        return _degree(docs, window, weighted=False)
    if kind == "w_degree":
        return _degree(docs, window, weighted=True)
    if kind == "closeness" and distinct:
        return closeness_of_distinct(docs, window)
    return closeness(docs, window, weighted=kind == "w_closeness")


def tw_weights(
    docs: DataFrame,
    vocab: DataFrame,
    kind: str = "closeness",
    window: int = 3,
    mode: str = "tw",
    b: float = 0.003,
    distinct: bool = False,
) -> DataFrame:
    """(mid, term, weight) by centrality, for words of the vocabulary.

    ``tw`` keeps the centrality alone.  ``tw_idf`` multiplies by the idf and divides
    by 1 - b + b * length / average length; ``vocab`` then carries idf and avg_len.
    """
    if mode not in ("tw", "tw_idf"):
        raise ValueError(f"unknown weight mode {mode}")
    values = centrality(docs, kind, window, distinct)
    if mode == "tw":
        return values.join(vocab.select("term"), "term").select("mid", "term", F.col("value").alias("weight"))
    sized = values.join(docs.select("mid", F.size("tokens").alias("_len")), "mid")
    weight = F.col("value") * F.col("idf") / (1 - b + b * F.col("_len") / F.col("avg_len"))
    return sized.join(vocab.select("term", "idf", "avg_len"), "term").select("mid", "term", weight.alias("weight"))
