"""Jaccard join of word shingle sets by chosen paths.

A set picks tokens by hash, each with a chance that makes one common pick likely for two sets as
similar as the threshold.  Every pick is a path, which picks again among the tokens that it has
not used, ``LEVELS`` deep; the last picks of all paths are the set's buckets.  So every bucket, of
whatever size, has been split as often as any other.  Buckets are joined by brute force, and
``runs`` independent runs reach the target recall.

Texts with equal shingle sets are one node, so copies meet no join at all.  Brute force takes
exact set sizes; a pair is counted in the least of the buckets that its nodes share, and
only there.  A bucket that is still large, say of near copies of one text, is cut into blocks,
and each pair of blocks is a unit of work of bounded size.  No pair is ever a row: units
give link counts and spanning edges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.llm import common as c
from letterloom.llm.components import components
from letterloom.llm.repeats import gram_hashes, mix
from letterloom.operators.skew import skew_join

SHINGLE = 5
NUMERATOR, DENOMINATOR = 4, 5  # similarity of 0.8 or more
RECALL = 0.999  # of pairs right at the threshold
LEVELS = 3  # picks of a path
WHOLE = 2_000  # larger buckets go to the block join without the bitmap test, which only saves work
BLOCK = 400
BITS = 512
PART_ROWS, PART_BYTES = 20_000, 8_000_000  # sets, and bytes of tokens, that a task takes on at once

_u64 = np.uint64


def runs_for(recall: float = RECALL, levels: int = LEVELS) -> int:
    """Runs needed: a path of picked tokens survives a level with a chance of 1 - exp(-chance so far)."""
    chance = 1.0
    for _ in range(levels):
        chance = 1 - math.exp(-chance)
    return math.ceil(math.log(1 - recall) / math.log(1 - chance))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of five words; a shorter text is one shingle of all its words."""
    words = c.utf8(text).split()
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _u64, len(words))
    return np.unique(gram_hashes(ids, min(SHINGLE, len(ids)))) if len(ids) else ids


def paths(tokens: np.ndarray, runs: int, levels: int = LEVELS) -> np.ndarray:
    """Keys of the buckets that all chosen paths end in.

    A token goes on a path if its hash with the path's key is small.  On its k-th pick a path has
    used k - 1 tokens, which two similar sets share; of the others they share ``threshold * size - k + 1``
    or more, so a chance of one by that number gives one common pick on average at every level.
    A set with fewer tokens than levels ends up in no bucket; it is similar to equal sets only.
    """
    seeds, used = mix(np.arange(1, runs + 1, dtype=_u64)), np.zeros((runs, 0), _u64)
    marks = mix(tokens)
    for level in range(levels):
        shared = len(tokens) * NUMERATOR / DENOMINATOR - level
        if len(tokens) <= level or not len(seeds):
            return np.zeros(0, _u64)
        limit = _u64(2**64 - 1) if shared <= 1 else _u64(int(2**64 / shared))
        path, at = [], []
        step = max(1, 200_000 // len(tokens))  # a very long text takes a few paths at once
        for start in range(0, len(seeds), step):
            hit = mix(tokens[None, :] ^ seeds[start : start + step, None]) <= limit
            for k in range(level):
                hit &= tokens[None, :] != used[start : start + step, k, None]
            row, column = np.nonzero(hit)
            path.append(row + start)
            at.append(column)
        path, at = np.concatenate(path), np.concatenate(at)
        seeds = mix(marks[at] ^ seeds[path])
        used = np.column_stack([used[path], tokens[at]])
    return np.unique(seeds)


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """``BITS`` bits, each the parity of the tokens that fall on it.

    Two bitmaps differ in no more bits than their sets differ in tokens.
    """
    parity = np.bincount((tokens % _u64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(parity.astype(np.uint8))


_ROWS = "doc_id long, tag long, set binary, size long, bits binary, keys array<long>"


def describe(docs: DataFrame, runs: int) -> DataFrame:
    """``doc_id, tag, set, size, bits, keys`` per row: digest, size, bitmap and buckets of its shingle set."""

    def row(r: dict) -> tuple:
        tokens = shingles(r["text"])
        digest = bytes.fromhex(c.sha(tokens.tobytes())[:32]) if len(tokens) else None
        return r["doc_id"], r["tag"], digest, len(tokens), bitmap(tokens).tobytes(), paths(tokens, runs).view(np.int64)

    return c.map_rows(docs.select("doc_id", F.xxhash64("text").alias("tag"), "text"), row, _ROWS)


_SIGN = -(2**63)


def _node(doc: Column, digest: Column) -> Column:
    """24 bytes that sort by doc_id and then by the set's digest."""
    return F.concat(F.unhex(F.lpad(F.hex(doc.bitwiseXOR(F.lit(_SIGN))), 16, "0")), digest)


def _node_doc(node: Column) -> Column:
    high = F.conv(F.hex(F.substring(node, 1, 8)), 16, -10).cast("bigint").bitwiseXOR(F.lit(_SIGN))
    return F.when(high != c.NULL_ID, high)


def _hot(sizes: DataFrame) -> DataFrame:
    """Keys, of ``key, n``, with more than a shuffle partition's fair share of all rows, and their number of shares."""
    fan = c.shuffle_partitions(sizes.sparkSession)
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    return sizes.where(F.col("n") * fan > total).select("key", F.ceil(F.col("n") * fan / max(1, total)).cast("int").alias("_slices"))


def _by_key(rows: DataFrame, facts: DataFrame, hot: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the facts of their bucket; the rows of a hot bucket are dealt over many tasks."""
    return skew_join(rows, facts, ["key"], spread=["set"], how=how, hot=hot)


def _buckets(nodes: DataFrame) -> DataFrame:
    """``key, set, n`` rows of buckets with two sets or more."""
    flat = nodes.select("set", F.explode("keys").alias("key"))
    sizes = c.stage(flat.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bucket-sizes")
    return _by_key(flat, sizes, _hot(sizes))


def _possible(buckets: DataFrame, sketches: DataFrame, parts: int) -> DataFrame:
    """Rows of ``buckets`` whose set has a partner in the bucket that size and bitmap do not rule out.

    Sets as similar as the threshold differ in at most (D - N) / (D + N) of the sum of their
    sizes, so a pair whose bitmaps differ in more bits is none.  Rows of buckets of more than
    ``WHOLE`` sets all stay; those are cut into blocks later.
    """

    def run(table: pa.Table) -> pa.Table:
        key, size = table.column("key").to_numpy(), table.column("size").to_numpy()
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), _u64).reshape(len(key), BITS // 64)
        keep = np.zeros(len(key), bool)
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
        for at in np.split(order, edges[1:]):
            if len(at) > WHOLE:
                keep[at] = True
                continue
            for start in range(0, len(at), 64):
                some = at[start : start + 64]
                apart = np.bitwise_count(bits[some, None] ^ bits[None, at]).sum(2, dtype=np.int64)
                ok = apart * (DENOMINATOR + NUMERATOR) <= (size[some, None] + size[None, at]) * (DENOMINATOR - NUMERATOR)
                ok[np.arange(len(some)), np.arange(start, start + len(some))] = False
                keep[some] = ok.any(1)
        rows = pa.array(np.flatnonzero(keep))
        kept = table.select(["key", "set"]).take(rows)
        c.give_back()
        return kept

    joined = buckets.where(F.col("n") <= WHOLE).join(sketches, "set").select("key", "set", "size", "bits")
    joined = joined.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)))
    kept = joined.groupBy("part").applyInArrow(run, "key long, set binary")
    return kept.unionByName(buckets.where(F.col("n") > WHOLE).select("key", "set"))


def _neighbours(lists: DataFrame, keys: str) -> DataFrame:
    """``key, n, other`` once for each key in an ascending list of (key, n) and the key before it."""
    at = F.when(F.size(keys) > 1, F.sequence(F.lit(1), F.size(keys) - 1))
    pair = lambda i: F.struct(F.get(keys, i)["key"].alias("key"), F.get(keys, i)["n"].alias("n"), F.get(keys, i - 1)["key"].alias("other"))
    return lists.select(F.explode(F.transform(at, pair)).alias("p")).select("p.*")


def _distinct_buckets(rows: DataFrame) -> DataFrame:
    """``key, set, n`` without buckets whose pairs all meet in a bucket with a lesser key too.

    First go those with the very same sets, then those whose sets all have one and the same bucket
    before this one in their list.  What stays is only more work, since a pair is counted once.
    """
    member = F.xxhash64("set")
    signature = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(member).alias("x"), F.sum(F.shiftright(member, 20)).alias("s")
    )
    signature = c.stage(signature, "bucket-signatures")
    kept = signature.groupBy("n", "x", "s").agg(F.min("key").alias("key")).select("key", "n")
    kept = c.stage(kept, "bucket-kept-keys")
    rows = c.stage(_by_key(rows, kept, _hot(signature.select("key", "n"))), "bucket-kept")
    lists = rows.groupBy("set").agg(F.array_sort(F.collect_list(F.struct("key", "n"))).alias("in"))
    meet = _neighbours(lists, "in").groupBy("key", "other").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("met"))
    inside = meet.where(F.col("met") == F.col("n")).select("key")
    out = c.stage(_by_key(rows, inside, _hot(kept), "left_anti"), "join-buckets")
    c.drop_stage(rows, signature, kept)
    return out


def _units(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``key, low, high, block, set, shared`` rows: each (key, low, high) is a unit of two blocks at most.

    ``shared`` lists the keys of all buckets of the node.  In a large bucket most nodes also
    meet in another large bucket with a lesser key; pairs of two such nodes are counted there, so
    their blocks are not set against each other here.
    """
    hot = _hot(sizes)
    lists = rows.groupBy("set").agg(F.array_sort(F.collect_list(F.struct("key", "n"))).alias("in"))
    large = lists.select(F.filter("in", lambda x: x["n"] > BLOCK).alias("large"))
    meet = _neighbours(large, "large").groupBy("key", "other").count()
    main = meet.groupBy("key").agg(F.max_by("other", F.struct("count", "other")).alias("main"))
    rows = rows.join(lists.select("set", F.transform("in", lambda x: x["key"]).alias("shared")), "set")
    rows = _by_key(rows, main, hot, "left")
    rows = rows.withColumn("covered", F.coalesce(F.array_contains("shared", F.col("main")), F.lit(False)))
    parts = rows.groupBy("key").agg(F.count_if("covered").alias("n_covered"), F.count_if(~F.col("covered")).alias("n_open"))
    rows = _by_key(rows, parts, hot)
    n_open = F.ceil(F.col("n_open") / BLOCK).cast("int")
    n_all = n_open + F.ceil(F.col("n_covered") / BLOCK).cast("int")
    place = F.xxhash64(F.lit(3), "set")
    block = F.when(F.col("covered"), n_open + F.pmod(place, n_all - n_open)).otherwise(F.pmod(place, F.greatest(n_open, F.lit(1))))
    rows = rows.withColumn("block", block.cast("int")).withColumn("n_other", F.when(F.col("covered"), n_open).otherwise(n_all))
    rows = rows.where("n_other > 0").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_other") - 1)))
    return rows.select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "set", "shared"
    )


_LINKS = "node binary, links long, parent binary"


def _join_unit(key: int, block: np.ndarray, nodes: list[bytes], copies: np.ndarray, shared: list[list[int]], sets: list[np.ndarray]):
    """Links per row, counted in copies, and the least row of each row's component."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(n), size)
    both = _overlaps(np.concatenate(sets), row, n)
    linked = both * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (size[:, None] + size[None, :])
    np.fill_diagonal(linked, False)
    if block.min() != block.max():  # two blocks: only pairs across
        linked &= block[:, None] != block[None, :]
    lesser = [[k for k in keys if k < key] for keys in shared]
    if linked.any() and any(lesser):
        counts = np.array([len(x) for x in lesser])
        tokens = np.array([k for x in lesser for k in x], np.int64)
        linked &= _overlaps(tokens, np.repeat(np.arange(n), counts), n) == 0
    links = linked @ copies
    label = np.argsort(np.argsort(np.array(nodes, object)))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], n).min(1))
        if (least == label).all():
            break
        label = least
    return links, label


def _overlaps(tokens: np.ndarray, row: np.ndarray, n: int, width: int = 2048) -> np.ndarray:
    """Number of tokens that each two rows share, by products of 0/1 matrices over chunks of tokens."""
    _, code, count = np.unique(tokens, return_inverse=True, return_counts=True)
    keep = count[code] > 1
    number = np.cumsum(count > 1) - 1
    code, row = number[code[keep]], row[keep]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        lo, hi = np.searchsorted(code, [start, start + width])
        cells = np.zeros((n, min(width, int(code[-1]) + 1 - start)), np.float32)
        cells[row[lo:hi], code[lo:hi] - start] = 1
        out += cells @ cells.T
    return out.astype(np.int64)


def _links(units: DataFrame, sets: DataFrame, parts: int) -> DataFrame:
    """``node, links, parent`` per unit and node with links."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        groups: dict[tuple, list[int]] = {}
        for i, unit in enumerate(zip(rows["key"], rows["low"], rows["high"])):
            groups.setdefault(unit, []).append(i)
        out: list[tuple] = []
        for (key, _, _), at in groups.items():
            nodes = [rows["node"][i] for i in at]
            links, label = _join_unit(
                key, np.array([rows["block"][i] for i in at]), nodes, np.array([rows["copies"][i] for i in at]),
                [rows["shared"][i] for i in at], [_long(rows["tokens"][i]) for i in at],
            )
            if links.any():
                ranked = sorted(nodes)
                out += [(nodes[k], int(links[k]), ranked[label[k]]) for k in np.flatnonzero(links)]
        node, link, parent = zip(*out) if out else ((), (), ())
        del rows, groups
        c.give_back()
        return pa.table([pa.array(node, pa.binary()), pa.array(link, pa.int64()), pa.array(parent, pa.binary())], names=["node", "links", "parent"])

    joined = units.join(sets, "set").drop("set").withColumn("part", F.pmod(F.xxhash64("key", "low", "high"), F.lit(parts)))
    return joined.groupBy("part").applyInArrow(run, _LINKS)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``set, node, copies, tokens`` of the wanted sets, from the text of one row of each."""
    chosen = docs.select(c.order_id().alias("doc"), F.xxhash64("text").alias("tag"), "text")
    picked = chosen.join(wanted.select("set", "node", "copies", "doc", "tag"), ["doc", "tag"])
    names = ("set", "node", "copies", "text")
    picked = picked.groupBy("doc", "tag").agg(*[F.first(x).alias(x) for x in names]).select(*names)  # repeated rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [_short(shingles(t)) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(tokens, pa.binary())], names=["set", "node", "copies", "tokens"])

    return picked.mapInArrow(run, "set binary, node binary, copies long, tokens binary")


def _short(tokens: np.ndarray) -> bytes:
    """Six bytes of each token: enough to tell the tokens of two texts apart."""
    return tokens.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(data: bytes) -> np.ndarray:
    short = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, :6] = short
    return out.view(_u64)[:, 0]


def join(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``doc_id, tag, class_id, class_tag, copy_id, n_links`` for every row of ``docs``.

    ``n_links`` counts the other rows whose shingle sets are as similar as the threshold;
    ``copy_id`` is the least doc_id with an equal set; ``class_id`` that of all rows linked
    directly or in steps.  ``tag`` hashes the text; ``class_tag`` is that of the text that stands
    for the class.  A text without words has no set: it has no links and is a class of its
    own.  Repeated rows are copies; a null doc_id sorts last and shows as null.
    """
    docs = c.documents(docs)
    described = c.stage(describe(docs, runs_for(recall)), "join-described")
    first = F.struct(c.order_id().alias("doc"), "tag")
    facts = [F.first(x).alias(x) for x in ("size", "bits", "keys")]  # these follow from the set
    nodes = described.where("set is not null").groupBy("set").agg(F.count(F.lit(1)).alias("copies"), F.min(first).alias("f"), *facts)
    nodes = nodes.select("set", "copies", "f.*", "size", "bits", "keys", _node(F.col("f.doc"), F.col("set")).alias("node"))
    sketched = c.stage(nodes, "join-sketched")
    nodes = c.stage(sketched.select("set", "copies", "doc", "tag", "size", "node"), "join-nodes")
    rows = c.stage(described.select("doc_id", "tag", "set"), "join-rows")
    c.drop_stage(described)
    level = c.stage(_buckets(sketched), "join-level")
    parts = -(-level.count() // PART_ROWS) or 1
    possible = c.stage(_possible(level, sketched.select("set", "size", "bits"), parts), "join-possible")
    c.drop_stage(level, sketched)
    buckets = _distinct_buckets(possible)
    wanted = nodes.join(buckets.select("set").distinct(), "set", "left_semi")
    sizes = c.stage(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "join-sizes")
    units = c.stage(_units(buckets, sizes), "join-units")
    mean = nodes.agg(F.avg("size").alias("n")).first()["n"] or 0
    parts = int(units.count() * mean * 6 // PART_BYTES) + 1
    links = c.stage(_links(units, _sets(docs, wanted), parts), "join-links")
    c.drop_stage(possible, buckets, sizes, units)
    linked = components(links.select(F.col("node").alias("child"), "parent"))
    totals = links.groupBy("node").agg(F.sum("links").alias("links"))
    heads = linked.select(F.col("child").alias("node"), F.col("parent").alias("head"))
    result = (
        nodes.select("set", "node", "copies", "doc", "tag")
        .join(totals, "node", "left")
        .join(heads, "node", "left")
        .withColumn("head", F.coalesce("head", "node"))
    )
    stands = nodes.select(F.col("node").alias("head"), F.col("tag").alias("class_tag"))
    result = result.join(stands, "head").select(
        "set",
        _node_doc(F.col("head")).alias("class_id"),
        "class_tag",
        _node_doc(F.col("node")).alias("copy_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = rows.select("doc_id", "tag", "set").join(result, "set", "left")
    alone = F.col("set").isNull()
    return out.select(
        "doc_id",
        "tag",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.col("tag")).otherwise(F.col("class_tag")).alias("class_tag"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_id")).alias("copy_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per class: the text that stands for it; all columns stay.

    Rows that agree in doc_id and text are the same document; one of them stays.
    """
    classes = join(docs)
    heads = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("tag") == F.col("class_tag")))
    doc, tag = c.free_name(docs, "doc"), c.free_name(docs, "tag")
    heads = heads.select(c.order_id().alias(doc), F.col("tag").alias(tag)).distinct()
    text = F.coalesce("text", F.lit(""))
    marked = docs.withColumns({doc: c.order_id().cast("bigint"), tag: F.xxhash64(text)})
    kept = marked.join(heads, [doc, tag], "left_semi").dropDuplicates([doc, tag])
    return kept.select(*docs.columns)


def jaccard_report(docs: DataFrame) -> DataFrame:
    """One row per document: class, copies' least id and number of links."""
    return join(docs).select("doc_id", "class_id", "copy_id", "n_links")
