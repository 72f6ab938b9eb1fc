"""Audit of how far the sources of a language differ in their words, by row accumulation over a term-major index.

The index has one row per kept term of a language, with the sources that use it and how often.  It is
cut into slices of terms.  In a slice each source goes through its terms, and each term scatters
into a dense row with one cell per peer, as in Gustavson's product of sparse matrices.  No pair of
postings ever becomes a row.

A source that lacks a term still gives it a baseline probability.  So a row starts from what all
terms would add at both baselines; a term of the source adds the difference that its own
probability makes against the peer's baseline, a term of the peer the same the other way round, and only
where both hold a term the scatter puts the true value in place of the two corrections.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from letterloom.llm import common as c
from letterloom.llm.terms import LETTERS, term_counts

MIN_DOCS = 10
SCALE_STEPS = 3  # probabilities are in units of 1 / 1000**3
TOP_TERMS = 10
BLOCK_SOURCES = 1_000  # sources of a block; a task holds two blocks' cells, 8 MB a matrix
SLICE_POSTINGS = 200_000  # postings of a slice of terms
SCATTER = 2_000_000  # postings gathered at once


def probability(count: np.ndarray, total: np.ndarray, n_terms: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * n_terms)), by long division in steps of 1,000 that cannot overflow."""
    over = np.asarray(total, np.int64) + 2 * n_terms
    whole, rest = np.divmod(np.asarray(count, np.int64) + 2, over)
    for _ in range(SCALE_STEPS):
        step, rest = np.divmod(rest * 1000, over)
        whole = whole * 1000 + step
    return whole + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q))."""
    return (p - q) ** 2 // (p + q)


def accumulate(starts: np.ndarray, source: np.ndarray, p: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Sum over the terms of a slice of ``difference`` between any two sources, less the value at both baselines.

    The postings of term t are ``source[starts[t]:starts[t + 1]]`` with probabilities ``p``; ``base`` has
    each source's probability of a term that it lacks.
    """
    n = len(base)
    none = difference(base[:, None], base[None, :])
    one = np.zeros((n, n), np.int64)  # row's own terms against each peer's baseline
    both = np.zeros((n, n), np.int64)
    term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    by_row = np.argsort(source, kind="stable")
    edges = np.searchsorted(source[by_row], np.arange(n + 1))
    for g in range(n):
        own = by_row[edges[g] : edges[g + 1]]
        values, times = np.unique(p[own], return_counts=True)
        for k in range(0, len(values), max(1, SCATTER // n)):
            some = slice(k, k + max(1, SCATTER // n))
            one[g] += ((difference(values[some, None], base[None, :]) - none[g]) * times[some, None]).sum(0)
        sizes = starts[term[own] + 1] - starts[term[own]]
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(SCATTER, int(sizes.sum()) + SCATTER, SCATTER))
        for part in np.split(own, np.unique(cuts)):
            if not len(part):
                continue
            first, size = starts[term[part]], starts[term[part] + 1] - starts[term[part]]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) - np.repeat(ends - size, size) + np.repeat(first, size)
            mine, peer = np.repeat(p[part], size), source[at]
            value = difference(mine, p[at]) - difference(mine, base[peer]) - difference(base[g], p[at]) + none[g][peer]
            np.add.at(both[g], peer, value)
    return one + one.T + both


_OUT = "lang string, source string, part string, item string, value long"


def _unit(table: pa.Table, top: int) -> pa.Table:
    """Pair sums and leading terms of one slice of terms and one pair of blocks of sources."""
    kind = table.column("term").is_null().to_numpy()
    groups = table.filter(pa.array(kind)).combine_chunks()
    rows = table.filter(pa.array(~kind)).combine_chunks().sort_by("term")
    names = groups.column("source").to_pylist()
    lang, v = groups.column("lang")[0].as_py(), groups.column("v")[0].as_py()
    total = groups.column("n").to_numpy()
    block, first_slice = groups.column("block").to_numpy(), groups.column("slice")[0].as_py() == 0
    a, b = groups.column("a")[0].as_py(), groups.column("b")[0].as_py()
    base = probability(np.zeros(len(names), np.int64), total, v) if v else np.ones(len(names), np.int64)
    postings = rows.column("postings").combine_chunks()
    flat = postings.flatten()
    starts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(postings)))]).astype(np.int64)
    source = np.asarray(pc.index_in(flat.field("source"), pa.array(names))).astype(np.int64)
    count = np.asarray(flat.field("tf")).astype(np.int64)
    p = probability(count, total[source], v) if len(count) else count
    sums = accumulate(starts, source, p, base)
    if first_slice and v:
        sums += v * difference(base[:, None], base[None, :])
    wanted = (block[:, None] == a) & (block[None, :] == b)
    wanted |= wanted.T
    np.fill_diagonal(wanted, False)
    if not first_slice:
        wanted &= sums != 0
    g, h = np.nonzero(wanted)
    out = [(names[i], "pair", names[j], int(sums[i, j])) for i, j in zip(g.tolist(), h.tolist())]
    if a == b and len(count):
        lang_total = groups.column("lang_n")[0].as_py()
        term = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        q = probability(rows.column("tf").to_numpy(), np.int64(lang_total), v)[term]
        words, value = rows.column("term").to_pylist(), np.where(p > q, difference(p, q), -1)
        order = np.lexsort((term, -value, source))
        order = order[value[order] >= 0]
        place = np.arange(len(order)) - np.searchsorted(source[order], source[order])
        out += [(names[source[k]], "term", words[term[k]], int(value[k])) for k in order[place < top].tolist()]
    columns = list(zip(*out)) if out else [()] * 4
    types = (pa.string(), pa.string(), pa.string(), pa.int64())
    arrays = [pa.array(x, t) for x, t in zip(columns, types)]
    return pa.table([pa.array([lang] * len(out), pa.string()), *arrays], names=["lang", "source", "part", "item", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` of each (lang, source) group of ``docs``.

    Part ``pair`` has the difference to every other source of the language, part ``term`` the ``top`` terms that
    the group uses more than its language.  Null texts, languages and sources are read as ''.  A
    language without kept terms has pairs of value 0.  Repeated rows count each time; ties go by
    the item's bytes.  An empty table gives no rows; texts are whole, whatever their length; other columns play no part.
    """
    read = docs.select(*[F.coalesce(n, F.lit("")).alias(n) for n in ("lang", "source", "text")])
    counts = c.stage(term_counts(read, ["lang", "source"], LETTERS), "audit-counts")
    postings = F.collect_list(F.struct("source", "tf"))
    index = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"), postings.alias("postings"))
    index = c.stage(index.where(F.col("df") >= min_docs).drop("df"), "audit-index")
    one = F.explode("postings").alias("p")
    in_group = index.select("lang", one).groupBy("lang", F.col("p.source").alias("source")).agg(F.sum("p.tf").alias("n"))
    in_lang = index.groupBy("lang").agg(F.sum("tf").alias("lang_n"), F.count(F.lit(1)).alias("v"))
    groups = counts.where("term is null").select("lang", "source").join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left")
    groups = c.stage(groups.na.fill(0, ["n", "lang_n", "v"]), "audit-groups")

    # Blocks and slices follow from the sizes of the written tables: two numbers come to the driver.
    n_groups = groups.groupBy("lang").count().agg(F.max("count").alias("n")).first()["n"] or 0
    n_postings = index.agg(F.sum(F.size("postings")).alias("n")).first()["n"] or 0
    blocks, slices = -(-n_groups // BLOCK_SOURCES) or 1, -(-n_postings // SLICE_POSTINGS) or 1
    units = F.explode(F.expr(f"flatten(transform(sequence(0, {blocks - 1}), a -> transform(sequence(a, {blocks - 1}), b -> named_struct('a', a, 'b', b))))"))
    block = lambda source: F.pmod(F.xxhash64(source), F.lit(blocks)).cast("int")
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    marks = groups.withColumn("block", block("source")).withColumn("u", units)
    marks = marks.where("block = u.a or block = u.b").withColumn("slice", every_slice)
    marks = marks.select("lang", "u.a", "u.b", "slice", "source", "block", "n", "v", "lang_n")
    inside = lambda u: F.filter("postings", lambda x: block(x["source"]).isin(u["a"], u["b"])) if blocks > 1 else F.col("postings")
    rows = index.withColumn("u", units).withColumn("postings", inside(F.col("u"))).where(F.size("postings") > 0)
    rows = rows.select("lang", "u.a", "u.b", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int").alias("slice"), "term", "tf", "postings")

    def run(table: pa.Table) -> pa.Table:
        return _unit(table, top)

    both = rows.unionByName(marks, allowMissingColumns=True)
    found = c.stage(both.groupBy("lang", "a", "b", "slice").applyInArrow(run, _OUT), "audit-found")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    first = found.where("part = 'term'").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(first)
