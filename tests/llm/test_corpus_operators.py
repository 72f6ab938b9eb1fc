"""Sharding, source divergence and ranked search against their definitions, on small blocks and with odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from letterloom.llm import divergence, dual_tree, sharding
from letterloom.llm.terms import LETTERS, WORDS, terms

DOCS = "doc_id long, text string, lang string, source string, size long, term string"


def odd_rows(seed, n=150):
    """A third of the rows share a source, some a text; nulls, an empty text and one very long text are there."""
    rng = random.Random(seed)
    words = ["Ñu", "été", "x1", "42"] + [f"w{chr(97 + i)}{chr(97 + i % 7)}" for i in range(25)]
    rows = [(None, None, None, None), (1, "", "en", None), (2, "... !", "de", "s1"), (3, "Wbb " * 4000, "en", "s0"), (4, "no", "only", "lone")]
    for i in range(5, n):
        text = rng.choice([" ", ", ", "_"]).join(rng.choice(words) for _ in range(rng.randrange(1, 40)))
        rows.append((rng.choice([i, i, i - 1, None]), text, rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s1", "s2", "s3", None])))
    return rows + rows[-4:]


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], DOCS).repartition(5)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_terms():
    assert terms("Éa B-c d1!", LETTERS) == ["Éa".encode(), b"b", b"c", b"d"]
    assert terms("Éa B-c d1!", WORDS) == ["Éa".encode(), b"b", b"c", b"d1"]
    assert terms(None, WORDS) == []


# --- shards ------------------------------------------------------------------------


def test_shards_match_the_mixture(spark):
    rows = odd_rows(1, 400)
    got = sharding.shard_report(table(spark, rows), shards=7).collect()
    facts = lambda t: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, *facts(t)) for d, t, _, _ in rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert sorted(by_shard) == list(range(7))
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    sizes = [len(s) for s in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1
    again = sharding.shard_report(table(spark, rows).repartition(2), shards=7)
    assert sorted_rows(again) == sorted(map(tuple, got), key=str)


def test_written_shards_hold_all_columns_in_slot_order(spark, tmp_path):
    rows = odd_rows(2, 200)
    docs = table(spark, rows)
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted_rows(back.select(*docs.columns)) == sorted_rows(docs)
    share = Counter(r.source or "" for r in docs.collect())
    for shard in range(4):
        here = Counter(r.source or "" for r in back.where(f"shard = {shard}").collect())
        assert all(abs(here[s] - n / 4) <= 2 for s, n in share.items())
    with pytest.raises(ValueError):
        sharding.write_shards(docs.selectExpr("*", "1 as shard"), str(tmp_path / "two"))


def test_few_and_no_rows(spark):
    few = sharding.shard_report(table(spark, [(1, "a", None, None), (2, None, None, None)])).collect()
    assert {r.slot for r in few} == {0} and len({r.shard for r in few}) == 2
    for report in (sharding.shard_report, divergence.audit):
        assert report(spark.createDataFrame([], DOCS)).count() == 0


# --- divergence ----------------------------------------------------------------------


def plain_audit(rows, min_docs, top):
    """Every pair of groups over every kept term, from the contract's formulas."""
    tf, df, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        tf.update((lang, source, w) for w in found)
        df.update((lang, w) for w in set(found))
    kept = defaultdict(list)
    for (lang, w), n in df.items():
        if n >= min_docs:
            kept[lang].append(w)
    out = []
    for lang, source in groups:
        v, peers = len(kept[lang]), [s for x, s in groups if x == lang]
        count = lambda s, w: tf[lang, s, w]
        total = {s: sum(count(s, w) for w in kept[lang]) for s in peers}
        p = lambda n, all_: 1 + 10**9 * (n + 2) // (all_ + 2 * v)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        pairs = [
            (sum(f(p(count(source, w), total[source]), p(count(s, w), total[s])) for w in kept[lang]), s) for s in peers if s != source
        ]
        words = []
        for w in kept[lang]:
            mine, whole = p(count(source, w), total[source]), p(sum(count(s, w) for s in peers), sum(total.values()))
            if count(source, w) and mine > whole:
                words.append((f(mine, whole), w))
        for part, found, limit in (("pair", pairs, None), ("term", words, top)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(found[:limit])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "size", "scatter"), [(1000, 200_000, 2_000_000), (2, 9, 5)])
def test_audit_equals_all_pairs(spark, monkeypatch, block, size, scatter):
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", block)
    monkeypatch.setattr(divergence, "SLICE_POSTINGS", size)
    monkeypatch.setattr(divergence, "SCATTER", scatter)
    rows = odd_rows(3)
    got = sorted_rows(divergence.audit(table(spark, rows), min_docs=4, top=3))
    assert got == plain_audit(rows, 4, 3)


def test_probability_does_not_overflow():
    count, total = np.array([0, 10**14, 7]), np.array([10**15, 10**15, 3])
    assert divergence.probability(count, total, 5).tolist() == [1 + 10**9 * (int(c) + 2) // (int(t) + 10) for c, t in zip(count, total)]


# --- ranked search ---------------------------------------------------------------------


def plain_search(rows, items, top=10):
    """Every item against every document, from the contract's formulas."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [(d, Counter(words(t))) for d, t, *_ in rows]
    docs = [(d, tf, sum(tf.values())) for d, tf in docs if tf]
    n_docs, n_terms = len(docs), sum(n for *_, n in docs)
    df = Counter(w for _, tf, _ in docs for w in tf)
    out = []
    for item, text in set(items):
        scores = []
        for d, tf, n in docs:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            one = lambda w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
            score = sum(one(w) for w in words(text) if tf[w])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("cells", "leaf", "block"), [(4_000_000, 16, 2_000_000), (600, 2, 100)])
def test_search_equals_all_pairs(spark, monkeypatch, cells, leaf, block):
    monkeypatch.setattr(dual_tree, "CELLS", cells)
    monkeypatch.setattr(dual_tree, "LEAF", leaf)
    monkeypatch.setattr(dual_tree, "BLOCK_CHARS", block)
    rng, rows = random.Random(5), odd_rows(4, 220)
    asked = [(k, " ".join(rng.choice(rows[5:])[1].split()[:9])) for k in range(25)]
    asked += [(30, None), (31, ""), (32, "zz unseen"), (33, "Wbb wbb WBB x1"), (None, "ÉTÉ été"), asked[0], (1, "wbb")]
    items = spark.createDataFrame([(*a, 1) for a in asked], "item_id long, text string, doc_id long")
    got = sorted_rows(dual_tree.ranked_search(table(spark, rows), items))
    assert got == plain_search(rows, asked)


def test_search_of_nothing(spark):
    docs, items = table(spark, odd_rows(6, 20)), spark.createDataFrame([(1, "wbb")], "item_id long, text string")
    assert dual_tree.ranked_search(docs, items.where("false")).count() == 0
    assert dual_tree.ranked_search(docs.where("false"), items).count() == 0


def test_trees_leave_out_most_pairs():
    """Bounds hold for all rows below a node, and with clustered rows most pairs of leaves are not scored."""
    rng = np.random.default_rng(2)
    topic = rng.integers(0, 20, 2000)
    impact = np.zeros((2000, 100))
    for k, t in enumerate(topic):
        impact[k, t * 5 + rng.integers(0, 5, 4)] = rng.integers(1, 1000, 4)
    items = np.zeros((64, 100))
    for k in range(64):
        items[k, (k % 20) * 5 + rng.integers(0, 5, 3)] = rng.integers(1, 50, 3)
    item_tree, doc_tree = dual_tree.grow(items, np.ones(100)), dual_tree.grow(impact, items.max(0))
    for tree, rows in ((item_tree, items), (doc_tree, impact)):
        for level in tree.levels:
            assert (level.max(0) >= rows.max(0)).all()
    best = dual_tree.Best(64, 10)
    scored = dual_tree.search(items, item_tree, impact, np.arange(2000), doc_tree, best)
    assert scored < 0.5 * len(item_tree.levels[0]) * len(doc_tree.levels[0])
    every = (items @ impact.T).astype(np.int64)
    want = np.lexsort((np.broadcast_to(np.arange(2000), every.shape), -every), axis=1)[:, :10]
    assert (best.doc == want).all()
