import random
import time

import numpy as np
import pytest

from letterloom.operators import wordgraph as wg
from tests.test_edges import brute_closeness, brute_edges


@pytest.mark.parametrize("weighted", [False, True])
def test_long_documents_without_repeats(spark, weighted):
    """The general forms take time in proportion to 20,000 words; by levels it was the third power."""
    docs = spark.range(12).selectExpr("id AS mid", "transform(sequence(1, 20000 - id), i -> lpad(string(i), 5, '0')) AS tokens")
    kind = "w_closeness" if weighted else "closeness"
    general = wg.centrality(docs, kind).withColumnRenamed("value", "got")
    closed = wg.centrality(docs, "closeness", distinct=True)
    both = general.join(closed, ["mid", "term"], "full")
    row = both.selectExpr("count(*) AS n", "count_if(abs(got - value) < 1.1e-5) AS same").first()
    assert row.n == row.same == sum(20000 - i for i in range(12))


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("window", [2, 3])
def test_narrow_and_wide_documents_together(weighted, window):
    """Words that come again near their place, chains, repeats far apart, lone pairs of any length."""
    rng = random.Random(4)
    docs = []
    for _ in range(25):
        at, walk = 0, []
        for _ in range(rng.randint(1, 30)):
            at = max(0, at + rng.choice((0, 0, 1, 1, 1, -1, 2)))
            walk.append(f"w{at}")
        docs += [walk, ["a", "b"] * rng.randint(1, 50) + ["c", "d"], [rng.choice("abcdefgh") for _ in range(rng.randint(1, 20))]]
        docs.append([f"w{i}" for i in range(rng.randint(1, 12)) for _ in range(rng.randint(1, 3))])
    tokens = np.array([t for d in docs for t in d], object)
    words, sizes, sums = wg._distance_sums(tokens, np.array([len(d) for d in docs]), window, weighted)
    at = 0
    for doc, n in zip(docs, sizes):
        got = {w: (n - 1) / s if n > 1 else 0.0 for w, s in zip(words[at : at + n], sums[at : at + n])}
        want = brute_closeness(doc, window, weighted)
        assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)
        at += n


@pytest.mark.parametrize("history", [wg.HISTORY_BYTES, 1 << 8])
def test_lines_repeated_more_often_than_levels(monkeypatch, history):
    """Edges over 64 long: words behind them only, words with a way around, and several blocks of sources."""
    monkeypatch.setattr(wg, "HISTORY_BYTES", history)
    rng = random.Random(5)
    docs = []
    for _ in range(6):
        line = [f"l{i}" for i in range(rng.randint(2, 9))]
        text = [f"t{rng.randint(0, 80)}" for _ in range(200)]
        docs += [text + line * rng.randint(66, 150), [w for x in text for w in (line + [x])], line * 70]
    tokens = np.array([t for d in docs for t in d], object)
    words, sizes, sums = wg._distance_sums(tokens, np.array([len(d) for d in docs]), 3, True)
    at = 0
    for doc, n in zip(docs, sizes):
        want = brute_closeness(doc, 3, True)
        got = {w: (n - 1) / s for w, s in zip(words[at : at + n], sums[at : at + n])}
        assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)
        at += n


def test_long_document_with_a_line_repeated():
    """One line 100 times in 4,000 other words: relaxing all edges from all words took 43 s."""
    rng = random.Random(6)
    text = [f"t{int(4000 * rng.random() ** 1.3)}" for _ in range(12_000)] + [f"t{i}" for i in range(4000)]
    doc = np.array(text[:8000] + [f"l{i}" for i in range(8)] * 100 + text[8000:], object)
    began = time.process_time()
    words, sizes, sums = wg._distance_sums(doc, np.array([len(doc)]), 3, True)
    assert time.process_time() - began < 20
    assert len(words) == sizes[0] == 4008 and (sums > 0).all()


def test_edges_and_degrees_of_split_documents(spark, monkeypatch):
    """Documents counted a few at a time; rows that share an id stay one document, also at a cut."""
    rng = random.Random(8)
    rows = [(m // 2 if m % 3 else m, [rng.choice("abcdef") for _ in range(rng.randint(0, 12))]) for m in range(90)]
    df = spark.createDataFrame([*rows, (500, None)], "mid long, tokens array<string>").coalesce(1)
    monkeypatch.setattr(wg, "TOKENS_AT_ONCE", 15)
    monkeypatch.setattr(wg, "DOCS_AT_ONCE", 2)
    want, terms = {}, {}
    for mid, doc in rows:
        terms.setdefault(mid, set()).update(doc)
        for (a, b), n in brute_edges(doc, 3).items():
            want[mid, a, b] = want.get((mid, a, b), 0) + n
    edges = wg.word_edges(df)
    found = edges.collect()
    assert len(found) == len(want) and {(r.mid, r.a, r.b): r.weight for r in found} == want
    assert "Aggregate" not in edges._jdf.queryExecution().optimizedPlan().toString()  # a partition's edges spilled
    for kind in ("degree", "w_degree"):
        sums = {(m, t): 0 for m, some in terms.items() for t in some}
        for (m, a, b), n in want.items():
            for t in (a, b):
                sums[m, t] += n if kind == "w_degree" else 1
        got = {(r.mid, r.term): r.value for r in wg.centrality(df, kind).collect()}
        assert got.keys() == sums.keys()
        assert all(abs(got[k] - (s / (len(terms[k[0]]) - 1) if len(terms[k[0]]) > 1 else 0)) < 1.1e-5 for k, s in sums.items())
