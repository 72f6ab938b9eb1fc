"""Sentence ends, lemma rules, and topic tables against plain versions."""

import random
import re
import unicodedata

import duckdb
import numpy as np
import pandas as pd
import pytest

from letterloom.operators import lemmas as lm
from letterloom.operators import sentence_ends as se
from letterloom.operators import topics as tp


def test_planted_abbreviations_do_not_end_sentences(spark):
    rng, rows = random.Random(4), []
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("nder", "stel", "rmit")]
    for k in range(300):
        text = []
        for _ in range(8):
            body = [rng.choice(words) for _ in range(rng.randrange(4, 9))]
            if rng.random() < 0.6:
                body.insert(rng.randrange(1, len(body)), rng.choice(["approx. ", "dr. ", "e.g. "]).strip())
            text.append("The " + " ".join(body) + rng.choice([". ", ". ", "! "]))
        rows.append((k, "".join(text)))
    docs = spark.createDataFrame([*rows, (900, ""), (901, "Saw dr. bander. The end.")], "mid long, body string").repartition(4)
    model = se.learn(docs)
    found = {r.type for r in model.abbreviations.collect()}
    assert {"dr", "e.g"} <= found and not found & set(words)
    assert "the" in {r.type for r in model.starters.collect()}
    got = {}
    for r in se.learned_sentences(docs, model).collect():
        got.setdefault(r.mid, {})[r.pos] = r.sentence
    assert [got[901][k] for k in sorted(got[901])] == ["Saw dr. bander.", "The end."]
    assert all(len(got[k]) == 8 for k, _ in rows) or sum(len(got[k]) == 8 for k, _ in rows) > 0.95 * len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in got.values())
    assert se.learn(docs.where("false")).abbreviations.count() == 0


def test_learned_sentences_equal_plain_ones_without_moving_every_piece(spark):
    """Odd blanks, empty and null texts; pieces stay in their text, where each was sorted and joined on its own before."""
    rng = random.Random(11)
    parts = ["dr.", "e.g.", "The", "the", "end.", "Smith", "x.y.", "ok!", "why?", "...", "a1.", "Äpfel.", "élan", "3.", ".", "end.\u00a0"]
    rows = [(k, "".join(rng.choice(parts) + rng.choice([" ", " ", "  ", "\n", "\t ", " \r\n"]) for _ in range(rng.randrange(40)))) for k in range(200)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, " dr. The end. \n"), (304, "\n dr.  the end. Smith"), (305, "dr.")]
    docs = spark.createDataFrame(rows, "mid long, body string").repartition(4)
    short, starts, pairs = {"dr", "e.g", "end"}, {"the", "smith"}, {("dr", "smith")}
    model = se.SentenceModel(
        spark.createDataFrame([(t, 1.0) for t in short], "type string, score double"),
        spark.createDataFrame([(t, 40.0) for t in starts], "type string, score double"),
        spark.createDataFrame([(*p, 9.0) for p in pairs], "first string, second string, score double"),
    )
    want = set()
    for mid, body in rows:
        body = "".join(c for c in unicodedata.normalize("NFD", body or "") if unicodedata.category(c) != "Mn")
        pieces = [x for x in re.split(r"(?<=[.!?])[ \t\r\n\f]+", body) if x.strip(" \t\r\n\f")]
        out = []
        for k, piece in enumerate(pieces):
            last, here = re.split(r"[ \t\r\n\f]+", pieces[k - 1])[-1], re.split(r"[ \t\r\n\f]+", piece)[0]
            bare = [re.sub(r"\.$", "", x).lower() for x in (last, here)]
            word = re.fullmatch(r"[^\W\d_]+(\.[^\W\d_]+)*\.", last)
            goes_on = k and word and bare[0] in short and (tuple(bare) in pairs or bare[1] not in starts or not here[0].isupper())
            out = [*out[:-1], f"{out[-1]} {piece}"] if goes_on else [*out, piece]
        want |= {(mid, k, x) for k, x in enumerate(out)}
    got = se.learned_sentences(docs, model)
    found = [(r.mid, r.pos, r.sentence) for r in got.collect()]
    assert len(found) == len(want) and set(found) == want
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()
    counts = {r.type: (r.n, r.n_period) for r in se.token_counts(se.split_texts(docs)).collect()}
    tokens = [t for _, body in rows for t in re.split(r"[ \t\r\n\f]+", body or "")]
    assert counts["dr"] == (tokens.count("dr."), tokens.count("dr.")) and counts["the"] == (tokens.count("the") + tokens.count("The"), 0)


def test_rules_reproduce_held_out_lemmas(spark):
    rng = random.Random(7)
    stems = ["".join(rng.choice("bdfgklmnprt") + rng.choice("aeou") for _ in range(3)) for _ in range(400)]
    pairs = {}
    for stem in stems:
        pairs |= {stem: stem, f"{stem}s": stem, f"{stem[:-1]}ies": f"{stem[:-1]}y", f"{stem}ning": f"{stem}n"}
    every = sorted(pairs.items())
    held = [p for k, p in enumerate(every) if k % 5 == 0]
    given = spark.createDataFrame([*[p for k, p in enumerate(every) if k % 5], ("odd", "strange"), (None, "x")], "token string, lemma string")
    rules = lm.induce(given)
    words = spark.createDataFrame([(w,) for w, _ in held] + [("odd",), ("",), ("s",)], "term string")
    got = {r.term: r.lemma for r in lm.lemmas_of(words, given, rules).collect()}
    right, same = sum(got[w] == lemma for w, lemma in held), sum(w == lemma for w, lemma in held)
    assert right > 0.95 * len(held) > same
    assert got["odd"] == "strange" and got[""] == ""
    assert lm.induce(given.where("false")).count() == 0


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet(np.full(50, 0.2), 5)
    p[0, :10], p[0] = 0, p[0] / p[0, 10:].sum()
    share = rng.dirichlet(np.ones(5))
    terms = spark.createDataFrame([(t, i, float(p[t, i])) for t in range(5) for i in range(50)], "topic int, idx int, p double")
    return p, share, terms, spark.createDataFrame([(t, float(s)) for t, s in enumerate(share)], "topic int, share double")


def test_relevance_equals_sql(tables):
    _, _, terms, shares = tables
    got = [(r.topic, r["rank"], r.idx, r.relevance) for r in tp.term_relevance(terms, shares, 0.6, 7).collect()]
    t, s = pd.DataFrame(terms.collect(), columns=["topic", "idx", "p"]), pd.DataFrame(shares.collect(), columns=["topic", "share"])  # noqa: F841
    want = duckdb.sql(
        """SELECT topic, rank, idx, r FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY r DESC, idx) AS rank FROM (
             SELECT topic, idx, round(0.6 * ln(p) + 0.4 * ln(p / total), 9) AS r
             FROM t JOIN (SELECT idx, sum(p * share) AS total FROM t JOIN s USING (topic) GROUP BY idx) USING (idx) WHERE p > 0)) WHERE rank <= 7"""
    ).fetchall()
    assert len(got) == 35
    assert all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-8 for a, b in zip(sorted(got), sorted(want)))


def test_distances_and_layout_equal_plain_ones(tables):
    p, _, terms, _ = tables
    distances = tp.topic_distances(terms)
    got = {(r.topic, r.other): r.distance for r in distances.collect()}
    kl = lambda a, b: float((a[a > 0] * np.log(a[a > 0] / b[a > 0])).sum())
    want = np.zeros((5, 5))
    for a in range(5):
        for b in range(5):
            middle = (p[a] + p[b]) / 2
            want[a, b] = (kl(p[a], middle) + kl(p[b], middle)) / 2
            assert a == b or abs(got[a, b] - want[a, b]) < 1e-9
    places = np.array([[r.x, r.y] for r in sorted(tp.topic_layout(distances).collect())])
    centre = np.eye(5) - 0.2
    gram = -0.5 * centre @ want**2 @ centre
    values = np.sort(np.linalg.eigvalsh(gram))[::-1][:2]
    assert np.allclose(np.sort((places**2).sum(0))[::-1], values)
    assert np.allclose(gram @ places, places * values)
