import random

import pytest
from pyspark.sql import functions as F

from letterloom.operators import vectors as vec
from letterloom.operators import vocab as vc


@pytest.fixture
def small_parts(monkeypatch):
    for name, value in (("PART_ROWS", 7), ("LEAST_ROWS", 3), ("ROWS_AT_ONCE", 4)):
        monkeypatch.setattr(vec, name, value)


def _tables(spark):
    rng = random.Random(4)
    counts = [(m, f"t{t}", rng.randint(1, 5)) for m in range(12) for t in rng.sample(range(20), 5)] + [(12, "lost", 2), (13, "t1", 3), (13, "lost", 1)]
    words = {f"t{t}": [rng.random() for _ in range(3)] for t in range(18)}
    docs = spark.createDataFrame([(m,) for m in range(15)], "mid long")
    return counts, words, docs, spark.createDataFrame(list(words.items()), "term string, vector array<double>")


def _check(found, want):
    got = {r.mid: r.vector for r in found}
    assert len(found) == len(got) and got.keys() == set(range(15))
    assert all(abs(x - y) < 1e-12 for m in got for x, y in zip(got[m], want.get(m, [0.0] * 3), strict=True))


def test_uniform_in_parts(spark, small_parts):
    counts, words, docs, vectors = _tables(spark)
    want = {}
    for m in range(14):
        own = [(t, c) for i, t, c in counts if i == m]
        want[m] = [sum(c * words[t][k] for t, c in own if t in words) / sum(c for _, c in own) for k in range(3)]
    _check(vec.doc_vector_uniform(docs, spark.createDataFrame(counts, "mid long, term string, cnt long"), vectors, 3).collect(), want)
    none = vectors.where("false")
    _check(vec.doc_vector_uniform(docs, spark.createDataFrame(counts, "mid long, term string, cnt long"), none, 3).collect(), {})


def test_tfidf_in_parts(spark, small_parts):
    counts, words, docs, vectors = _tables(spark)
    rows = [(m, t, c / 3, c) for m, t, c in counts] + [(14, "t2", 0.0, 1)]
    want = {}
    for m in range(14):
        own = [(t, w * c) for i, t, w, c in rows if i == m and t in words]
        if own:
            want[m] = [sum(w * words[t][k] for t, w in own) / sum(w for _, w in own) for k in range(3)]
    _check(vec.doc_vector_tfidf(docs, spark.createDataFrame(rows, "mid long, term string, weight double, slots long"), vectors, 3).collect(), want)


def test_a_part_meets_each_word_once(spark):
    """A word of many documents brings its vector to a part once, not with every document."""
    counts = spark.range(500).select(F.col("id").alias("mid"), F.lit("t").alias("term"), F.lit(1).alias("weight"))
    vectors = spark.createDataFrame([("t", [1.0, 2.0])], "term string, vector array<double>")
    sizes, part_sums = spark.sparkContext.accumulator(0), vec._part_sums

    def counted(rows, words):
        sizes.add(len(words))
        return part_sums(rows, words)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(vec, "_part_sums", counted)
        assert vec._word_sums(counts, vectors).where("known = 1 and every = 1").count() == 500
    assert sizes.value == 1


def test_words_of_a_small_vocabulary_stay(spark):
    """The model goes to the documents, whose words are counted once."""
    docs = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b", "c"])], "mid long, tokens array<string>")
    found = vc.tfidf_transform(docs, spark.createDataFrame([("a", 1.0), ("b", 2.0)], "term string, idf double"), keep_n=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan and plan.count("Generate") == 1
    got = {(r.mid, r.term): round(r.weight, 9) for r in found.collect()}
    assert got == {(1, "a"): round(0.5**0.5, 9), (1, "b"): round(0.5**0.5, 9), (2, "b"): 1.0}
