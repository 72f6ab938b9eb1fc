"""What is moved and kept on disk follows the input a few times at most."""

import math
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from letterloom.operators import contacts as ct
from letterloom.operators import similarity as sim
from letterloom.operators import vectors as vec
from letterloom.operators import vocab as vc
from letterloom.operators.skew import stage


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_a_stage_lets_its_shuffles_go(spark):
    before = _shuffle_files(spark)
    staged = stage(spark.range(1000).repartition(5), "let-go")
    for _ in range(100):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before and staged.count() == 1000


DOCS = [(1, ["a", "b", "a", None]), (2, ["b", "c", "xä", ""]), (1, ["b"]), (3, []), (4, None), (5, ["x"]), (None, ["c", "c"]), (6, ["z", "z"])]
IDF = {"a": 1.0, "b": 2.0, "c": 0.5, "z": 0.0}


def _expected():
    out, docs = {}, {}
    for mid, tokens in DOCS:
        docs.setdefault(mid, []).extend(t for t in tokens or [] if t in IDF)
    for mid, tokens in docs.items():
        weights = {t: n * IDF[t] for t, n in Counter(tokens).items()}
        norm = math.hypot(*weights.values())
        out |= {(mid, t): w / norm if norm else 0.0 for t, w in weights.items()}
    return out


def test_counts_stay_with_their_documents(spark, monkeypatch):
    """No join moves counts: a part gets its words once, and rows of one id are one document."""
    monkeypatch.setattr(vc, "PART_TOKENS", 3)
    monkeypatch.setattr(vc, "LEAST_TOKENS", 2)
    docs = spark.createDataFrame(DOCS, "mid long, tokens array<string>")
    model = spark.createDataFrame([*IDF.items(), (None, 9.0)], "term string, idf double")
    found = vc.tfidf_transform(docs, model)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "Join" not in plan.split("CoGroup")[0] and "array_join" in plan
    rows, want = found.collect(), _expected()
    got = {(r.mid, r.term): r.weight for r in rows}
    assert len(rows) == len(want) and got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert vc.tfidf_transform(docs.where("false"), model).count() == 0
    assert vc.tfidf_transform(docs, model.where("false")).count() == 0


def test_packed_vectors_have_numbers_for_terms(spark):
    docs = spark.createDataFrame(DOCS, "mid long, tokens array<string>")
    model = vc.number_terms(spark.createDataFrame(list(IDF.items()), "term string, idf double"))
    names = {r.number: r.term for r in model.collect()}
    assert [names[k] for k in sorted(names)] == ["z", "c", "a", "b"]
    packed = vc.tfidf_transform(docs, model, packed=True)
    assert packed.schema["terms"].dataType.simpleString() == "array<int>" and packed.count() == 4
    got = {(r.mid, names[r.term]): r.weight for r in vc.in_rows(packed).collect()}
    want = _expected()
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_packed_messages_are_alike_as_rows_are(spark):
    docs = spark.createDataFrame([(m, [f"w{(m * k) % 11}" for k in range(1, 9)]) for m in range(20)] + [(20, ["z"])], "mid long, tokens array<string>")
    model = vc.number_terms(spark.createDataFrame([(f"w{k}", 1.0 + k) for k in range(9)] + [("z", 0.0)], "term string, idf double"))
    packed = stage(vc.tfidf_transform(docs, model, packed=True), "packed")
    flat = spark.range(21).select((F.col("id") % 2).alias("sender"), (F.col("id") % 3).alias("recipient"), F.col("id").alias("mid"))
    rows = flat.select(F.col("sender").alias("user"), "mid")
    pairs = rows.crossJoin(flat.select(F.col("recipient").alias("contact")).distinct())
    found = []
    for vectors in (packed, stage(vc.in_rows(packed), "rows")):
        means = stage(sim.pair_mean_vector(flat, vectors), "means")
        one = {tuple(r[:3]): round(r.sim, 9) for r in sim.text_similarity(pairs, vectors, means, every_contact=True).select("mid", "user", "contact", "sim").collect()}
        other = {(r.user, r.mid, r["rank"]): (r.other, round(r.score, 8)) for r in sim.top_similar(rows, rows, vectors, 3).collect()}
        own = flat.select("mid", F.col("sender").alias("user"), F.col("recipient").alias("contact"))
        counts = own.groupBy("user", "contact").agg(F.count(F.lit(1)).alias("n"))
        left = {r.mid: round(r.sim, 8) for r in sim.leave_one_out_similarity(own, vectors, means, counts).collect()}
        found.append((one, other, left))
    assert len(found[0][0]) == 63 and found[0] == found[1]


def test_sizes_do_not_move_lists(spark):
    """How many cells a user has is counted from sizes, not from lists that were moved for it."""
    vectors = spark.createDataFrame([(1, [1], [1.0], 1.0)], "mid long, terms array<int>, weights array<double>, norm double")
    owners = spark.createDataFrame([(1, "u")], "mid long, user string")
    sizes = sim._whole(vectors).join(owners, "mid").select("user", "_size").groupBy("user").agg(F.sum("_size"))
    plan = sizes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Join")[1].count("size(terms") == 1 and "weights" not in plan.split("LogicalRDD")[0]


def test_vectors_of_floats_move_as_floats(spark):
    """Half the bytes where no digit is lost; all digits where one would be."""
    counts = spark.createDataFrame([(1, "f", 2.0), (1, "d", 1.0), (2, "f", 1.0), (3, "none", 1.0)], "mid long, term string, weight double")
    words = spark.createDataFrame([("f", [0.5, -1.25]), ("d", [0.1, 1e300]), ("unused", [1.0, 2.0])], "term string, vector array<double>")
    found = vec._word_sums(counts, words)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array<float>" in plan
    got = {r.mid: (r.vector, r.known, r.every) for r in found.collect()}
    assert got == {1: ([0.1 + 1.0, 1e300 - 2.5], 3.0, 3.0), 2: ([0.5, -1.25], 1.0, 1.0), 3: ([0.0, 0.0], 0.0, 1.0)}


def test_word_sums_in_rounds(spark, monkeypatch):
    """Many parts go a few at a time, with the same sums."""
    for name, value in (("PART_ROWS", 5), ("PARTS_AT_ONCE", 2)):
        monkeypatch.setattr(vec, name, value)
    rounds, stage_it = [], vec.stage
    monkeypatch.setattr(vec, "stage", lambda df, label: rounds.append(label) or stage_it(df, label))
    counts = spark.range(40).select((F.col("id") % 13).alias("mid"), F.concat(F.lit("t"), F.col("id") % 7).alias("term"), F.lit(1.0).alias("weight"))
    words = spark.createDataFrame([(f"t{k}", [float(k), 0.1 * k]) for k in range(6)], "term string, vector array<double>")
    got = {r.mid: (r.vector, r.known, r.every) for r in vec._word_sums(counts, words).collect()}
    assert rounds == ["moved-words"] + ["word-sums"] * 4 and len(got) == 13
    for m, (vector, known, every) in got.items():
        own = [k % 7 for k in range(40) if k % 13 == m]
        assert every == len(own) and known == sum(k < 6 for k in own)
        assert all(abs(x - y * sum(k for k in own if k < 6)) < 1e-12 for x, y in zip(vector, (1.0, 0.1)))


@pytest.mark.parametrize("size", [10_000, 3])
def test_contacts_without_recipients_in_lists(spark, monkeypatch, size):
    """Candidates do not move; nulls, repeats, unknown senders and a sender of many contacts are as in an anti join."""
    monkeypatch.setattr(ct, "LIST", size)
    contacts = [("a", c) for c in range(20)] + [("a", None), ("b", 1), ("b", 2), (None, 5), ("d", 7)]
    messages = [("a", m) for m in range(15)] + [("a", 3), ("b", 20), ("b", None), (None, 21), ("c", 22), ("d", 23)]
    flat = [(m % 30, (m * 7) % 19) for m in range(60)] + [(0, 4), (0, 4), (1, None), (None, 1), (23, 7), (20, 2)]
    found = ct.contacts_minus_recipients(
        spark.createDataFrame(messages, "sender string, mid long"), spark.createDataFrame(contacts, "user string, contact long"), spark.createDataFrame(flat, "mid long, recipient int")
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "Join" not in plan.split("Generate")[0]
    got = {(m, c) for m, c in flat if m is not None and c is not None}
    want = Counter((m, c) for s, m in messages for u, c in contacts if s is not None and s == u and (m, c) not in got)
    assert Counter(map(tuple, found.collect())) == want


def test_means_move_as_lists(spark, monkeypatch):
    """Terms of means go to their cells without the names of user and contact on each; also where a pair stands for the user."""
    monkeypatch.setattr(sim, "LIST_ROWS", 4)
    rows = [(f"u{k % 2}", f"c{k % 3}" if k % 3 else None, k, 0.5 * k) for k in range(24)]
    means = spark.createDataFrame(rows, "user string, contact string, term int, weight double").coalesce(1)
    for user in (F.col("user"), F.struct("user", "contact").alias("user")):
        packed = sim._in_lists(means.select(user, "contact", "term", "weight"))
        assert packed.schema["terms"].dataType.simpleString() == "array<int>"
        found = [(r.user, r.contact, t, w) for r in packed.collect() for t, w in zip(r.terms, r.weights, strict=True)]
        assert packed.count() < 24 and Counter((u if isinstance(u, str) else u.user, c, t, w) for u, c, t, w in found) == Counter(rows)
    found = sim.text_similarity(spark.createDataFrame([(1, "u0", "c2")], "mid long, user string, contact string"), spark.createDataFrame([(1, [2], [1.0], 1.0)], "mid long, terms array<int>, weights array<double>, norm double"), means, True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and found.count() == 1
