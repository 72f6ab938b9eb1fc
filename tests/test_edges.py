"""Edge cases of single operators on small in-line tables."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from letterloom.functions import addresses as ad
from letterloom.functions import text as tx
from letterloom.functions import weights as wt
from letterloom.operators import baselines as bl
from letterloom.operators import evaluate as ev
from letterloom.operators import greetings as gr
from letterloom.operators import reshape as rs
from letterloom.operators import sampling as sm
from letterloom.operators import temporal as tm
from letterloom.operators import vectors as vec
from letterloom.operators import wordgraph as wg
from letterloom.operators.skew import hot_keys, rank_within, skew_join
from letterloom.operators.split import chrono_split


def one(spark, expr, value):
    """Apply a column function to a single string."""
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


# --- strings ---------------------------------------------------------------------


def test_glue_and_filter_differ(spark):
    assert one(spark, ad.glue_recipients, "a@x b c@y d") == ["a@x", "bc@y"]
    assert one(spark, ad.filter_recipients, "a@x b c@y d") == ["a@x", "c@y"]


def test_glue_random(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["a@x", "b", "@", "c@d", "", "e.f"]) for _ in range(rng.randint(0, 8))) for _ in range(300)]

    def glued(s):
        pieces = s.split()
        cuts = [0, *(i + 1 for i, p in enumerate(pieces) if "@" in p)]
        return ["".join(pieces[a:b]) for a, b in itertools.pairwise(cuts)]

    rows = spark.createDataFrame([(t,) for t in texts], "x string").select("x", ad.glue_recipients(F.col("x")).alias("y"))
    assert all(r.y == glued(r.x) for r in rows.collect())


def test_glue_many_pieces(spark):
    assert one(spark, ad.glue_recipients, "b " * 20_000 + "c@d") == ["b" * 20_000 + "c@d"]
    assert one(spark, ad.glue_recipients, "b " * 20_000) == []


def test_split_ids_at_the_edges(spark):
    assert one(spark, ad.split_ids, "") == []
    assert one(spark, ad.split_ids, " 1\t2 \t") == [1, 2]


def test_date_repair(spark):
    fix = lambda c: F.to_timestamp_ntz(ad.repair_date(c)).cast("string")
    assert one(spark, fix, "0001-05-02 10:00:00") == "2001-05-02 10:00:00"
    assert one(spark, fix, "0002-01-01 00:00:00") == "2002-01-01 00:00:00"


def test_text_rules(spark):
    assert one(spark, tx.strip_forward, "x ---- Forwarded by A Subject: hi") == "x \nForwarded\n hi"
    assert one(spark, tx.split_boundaries, "helloWorld 12ab") == "hello World 12 ab"
    assert one(spark, tx.deaccent, "Élan naïve señor Å") == "Elan naive senor A"
    assert one(spark, tx.infix_split, "a.b...c d--e f-g,h 1,2 i?!") == "a . b ... c d -- e f - g , h 1,2 i?!"
    assert one(spark, tx.bag_of_words, "The (Cat) sat, 42 a/b don't end.") == ["cat", "sat", "dont", "end"]


def test_sentence_tokens_keep_empty_sentences(spark):
    assert one(spark, tx.sentence_tokens, "Red fox. 12! Blue.") == [["red", "fox"], [], ["blue"]]
    first = lambda c: tx.sentence_tokens(c, first=1)
    assert one(spark, first, "Red fox. 12! Blue.") == [["red", "fox"]]


def test_greeting_tokens(spark):
    assert one(spark, ad.greeting_tokens, "Hi JohnSmith, ok") == ["Hi", "John", "Smith"]


def test_names(spark):
    log = spark.createDataFrame([(["a.b@corp.com", "ann.lee@corp.com", "ann.lee@else.com", "ann.@corp.com"],)], "recipients array<string>")
    assert [r.name for r in gr.first_names(log, "corp.com").collect()] == ["ann"]
    assert [r.name for r in gr.last_names(log, "corp.com").collect()] == ["lee"]


def test_greeting_value_minds_case(spark):
    pairs = spark.createDataFrame([(1, "phillip.a@x"), (2, "phillip.a@x"), (3, "phillip.a@x"), (1, "new@x")], "mid long, recipient string")
    words = spark.createDataFrame([(1, 0, "Phillip"), (2, 0, "phillip")], "mid long, pos int, word string")
    book = spark.createDataFrame([], "recipient string, name string, weight double")
    known = spark.createDataFrame([("phillip.a@x",)], "recipient string")
    got = {(r.mid, r.recipient): r.greet for r in gr.greeting_value(pairs, words, book, known).collect()}
    assert got == {(1, "phillip.a@x"): -1, (2, "phillip.a@x"): 1, (3, "phillip.a@x"): 0, (1, "new@x"): 0}


def test_bad_modes_raise(spark):
    with pytest.raises(ValueError):
        wt.idf(F.lit(1), F.lit(1), "other")
    docs = spark.createDataFrame([(1, ["a"])], "mid long, tokens array<string>")
    with pytest.raises(ValueError):
        wg.centrality(docs, "pagerank")


# --- tables ------------------------------------------------------------------------


def test_explode_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, []), (2, None), (3, ["5", None])], "id int, xs array<string>")
    assert [tuple(r) for r in rs.explode_list(df, "xs", "x", "int").collect()] == [(3, 5)]


def test_relative_time_modes(spark):
    df = spark.sql("select explode(array(timestamp_ntz'2001-01-01 10:00:00', timestamp_ntz'2001-01-02 10:00:05')) date")
    assert sorted(r.time for r in rs.relative_time(df).collect()) == [0, 5]
    assert sorted(r.time for r in rs.relative_time(df, "elapsed").collect()) == [0, 86405]


def test_split_small_groups(spark):
    rows = [("s", i, i) for i in range(4)] + [("l", i, i) for i in range(10, 20)]
    df = spark.createDataFrame(rows, "sender string, mid long, date long")
    count = lambda d: Counter((r.sender, r.part) for r in d.collect())
    assert count(chrono_split(df)) == {("s", "dev"): 4, ("l", "train"): 8, ("l", "dev"): 2}
    assert count(chrono_split(df, small_groups="train"))[("s", "train")] == 4
    late = {r.mid for r in chrono_split(df).collect() if r.sender == "l" and r.part == "dev"}
    assert late == {18, 19}


def test_average_precision(spark):
    predicted = spark.createDataFrame([(1, 1, "1"), (1, 2, "1"), (1, 3, "2"), (2, 1, "9")], "mid long, rank int, contact string")
    actual = spark.createDataFrame([(1, "1"), (1, "2"), (3, "4")], "mid long, recipient string")
    got = {r.mid: round(r.ap, 6) for r in ev.average_precision(predicted, actual).collect()}
    assert got == {1: 0.833333, 2: 0.0, 3: 0.0}


def test_average_precision_random(spark):
    rng = random.Random(3)
    cases = {}
    for mid in range(200):
        actual = [rng.randint(0, 8) for _ in range(rng.randint(0, 5))]
        cases[mid] = (actual, [rng.randint(0, 8) for _ in range(rng.randint(1, 12))])

    def expected(actual, predicted, k=10):
        """Precision at the rank of each truth's first hit, summed over the truths."""
        ranks = sorted(predicted.index(x) + 1 for x in set(actual) & set(predicted[:k]))
        return sum(n / rank for n, rank in enumerate(ranks, 1)) / max(1, min(len(actual), k))

    predicted = spark.createDataFrame([(m, i + 1, c) for m, (_, p) in cases.items() for i, c in enumerate(p)], "mid long, rank int, contact long")
    actual = spark.createDataFrame([(m, c) for m, (a, _) in cases.items() for c in a], "mid long, recipient long")
    got = {r.mid: r.ap for r in ev.average_precision(predicted, actual).collect()}
    assert all(abs(got[m] - expected(a, p)) < 1e-9 for m, (a, p) in cases.items())


def test_keyword_slots(spark):
    counts = spark.createDataFrame([(1, "a", 2), (1, "b", 1)], "mid long, term string, cnt long")
    freq = spark.createDataFrame([("a", 1), ("b", 1)], "term string, df long")
    got = {(r.term, r.slots) for r in vec.top_keywords(counts, freq, F.lit(10), k=2).collect()}
    assert got == {("a", 2)}
    assert vec.top_keywords(counts, freq, F.lit(10), k=0).count() == 2


# --- graphs of words ------------------------------------------------------------------


def brute_edges(terms, w):
    edges = Counter()
    if len(terms) > w:
        for i, j in itertools.combinations(range(len(terms)), 2):
            if j - i < w and (terms[i] != terms[j] or j < w):
                edges[terms[i], terms[j]] += 1
    return edges


def brute_closeness(terms, w, weighted):
    nodes = sorted(set(terms))
    n = len(nodes)
    dist = {(a, b): 0 if a == b else float("inf") for a in nodes for b in nodes}
    for (a, b), c in brute_edges(terms, w).items():
        if a != b:
            d = c if weighted else 1
            dist[a, b] = min(dist[a, b], d)
            dist[b, a] = min(dist[b, a], d)
    for k, a, b in itertools.product(nodes, repeat=3):
        dist[a, b] = min(dist[a, b], dist[a, k] + dist[k, b])
    if n == 1:
        return {nodes[0]: 0.0}
    return {a: (n - 1) / sum(n if d == float("inf") else d for (x, _), d in dist.items() if x == a) for a in nodes}


@pytest.fixture(scope="module")
def word_docs(spark):
    rng = random.Random(11)
    docs = [[rng.choice("abcdefgh"[: rng.randint(1, 8)]) for _ in range(rng.randint(1, 14))] for _ in range(60)]
    docs += [["a", "a", "b", "b"], ["a", "b"], list("abcabc") * 40]
    return dict(enumerate(docs)), spark.createDataFrame(list(enumerate(docs)), "mid long, tokens array<string>")


@pytest.mark.parametrize("window", [2, 3, 5])
def test_word_edges(word_docs, window):
    docs, df = word_docs
    got = {(r.mid, r.a, r.b): r.weight for r in wg.word_edges(df, window).collect()}
    want = {(m, *e): c for m, d in docs.items() for e, c in brute_edges(d, window).items()}
    assert got == want


@pytest.mark.parametrize("weighted", [False, True])
def test_closeness(word_docs, weighted):
    docs, df = word_docs
    got = {(r.mid, r.term): r.value for r in wg.closeness(df, 3, weighted).collect()}
    want = {(m, t): c for m, d in docs.items() for t, c in brute_closeness(d, 3, weighted).items()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1.1e-5 for k in want)


def test_closed_form_equals_general(spark):
    docs = [(n, [f"t{i:02d}" for i in range(n)]) for n in range(1, 30)]
    df = spark.createDataFrame(docs, "mid long, tokens array<string>")
    for w in (2, 3, 5):
        fast = {(r.mid, r.term): r.value for r in wg.centrality(df, "closeness", w, distinct=True).collect()}
        slow = {(r.mid, r.term): r.value for r in wg.centrality(df, "closeness", w).collect()}
        assert fast.keys() == slow.keys() and all(abs(fast[k] - slow[k]) < 1.1e-5 for k in fast)
    assert [fast[4, f"t{i:02d}"] for i in range(4)] == [0.25] * 4  # window 5 is longer than the document


# --- hot keys -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A log where one sender owns more than a third of the rows, many at one time."""
    rng = random.Random(5)
    rows = []
    for mid in range(3000):
        sender = 0 if rng.random() < 0.4 else rng.randint(1, 40)
        time = 70_000 if rng.random() < 0.3 else rng.randint(0, 400_000)
        rows += [(sender, r, mid, time) for r in {rng.randint(0, 60) for _ in range(rng.randint(1, 4))}]
    return rows, spark.createDataFrame(rows, "sender long, recipient long, mid long, time long")


def test_rank_within_hot_group(skewed):
    rows, df = skewed
    ranked = rank_within(df, ["sender"], ["time", "mid", "recipient"], size="n").collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append((r[3], r[2], r[1]))
    for r in ranked:
        group = groups[r.sender]
        assert r.n == len(group)
    for sender, group in groups.items():
        got = [(r.time, r.mid, r.recipient) for r in sorted((x for x in ranked if x.sender == sender), key=lambda x: x["rank"])]
        assert got == sorted(group)


def test_hot_group_is_split(skewed):
    _, df = skewed
    slices = df.repartitionByRange("sender", "time", "mid").where("sender = 0").select(F.spark_partition_id()).distinct()
    assert slices.count() > 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, skewed, how):
    _, df = skewed
    assert hot_keys(df, ["sender"]).count() == 1
    right = spark.createDataFrame([(s, s * 10 + i) for s in range(0, 30) for i in range(3)], "sender long, x long")
    plain = sorted(map(tuple, df.join(right, ["sender"], how).collect()))
    assert sorted(map(tuple, skew_join(df, right, ["sender"], ["mid"], how).collect())) == plain


def test_no_hot_keys(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert hot_keys(df, ["k"]).count() == 0


def test_right_hot_key_is_dealt_out(spark):
    left = spark.createDataFrame([(k, m) for k in range(10) for m in range(3)], "k long, mid long")
    right = spark.range(6000).select(F.when(F.col("id") < 5000, 7).otherwise(F.col("id") % 10).alias("k"), F.col("id").alias("x"))
    joined = skew_join(left, right, ["k"], ["mid"], right_spread=["x"])
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, left.join(right, "k").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tasks = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks > 1


def test_hot_keys_are_counted_in_parallel(spark, skewed):
    plan = hot_keys(skewed[1], ["sender"])._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in plan


def test_null_keys_are_ranked(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, x long")
    got = sorted((r.k or "", r.x, r.rank) for r in rank_within(df, ["k"], ["x"]).collect())
    assert got == [("", 1, 1), ("", 2, 2), ("a", 3, 1)]


def test_time_features_brute(skewed):
    rows, df = skewed
    horizon = 300_000
    got = {(r.user, r.contact): tuple(r)[2:] for r in tm.time_features(df, horizon).collect()}
    senders, recipients = {r[0] for r in rows}, {r[1] for r in rows}

    def side(u, c):
        early = [r for r in rows if r[3] < horizon]
        met = {(r[u], r[c]) for r in early}
        out = {}
        for user, contact in met:
            mine = [r for r in rows if r[u] == user]
            early_all = {r[2] for r in mine if r[3] < horizon}
            pair = {r[2] for r in early if (r[u], r[c]) == (user, contact)}
            last = max(r[3] for r in mine if r[c] == contact)
            since = {r[2] for r in mine if last <= r[3] < horizon}
            out[user, contact] = (len(pair) / len(early_all), len(since) / (2 * len({r[2] for r in mine})))
        return out

    outgoing, incoming = side(0, 1), side(1, 0)
    want = {}
    for key in outgoing.keys() | incoming.keys():
        no_out = (0.0, 0.0) if key[0] in senders else (1.0, 1.0)
        no_in = (0.0, 0.0) if key[0] in recipients else (1.0, 1.0)
        want[key] = (*outgoing.get(key, no_out), *incoming.get(key, no_in))
    assert got.keys() == want.keys()
    assert all(abs(a - b) < 1e-12 for k in want for a, b in zip(got[k], want[k]))


def test_negative_contacts_rules(skewed):
    rows, df = skewed
    contacts = df.select(F.col("sender").alias("user"), F.col("recipient").alias("contact")).distinct()
    got = sm.negative_contacts(df, contacts, percent=0.3).collect()
    book, to, owner = {}, {}, {}
    for s, r, m, _ in rows:
        book.setdefault(s, set()).add(r)
        to.setdefault(m, set()).add(r)
        owner[m] = s
    picked = {}
    for r in got:
        assert r.contact in book[r.sender] - to[r.mid]
        assert r.contact not in picked.setdefault(r.mid, set())
        picked[r.mid].add(r.contact)
    for m, recipients in to.items():
        want = min(-(-3 * len(recipients) // 10), len(book[owner[m]] - recipients))
        assert len(picked.get(m, ())) == want


def test_no_negatives_when_all_contacts_got_it(spark):
    flat = spark.createDataFrame([("a", "x", 1), ("a", "y", 1)], "sender string, recipient string, mid long")
    contacts = flat.select(F.col("sender").alias("user"), F.col("recipient").alias("contact"))
    assert sm.negative_contacts(flat, contacts).count() == 0


def test_negative_neighbors_rules(skewed):
    rows, df = skewed
    edges = df.select(F.col("sender").alias("user"), F.col("recipient").alias("contact")).distinct()
    users = df.select(F.col("sender").alias("user")).union(df.select("recipient")).distinct()
    got = sm.negative_neighbors(df, edges, users, percent=1.0).collect()
    book, to = {}, {}
    for s, r, m, _ in rows:
        book.setdefault(s, set()).add(r)
        to.setdefault(m, []).append(r)
    per = Counter(r.mid for r in got)
    assert per == {m: len(t) for m, t in to.items()}
    for r in got:
        free = book[r.sender] - set(to[r.mid])
        assert r.contact not in to[r.mid]
        assert (r.contact in free) == (r.draw < len(free)) or r.draw >= len(free)


def test_random_baseline_is_distinct(spark):
    users = spark.range(23).select(F.col("id").alias("user"))
    mids = spark.range(50).select(F.col("id").alias("mid"))
    rows = bl.random_baseline(mids, users, k=10).collect()
    per = {}
    for r in rows:
        per.setdefault(r.mid, set()).add(r.contact)
    assert len(rows) == 500 and all(len(s) == 10 for s in per.values())


def test_vectors_with_blanks_and_of_length_one(spark, tmp_path):
    from letterloom.sources import vectors as src

    (tmp_path / "a.txt").write_text("2 3\n1 3.0 0.0 4.0 \n2 \t0 0 2\n")
    assert {r.id: r.vector for r in src.read_vectors(spark, str(tmp_path / "a.txt")).collect()} == {1: [0.6, 0, 0.8], 2: [0, 0, 1]}
    (tmp_path / "b.txt").write_text("2 1\n1 3.0\n2 -2.5\n")
    assert {r.id: r.vector for r in src.read_vectors(spark, str(tmp_path / "b.txt")).collect()} == {1: [1.0], 2: [-1.0]}


def test_stages_are_dropped(spark):
    from pathlib import Path

    from letterloom.operators.skew import drop_stages, stage, stage_root

    stage(spark.range(3), "x")
    assert any(Path(stage_root(spark)).glob("x-*"))
    drop_stages(spark)
    assert not Path(stage_root(spark)).exists()
