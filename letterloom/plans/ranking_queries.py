"""Feature assembly and learned ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterloom.functions import text as tx
from letterloom.operators import contacts as ct
from letterloom.operators import evaluate as ev
from letterloom.operators import forests as fo
from letterloom.operators import greetings as gr
from letterloom.operators import learning as ln
from letterloom.operators import sampling as sm
from letterloom.operators import similarity as sim
from letterloom.operators import temporal as tm
from letterloom.operators import topics as tp
from letterloom.operators import vocab as vc
from letterloom.operators import wordgraph as wg
from letterloom.operators.reshape import flatten_topics, relative_time
from letterloom.operators.skew import hot_keys, stage
from letterloom.operators.split import chrono_split
from letterloom.plans import views as v
from letterloom.plans.registry import query
from letterloom.plans.text_queries import DOMAIN
from letterloom.plans.time_queries import HORIZON, _rounded, timed_events


@query(
    "feature_assembly",
    """SELECT p.sender AS user, p.recipient AS contact, p.mid,
         round(coalesce(OUT_ratio, 0), 6) AS OUT_ratio, round(coalesce(OUT_ratio_recent, 0), 6) AS OUT_ratio_recent,
         round(coalesce(IN_ratio, 0), 6) AS IN_ratio, round(coalesce(IN_ratio_recent, 0), 6) AS IN_ratio_recent,
         coalesce(t.topic_0, 0) AS topic_0, coalesce(t.topic_1, 0) AS topic_1
       FROM (SELECT DISTINCT sender, recipient, mid FROM event_flat) p
       LEFT JOIN x_all x ON x.user = p.sender AND x.contact = p.recipient
       LEFT JOIN (SELECT mid, max(score) FILTER (topic = 0) AS topic_0, max(score) FILTER (topic = 1) AS topic_1
                  FROM topic_scores GROUP BY mid) t ON t.mid = p.mid""",
)
def _(spark, sf):
    flat = timed_events(spark, sf)
    pairs = flat.select(F.col("sender").alias("user"), F.col("recipient").alias("contact"), "mid").distinct()
    topics = flatten_topics(v.topic_scores(spark, sf), 2)
    return _rounded(ln.assemble_features(pairs, tm.time_features(flat, HORIZON), topics))


def ranking_tables(spark, sf, weights="tfidf"):
    """(train pairs, candidate pairs, truth, owners) of greet_mail, features staged.

    The last 20 % of each sender's messages are held out; everything a feature
    knows comes from the rest.  Topics are those of a model fitted on all bodies, and ``weights``
    picks the message vectors: tf-idf or TW (graph of words).
    """
    log = v.greet_mail(spark, sf)
    split = chrono_split(log.select("sender", "mid", "date"))
    log = stage(
        log.join(split.select("mid", "part"), "mid")
        .withColumn("words", tx.bag_of_words(F.col("body")))
        .withColumn("tokens", tx.distinct_tokens(F.col("words"))),
        "ranking-log",
    )
    train, dev = log.where("part = 'train'"), log.where("part = 'dev'")
    flat = stage(train.select("sender", "mid", "date", F.explode("recipients").alias("recipient")), "ranking-flat")

    timed = stage(relative_time(flat, "elapsed"), "ranking-timed")
    horizon = timed.agg(F.max("time") + 1).scalar()
    time_features = stage(tm.time_features(timed, horizon), "ranking-time")
    contacts = stage(time_features.select("user", "contact"), "ranking-contacts")

    if weights == "tfidf":
        vectors = vc.tfidf_transform(log, vc.tfidf_model(train))
    else:
        vectors = vc.l2_normalize(wg.tw_weights(log, vc.vocabulary(train, no_below=4), distinct=True))
    vectors = stage(vectors, "ranking-vectors")
    means = {d: stage(sim.pair_mean_vector(flat, vectors, d), "ranking-means") for d in (sim.OUT, sim.IN)}
    words = stage(gr.detect_greetings(log, gr.known_names(train, DOMAIN)), "ranking-greetings")
    book = stage(gr.greeting_book(train, words), "ranking-book")
    known = flat.select("recipient").distinct()
    bodies = log.select("mid", F.col("words").alias("tokens"))
    topics = stage(flatten_topics(tp.score_topics(tp.fit_topics(bodies), bodies), 4), "ranking-topics")

    def features(pairs, every_contact):
        # each feature is a stage, as a plan of all of them takes the driver's memory, whatever the size of the tables
        pairs = stage(pairs, "ranking-pairs")
        greet = gr.greeting_value(
            pairs.select("mid", F.col("contact").alias("recipient")).distinct(), words, book, known
        ).withColumnRenamed("recipient", "contact")
        out = pairs.join(stage(greet, "ranking-greet"), ["mid", "contact"])
        for name, direction in (("outgoing_txt", sim.OUT), ("incoming_txt", sim.IN)):
            asked_pairs = pairs.select("mid", "user", "contact").distinct()
            score = sim.text_similarity(asked_pairs, vectors, means[direction], every_contact)
            out = out.join(stage(score.withColumnRenamed("sim", name), "ranking-similarity"), ["mid", "user", "contact"])
        hot = hot_keys(pairs, ["user", "contact"])
        return stage(ln.assemble_features(out, time_features, topics, hot), "ranking-features")

    labelled = sm.labelled_pairs(flat, sm.negative_contacts(flat, contacts)).select(
        F.col("sender").alias("user"), F.col("recipient").alias("contact"), "mid", "label"
    )
    asked = ct.candidates(dev.select("sender", "mid"), contacts).withColumnRenamed("sender", "user")
    truth = dev.select("mid", F.explode("recipients").alias("recipient"))
    return features(labelled, False), features(asked, True), truth, dev.select("mid", "sender")


@query("learned_rank")
def _(spark, sf):
    train, asked, _, _ = ranking_tables(spark, sf)
    return ln.rank_scores(ln.score_pairs(ln.fit_forest(train), asked))


@query("learned_rank_tw")
def _(spark, sf):
    train, asked, _, _ = ranking_tables(spark, sf, weights="tw")
    return ln.rank_scores(ln.score_pairs(ln.fit_forest(train), asked))


@query("learned_rank_map")
def _(spark, sf):
    train, asked, truth, owners = ranking_tables(spark, sf)
    ranked = stage(ln.rank_scores(ln.score_pairs(ln.fit_forest(train), asked)), "ranked")
    overall = ev.mean_average_precision(ranked, truth).select(F.lit("messages").alias("over"), "map")
    return overall.unionByName(ev.macro_map(ranked, truth, owners).select(F.lit("users").alias("over"), "map"))


@query("per_user_rank")
def _(spark, sf):
    """A forest of each user's own pairs ranks the user's candidates."""
    train, asked, _, _ = ranking_tables(spark, sf)
    names = ln.feature_columns(train)
    forest, ranges, _ = fo.grow(train, names)
    return ln.rank_scores(fo.score(forest, ranges, asked, names))


@query("oob_score")
def _(spark, sf):
    """Out-of-bag accuracy of each user's forest."""
    train = ranking_tables(spark, sf)[0]
    return fo.out_of_bag(fo.grow(train, ln.feature_columns(train))[2])


@query("per_user_logistic_rank")
def _(spark, sf):
    train, asked, _, _ = ranking_tables(spark, sf)
    models = ln.fit_per_user(train, hot=hot_keys(train, ["user"]))
    return ln.rank_scores(ln.score_per_user(models, asked, ln.feature_columns(train)))


@query("holdout_score")
def _(spark, sf):
    return ln.holdout_score(ranking_tables(spark, sf)[0])
