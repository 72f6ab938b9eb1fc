"""Graph-of-words, dense vector, topic and embedding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterloom.functions import text as tx
from letterloom.operators import paragraphs as pg
from letterloom.operators import topics as tp
from letterloom.operators import vectors as vec
from letterloom.operators import vocab as vc
from letterloom.operators import wordgraph as wg
from letterloom.operators.baselines import hash_long
from letterloom.operators.reshape import flatten_topics
from letterloom.operators.skew import drop_stage, stage, stage_path
from letterloom.plans import views as v
from letterloom.plans.registry import query, sql_view
from letterloom.plans.text_queries import unique_tokens
from letterloom.plans.time_queries import _hash, _rounded
from letterloom.sources import vectors as src

DIM = 64


def _tokens(spark, sf):
    """Bags of words in text order, staged once per query."""
    return stage(v.doc_tokens(spark, sf).select("mid", "tokens"), "tokens")


# --- graphs of words ---------------------------------------------------------------

sql_view("w_pos", "SELECT mid, term, row_number() OVER (PARTITION BY mid ORDER BY si, ti) - 1 AS j FROM doc_word")
sql_view(
    "w_edge",
    """SELECT x.mid, x.term AS a, y.term AS b, count(*) AS weight
       FROM w_pos x JOIN w_pos y ON y.mid = x.mid AND y.j - x.j IN (1, 2)
       WHERE (x.term <> y.term OR y.j < 3) AND x.mid IN (SELECT mid FROM w_pos WHERE j = 3)
       GROUP BY ALL""",
)


def _degree_sql(value: str) -> str:
    return f"""SELECT mid, term, CASE WHEN n > 1 THEN floor(coalesce(d, 0) / (n - 1) * 100000 + 0.5) / 100000 ELSE 0 END AS value FROM (
        SELECT t.mid, t.term, CAST(count(*) OVER (PARTITION BY t.mid) AS DOUBLE) AS n, d FROM doc_term t LEFT JOIN (
          SELECT mid, term, CAST(sum(s) AS DOUBLE) AS d FROM (SELECT mid, a AS term, {value} AS s FROM w_edge
            UNION ALL SELECT mid, b, {value} FROM w_edge) GROUP BY ALL) e ON e.mid = t.mid AND e.term = t.term)"""


@query("gow_edges", "SELECT * FROM w_edge")
def _(spark, sf):
    return wg.word_edges(v.doc_tokens(spark, sf))


@query("gow_degree", _degree_sql("1"))
def _(spark, sf):
    return wg.centrality(_tokens(spark, sf), "degree")


@query("gow_w_degree", _degree_sql("weight"))
def _(spark, sf):
    return wg.centrality(_tokens(spark, sf), "w_degree")


sql_view(
    "w_close",
    """SELECT mid, term, floor(CASE WHEN n = 1 THEN 0 WHEN n <= 3 THEN 1 / n
         ELSE (n - 1) / (ceil(i / 2) * (floor(i / 2) + 1) + ceil((n - 1 - i) / 2) * (floor((n - 1 - i) / 2) + 1)) END * 100000 + 0.5)
           / 100000 AS value
       FROM (SELECT mid, term, CAST(row_number() OVER (PARTITION BY mid ORDER BY term) - 1 AS DOUBLE) AS i,
                    CAST(count(*) OVER (PARTITION BY mid) AS DOUBLE) AS n FROM doc_term)""",
)


@query("gow_closeness", "SELECT * FROM w_close")
def _(spark, sf):
    return wg.centrality(unique_tokens(spark, sf), "closeness", distinct=True)


@query("gow_closeness_general")
def _(spark, sf):
    """Shortest paths by edges over the words as they stand, with repeats."""
    return wg.centrality(_tokens(spark, sf), "closeness")


@query("gow_w_closeness")
def _(spark, sf):
    """Shortest paths over real edge weights."""
    return wg.centrality(_tokens(spark, sf), "w_closeness")


# Over distinct tokens each edge has weight 1, so both general forms must give the closed form.
@query("gow_closeness_general_distinct", "SELECT mid, term, round(value, 6) AS value FROM w_close")
def _(spark, sf):
    return wg.centrality(unique_tokens(spark, sf), "closeness").withColumn("value", F.round("value", 6))


@query("gow_w_closeness_distinct", "SELECT mid, term, round(value, 6) AS value FROM w_close")
def _(spark, sf):
    return wg.centrality(unique_tokens(spark, sf), "w_closeness").withColumn("value", F.round("value", 6))


@query("tw_weights", "SELECT mid, term, value AS weight FROM w_close JOIN vocab10 USING (term)")
def _(spark, sf):
    docs = stage(unique_tokens(spark, sf), "tokens")
    return wg.tw_weights(docs, vc.vocabulary(docs, no_below=10), distinct=True)


@query(
    "tw_idf_weights",
    """SELECT mid, term, round(value * log10((CAST((SELECT count(*) FROM doc_mail) AS DOUBLE) + 1) / df)
           / (1 - 0.003 + 0.003 * n / avg_len), 6) AS weight
       FROM w_close JOIN vocab10 USING (term) JOIN (SELECT mid, CAST(count(*) AS DOUBLE) AS n FROM doc_term GROUP BY mid) USING (mid),
            (SELECT CAST((SELECT count(*) FROM doc_term) // (SELECT count(*) FROM doc_mail) AS DOUBLE) AS avg_len)""",
)
def _(spark, sf):
    docs = stage(unique_tokens(spark, sf), "tokens")
    return _rounded(wg.tw_weights(docs, vc.global_text_features(docs), mode="tw_idf", distinct=True))


# --- dense vectors -------------------------------------------------------------------


def embeddings(spark, sf):
    e = v.table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))


def _vector_by(spark, sf, keys, key, *parts, shift=0):
    """Gives each key row one of the embedding vectors, by a hash of the key."""
    e = embeddings(spark, sf)
    n = e.agg(F.count(F.lit(1))).scalar()
    slot = (hash_long(*parts, seed=42, tag="vec") + shift) % n
    return keys.withColumn("id", slot).join(e, "id").select(key, "vector")


def word_vectors(spark, sf, counts, shift=0):
    return _vector_by(spark, sf, counts.select("term").distinct(), "term", "term", shift=shift)


def message_vectors(spark, sf):
    return _vector_by(spark, sf, v.doc_mail(spark, sf).select("mid"), "mid", "mid")


sql_view("e_n", "SELECT count(*) AS n FROM embeddings")
sql_view(
    "word_vec",
    f"""SELECT term, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vector FROM (
          SELECT DISTINCT term, {_hash('42vec', 'term')} % n AS id FROM doc_df, e_n) JOIN embeddings ON vec_id = id""",
)
sql_view(
    "msg_vec",
    f"""SELECT mid, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vector FROM (
          SELECT mid, {_hash('42vec', 'mid')} % n AS id FROM doc_mail, e_n) JOIN embeddings ON vec_id = id""",
)


def _long(df, *keys):
    """Vector rows to (keys, pos, value)."""
    rows = df.select(*keys, F.posexplode("vector").alias("pos", "value"))
    return rows.withColumn("value", F.round("value", 6))


def _mean_sql(keys: str, source: str) -> str:
    return f"""SELECT {keys}, pos - 1 AS pos, round(avg(value), 6) AS value FROM (
        SELECT {keys}, unnest(vector) AS value, generate_subscripts(vector, 1) AS pos FROM {source}) GROUP BY {keys}, pos"""


@query(
    "vectors_load_normalize",
    """SELECT 'v' || label || '-' || vec_id AS user, pos - 1 AS pos, round(value / norm, 6) AS value FROM (
         SELECT vec_id, label, unnest(e) AS value, generate_subscripts(e, 1) AS pos,
                sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm
         FROM (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings))""",
)
def _(spark, sf):
    e = v.table(spark, sf, "embeddings")
    path = stage_path(spark, "vectors")
    src.write_vectors(e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")), path)
    name = F.concat(F.lit("v"), F.col("label").cast("string"), F.lit("-"), F.col("vec_id").cast("string"))
    return _long(src.read_named_vectors(spark, path, e.select(name.alias("user"), F.col("vec_id").alias("id"))), "user")


@query("sender_vectors", _mean_sql("sender", "(SELECT sender, vector FROM talk_mail JOIN msg_vec USING (mid))"))
def _(spark, sf):
    return _long(vec.people_vectors(v.talk_mail(spark, sf), message_vectors(spark, sf), "sender"), "sender")


@query("recipient_vectors", _mean_sql("recipient", "(SELECT recipient, vector FROM greet_flat JOIN msg_vec USING (mid))"))
def _(spark, sf):
    flat = v.greet_mail(spark, sf).select("sender", "mid", F.explode("recipients").alias("recipient"))
    return _long(vec.people_vectors(flat, message_vectors(spark, sf), "recipient"), "recipient")


@query(
    "pair_vectors",
    _mean_sql("recipient, sender", "(SELECT recipient, sender, vector FROM talk_mail JOIN msg_vec USING (mid))"),
)
def _(spark, sf):
    return _long(vec.pair_vectors(v.talk_mail(spark, sf), message_vectors(spark, sf)), "recipient", "sender")


def _filled_sql(body: str) -> str:
    """Document vectors in long form with zeros for documents that have none."""
    return f"""SELECT mid, pos, round(coalesce(value, 0), 6) AS value FROM (SELECT mid, unnest(range({DIM})) AS pos FROM doc_mail)
        LEFT JOIN ({body}) USING (mid, pos)"""


@query(
    "doc_vector_uniform",
    _filled_sql(
        """SELECT mid, pos - 1 AS pos, sum(value * cnt) / sum(cnt) AS value FROM (
             SELECT mid, cnt, unnest(vector) AS value, generate_subscripts(vector, 1) AS pos
             FROM doc_term JOIN word_vec USING (term)) GROUP BY mid, pos"""
    ),
)
def _(spark, sf):
    docs = _tokens(spark, sf)
    counts = stage(vc.term_counts(docs), "counts")
    drop_stage(docs)
    return _long(vec.doc_vector_uniform(v.doc_mail(spark, sf), counts, word_vectors(spark, sf, counts), DIM), "mid")


sql_view(
    "kw",
    """SELECT mid, term, weight, least(cnt, 15 - used) AS slots FROM (
         SELECT *, coalesce(sum(cnt) OVER (PARTITION BY mid ORDER BY weight DESC, term ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
         FROM (SELECT mid, term, cnt, round((1 + ln(cnt)) * ln((CAST((SELECT count(*) FROM doc_mail) AS DOUBLE) + 1) / (df + 1)), 9) AS weight
               FROM doc_term JOIN doc_df USING (term) ))
       WHERE used < 15""",
)


def _keywords(docs, counts):
    return vec.top_keywords(counts, vc.doc_freq(docs, min_df=0), vc.n_docs(docs))


@query("top_keywords", "SELECT mid, term, round(weight, 6) AS weight, CAST(slots AS BIGINT) AS slots FROM kw")
def _(spark, sf):
    docs = _tokens(spark, sf)
    return _rounded(_keywords(docs, stage(vc.term_counts(docs), "counts")))


@query(
    "doc_vector_tfidf",
    _filled_sql(
        """SELECT mid, pos - 1 AS pos, sum(value * weight * slots) / sum(weight * slots) AS value FROM (
             SELECT mid, weight, slots, unnest(vector) AS value, generate_subscripts(vector, 1) AS pos
             FROM kw JOIN word_vec USING (term) WHERE weight > 0) GROUP BY mid, pos"""
    ),
)
def _(spark, sf):
    docs = _tokens(spark, sf)
    counts = stage(vc.term_counts(docs), "counts")
    freq = stage(vc.doc_freq(docs, min_df=0), "df")
    drop_stage(docs)
    docs = v.doc_mail(spark, sf).select("mid")
    keywords = stage(vec.top_keywords(counts, freq, vc.n_docs(docs)), "keywords")
    return _long(vec.doc_vector_tfidf(docs, keywords, word_vectors(spark, sf, counts), DIM), "mid")


@query(
    "vectors_intersect",
    f"""SELECT term, pos - 1 AS pos, round(value, 6) AS value FROM (
          SELECT t.term, unnest(coalesce(p.vector, t.vector)) AS value, generate_subscripts(t.vector, 1) AS pos
          FROM word_vec t LEFT JOIN (
            SELECT term, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vector FROM (
              SELECT term, ({_hash('42vec', 'term')} + 1) % n AS id FROM doc_df, e_n WHERE df >= 10) JOIN embeddings ON vec_id = id) p
            ON p.term = t.term)""",
)
def _(spark, sf):
    freq = stage(vc.doc_freq(_tokens(spark, sf), 0), "df")
    trained = word_vectors(spark, sf, freq)
    given = word_vectors(spark, sf, freq.where("df >= 10"), shift=1)
    return _long(vec.replace_known(trained, given), "term")


_TAGGED = """SELECT {tag} AS tag, g.mid, coalesce(t.tokens, '') AS tokens FROM {source} g
    LEFT JOIN (SELECT mid, string_agg(term, ' ' ORDER BY si, ti) AS tokens FROM doc_word GROUP BY mid) t USING (mid)"""


@query(
    "tagged_docs",
    "SELECT 'm' AS mode, * FROM (" + _TAGGED.format(tag="CAST(g.mid AS VARCHAR)", source="greet_mail")
    + ") UNION ALL SELECT 'p', * FROM ("
    + _TAGGED.format(tag="g.who", source="(SELECT mid, recipient AS who FROM greet_flat UNION ALL SELECT mid, sender FROM greet_mail)")
    + ")",
)
def _(spark, sf):
    docs = v.greet_mail(spark, sf).withColumn("tokens", tx.bag_of_words(F.col("body")))
    by_mid = vec.tagged_docs(docs).select(F.lit("m").alias("mode"), "*")
    by_people = vec.tagged_docs(docs, people=True).select(F.lit("p").alias("mode"), "*")
    return by_mid.unionByName(by_people).withColumn("tokens", F.array_join("tokens", " "))


# --- models ----------------------------------------------------------------------------


def _topic_model(spark, sf):
    """Fitted on the documents and the benchmark passages under each other."""
    bodies = v.stacked_bodies(spark, sf)
    return tp.fit_topics(stage(bodies.select("mid", tx.bag_of_words(F.col("body")).alias("tokens")), "stacked-tokens"))


@query("lda_topics")
def _(spark, sf):
    docs = _tokens(spark, sf)
    return flatten_topics(tp.score_topics(_topic_model(spark, sf), docs), 4)


@query("lda_score")
def _(spark, sf):
    model = _topic_model(spark, sf)
    unseen = v.table(spark, sf, "benchmark").select(
        F.col("item_id").alias("mid"), tx.bag_of_words(F.col("text")).alias("tokens")
    )
    return flatten_topics(tp.score_topics(model, unseen), 4)


@query("lda_describe")
def _(spark, sf):
    return tp.describe_topics(_topic_model(spark, sf))


def _topic_tables(spark, sf):
    """The model's terms, and the topics' mean shares in the documents."""
    model = _topic_model(spark, sf)
    shares = tp.score_topics(model, _tokens(spark, sf)).groupBy("topic").agg(F.avg("score").alias("share"))
    words = spark.createDataFrame(list(enumerate(model.vocabulary)), "idx int, term string")  # at most keep_n
    return stage(tp.topic_terms(model), "topic-terms"), stage(shares, "topic-shares"), words


@query("topic_relevance")
def _(spark, sf):
    terms, shares, words = _topic_tables(spark, sf)
    return tp.term_relevance(terms, shares).join(words, "idx").select("topic", "rank", "term", "relevance")


@query("topic_map")
def _(spark, sf):
    """Place and share of each topic, so that like topics lie near each other."""
    terms, shares, _ = _topic_tables(spark, sf)
    return tp.topic_layout(tp.topic_distances(terms)).join(shares, "topic")


def _paragraph_model(spark, sf):
    docs = stage(_tokens(spark, sf).select("mid", "tokens"), "paragraph-bodies")
    return pg.fit_paragraphs(docs, dim=128, rounds=4, passes=3)


@query("doc_embeddings")
def _(spark, sf):
    """Paragraph vectors of all documents."""
    return _paragraph_model(spark, sf).docs


@query("doc_embeddings_unseen")
def _(spark, sf):
    """Paragraph vectors of the benchmark passages, with the words of the documents' model as they are."""
    unseen = v.table(spark, sf, "benchmark").select(F.col("item_id").alias("mid"), tx.bag_of_words(F.col("text")).alias("tokens"))
    return pg.infer_paragraphs(_paragraph_model(spark, sf), unseen)


@query("doc_embeddings_mean")
def _(spark, sf):
    return tp.doc_embeddings(_tokens(spark, sf), dim=128, max_iter=30)
