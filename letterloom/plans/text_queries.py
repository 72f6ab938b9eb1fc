"""Text clean-up, tokens, vocabulary, similarity and greeting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterloom.functions import addresses as ad
from letterloom.functions import text as tx
from letterloom.functions import weights as wt
from letterloom.operators import contacts as ct
from letterloom.operators import greetings as gr
from letterloom.operators import lemmas as lm
from letterloom.operators import sentence_ends as se
from letterloom.operators import similarity as sim
from letterloom.operators import vocab as vc
from letterloom.operators.reshape import explode_computed, explode_list
from letterloom.operators.skew import drop_stage, stage, stage_path
from letterloom.operators.split import chrono_split
from letterloom.plans import views as v
from letterloom.plans.registry import query, sql_view
from letterloom.plans.time_queries import _rounded
from letterloom.sources.corpus import read_corpus, write_corpus

DOMAIN = "corp.example"


def _mapped(fn):
    """Query that applies a text function to every reply_mail body."""
    return lambda spark, sf: v.reply_mail(spark, sf).select("mid", fn(F.col("body")).alias("body"))


query("deaccent", "SELECT doc_id AS mid, strip_accents(text) AS body FROM documents")(
    lambda spark, sf: v.doc_mail(spark, sf).select("mid", tx.deaccent(F.col("body")).alias("body"))
)
query("is_forward", "SELECT mid, contains(body, '-----Original Message-----') AS body FROM reply_mail")(
    _mapped(tx.is_forward)
)
_STRIP = r"regexp_replace({0}, '----[- \t\n\r\f\x0B]*(Original|Forwarded)[^\n]*Subject:', chr(10) || '\1' || chr(10), 'g')"
query("strip_forward", f"SELECT mid, {_STRIP.format('body')} AS body FROM reply_mail")(_mapped(tx.strip_forward))
query("split_boundaries", f"SELECT mid, {v.BOUNDARY_SQL.format('body')} AS body FROM reply_mail")(
    _mapped(tx.split_boundaries)
)
_NORMAL = v.BOUNDARY_SQL.format(f"replace({_STRIP.format('strip_accents(body)')}, '>', ' ')")
query("normalize_text", f"SELECT mid, {_NORMAL} AS body FROM reply_mail")(_mapped(tx.normalize_text))
query("infix_split", f"SELECT mid, {v._INFIX_SQL} AS body FROM (SELECT mid, body AS txt FROM reply_mail)")(
    _mapped(tx.infix_split)
)


@query("sentences", "SELECT mid, si AS pos, txt AS sentence FROM doc_sentence")
def _(spark, sf):
    sents = tx.sentences(tx.clean_body(F.col("body")))
    return explode_computed(v.doc_mail(spark, sf), ["mid"], sents, "sentence", pos="pos")


_TYPE = r"""CASE WHEN regexp_matches(regexp_replace({0}, '\.$', ''), '^\p{{L}}+(\.\p{{L}}+)*$') THEN lower(regexp_replace({0}, '\.$', '')) END"""
sql_view(
    "sent_type",
    f"""SELECT type, count(*) AS n, CAST(sum(p) AS BIGINT) AS n_period FROM (
          SELECT {_TYPE.format('tok')} AS type, CASE WHEN tok LIKE '%.' THEN 1 ELSE 0 END AS p
          FROM (SELECT unnest(string_split_regex(txt, '[ \t\r\n\f]+')) AS tok FROM doc_clean))
        WHERE type IS NOT NULL GROUP BY type""",
)
sql_view(
    "sent_abbr",
    """SELECT type, round(2 * (n_period * ln(0.99) + (n - n_period) * ln(0.01) - n_period * ln(p) - (n - n_period) * ln(1 - p))
           * exp(-letters) * periods * pow(CAST(letters AS DOUBLE), -CAST(n - n_period AS DOUBLE)), 6) AS score
       FROM (SELECT *, length(type) - periods + 1 AS letters FROM (
               SELECT *, length(type) - length(replace(type, '.', '')) + 1 AS periods FROM sent_type WHERE n_period > 0)),
            (SELECT CAST(sum(n_period) AS DOUBLE) / sum(n) AS p FROM sent_type)
       WHERE score >= 0.3""",
)
sql_view(
    "sent_break",
    f"""SELECT mid, si, txt, last, following, {_TYPE.format('last')} AS first, {_TYPE.format('following')} AS second,
          regexp_matches(last, '^\p{{L}}+(\.\p{{L}}+)*\.$') AS period FROM (
          SELECT mid, si, txt, regexp_extract(txt, '([^ \t\r\n\f]+)[ \t\r\n\f]*$', 1) AS last,
            lead(regexp_extract(txt, '([^ \t\r\n\f]+)', 1)) OVER (PARTITION BY mid ORDER BY si) AS following FROM doc_sentence)""",
)


def _fit(hits: str, misses: str, q: str) -> str:
    return f"CASE WHEN {q} > 0 AND {q} < 1 THEN ({hits}) * ln({q}) + ({misses}) * ln(1 - {q}) ELSE 0 END"


_RATIO = f"""round(2 * ({_fit('ab', 'a - ab', 'p1')} + {_fit('b - ab', 'n - a - b + ab', 'p2')}
    - {_fit('ab', 'a - ab', 'p')} - {_fit('b - ab', 'n - a - b + ab', 'p')}), 6)"""


def _ratio_sql(keys: str, source: str, least: float) -> str:
    return f"""SELECT {keys}, {_RATIO} AS score FROM (
        SELECT *, CAST(b AS DOUBLE) / n AS p, CAST(ab AS DOUBLE) / a AS p1, CASE WHEN n > a THEN CAST(b - ab AS DOUBLE) / (n - a) ELSE 0 END AS p2
        FROM ({source}), (SELECT CAST(sum(n) AS BIGINT) AS n FROM sent_type)) WHERE CAST(n AS DOUBLE) * ab > CAST(a AS DOUBLE) * b AND score >= {least}"""


sql_view(
    "sent_start",
    _ratio_sql(
        "second AS type",
        """SELECT second, ab, b, a FROM (
             SELECT second, count(*) AS ab FROM sent_break WHERE following IS NOT NULL AND second IS NOT NULL
               AND (first IS NULL OR first NOT IN (SELECT type FROM sent_abbr)) GROUP BY second)
           JOIN (SELECT type AS second, n AS b FROM sent_type) USING (second),
           (SELECT count(*) AS a FROM sent_break WHERE following IS NOT NULL AND (first IS NULL OR first NOT IN (SELECT type FROM sent_abbr)))""",
        30.0,
    ),
)
sql_view(
    "sent_pair",
    _ratio_sql(
        "first, second",
        """SELECT first, second, ab, b, a FROM (
             SELECT first, second, count(*) AS ab FROM sent_break WHERE following IS NOT NULL AND second IS NOT NULL AND period
               AND first IN (SELECT type FROM sent_abbr) GROUP BY ALL HAVING count(*) > 1)
           JOIN (SELECT type AS second, n AS b FROM sent_type) USING (second) JOIN (SELECT type AS first, n AS a FROM sent_type) USING (first)""",
        7.88,
    ),
)


@query(
    "sentence_types",
    """SELECT 'abbreviation' AS kind, type AS first, '' AS second, score FROM sent_abbr
       UNION ALL SELECT 'starter', type, '', score FROM sent_start UNION ALL SELECT 'collocation', first, second, score FROM sent_pair""",
)
def _(spark, sf):
    model = se.learn(v.doc_mail(spark, sf))
    none = F.lit("").alias("second")
    short = model.abbreviations.select(F.lit("abbreviation").alias("kind"), F.col("type").alias("first"), none, "score")
    starts = model.starters.select(F.lit("starter").alias("kind"), F.col("type").alias("first"), none, "score")
    return short.unionByName(starts).unionByName(model.collocations.select(F.lit("collocation").alias("kind"), "first", "second", "score"))


@query(
    "sentences_learned",
    """SELECT mid, CAST(number AS INTEGER) AS pos, string_agg(txt, ' ' ORDER BY si) AS sentence FROM (
         SELECT *, coalesce(sum(CASE WHEN inside THEN 0 ELSE 1 END) OVER (
             PARTITION BY mid ORDER BY si ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS number FROM (
           SELECT b.*, following IS NOT NULL AND period AND b.first IN (SELECT type FROM sent_abbr)
             AND (c.score IS NOT NULL OR s.score IS NULL OR NOT regexp_matches(following, '^\\p{Lu}')) AS inside
           FROM sent_break b LEFT JOIN sent_start s ON s.type = b.second LEFT JOIN sent_pair c ON c.first = b.first AND c.second = b.second))
       GROUP BY mid, number""",
)
def _(spark, sf):
    docs = v.doc_mail(spark, sf)
    texts = se.split_texts(docs)
    return se.learned_sentences(docs, se.learn(docs, texts), texts)


@query(
    "strip_punct_digits",
    """SELECT regexp_replace(regexp_replace(orth, '[[:punct:]]', '', 'g'), '[0-9]', '', 'g') AS word, count(*) AS n
       FROM doc_piece GROUP BY 1""",
)
def _(spark, sf):
    raw = explode_computed(v.doc_mail(spark, sf), [], tx.pieces(tx.clean_body(F.col("body"))), "raw")
    words = raw.select(tx.strip_digits(tx.strip_punct(F.col("raw"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _joined_sql(term: str, source: str, distinct: str = "") -> str:
    agg = f"string_agg(DISTINCT {term}, ' ' ORDER BY {term})" if distinct else f"string_agg({term}, ' ' ORDER BY si, ti)"
    return f"""SELECT d.mid, coalesce(t.tokens, '') AS tokens FROM doc_mail d
               LEFT JOIN (SELECT mid, {agg} AS tokens FROM {source} GROUP BY mid) t USING (mid)"""


_BASIC = "(SELECT mid, si, ti, CASE WHEN low LIKE '-%' OR low LIKE '%-' THEN replace(low, '-', '') ELSE low END AS term FROM doc_kept WHERE length(orth) > 1)"
_SECOND_LIST = (*ad.NOT_NAMES, "thing", "ing", "queno")  # words of the texts among them
query("bow_extended", _joined_sql("term", f"(SELECT * FROM doc_word WHERE term NOT IN ({v.word_list(_SECOND_LIST)}))"))(
    lambda spark, sf: v.doc_mail(spark, sf).select(
        "mid", F.array_join(tx.bag_of_words(F.col("body"), extra_stop_words=_SECOND_LIST), " ").alias("tokens")
    )
)
query("bow_basic", _joined_sql("term", _BASIC))(
    lambda spark, sf: v.doc_mail(spark, sf).select(
        "mid", F.array_join(tx.bag_of_words(F.col("body"), extended=False), " ").alias("tokens")
    )
)


@query(
    "bow_sentences",
    f"""SELECT s.mid, s.si AS pos, coalesce(string_agg(t.term, ' ' ORDER BY t.ti), '') AS tokens
        FROM doc_sentence s LEFT JOIN {_BASIC} t ON t.mid = s.mid AND t.si = s.si GROUP BY s.mid, s.si""",
)
def _(spark, sf):
    sents = tx.sentence_tokens(F.col("body"), extended=False)
    rows = explode_computed(v.doc_mail(spark, sf), ["mid"], sents, "_t", pos="pos")
    return rows.select("mid", "pos", F.array_join("_t", " ").alias("tokens"))


@query(
    "bow_first_sentences",
    """SELECT s.mid, s.si AS pos, coalesce(string_agg(t.term, ' ' ORDER BY t.ti), '') AS tokens
       FROM doc_sentence s LEFT JOIN (
         SELECT w.* FROM doc_word w JOIN doc_mail d USING (mid)
         WHERE w.low <> lower(regexp_extract(d.body, '([A-Za-z]+)', 1))) t ON t.mid = s.mid AND t.si = s.si
       WHERE s.si < 2 GROUP BY s.mid, s.si""",
)
def _(spark, sf):
    # the first word of each body plays the tagged person
    persons = F.array(F.lower(F.regexp_extract("body", "([A-Za-z]+)", 1)))
    sents = tx.sentence_tokens(F.col("body"), first=2, excluded=persons)
    rows = explode_computed(v.doc_mail(spark, sf), ["mid"], sents, "_t", pos="pos")
    return rows.select("mid", "pos", F.array_join("_t", " ").alias("tokens"))


query("tokens_unique", _joined_sql("term", "doc_word", "distinct"))(
    lambda spark, sf: unique_tokens(spark, sf).select("mid", F.array_join("tokens", " ").alias("tokens"))
)


def unique_tokens(spark, sf):
    """doc_mail with sorted distinct tokens, as the ranking features use them."""
    return v.doc_tokens(spark, sf).withColumn("tokens", tx.distinct_tokens(F.col("tokens")))


@query("tokens_table", _joined_sql("term", "doc_word", "distinct"))
def _(spark, sf):
    table = stage(unique_tokens(spark, sf).select("mid", "tokens"), "tokens")
    return table.select("mid", F.array_join("tokens", " ").alias("tokens"))


@query(
    "doc_sents",
    """SELECT s.mid, s.si AS pos, coalesce(string_agg(t.term, ' ' ORDER BY t.ti), '') AS tokens
       FROM stk_sentence s LEFT JOIN stk_word t ON t.mid = s.mid AND t.si = s.si GROUP BY s.mid, s.si""",
)
def _(spark, sf):
    rows = explode_computed(v.stacked_bodies(spark, sf), ["mid"], tx.sentence_tokens(F.col("body")), "_t", pos="pos")
    return rows.select("mid", "pos", F.array_join("_t", " ").alias("tokens"))


@query(
    "doc_persons",
    """SELECT mid, term, count(*) AS n FROM stk_word
       WHERE term IN (SELECT split_part(recipient, '.', 1) FROM greet_flat) GROUP BY mid, term""",
)
def _(spark, sf):
    docs = v.stacked_bodies(spark, sf).select("mid", tx.bag_of_words(F.col("body")).alias("tokens"))
    names = v.greet_mail(spark, sf).select(F.explode("recipients").alias("_a"))
    names = names.select(F.substring_index("_a", ".", 1).alias("name"))
    return vc.known_words(vc.term_counts(docs), names).select("mid", "term", F.col("cnt").alias("n"))


# --- vocabulary and weights ------------------------------------------------------


def word_counts(spark, sf):
    return vc.term_counts(v.doc_tokens(spark, sf))


sql_view("doc_df", "SELECT term, count(DISTINCT mid) AS df FROM doc_word GROUP BY term")


def _vocab_sql(no_below: int) -> str:
    return f"""SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id, df FROM (
                 SELECT * FROM doc_df WHERE df >= {no_below} AND df <= CAST(0.2 AS DOUBLE) * (SELECT count(*) FROM doc_mail)
                 ORDER BY df DESC, term LIMIT 100000)"""


sql_view("vocab10", _vocab_sql(10))
sql_view("vocab4", _vocab_sql(4))


@query("doc_freq", "SELECT term, df FROM doc_df WHERE df > 4")
def _(spark, sf):
    return vc.doc_freq(v.doc_tokens(spark, sf), 4)


@query("avg_doc_len", "SELECT (SELECT count(*) FROM doc_word) // (SELECT count(*) FROM doc_mail) AS avg_len")
def _(spark, sf):
    return vc.avg_doc_len(v.doc_tokens(spark, sf))


@query("vocab_filter", "SELECT * FROM vocab10")
def _(spark, sf):
    return vc.vocabulary(v.doc_tokens(spark, sf), no_below=10)


sql_view("doc_uniq", "SELECT DISTINCT mid, term FROM doc_word")


@query(
    "global_text_features",
    """SELECT term, term_id, df, round(log10((CAST((SELECT count(*) FROM doc_mail) AS DOUBLE) + 1) / df), 6) AS idf,
         (SELECT count(*) FROM doc_uniq) // (SELECT count(*) FROM doc_mail) AS avg_len FROM vocab10""",
)
def _(spark, sf):
    return _rounded(vc.global_text_features(stage(unique_tokens(spark, sf), "tokens")))


@query("doc2bow", "SELECT mid, term_id, cnt FROM doc_term JOIN vocab4 USING (term)")
def _(spark, sf):
    docs = stage(v.doc_tokens(spark, sf), "tokens")
    return vc.doc2bow(docs, vc.vocabulary(docs, no_below=4))


@query("corpus_roundtrip", "SELECT mid, term, cnt FROM doc_term JOIN vocab4 USING (term)")
def _(spark, sf):
    docs = stage(v.doc_tokens(spark, sf), "tokens")
    vocab = stage(vc.vocabulary(docs, no_below=4), "vocabulary")
    path = stage_path(spark, "corpus")
    write_corpus(vocab, vc.doc2bow(docs, vocab), path)
    vocab, corpus = read_corpus(spark, path)
    return corpus.join(vocab, "term_id").select("mid", "term", "cnt")


@query(
    "idf_variants",
    """SELECT term, df, round(log10((n + 1) / df), 6) AS idf_log10, round(ln((n + 1) / (df + 1)), 6) AS idf_tfidf,
         round(ln((n - df + 0.5) / (df + 0.5)), 6) AS idf_bm25
       FROM (SELECT term, CAST(df AS DOUBLE) AS df, CAST((SELECT count(*) FROM doc_mail) AS DOUBLE) AS n FROM doc_df)""",
)
def _(spark, sf):
    docs = stage(v.doc_tokens(spark, sf), "tokens")
    n, df = vc.n_docs(docs), F.col("df")
    return _rounded(
        vc.doc_freq(docs).select(
            "term", df.cast("double").alias("df"), wt.idf_log10(n, df).alias("idf_log10"),
            wt.idf(n, df).alias("idf_tfidf"), wt.idf(n, df, "bm25").alias("idf_bm25"),
        )
    )


@query(
    "tf_modes",
    """SELECT mid, term, CAST(cnt AS DOUBLE) AS raw, round(1 + ln(cnt), 6) AS log,
         round(1 + ln(1 + ln(cnt)), 6) AS loglog, round(sqrt(cnt), 6) AS sqrt FROM doc_term""",
)
def _(spark, sf):
    modes = [wt.tf(F.col("cnt"), m).alias(m) for m in ("raw", "log", "loglog", "sqrt")]
    return _rounded(word_counts(spark, sf).select("mid", "term", *modes))


def _unit_sql(body: str) -> str:
    return f"SELECT mid, term, w / sqrt(sum(w * w) OVER (PARTITION BY mid)) AS weight FROM ({body})"


sql_view(
    "tfidf",
    _unit_sql(
        """SELECT mid, term, cnt * (ln((1 + CAST((SELECT count(*) FROM doc_mail) AS DOUBLE)) / (1 + df)) + 1) AS w
           FROM doc_term JOIN doc_df USING (term) WHERE df >= 5"""
    ),
)
sql_view(
    "tfidf_held",
    _unit_sql(
        """SELECT t.mid, t.term, t.cnt * (ln((1 + CAST((SELECT count(*) FROM doc_split WHERE part = 'train') AS DOUBLE)) / (1 + f.df)) + 1) AS w
           FROM doc_term t JOIN doc_split s ON s.mid = t.mid AND s.part = 'dev' JOIN (
             SELECT term, count(*) AS df FROM doc_term JOIN doc_split USING (mid) WHERE part = 'train'
             GROUP BY term HAVING count(*) >= 5) f ON f.term = t.term"""
    ),
)
_ROUND_W = "SELECT mid, term, round(weight, 6) AS weight FROM {0}"


def tfidf_vectors(docs):
    return vc.tfidf_transform(docs, vc.tfidf_model(docs))


@query("tfidf_fit", _ROUND_W.format("tfidf"))
def _(spark, sf):
    return _rounded(tfidf_vectors(stage(v.doc_tokens(spark, sf), "tokens")))


@query("tfidf_transform", _ROUND_W.format("tfidf_held"))
def _(spark, sf):
    docs = stage(v.doc_tokens(spark, sf), "tokens")
    dated = docs.select("sender", "mid", F.col("mid").alias("date"))
    parts = docs.join(stage(chrono_split(dated).select("mid", "part"), "split"), "mid")
    model = vc.tfidf_model(parts.where("part = 'train'"))
    return _rounded(vc.tfidf_transform(parts.where("part = 'dev'"), model))


@query(
    "tfidf_log2",
    _ROUND_W.format(
        "("
        + _unit_sql(
            """SELECT mid, term, cnt * log2(CAST((SELECT count(*) FROM doc_mail) AS DOUBLE) / df) AS w
               FROM doc_term JOIN vocab4 USING (term) WHERE df < (SELECT count(*) FROM doc_mail)"""
        )
        + ")"
    ),
)
def _(spark, sf):
    docs = stage(v.doc_tokens(spark, sf), "tokens")
    return _rounded(vc.tfidf_transform(docs, vc.log2_model(docs, vc.vocabulary(docs, no_below=4)), keep_n=True))


@query(
    "lemma_lookup",
    """SELECT mid, lemma, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
         SELECT mid, CASE WHEN term LIKE '%s' AND length(term) > 3 THEN term[:-2] ELSE term END AS lemma, cnt FROM doc_term)
       GROUP BY ALL""",
)
def _(spark, sf):
    counts = stage(word_counts(spark, sf), "counts")
    plural = counts.select("term").distinct().where(F.endswith("term", F.lit("s")) & (F.length("term") > 3))
    lemmas = plural.select(F.col("term").alias("token"), F.regexp_replace("term", "s$", "").alias("lemma"))
    return vc.lemmatize(counts, lemmas)


# Words of one fold are held out of the lemma table; what becomes of them follows from the rules of the others.
sql_view(
    "lemma_pair",
    """SELECT term, lemma, substring(md5(term), 1, 1) IN ('0', '1', '2') AS held FROM (
         SELECT DISTINCT term, CASE WHEN term LIKE '%ies' AND length(term) > 4 THEN term[:-4] || 'y'
           WHEN term LIKE '%s' AND length(term) > 3 THEN term[:-2]
           WHEN term LIKE '%ing' AND length(term) > 5 THEN term[:-4] ELSE term END AS lemma FROM doc_term)""",
)
sql_view(
    "lemma_rule",
    f"""SELECT suffix, best.r AS replacement, best.n AS n FROM (
          SELECT suffix, max({{'n': n, 'r': replacement}}) AS best, sum(n) AS total FROM (
            SELECT right(term, k) AS suffix, right(lemma, length(lemma) - length(term) + k) AS replacement, count(*) AS n FROM (
              SELECT term, lemma, unnest(range(length(term) - p, least(length(term), {lm.LONGEST}) + 1)) AS k FROM (
                SELECT term, lemma, list_max(list_filter(range(0, least(length(term), length(lemma)) + 1),
                  lambda i: left(term, i) = left(lemma, i))) AS p FROM lemma_pair WHERE NOT held))
            GROUP BY ALL) GROUP BY suffix) WHERE best.n >= {lm.MIN_SUPPORT} AND best.n >= {lm.MIN_SHARE} * total""",
)


@query(
    "lemma_rules",
    """SELECT p.term, coalesce(CASE WHEN NOT held THEN p.lemma END, r.lemma, p.term) AS lemma FROM lemma_pair p LEFT JOIN (
         SELECT term, max({'k': length(suffix), 'l': left(term, length(term) - length(suffix)) || replacement}).l AS lemma
         FROM (SELECT term, right(term, unnest(range(0, least(length(term), 6) + 1))) AS suffix FROM lemma_pair WHERE held)
         JOIN lemma_rule USING (suffix) GROUP BY term) r ON r.term = p.term""",
)
def _(spark, sf):
    words = stage(word_counts(spark, sf).select("term").distinct(), "words")
    n, term = F.length("term"), F.col("term")
    lemma = (
        F.when(F.endswith(term, F.lit("ies")) & (n > 4), F.concat(F.left(term, n - 3), F.lit("y")))
        .when(F.endswith(term, F.lit("s")) & (n > 3), F.left(term, n - 1))
        .when(F.endswith(term, F.lit("ing")) & (n > 5), F.left(term, n - 3))
        .otherwise(term)
    )
    given = words.where(~F.substring(F.md5(term), 1, 1).isin("0", "1", "2")).select(term.alias("token"), lemma.alias("lemma"))
    return lm.lemmas_of(words, given, lm.induce(given))


# --- similarity --------------------------------------------------------------------

for _dir, _u, _c in (("out", "sender", "recipient"), ("in", "recipient", "sender")):
    sql_view(
        f"mean_{_dir}",
        f"""SELECT {_u} AS user, {_c} AS contact, term, sum(weight) / any_value(n) AS weight
            FROM talk_mail JOIN tfidf USING (mid)
            JOIN (SELECT {_u}, {_c}, CAST(count(*) AS DOUBLE) AS n FROM talk_mail GROUP BY ALL) USING ({_u}, {_c}) GROUP BY ALL""",
    )
sql_view(
    "talk_pairs",
    """SELECT m.mid, m.sender AS user, c.contact FROM talk_mail m JOIN (
         SELECT sender AS user, recipient AS contact FROM talk_mail UNION SELECT recipient, sender FROM talk_mail) c
       ON c.user = m.sender""",
)


def _sim_sql(direction: str) -> str:
    return f"""SELECT p.mid, p.user, p.contact, round(coalesce(sim, 0), 6) AS sim FROM talk_pairs p LEFT JOIN (
        SELECT d.mid, d.user, d.contact, dot / (a * b) AS sim FROM (
          SELECT v.mid, m.user, m.contact, sum(v.weight * m.weight) AS dot FROM tfidf v JOIN talk_mail t ON t.mid = v.mid
          JOIN mean_{direction} m ON m.user = t.sender AND m.term = v.term GROUP BY ALL) d
        JOIN (SELECT mid, sqrt(sum(weight * weight)) AS a FROM tfidf GROUP BY mid) x ON x.mid = d.mid
        JOIN (SELECT user, contact, sqrt(sum(weight * weight)) AS b FROM mean_{direction} GROUP BY ALL) y
          ON y.user = d.user AND y.contact = d.contact) s ON s.mid = p.mid AND s.user = p.user AND s.contact = p.contact"""


def talk_vectors(spark, sf, numbered=True):
    """(talk log, its tf-idf vectors); the vectors are staged and packed, with numbers for terms if ``numbered``."""
    docs = stage(vc.by_id(v.doc_tokens(spark, sf).select("mid", "tokens")), "tokens")
    model = stage(vc.tfidf_model(docs), "model")
    model = vc.number_terms(model) if numbered else model
    vectors = stage(vc.tfidf_transform(docs, model, packed=True), "vectors")
    drop_stage(docs)
    return v.talk_mail(spark, sf).drop("body"), vectors


@query("pair_mean_vector", "SELECT user, contact, term, round(weight, 6) AS weight FROM mean_out")
def _(spark, sf):
    flat, vectors = talk_vectors(spark, sf, numbered=False)
    return _rounded(sim.pair_mean_vector(flat, vectors))


def _text_sim(direction):
    def run(spark, sf):
        flat, vectors = talk_vectors(spark, sf)
        means = stage(sim.pair_mean_vector(flat, vectors, direction), "means")
        pairs = ct.candidates(flat.select("sender", "mid"), ct.contacts_all(flat))
        pairs = stage(pairs.select("mid", F.col("sender").alias("user"), "contact"), "pairs")
        similar = sim.text_similarity(pairs, vectors, means, every_contact=True)
        drop_stage(vectors)
        return _rounded(similar)

    return run


query("text_sim_out", _sim_sql("out"))(_text_sim(sim.OUT))
query("text_sim_in", _sim_sql("in"))(_text_sim(sim.IN))



sql_view(
    "loo",
    """SELECT q.mid, t.term, sum(t.weight) AS w FROM talk_mail q
       JOIN talk_mail c ON c.sender = q.sender AND c.recipient = q.recipient AND c.mid <> q.mid
       JOIN tfidf t ON t.mid = c.mid GROUP BY q.mid, t.term""",
)


@query(
    "text_sim_leave_one_out",
    """SELECT q.mid, q.sender AS user, q.recipient AS contact, round(coalesce(d.dot / (x.a * o.b), 0), 6) AS sim FROM talk_mail q
       LEFT JOIN (SELECT o.mid, sum(o.w * t.weight) AS dot FROM loo o JOIN tfidf t ON t.mid = o.mid AND t.term = o.term GROUP BY o.mid) d
         ON d.mid = q.mid
       LEFT JOIN (SELECT mid, sqrt(sum(w * w)) AS b FROM loo GROUP BY mid) o ON o.mid = q.mid
       LEFT JOIN (SELECT mid, sqrt(sum(weight * weight)) AS a FROM tfidf GROUP BY mid) x ON x.mid = q.mid""",
)
def _(spark, sf):
    flat, vectors = talk_vectors(spark, sf)
    own = flat.select("mid", F.col("sender").alias("user"), F.col("recipient").alias("contact"))
    counts = own.groupBy("user", "contact").agg(F.count(F.lit(1)).alias("n"))
    means = stage(sim.pair_mean_vector(flat, vectors), "means")
    return _rounded(sim.leave_one_out_similarity(own, vectors, means, counts))


N_SIMILAR = 5


def _top_sql(role: str) -> str:
    return f"""SELECT user, mid, other, score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user, mid ORDER BY score DESC, other) AS rank FROM (
          SELECT e.user, e.mid, e.other, round(coalesce(s.dot / (x.a * y.a), 0), 9) AS score
          FROM (SELECT q.user, q.mid, c.mid AS other FROM asked q
                JOIN talk_mail c ON c.{role} = q.user) e
          LEFT JOIN (SELECT q.mid, c.mid AS other, sum(a.weight * b.weight) AS dot
                FROM asked q JOIN tfidf a ON a.mid = q.mid
                JOIN talk_mail c ON c.{role} = q.user JOIN tfidf b ON b.mid = c.mid AND b.term = a.term GROUP BY ALL) s
            ON s.mid = e.mid AND s.other = e.other
          LEFT JOIN (SELECT mid, sqrt(sum(weight * weight)) AS a FROM tfidf GROUP BY mid) x ON x.mid = e.mid
          LEFT JOIN (SELECT mid, sqrt(sum(weight * weight)) AS a FROM tfidf GROUP BY mid) y ON y.mid = e.other))
      WHERE rank <= {N_SIMILAR}"""


sql_view("asked", "SELECT sender AS user, mid FROM doc_split JOIN doc_mail USING (mid) WHERE part = 'dev'")
sql_view("top_sent", _top_sql("sender"))
sql_view("top_got", _top_sql("recipient"))


def _flag_sql(top: str, role: str) -> str:
    return f"""SELECT q.user, q.mid, c.contact, CASE WHEN EXISTS (
          SELECT 1 FROM {top} s JOIN talk_mail t ON t.mid = s.other WHERE s.user = q.user AND s.mid = q.mid AND t.{role} = c.contact) THEN 1 ELSE -1 END AS flag
        FROM (SELECT DISTINCT user, mid FROM {top}) q JOIN (
          SELECT sender AS user, recipient AS contact FROM talk_mail UNION SELECT recipient, sender FROM talk_mail) c USING (user)"""


def _asked(flat):
    """(user, mid): every held-out message of every sender."""
    parts = stage(chrono_split(flat.select("sender", "mid", F.col("mid").alias("date")), percent=0.2), "parts")
    return parts.where("part = 'dev'").select(F.col("sender").alias("user"), "mid")


def _similar(spark, sf, role):
    flat, vectors = talk_vectors(spark, sf)
    corpus = flat.select(F.col(role).alias("user"), "mid")
    return flat, sim.top_similar(_asked(flat), corpus, vectors, N_SIMILAR)


@query("topk_similar_from_sender", "SELECT user, mid, other, round(score, 6) AS score, rank FROM top_sent")
def _(spark, sf):
    return _rounded(_similar(spark, sf, "sender")[1])


@query("incoming_flag", _flag_sql("top_got", "sender"))
def _(spark, sf):
    flat, similar = _similar(spark, sf, "recipient")
    return sim.similarity_flags(stage(similar, "similar"), flat, "sender", ct.contacts_all(flat))


@query("outgoing_flag", _flag_sql("top_sent", "recipient"))
def _(spark, sf):
    flat, similar = _similar(spark, sf, "sender")
    return sim.similarity_flags(stage(similar, "similar"), flat, "recipient", ct.contacts_all(flat))


# --- greetings ---------------------------------------------------------------------

_STOP = v.word_list(ad.name_stop_words(DOMAIN))
sql_view(
    "g_first",
    f"""SELECT DISTINCT lower(name) AS name FROM (SELECT split_part(recipient, '.', 1) AS name FROM greet_flat
          WHERE strpos(recipient, '.') < strpos(recipient, '@') AND split_part(recipient, '@', 2) = '{DOMAIN}')
        WHERE length(name) > 1 AND name NOT IN ({_STOP})""",
)
sql_view(
    "g_last",
    f"""SELECT DISTINCT lower(name) AS name FROM (SELECT split_part(split_part(recipient, '@', 1), '.', 2) AS name FROM greet_flat
          WHERE strpos(recipient, '.') < strpos(recipient, '@') - 1 AND split_part(recipient, '@', 2) = '{DOMAIN}')
        WHERE length(name) > 1 AND name NOT IN ({_STOP})""",
)
sql_view(
    "g_token",
    r"""SELECT mid, unnest(l) AS word, generate_subscripts(l, 1) - 1 AS pos FROM (
          SELECT mid, list_filter(list_slice(ws, 1, len(ws) - 1), lambda w: length(w) > 1) AS l FROM (
            SELECT mid, string_split_regex(regexp_replace(substr(b, 1, length(b) - 1), '(\p{Ll})(\p{Lu})', '\1 \2', 'g')
                        || substr(b, length(b), 1), '[[:punct:] ]') AS ws
            FROM (SELECT mid, substr(body, 1, 100) AS b FROM doc_mail)))""",
)
sql_view(
    "g_hit",
    "SELECT mid, pos, word FROM g_token WHERE lower(word) IN (SELECT name FROM g_first UNION SELECT name FROM g_last)",
)
sql_view(
    "g_book",
    """SELECT recipient, word AS name, sum(c / n) AS weight FROM (
         SELECT recipient, mid, CAST(len(recipients) AS DOUBLE) AS n, row_number() OVER (PARTITION BY recipient ORDER BY date, mid, pos) AS seen
         FROM (SELECT mid, date, recipients, unnest(recipients) AS recipient, generate_subscripts(recipients, 1) AS pos FROM greet_mail))
       JOIN (SELECT mid, word, count(*) AS c FROM g_hit GROUP BY ALL) USING (mid)
       WHERE seen > 1 GROUP BY ALL HAVING sum(c / n) > 0.2""",
)
sql_view(
    "g_pairs",
    "SELECT DISTINCT mid, recipient FROM greet_flat UNION SELECT mid, sender FROM greet_mail",
)


@query("first_names", "SELECT name FROM g_first")
def _(spark, sf):
    return gr.first_names(v.greet_mail(spark, sf), DOMAIN)


@query("last_names", "SELECT name FROM g_last")
def _(spark, sf):
    return gr.last_names(v.greet_mail(spark, sf), DOMAIN)


@query("greeting_tokens", "SELECT mid, pos, word FROM g_token")
def _(spark, sf):
    d = v.doc_mail(spark, sf)
    return d.select("mid", F.posexplode(ad.greeting_tokens(F.col("body"))).alias("pos", "word"))


@query("greeting_detect", "SELECT mid, pos, word FROM g_hit WHERE mid IN (SELECT mid FROM greet_mail)")
def _(spark, sf):
    log = v.greet_mail(spark, sf)
    return gr.detect_greetings(log, gr.known_names(log, DOMAIN))


def greeting_parts(spark, sf):
    """(log, greeting words, book), the last two staged."""
    log = v.greet_mail(spark, sf)
    words = stage(gr.detect_greetings(log, gr.known_names(log, DOMAIN)), "greeting-words")
    return log, words, stage(gr.greeting_book(log, words), "greeting-book")


@query(
    "greeting_book",
    """SELECT recipient, name, round(weight, 6) AS weight,
         row_number() OVER (PARTITION BY recipient ORDER BY round(weight, 9) DESC, name) AS rank FROM g_book""",
)
def _(spark, sf):
    return _rounded(gr.greeting_book_ranked(greeting_parts(spark, sf)[2]))


@query(
    "greeting_value",
    """SELECT p.mid, p.recipient, CASE
         WHEN p.recipient NOT IN (SELECT recipient FROM greet_flat) OR NOT EXISTS (SELECT 1 FROM g_hit h WHERE h.mid = p.mid) THEN 0
         WHEN EXISTS (SELECT 1 FROM g_hit h WHERE h.mid = p.mid AND (
             list_contains(string_split(split_part(p.recipient, '@', 1), '.'), h.word)
             OR EXISTS (SELECT 1 FROM g_book b WHERE b.recipient = p.recipient AND b.name = h.word AND b.weight > 0.5))) THEN 1
         ELSE -1 END AS greet FROM g_pairs p""",
)
def _(spark, sf):
    log, words, book = greeting_parts(spark, sf)
    flat = explode_list(log, "recipients", "recipient")
    known = flat.select("recipient").distinct()
    # the sender's own id is no known recipient
    pairs = flat.select("mid", "recipient").union(log.select("mid", "sender")).distinct()
    return gr.greeting_value(pairs, words, book, known)


@query(
    "clean_names",
    f"""SELECT DISTINCT name FROM (SELECT regexp_replace(split_part(w, '/', 1), '[0-9]', '', 'g') AS name
          FROM (SELECT unnest(string_split(body, ' ')) AS w FROM doc_mail))
        WHERE name <> '' AND NOT regexp_matches(name, '[[:punct:]]') AND name NOT IN ({v.word_list(tx.STOP_WORDS)})""",
)
def _(spark, sf):
    persons = v.doc_mail(spark, sf).select(F.split("body", " ", -1).alias("persons"))
    return gr.clean_names(persons, tx.STOP_WORDS)
