"""Sentence ends learned from the texts themselves.

Which words are abbreviations, which words start sentences and which pairs belong together follows from
likelihood ratios over counts of word types in the whole corpus (the published unsupervised method for
sentence boundaries, with its thresholds).  Counts are sums over all texts; what is learned is a
table of types, and texts meet it by joins.  A break of the plain rule stays unless the table speaks against it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.functions import text as tx
from letterloom.operators.reshape import explode_computed
from letterloom.operators.skew import skew_join, stage

# Thresholds of the method.
ABBREVIATION, STARTER, COLLOCATION = 0.3, 30.0, 7.88
WORD_OR_PERIOD = r"^\p{L}+(\.\p{L}+)*\.?$"
WITH_PERIOD = r"^\p{L}+(\.\p{L}+)*\.$"
NO_BLANKS = r"[^ \t\r\n\f]+"


@dataclass
class SentenceModel:
    """``abbreviations`` (type, score), ``starters`` (type, score), ``collocations`` (first, second, score)."""

    abbreviations: DataFrame
    starters: DataFrame
    collocations: DataFrame


def _type(token: Column) -> Column:
    """The word in lower case without its final period, null for what is no word."""
    return F.when(token.rlike(WORD_OR_PERIOD), F.lower(F.regexp_replace(token, r"\.$", "")))


def split_texts(docs: DataFrame) -> DataFrame:
    """(mid, sentences, ends) of (mid, body), written once: pieces by the plain rule, and for all but the last what stands around their end.

    An end has the types of the last word and of the one that follows, whether a word and a period end the piece, and whether a capital follows.
    All pieces but the first start with a word and all but the last end with one.
    """
    word = f"^{NO_BLANKS}"

    def words(piece: Column, following: Column) -> Column:
        last = F.reverse(F.regexp_extract(F.reverse(piece), word, 0))
        return F.struct(last.alias("last"), F.regexp_extract(following, word, 0).alias("following"))

    def end(pair: Column) -> Column:
        last, following = pair["last"], pair["following"]
        fields = {"first": _type(last), "second": _type(following), "period": last.rlike(WITH_PERIOD), "capital": following.rlike(r"^\p{Lu}")}
        return F.struct(*[value.alias(name) for name, value in fields.items()])

    pieces = docs.select("mid", tx.sentences(tx.clean_body(F.col("body"))).alias("sentences"))
    n = F.size("sentences")
    before, after = F.slice("sentences", F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice("sentences", F.lit(2), F.greatest(n, F.lit(0)))
    return stage(pieces.select("mid", "sentences", F.transform(F.zip_with(before, after, words), end).alias("ends")), "sentence-texts")


def token_counts(texts: DataFrame) -> DataFrame:
    """(type, n, n_period): occurrences of each word type, and those with a period right after.

    Equal words are counted first, so that each is looked at once.
    """
    tokens = explode_computed(texts, [], F.split(F.array_join("sentences", " "), tx.BLANKS), "token")
    tokens = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("times"))
    period = F.when(F.endswith("token", F.lit(".")), F.col("times")).otherwise(0)
    words = tokens.select(_type(F.col("token")).alias("type"), "times", period.alias("p")).where("type is not null")
    return words.groupBy("type").agg(F.sum("times").alias("n"), F.sum("p").alias("n_period"))


def abbreviations(counts: DataFrame) -> DataFrame:
    """(type, score): types that a period follows far more often than chance has it; short ones and those with inner periods score higher."""
    whole = counts.agg(F.sum("n").alias("all_n"), F.sum("n_period").alias("all_p"))
    p = F.col("all_p") / F.col("all_n")
    n, k = F.col("n"), F.col("n_period")
    null = k * F.log(p) + (n - k) * F.log(1 - p)
    close = k * F.log(F.lit(0.99)) + (n - k) * F.log(F.lit(0.01))
    periods = F.length("type") - F.length(F.replace("type", F.lit("."))) + 1
    letters = F.length("type") - periods + 1
    score = 2 * (close - null) * F.exp(-letters) * periods * F.pow(letters.cast("double"), -(n - k).cast("double"))
    scored = counts.where("n_period > 0").join(F.broadcast(whole.where("all_p > 0 and all_p < all_n")))  # one row
    return scored.select("type", F.round(score, 6).alias("score")).where(F.col("score") >= ABBREVIATION)


def _log_ratio(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Likelihood ratio of ``ab`` joint cases among ``a`` and ``b`` of ``n``."""
    p, p1, p2 = b / n, ab / a, F.when(n > a, (b - ab) / (n - a)).otherwise(0.0)

    def fit(hits: Column, misses: Column, q: Column) -> Column:
        return F.when((q > 0) & (q < 1), hits * F.log(q) + misses * F.log(1 - q)).otherwise(0.0)

    apart = fit(ab, a - ab, p) + fit(b - ab, n - a - b + ab, p)
    together = fit(ab, a - ab, p1) + fit(b - ab, n - a - b + ab, p2)
    return 2 * (together - apart)


def learn(docs: DataFrame, texts: DataFrame | None = None) -> SentenceModel:
    """The tables of (mid, body); ``texts`` is the result of ``split_texts``, if there is one."""
    texts = split_texts(docs) if texts is None else texts
    counts = stage(token_counts(texts), "sentence-types")
    short = stage(abbreviations(counts), "sentence-abbreviations")
    after = texts.select(F.explode("ends").alias("e")).select("e.first", "e.second", "e.period")
    known = short.select(F.col("type").alias("first"), F.lit(True).alias("abbreviated"))
    pairs = after.groupBy("first", "second", "period").agg(F.count(F.lit(1)).alias("ab"))
    pairs = stage(pairs.join(known, "first", "left").withColumn("abbreviated", F.coalesce("abbreviated", F.lit(False))), "sentence-pairs")
    totals = counts.agg(F.sum("n").alias("n"))
    types = counts.select(F.col("type").alias("second"), F.col("n").alias("b"))

    sure = pairs.where("not abbreviated")
    n_breaks = sure.agg(F.sum("ab").alias("a"))
    starts = sure.where("second is not null").groupBy("second").agg(F.sum("ab").alias("ab")).join(types, "second")
    starts = starts.join(F.broadcast(n_breaks)).join(F.broadcast(totals))  # one row each
    ratio = _log_ratio(F.col("a"), F.col("b"), F.col("ab"), F.col("n"))
    more = F.col("n") * F.col("ab") > F.col("a") * F.col("b")
    starters = starts.where(more).select(F.col("second").alias("type"), F.round(ratio, 6).alias("score")).where(F.col("score") >= STARTER)

    both = pairs.where("abbreviated and period and second is not null").groupBy("first", "second").agg(F.sum("ab").alias("ab")).where("ab > 1")
    both = both.join(types, "second").join(counts.select(F.col("type").alias("first"), F.col("n").alias("a")), "first").join(F.broadcast(totals))
    collocations = both.where(more).select("first", "second", F.round(ratio, 6).alias("score")).where(F.col("score") >= COLLOCATION)
    return SentenceModel(short, stage(starters, "sentence-starters"), stage(collocations, "sentence-collocations"))


def learned_sentences(docs: DataFrame, model: SentenceModel, texts: DataFrame | None = None) -> DataFrame:
    """(mid, pos, sentence) of (mid, body): pieces of the plain rule, joined by a blank where the model sees no end.

    A period after an abbreviation ends a sentence only if a capitalised sentence starter follows that does not
    belong to it.  ``texts`` is the result of ``split_texts``, if there is one.  Only ends after abbreviations are
    joined with the model; a text then meets the list of its pieces that go on.
    """
    texts = split_texts(docs) if texts is None else texts
    ends = texts.select("mid", F.posexplode("ends").alias("pos", "e")).where("e.period").select("mid", "pos", "e.first", "e.second", "e.capital")
    ends = skew_join(ends, model.abbreviations.select(F.col("type").alias("first")), ["first"], spread=["mid", "pos"])
    ends = ends.join(model.starters.select(F.col("type").alias("second"), F.lit(True).alias("starts")), "second", "left")
    ends = ends.join(model.collocations.select("first", "second", F.lit(True).alias("belongs")), ["first", "second"], "left")
    inside = ends.where(F.col("belongs").isNotNull() | F.col("starts").isNull() | ~F.col("capital"))
    inside = inside.groupBy("mid").agg(F.collect_list(F.col("pos") + 1).alias("inside"))  # one text
    marked = texts.where(F.size("sentences") > 0).select("mid", "sentences").join(inside, "mid", "left")
    n = F.size("sentences")
    later = F.slice(F.sequence(F.lit(0), n - 1), F.lit(2), n)
    starts = F.concat(F.array(F.lit(0)), F.array_except(later, F.coalesce("inside", F.array().cast("array<int>"))))
    marked = marked.select("mid", "sentences", starts.alias("starts"), n.alias("n"))

    def joined(start: Column, k: Column) -> Column:
        following = F.coalesce(F.get("starts", k + 1), F.col("n"))
        return F.array_join(F.slice("sentences", start + 1, following - start), " ")

    return explode_computed(marked, ["mid"], F.transform("starts", joined), "sentence", pos="pos")
