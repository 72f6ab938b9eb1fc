"""Lemmas of words that a given table lacks, by suffix rules induced from the table.

Each entry votes for one rule per suffix that holds what the lemma changes: words that end like
this get that end.  Votes are summed per suffix; a suffix whose best rule has enough of them is
trusted.  An unseen word follows its longest trusted suffix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LONGEST = 6  # letters of a suffix
MIN_SUPPORT, MIN_SHARE = 3, 0.6  # entries that a rule needs, and its share of all entries with the suffix


def induce(lemmas: DataFrame, longest: int = LONGEST, min_support: int = MIN_SUPPORT, min_share: float = MIN_SHARE) -> DataFrame:
    """(suffix, replacement, n): trusted rules of (token, lemma).

    Entries whose lemma is the token itself vote for leaving it.  Of rules with equal votes the later one by name stays;
    null entries have no vote.
    """
    pairs = lemmas.where("token is not null and lemma is not null").select("token", "lemma").distinct()
    upto = F.sequence(F.lit(0), F.least(F.length("token"), F.length("lemma")))
    same = F.array_max(F.filter(upto, lambda i: F.left("token", i) == F.left("lemma", i)))
    size = F.length("token")
    rules = pairs.withColumn("_same", same).where(size - F.col("_same") <= longest)
    rules = rules.withColumn("_k", F.explode(F.sequence(size - F.col("_same"), F.least(size, F.lit(longest)))))
    votes = rules.groupBy(
        F.right("token", F.col("_k")).alias("suffix"), F.right("lemma", F.length("lemma") - F.length("token") + F.col("_k")).alias("replacement")
    ).agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("suffix").agg(F.max(F.struct("n", "replacement")).alias("best"), F.sum("n").alias("total"))
    trusted = (F.col("best.n") >= min_support) & (F.col("best.n") >= min_share * F.col("total"))
    return best.where(trusted).select("suffix", "best.replacement", "best.n")


def lemmas_of(words: DataFrame, lemmas: DataFrame, rules: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(term, lemma) of distinct words: by the table, else by the rule of the longest suffix, else the word itself."""
    words = words.select("term").distinct()
    table = lemmas.groupBy(F.col("token").alias("term")).agg(F.min("lemma").alias("_given"))
    known = words.join(table, "term", "left")
    unseen = known.where("_given is null").select("term")
    ends = unseen.withColumn("_k", F.explode(F.sequence(F.lit(0), F.least(F.length("term"), F.lit(longest)))))
    ends = ends.withColumn("suffix", F.right("term", F.col("_k"))).join(rules, "suffix")
    made = F.concat(F.left("term", F.length("term") - F.col("_k")), F.col("replacement"))
    ruled = ends.groupBy("term").agg(F.max_by(made, "_k").alias("_ruled"))
    return known.join(ruled, "term", "left").select("term", F.coalesce("_given", "_ruled", "term").alias("lemma"))
