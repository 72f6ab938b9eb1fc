"""Vocabulary, bags of words and sparse text vectors in long form.

Documents are rows (mid, tokens).  Sparse vectors are rows (mid, term, weight), or packed as rows
(mid, terms, weights, norm) whose weights are still to be divided by the norm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from letterloom.functions import weights as wt
from letterloom.operators.reshape import explode_computed
from letterloom.operators.skew import rank_within, skew_join

PART_TOKENS = 2_000_000  # tokens of documents that meet their words' weights in one group
LEAST_TOKENS = 20_000  # smaller groups are not worth a task


def term_counts(docs: DataFrame) -> DataFrame:
    """(mid, term, cnt).  Documents move once, as arrays; counting is then local."""
    terms = explode_computed(docs.select("mid", "tokens").repartition("mid"), ["mid"], "tokens", "term")
    return terms.groupBy("mid", "term").agg(F.count(F.lit(1)).alias("cnt"))


def doc_freq(docs: DataFrame, min_df: int = 0) -> DataFrame:
    """(term, df): documents a term occurs in, kept where df > min_df."""
    terms = explode_computed(docs, [], F.array_distinct("tokens"), "term")
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > min_df)


def n_docs(docs: DataFrame) -> Column:
    return docs.agg(F.count(F.lit(1))).scalar()


def avg_doc_len(docs: DataFrame) -> DataFrame:
    """Average document length, rounded down."""
    return docs.agg(F.floor(F.sum(F.size("tokens")) / F.count(F.lit(1))).alias("avg_len"))


def vocabulary(docs: DataFrame, no_below: int, no_above: float = 0.2, keep_n: int = 100_000) -> DataFrame:
    """(term, term_id, df): terms in at least ``no_below`` documents and at most a
    share ``no_above`` of them; of these the ``keep_n`` most frequent.

    Ids follow the sorted terms.  At most ``keep_n`` rows leave the top-k, so
    numbering them in one window is bounded.
    """
    kept = (
        doc_freq(docs)
        .where((F.col("df") >= no_below) & (F.col("df") <= F.lit(float(no_above)) * n_docs(docs)))
        .orderBy(F.desc("df"), "term")
        .limit(keep_n)
    )
    return kept.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("term_id"), "df")


def doc2bow(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(mid, term_id, cnt); words outside the vocabulary are dropped.

    The vocabulary holds at most ``keep_n`` rows, so Spark may broadcast it.
    """
    return term_counts(docs).join(vocab.select("term", "term_id"), "term").select("mid", "term_id", "cnt")


def global_text_features(docs: DataFrame, no_below: int = 10, no_above: float = 0.2, keep_n: int = 100_000) -> DataFrame:
    """(term, term_id, df, idf, avg_len) with the base-10 idf."""
    vocab = vocabulary(docs, no_below, no_above, keep_n)
    length = avg_doc_len(docs).scalar()
    return vocab.withColumn("idf", wt.idf_log10(n_docs(docs), F.col("df"))).withColumn("avg_len", length)


def l2_normalize(vectors: DataFrame, key: str = "mid") -> DataFrame:
    """Rows scaled to unit length; a document has at most a vocabulary of terms."""
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return vectors.withColumn("weight", F.when(norm > 0, F.col("weight") / norm).otherwise(F.lit(0.0)))


def tfidf_model(docs: DataFrame, min_df: int = 5) -> DataFrame:
    """(term, idf): fitted smooth idf of terms in at least ``min_df`` documents."""
    kept = doc_freq(docs, min_df - 1)
    return kept.select("term", wt.idf_smoothed(n_docs(docs), F.col("df")).alias("idf"))


def log2_model(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """(term, idf) with idf = log2(N / df); terms of idf 0 carry no weight."""
    idf = wt.idf_log2(n_docs(docs), F.col("df"))
    return vocab.select("term", idf.alias("idf")).where("idf > 0")


def number_terms(model: DataFrame) -> DataFrame:
    """(term, idf, number): small numbers for frequent terms."""
    ranked = rank_within(model, [], ["idf", "term"], rank="number")
    return ranked.select("term", "idf", F.col("number").cast("int").alias("number"))


def tfidf_transform(docs: DataFrame, model: DataFrame, keep_n: bool = False, packed: bool = False) -> DataFrame:
    """(mid, term, weight): raw count times fitted idf, unit length per document.

    ``keep_n`` tells that the model is of a vocabulary of at most ``keep_n`` words: then it goes to the documents,
    and their words do not move.  Otherwise documents are dealt over parts of about ``PART_TOKENS`` tokens, and a part
    meets each of its words once; joined word by word, all counts would move there and back.  ``packed`` gives rows
    (mid, terms, weights, norm) then, and a model with ``number`` gives these in place of its terms.
    """
    if keep_n:
        joined = term_counts(docs).join(F.broadcast(model), "term")
        return l2_normalize(joined.select("mid", "term", (F.col("cnt") * F.col("idf")).alias("weight")))
    vectors = _packed_weights(docs, model)
    return vectors if packed else in_rows(vectors)


def in_rows(vectors: DataFrame) -> DataFrame:
    """Packed vectors as rows with ``term`` and ``weight``; other columns stay, and so do rows that are not packed."""
    if "terms" not in vectors.columns:
        return vectors
    rest = [c for c in vectors.columns if c not in ("terms", "weights")]
    rows = explode_computed(vectors, rest, F.arrays_zip("terms", "weights"), "_t")
    weight = F.when(F.col("norm") > 0, F.col("_t.weights") / F.col("norm")).otherwise(0.0)
    return rows.select(*[c for c in rest if c != "norm"], F.col("_t.terms").alias("term"), weight.alias("weight"))


def in_packs(vectors: DataFrame) -> DataFrame:
    """Rows (mid, term, weight) as packed vectors; packed ones stay."""
    if "terms" in vectors.columns:
        return vectors
    rows = vectors.groupBy("mid").agg(F.collect_list(F.struct("term", "weight")).alias("_t"))
    return rows.select("mid", F.col("_t.term").alias("terms"), F.col("_t.weight").alias("weights"), F.lit(1.0).alias("norm"))


def _power_of_two(n: int) -> int:
    return 1 << max(n - 1, 0).bit_length()


def by_id(docs: DataFrame) -> DataFrame:
    """Documents dealt by id; where they are staged so, a part of ``tfidf_transform`` is in few files, and their tasks know its words apart."""
    n = _power_of_two(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return docs.repartition(n, F.pmod(F.xxhash64("mid"), F.lit(n)))


def _packed_weights(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(mid, terms, weights, norm) of the documents with a term of the model."""
    tokens, cores = docs.agg(F.sum(F.size("tokens"))).first()[0] or 0, docs.sparkSession.sparkContext.defaultParallelism
    parts = _power_of_two(max(-(-tokens // PART_TOKENS), min(2 * cores, -(-tokens // LEAST_TOKENS))))
    part = F.pmod(F.xxhash64("mid"), F.lit(parts)).cast("int").alias("part")
    held = explode_computed(docs, [part], "tokens", "term").distinct().join(model.where("term is not null"), "term")
    sizes = F.transform("tokens", lambda t: F.octet_length(t))  # tokens move as one text, which is half of what a list of them takes
    dealt = docs.select(part, "mid", F.array_join("tokens", "").alias("text"), sizes.alias("sizes"))
    name = "number" if "number" in model.columns else "term"
    held = held.select(F.col("part").alias("of_part"), F.col("term").alias("word"), F.col(name).alias("name"), F.col("idf").cast("double").alias("idf"))
    lists = [StructField("terms", ArrayType(held.schema["name"].dataType)), StructField("weights", ArrayType(DoubleType()))]
    fields = StructType([dealt.schema["mid"], *lists, StructField("norm", DoubleType())])
    return dealt.groupBy("part").cogroup(held.groupBy("of_part")).applyInArrow(_weighted, fields)


def _tokens(docs: pa.Table) -> pa.Array:
    """The tokens of all documents, cut out of their texts; null where a size is."""
    text, sizes = docs["text"].combine_chunks(), pc.list_flatten(docs["sizes"]).combine_chunks()
    first = np.frombuffer(text.buffers()[1], np.int32)[text.offset] if len(text) else 0
    ends = np.append(0, np.cumsum(np.asarray(pc.fill_null(sizes, 0)), dtype=np.int64)) + first
    data = text.buffers()[2] if len(text) else None
    tokens = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends.astype(np.int32)), data or pa.py_buffer(b""))
    return pc.if_else(sizes.is_valid(), tokens, pa.scalar(None, pa.string()))


def _weighted(docs: pa.Table, words: pa.Table) -> pa.Table:
    """Packed weights of a part's documents; rows of one id are one document."""
    docs, words = docs.combine_chunks(), words.combine_chunks().sort_by("name")
    mids = docs["mid"].combine_chunks()
    doc = np.asarray(mids.dictionary_encode("encode").indices).astype(np.int64)
    first = np.unique(doc, return_index=True)[1]
    sizes = np.asarray(pc.fill_null(pc.list_value_length(docs["sizes"]), 0))
    word = np.asarray(pc.fill_null(pc.index_in(_tokens(docs), words["word"].combine_chunks()), -1)).astype(np.int64)
    key = (np.repeat(doc, sizes) * max(1, len(words)) + word)[word >= 0]
    key, times = np.unique(key, return_counts=True)
    doc, word = np.divmod(key, max(1, len(words)))
    weights = times * np.asarray(words["idf"])[word]
    starts = np.flatnonzero(np.append(True, np.diff(doc) != 0)[: len(doc)])
    norm = np.sqrt(np.add.reduceat(weights * weights, starts)) if len(starts) else np.zeros(0)
    ends = pa.array(np.append(starts, len(doc)).astype(np.int32))
    terms = words["name"].combine_chunks().take(pa.array(word))
    lists = [pa.ListArray.from_arrays(ends, x) for x in (terms, pa.array(weights.astype(float)))]
    return pa.table([mids.take(pa.array(first[doc[starts]])), *lists, pa.array(norm)], names=["mid", "terms", "weights", "norm"])


def lemmatize(counts: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(mid, lemma, cnt): counted tokens by the lemma of a given (token, lemma) table.

    Tokens without an entry stand for themselves, in lower case.
    """
    table = lemmas.select(F.col("token").alias("term"), "lemma")
    joined = skew_join(counts, table, ["term"], spread=["mid"], how="left")
    named = joined.select("mid", F.coalesce("lemma", F.lower("term")).alias("lemma"), "cnt")
    return named.groupBy("mid", "lemma").agg(F.sum("cnt").alias("cnt"))


def known_words(terms: DataFrame, names: DataFrame, how: str = "left_semi") -> DataFrame:
    """Term rows found in (``left_semi``) or missing from (``left_anti``) a name table."""
    return skew_join(terms, names.select(F.col("name").alias("term")).distinct(), ["term"], spread=["mid"], how=how)
