"""The numbered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.llm import (
    automaton, boosting, bpe, chat, chosen_path, divergence, dual_tree, licenses, outliers, pii, radix_dedup, sharding, suffix_trees,
)
from letterloom.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.tokenize_report(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_report(turns.unionByName(extra))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.substring_report(table(spark, sf_dir, "documents"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup.byte_string_report(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.quality_rules_report(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.default_templates(spark))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.jaccard_report(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosting.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dual_tree.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP2_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
u AS (
  SELECT *, length(x) + length(x) - length(replace(x, chr(92), ''))
            + len(regexp_extract_all(x, '</?s>|\[/?ROLE\]|\[TURN\]|\[/?INST\]|<</?SYS>>|<unk>|<pad>')) AS n, kind
  FROM (SELECT conv_id, turn, role, text, unnest([role, text]) AS x, unnest(['role', 'text']) AS kind FROM t)),
v AS (
  SELECT conv_id, turn, role, text, max(n) FILTER (kind = 'role') AS n_role, max(n) FILTER (kind = 'text') AS n_text,
         coalesce(role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), false) AS joined
  FROM u GROUP BY conv_id, turn, role, text)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n_text + CASE WHEN joined THEN 6 ELSE n_role + 20 END) AS BIGINT) AS formatted_chars
FROM v GROUP BY conv_id"""

OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (
    SELECT doc_id, list_transform(range(1, len(w) - 18), lambda k: array_to_string(w[k:k + 19], ' ')) AS l
    FROM d WHERE len(w) >= 20)),
first AS (SELECT s, min({'d': doc_id, 'i': i}) AS f FROM win GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(20)) AS i FROM win JOIN first USING (s)
  WHERE doc_id > f.d OR (doc_id = f.d AND i > f.i)),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d)
SELECT d.doc_id, len(w) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS kept FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id) k USING (doc_id)"""

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
_GAP, _IN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
OP9_SQL = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, 13 AS n, s FROM (
    SELECT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS s
    FROM b WHERE len(w) >= 13)
  UNION SELECT DISTINCT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 12),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
seen AS (
  SELECT doc_id, n, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (
    SELECT doc_id, n, list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' ')) AS l
    FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, n, item_id FROM seen JOIN win USING (n, s)),
cover AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, i + unnest(range(n)) AS i FROM hit) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id),
piece AS (
  SELECT doc_id, len(w) AS n_words, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_GAP}*{_IN}+') AS p
  FROM (SELECT doc_id, text, {_WORDS} AS w FROM documents)),
run AS (
  SELECT doc_id, min(i) AS a, count(*) AS n FROM (
    SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS g
    FROM (SELECT DISTINCT doc_id, i + unnest(range(n)) AS i FROM hit)) GROUP BY doc_id, g),
gone AS (
  SELECT doc_id, list(a) AS starts, flatten(list(range(a, a + r.n))) AS places, CAST(sum(r.n) AS BIGINT) AS n_cut
  FROM run r JOIN cover USING (doc_id) JOIN piece USING (doc_id) WHERE r.n > 20 OR 20 * n_hit > n_words GROUP BY doc_id),
clean AS (
  SELECT doc_id, n_cut, CASE WHEN n_cut IS NULL THEN text ELSE array_to_string(list_transform(p, lambda x, i:
    CASE WHEN list_contains(starts, i) THEN regexp_extract(x, '^{_GAP}*') WHEN list_contains(places, i) THEN '' ELSE x END), '')
    || regexp_extract(text, '{_GAP}*$') END AS cut FROM piece LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  coalesce(n_cut, 0) AS n_cut, sha256(cut) AS cut_sha256
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN item USING (doc_id) JOIN clean USING (doc_id)"""

# The checksum by its table of 256 steps, which follows from the polynomial, over the bytes of each text.
OP11_SQL = r"""
WITH step AS (
  SELECT list(list_reduce(range(8), lambda acc, k: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END, n) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
d AS (
  SELECT doc_id, coalesce(source, '') AS source, strlen(coalesce(text, '')) + 16 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM documents),
fact AS (
  SELECT doc_id, source, size,
    xor(list_reduce(bytes, lambda acc, b: xor(acc >> 8, t[(xor(acc, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS crc
  FROM d, step),
nth AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5(concat_ws(':', '11', coalesce(CAST(doc_id AS VARCHAR), ''), size, crc)), doc_id) AS r,
    count(*) OVER (PARTITION BY source) AS n FROM fact),
place AS (
  SELECT *, row_number() OVER (ORDER BY CAST(2 * r - 1 AS DOUBLE) / CAST(2 * n AS DOUBLE), source, r) - 1 AS p, count(*) OVER () AS total FROM nth)
SELECT doc_id, size, crc AS text_crc32, 'rows' AS law, CAST(p * 40 // total AS INTEGER) AS shard,
  p - (p * 40 // total * total + 39) // 40 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM place"""

_LETTERS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)


def _chance(count: str, total: str) -> str:
    return f"CAST(1 + 1000000000::HUGEINT * ({count} + 2) // ({total} + 2 * v) AS HUGEINT)"


OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LETTERS} AS w FROM documents),
word AS (SELECT row_id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_tf FROM word GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
tf AS (SELECT lang, source, term, count(*) AS c FROM word SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
one AS (SELECT lang, count(*) AS v, sum(lang_tf) AS lang_n FROM kept GROUP BY lang),
grp AS (
  SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v, coalesce(lang_n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(c) AS n FROM tf GROUP BY lang, source) USING (lang, source)
  LEFT JOIN one USING (lang)),
p AS (
  SELECT lang, source, term, coalesce(c, 0) AS c, {_chance("coalesce(c, 0)", "n")} AS p, {_chance("lang_tf", "lang_n")} AS q
  FROM grp JOIN kept USING (lang) LEFT JOIN tf USING (lang, source, term)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
  ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
item AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM item)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10"""

OP13_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS w FROM documents),
docs AS (SELECT row_id, doc_id, len(w) AS n FROM d WHERE len(w) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM docs),
item AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
asked AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest({_WORDS}) AS term FROM item) GROUP BY ALL),
tf AS (
  SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(w) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term, n_docs),
norm AS (SELECT row_id, doc_id, 25 + 75 * n * n_docs // n_terms AS m FROM docs, whole),
score AS (
  SELECT i, item_id, row_id, doc_id, CAST(sum(times * w * (1000000000 * tf // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN norm USING (row_id) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

QUERIES: dict[str, QueryFn] = {
    f.__name__: f
    for f in (
        op1_bpe, op2_chat, op3_pii, op4_substrings, op5_suffix_array, op6_quality_rules, op7_licenses, op8_jaccard_join,
        op9_decontaminate, op10_quality, op11_shards, op12_divergence, op13_search,
    )
}
ORACLES: dict[str, str] = {
    "op2_chat": OP2_SQL, "op4_substrings": OP4_SQL, "op9_decontaminate": OP9_SQL, "op11_shards": OP11_SQL, "op12_divergence": OP12_SQL,
    "op13_search": OP13_SQL,
}
