"""Message-log views over the driver tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letterloom.functions import text as tx
from letterloom.plans.registry import sql_view

IDS_PER_INDEX_ROW = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents on all cores, also where they are fewer files than cores.

    A file of one row group is one task, whatever its size, so a few files are dealt out after the
    scan; a table of many files stays as it is.
    """
    d = table(spark, sf_dir, "documents")
    cores = spark.sparkContext.defaultParallelism
    return d.repartition(cores, "doc_id") if len(d.inputFiles()) < cores else d


def trade_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers write to suppliers; one row per message and recipient."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("mid"), F.col("o_custkey").alias("sender"), F.col("o_orderdate").alias("date")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("mid"), F.col("l_suppkey").alias("recipient")
    )
    return orders.join(lines, "mid").select("sender", "recipient", "mid", "date")


sql_view(
    "trade_flat",
    """SELECT o_custkey AS sender, l_suppkey AS recipient, o_orderkey AS mid, o_orderdate AS date
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
)


def trade_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the trade log that have at least one recipient, without recipients."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("sender"), F.col("o_orderkey").alias("mid"), F.col("o_orderdate").alias("date")
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("mid"))
    return orders.join(lines, "mid", "left_semi").select("sender", "mid", "date")


sql_view(
    "trade_messages",
    """SELECT o_custkey AS sender, o_orderkey AS mid, o_orderdate AS date
       FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)""",
)


def trade_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw message info: mid, date string with a broken year, body, recipient string.

    Every third order is written by two addresses with stray pieces in between.
    """
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    broken = F.when(year == 1995, F.lit("0001")).when(year == 1997, F.lit("0002")).otherwise(year.cast("string"))
    key = F.col("o_orderkey")
    host = F.concat(F.lit("c"), (key % 50).cast("string"), F.lit("@corp.example"))
    other = F.concat(F.lit("d"), (key % 7).cast("string"), F.lit("@corp.example"))
    return o.select(
        key.alias("mid"),
        F.concat(broken, F.date_format("o_orderdate", "-MM-dd HH:mm:ss")).alias("date"),
        F.col("o_orderpriority").alias("body"),
        F.when(key % 3 == 0, F.concat(F.lit("team "), host, F.lit(" dept x "), other, F.lit(" tail")))
        .when(key % 3 == 1, F.concat(host, F.lit(" "), other))
        .otherwise(host)
        .alias("recipients"),
    )


sql_view(
    "trade_raw",
    """SELECT o_orderkey AS mid,
         CASE year(o_orderdate) WHEN 1995 THEN '0001' WHEN 1997 THEN '0002'
              ELSE CAST(year(o_orderdate) AS VARCHAR) END || strftime(o_orderdate, '-%m-%d %H:%M:%S') AS date,
         o_orderpriority AS body,
         CASE o_orderkey % 3
           WHEN 0 THEN 'team c' || (o_orderkey % 50) || '@corp.example dept x d' || (o_orderkey % 7) || '@corp.example tail'
           WHEN 1 THEN 'c' || (o_orderkey % 50) || '@corp.example d' || (o_orderkey % 7) || '@corp.example'
           ELSE 'c' || (o_orderkey % 50) || '@corp.example' END AS recipients
       FROM orders""",
)


def trade_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message index: sender and a string of ids, at most 4096 ids to a row.

    A heavy sender takes several rows, so no row grows with the data.
    """
    o = table(spark, sf_dir, "orders")
    return (
        o.groupBy(F.col("o_custkey").alias("sender"), F.floor(F.col("o_orderkey") / IDS_PER_INDEX_ROW).alias("_chunk"))
        .agg(F.sort_array(F.collect_list("o_orderkey")).alias("ids"))
        .select("sender", F.array_join(F.col("ids").cast("array<string>"), " ").alias("mids"))
    )


sql_view(
    "trade_index",
    f"""SELECT o_custkey AS sender, string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS mids
        FROM orders GROUP BY o_custkey, o_orderkey // {IDS_PER_INDEX_ROW}""",
)


def event_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users write to users: the same id space on both sides."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("sender"),
        F.get_json_object("props", "$.k").cast("bigint").alias("recipient"),
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("mid"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("date"),
    )


sql_view(
    "event_flat",
    """SELECT user_id AS sender, CAST(json_extract_string(props, '$.k') AS BIGINT) AS recipient,
         user_id * 100 + day(ts) AS mid, CAST(date_trunc('day', ts) AS TIMESTAMP) AS date
       FROM events""",
)


def doc_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text log: 20 senders, 4 recipients, one recipient per message."""
    d = documents(spark, sf_dir)
    return d.select(
        F.col("source").alias("sender"), F.col("lang").alias("recipient"), F.col("doc_id").alias("mid"),
        F.col("text").alias("body"),
    )


sql_view(
    "doc_mail",
    "SELECT source AS sender, lang AS recipient, doc_id AS mid, text AS body FROM documents",
)


def greet_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text log with two address-like recipients per message.

    The first recipient is named after the first word of the message itself, the
    second after that of the next message, or ``last`` where no message follows.
    """
    d = documents(spark, sf_dir)
    word = F.lower(F.regexp_extract("text", "([A-Za-z]+)", 1))
    address = F.concat(word, F.lit("."), F.col("lang"), F.lit("@corp.example"))
    own = d.select("doc_id", "source", "lang", "text", address.alias("to1"))
    following = d.select((F.col("doc_id") - 1).alias("doc_id"), address.alias("to2"))
    joined = own.join(following, "doc_id", "left")
    joined = joined.withColumn("to2", F.coalesce("to2", F.concat(F.lit("last."), F.col("lang"), F.lit("@corp.example"))))
    return joined.select(
        F.col("source").alias("sender"),
        F.col("doc_id").alias("mid"),
        F.timestamp_add("MINUTE", F.col("doc_id").cast("int"), F.lit("2001-01-01").cast("timestamp_ntz")).alias("date"),
        F.col("text").alias("body"),
        F.array("to1", "to2").alias("recipients"),
    )


sql_view(
    "greet_mail",
    """SELECT a.source AS sender, a.doc_id AS mid,
         TIMESTAMP '2001-01-01' + to_minutes(a.doc_id) AS date, a.text AS body,
         [lower(regexp_extract(a.text, '([A-Za-z]+)', 1)) || '.' || a.lang || '@corp.example',
          coalesce(lower(regexp_extract(b.text, '([A-Za-z]+)', 1)) || '.' || b.lang || '@corp.example',
                   'last.' || a.lang || '@corp.example')] AS recipients
       FROM documents a LEFT JOIN documents b ON b.doc_id = a.doc_id + 1""",
)
sql_view(
    "greet_flat",
    """SELECT sender, mid, date, body, unnest(recipients) AS recipient,
              generate_subscripts(recipients, 1) - 1 AS pos
       FROM greet_mail""",
)


def topic_scores(spark: SparkSession, sf_dir: str, n_topics: int = 4) -> DataFrame:
    """Long topic scores for every document."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("mid"), F.explode(F.sequence(F.lit(0), F.lit(n_topics - 1))).alias("topic")
    ).withColumn("score", (1 + (F.col("mid") * 7 + F.col("topic") * 3) % 10).cast("double") / 40)


sql_view(
    "topic_scores",
    """SELECT doc_id AS mid, topic, CAST(1 + (doc_id * 7 + topic * 3) % 10 AS DOUBLE) / 40 AS score
       FROM documents, (VALUES (0), (1), (2), (3)) t(topic)""",
)


def word_list(words) -> str:
    return ", ".join("'" + w + "'" for w in words)


# Tokens in SQL: the same rules without look-around, for the comparison engine.
_EDGE = r"""[.,;:!?"''()\[\]{}<>]"""
_INFIX_SQL = "txt"
for _p in (
    (r"(\.\.\.)", r" \1 "),
    (r"([a-z0-9])\.([a-zA-Z0-9\[\]_\-*])", r"\1 . \2"),
    (r"([a-zA-Z0-9])--([a-zA-Z0-9\[\\\]^_`])", r"\1 -- \2"),
    (r"([a-zA-Z0-9])([-?!])([a-zA-Z0-9])", r"\1 \2 \3"),
    (r"([A-Za-z0-9]),([A-Za-z\[])", r"\1 , \2"),
):
    for _ in range(2):  # twice, since consuming groups miss every other neighbour
        _INFIX_SQL = f"regexp_replace({_INFIX_SQL}, '{_p[0]}', '{_p[1]}', 'g')"

CLEAN_SQL = (
    "replace(regexp_replace({0}, '----[- \\t\\n\\r\\f\\x0B]*(Original|Forwarded)[^\\n]*Subject:',"
    " '\n\\1\n', 'g'), '>', ' ')"
)
BOUNDARY_SQL = "regexp_replace(regexp_replace({0}, '([a-z])([A-Z])', '\\1 \\2', 'g'), '([0-9])([a-zA-Z])', '\\1 \\2', 'g')"


def _token_views(prefix: str, source: str) -> None:
    """SQL views from text to words for ``source`` (mid, body)."""
    sql_view(f"{prefix}_clean", f"SELECT mid, {CLEAN_SQL.format('strip_accents(body)')} AS txt FROM {source}")
    sql_view(
        f"{prefix}_sentence",
        rf"""SELECT mid, unnest(l) AS txt, generate_subscripts(l, 1) - 1 AS si FROM (
             SELECT mid, list_filter(string_split(regexp_replace(txt, '([.!?])[ \t\r\n\f]+', '\1' || chr(1), 'g'), chr(1)),
                                     lambda s: regexp_matches(s, '[^ \t\r\n\f]')) AS l
             FROM {prefix}_clean)""",
    )
    sql_view(
        f"{prefix}_piece",
        rf"""SELECT mid, si, orth, ti FROM (
              SELECT mid, si, unnest(l) AS orth, generate_subscripts(l, 1) AS ti FROM (
                SELECT mid, si, list_transform(string_split_regex({_INFIX_SQL}, '[ \t\r\n\f]+'),
                         lambda w: regexp_replace(w, '^{_EDGE}+|{_EDGE}+$', '', 'g')) AS l
                FROM (SELECT mid, si, {BOUNDARY_SQL.format('txt')} AS txt FROM {prefix}_sentence)))
            WHERE orth <> ''""",
    )
    sql_view(
        f"{prefix}_kept",
        rf"""SELECT mid, si, ti, orth, low FROM (SELECT *, lower(orth) AS low FROM {prefix}_piece)
            WHERE NOT regexp_matches(orth, '_|--|[*/:=(\])#|@+]') AND NOT regexp_matches(orth, '^[[:punct:]]+$')
              AND NOT regexp_matches(low, '^[0-9]+([.,/][0-9]+)*$')
              AND NOT regexp_matches(low, '^(https?:|www\.)|\.(com|org|net|edu|gov)(/|$)')
              AND low NOT IN ({word_list((*tx.STOP_WORDS, *tx.NUMBER_WORDS))})""",
    )
    sql_view(
        f"{prefix}_word",
        f"""SELECT * FROM (SELECT mid, si, ti, low, regexp_replace(low, '[[:punct:]0-9]', '', 'g') AS term FROM {prefix}_kept)
           WHERE length(term) > 1""",
    )


_token_views("doc", "doc_mail")
sql_view("doc_term", "SELECT mid, term, count(*) AS cnt FROM doc_word GROUP BY mid, term")


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_mail with its bag of words, in text order."""
    return doc_mail(spark, sf_dir).select("sender", "recipient", "mid", tx.bag_of_words(F.col("body")).alias("tokens"))


def reply_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_mail where two of three bodies quote themselves under a forward header."""
    d = doc_mail(spark, sf_dir)
    text = F.col("body")
    body = (
        F.when(F.col("mid") % 3 == 0, F.concat(text, F.lit("\n-----Original Message----- To bobSmith Subject: re\n> "), text))
        .when(F.col("mid") % 3 == 1, F.concat(text, F.lit("\n---- - Forwarded by a Subject: 12fw\n>"), text))
        .otherwise(text)
    )
    return d.withColumn("body", body)


sql_view(
    "reply_mail",
    """SELECT sender, recipient, mid, CASE mid % 3
         WHEN 0 THEN body || chr(10) || '-----Original Message----- To bobSmith Subject: re' || chr(10) || '> ' || body
         WHEN 1 THEN body || chr(10) || '---- - Forwarded by a Subject: 12fw' || chr(10) || '>' || body
         ELSE body END AS body FROM doc_mail""",
)


def stacked_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two text tables under each other: documents, and benchmark items with negative ids."""
    items = table(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("mid"), F.col("text").alias("body"))
    return doc_mail(spark, sf_dir).select("mid", "body").unionByName(items)


sql_view("stacked", "SELECT mid, body FROM doc_mail UNION ALL SELECT -1 - item_id, text FROM benchmark")
_token_views("stk", "stacked")


def talk_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text log whose senders also receive: the recipient is another source, by message id."""
    to = F.concat(F.lit("src"), (F.floor(F.col("mid") / 20) * 7 + 3) % 20)
    return doc_mail(spark, sf_dir).withColumn("recipient", to)


sql_view("talk_mail", "SELECT sender, 'src' || ((mid // 20 * 7 + 3) % 20) AS recipient, mid, body FROM doc_mail")
sql_view(
    "doc_split",
    """SELECT mid, CASE WHEN nd = 0 OR rn > n - nd THEN 'dev' ELSE 'train' END AS part FROM (
         SELECT *, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT) AS nd FROM (
           SELECT mid, count(*) OVER (PARTITION BY sender) AS n, row_number() OVER (PARTITION BY sender ORDER BY mid) AS rn
           FROM doc_mail))""",
)
