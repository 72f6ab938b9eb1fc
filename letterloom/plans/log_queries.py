"""Loading, reshaping and counting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterloom.functions import addresses as ad
from letterloom.operators import contacts as ct
from letterloom.operators import reshape as rs
from letterloom.operators.skew import stage, stage_path
from letterloom.operators.split import chrono_split
from letterloom.operators.store import StageStore
from letterloom.plans import views as v
from letterloom.plans.registry import query, sql_view
from letterloom.sources import logs

# --- CSV sources -----------------------------------------------------------


def _index_csv(spark, sf):
    path = stage_path(spark, "index")
    logs.write_csv(v.trade_index(spark, sf), path)
    return logs.read_index(spark, path)


def _info_csv(spark, sf):
    path = stage_path(spark, "info")
    logs.write_csv(v.trade_raw(spark, sf), path)
    return logs.read_info(spark, path)


@query("scan_index_csv", "SELECT * FROM trade_index")
def _(spark, sf):
    return _index_csv(spark, sf)


@query("scan_info_csv", "SELECT * FROM trade_raw")
def _(spark, sf):
    return _info_csv(spark, sf)


sql_view(
    "loaded_log",
    """SELECT sender, mid, strptime(fixed, '%Y-%m-%d %H:%M:%S') AS date, body, recipients FROM (
         SELECT o_custkey AS sender, mid, body, recipients, row_number() OVER (
             PARTITION BY o_custkey, body, fixed, recipients ORDER BY chunk, mid) AS rn, fixed
         FROM (SELECT *, replace(replace(date, '0001', '2001'), '0002', '2002') AS fixed, mid // 4096 AS chunk
               FROM trade_raw JOIN orders ON o_orderkey = mid))
       WHERE rn = 1""",
)
_GLUED = r"""list_transform(regexp_extract_all(recipients, '((?:[^\s@]+\s+)*\S*@\S*)', 1),
             lambda x: regexp_replace(x, '\s+', '', 'g'))"""


@query(
    "load_log_nested",
    f"""SELECT CAST(sender AS VARCHAR) AS sender, mid, date, body,
          array_to_string({_GLUED}, ' ') AS recipients FROM loaded_log""",
)
def _(spark, sf):
    log = logs.load_log(_index_csv(spark, sf), _info_csv(spark, sf))
    return log.withColumn("recipients", F.array_join("recipients", " "))


@query(
    "load_log_flat",
    f"""SELECT CAST(sender AS VARCHAR) AS sender, mid, date, body,
          unnest({_GLUED}) AS recipient FROM loaded_log""",
)
def _(spark, sf):
    return logs.load_log(_index_csv(spark, sf), _info_csv(spark, sf), flat=True)


@query(
    "load_log_test",
    """SELECT CAST(o_custkey AS VARCHAR) AS sender, mid, body,
         strptime(replace(replace(date, '0001', '2001'), '0002', '2002'), '%Y-%m-%d %H:%M:%S') AS date
       FROM trade_raw JOIN orders ON o_orderkey = mid""",
)
def _(spark, sf):
    path = stage_path(spark, "test-info")
    logs.write_csv(v.trade_raw(spark, sf).drop("recipients"), path)
    return logs.load_log(_index_csv(spark, sf), logs.read_info(spark, path, with_recipients=False), train=False)


@query(
    "dedupe_first",
    """SELECT sender, mid, body, date, recipients FROM (
         SELECT *, row_number() OVER (PARTITION BY sender, body, date, recipients ORDER BY mid) AS rn
         FROM (SELECT CAST(lang AS VARCHAR) AS sender, doc_id AS mid, text AS body, 'd' AS date, source AS recipients
               FROM documents)) WHERE rn = 1""",
)
def _(spark, sf):
    log = v.table(spark, sf, "documents").select(
        F.col("lang").alias("sender"), F.col("doc_id").alias("mid"), F.col("text").alias("body"),
        F.lit("d").alias("date"), F.col("source").alias("recipients"),
        F.lit(0).alias("row"), F.col("doc_id").alias("pos"),
    )
    return logs.dedupe_first(log).drop("row", "pos")


@query(
    "corpus_union",
    """SELECT doc_id AS mid, text AS body FROM documents
       UNION ALL SELECT o_orderkey, o_orderpriority FROM orders""",
)
def _(spark, sf):
    docs = v.doc_mail(spark, sf)
    return logs.stack_bodies(docs, v.trade_raw(spark, sf))


# --- reshaping ---------------------------------------------------------------


@query(
    "explode_list",
    """SELECT mid, sender, word FROM (
         SELECT doc_id AS mid, source AS sender, unnest(string_split(text, ' ')) AS word FROM documents)
       WHERE word <> ''""",
)
def _(spark, sf):
    d = v.doc_mail(spark, sf)
    # blanks become nulls, which the explode drops
    words = F.transform(F.split("body", " ", -1), lambda w: F.nullif(w, F.lit("")))
    return rs.explode_list(d.select("mid", "sender", words.alias("words")), "words", "word")


@query("split_ids", "SELECT o_custkey AS sender, o_orderkey AS mid FROM orders")
def _(spark, sf):
    return logs.split_index(v.trade_index(spark, sf)).select("sender", "mid")


@query("recipients_glue", f"SELECT mid, array_to_string({_GLUED}, '|') AS recipients FROM trade_raw")
def _(spark, sf):
    return v.trade_raw(spark, sf).select(
        "mid", F.array_join(ad.glue_recipients(F.col("recipients")), "|").alias("recipients")
    )


@query(
    "recipients_filter",
    """SELECT mid, array_to_string(list_filter(string_split(recipients, ' '), lambda x: contains(x, '@')), '|')
         AS recipients FROM trade_raw""",
)
def _(spark, sf):
    return v.trade_raw(spark, sf).select(
        "mid", F.array_join(ad.filter_recipients(F.col("recipients")), "|").alias("recipients")
    )


@query(
    "date_repair",
    """SELECT mid, strptime(replace(replace(date, '0001', '2001'), '0002', '2002'), '%Y-%m-%d %H:%M:%S') AS date
       FROM trade_raw""",
)
def _(spark, sf):
    return v.trade_raw(spark, sf).select("mid", F.to_timestamp_ntz(ad.repair_date(F.col("date"))).alias("date"))


sql_view(
    "event_seconds",
    "SELECT event_id, (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) // 1000000 AS elapsed FROM events",
)


@query("relative_time", "SELECT event_id, elapsed % 86400 AS seconds_of_day, elapsed FROM event_seconds")
def _(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", "ts")
    e = rs.relative_time(e, "seconds_of_day", date="ts", time="seconds_of_day")
    return rs.relative_time(e, "elapsed", date="ts", time="elapsed").drop("ts")


@query(
    "time_filter",
    """SELECT event_id, elapsed AS time, CASE WHEN elapsed < 864000 THEN 'before' ELSE 'between' END AS part
       FROM event_seconds WHERE elapsed < 1728000""",
)
def _(spark, sf):
    e = rs.relative_time(v.table(spark, sf, "events").select("event_id", "ts"), "elapsed", date="ts").drop("ts")
    before = rs.time_before(e, 864000).withColumn("part", F.lit("before"))
    return before.unionByName(rs.time_between(e, 864000, 1728000).withColumn("part", F.lit("between")))


@query(
    "messages_to_user",
    """SELECT DISTINCT mid, sender FROM greet_flat
       WHERE recipient = 'the.en@corp.example' OR recipient = 'de.es@corp.example'""",
)
def _(spark, sf):
    g = v.greet_mail(spark, sf)
    both = ct.messages_to_user(g, "the.en@corp.example").union(ct.messages_to_user(g, "de.es@corp.example"))
    return both.select("mid", "sender").distinct()


@query(
    "dense_ids",
    """SELECT id, row_number() OVER (ORDER BY id) - 1 AS dense_id FROM (
         SELECT DISTINCT recipient AS id FROM greet_flat UNION SELECT sender FROM greet_flat)""",
)
def _(spark, sf):
    flat = _greet_flat(spark, sf)
    users = ct.all_users(flat).withColumnRenamed("user", "id")
    return rs.dense_ids(users, "id", "dense_id")


def _greet_flat(spark, sf):
    return rs.explode_list(v.greet_mail(spark, sf), "recipients", "recipient")


@query(
    "shuffle_sample",
    "SELECT doc_id AS mid, source FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100",
)
def _(spark, sf):
    d = v.table(spark, sf, "documents").select(F.col("doc_id").alias("mid"), "source")
    return rs.shuffle_sample(d, "mid", 100)


@query(
    "topics_flatten",
    """SELECT mid, coalesce(max(score) FILTER (topic = 0), 0) AS topic_0,
         coalesce(max(score) FILTER (topic = 1), 0) AS topic_1, coalesce(max(score) FILTER (topic = 2), 0) AS topic_2,
         coalesce(max(score) FILTER (topic = 3), 0) AS topic_3
       FROM topic_scores WHERE score > 0.1 GROUP BY mid""",
)
def _(spark, sf):
    return rs.flatten_topics(v.topic_scores(spark, sf).where("score > 0.1"), 4)


# --- joins on keys -----------------------------------------------------------


@query("semi_mid", "SELECT * FROM trade_flat WHERE mid IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def _(spark, sf):
    kept = v.table(spark, sf, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("mid"))
    return ct.keep_messages(v.trade_flat(spark, sf), kept)


@query(
    "anti_users",
    """SELECT DISTINCT 'sender' AS never, recipient AS user FROM event_flat
         WHERE recipient NOT IN (SELECT sender FROM event_flat)
       UNION ALL SELECT DISTINCT 'recipient', sender FROM event_flat
         WHERE sender NOT IN (SELECT recipient FROM event_flat)""",
)
def _(spark, sf):
    flat = v.event_flat(spark, sf)
    parts = [ct.users_without(flat, role).select(F.lit(role).alias("never"), "user") for role in ("sender", "recipient")]
    return parts[0].union(parts[1])


@query(
    "candidates_contacts",
    """SELECT m.mid, m.sender, c.contact FROM trade_messages m
       JOIN (SELECT DISTINCT sender, recipient AS contact FROM trade_flat) c USING (sender)""",
)
def _(spark, sf):
    return ct.candidates(
        v.trade_messages(spark, sf).select("sender", "mid"), ct.contacts_sent(v.trade_flat(spark, sf))
    )


sql_view("event_edges", "SELECT sender AS src, recipient AS dst, count(*) AS weight FROM event_flat GROUP BY ALL")
sql_view(
    "event_neighbors",
    "SELECT src AS user, dst AS contact FROM event_edges UNION SELECT dst, src FROM event_edges",
)


@query(
    "candidates_graph",
    """SELECT m.mid, m.sender, n.contact FROM (SELECT DISTINCT sender, mid FROM event_flat) m
       JOIN event_neighbors n ON n.user = m.sender""",
)
def _(spark, sf):
    flat = v.event_flat(spark, sf)
    return ct.candidates(flat.select("sender", "mid").distinct(), ct.neighbors(ct.edges(flat)))


@query(
    "candidates_graph_dr",
    """SELECT m.mid, m.sender, n.dst AS contact FROM (SELECT DISTINCT sender, mid FROM event_flat) m
       JOIN event_edges n ON n.src = m.sender""",
)
def _(spark, sf):
    flat = v.event_flat(spark, sf)
    return ct.candidates(flat.select("sender", "mid").distinct(), ct.neighbors(ct.edges(flat), directed=True))


@query(
    "contacts_minus_recipients",
    """SELECT DISTINCT m.mid, c.recipient AS contact FROM trade_flat m JOIN trade_flat c USING (sender)
       WHERE NOT EXISTS (SELECT 1 FROM trade_flat r WHERE r.mid = m.mid AND r.recipient = c.recipient)""",
)
def _(spark, sf):
    flat = v.trade_flat(spark, sf)
    return ct.contacts_minus_recipients(v.trade_messages(spark, sf), ct.contacts_sent(flat), flat)


# --- counting ----------------------------------------------------------------


@query("pair_msgs", "SELECT sender, recipient, count(DISTINCT mid) AS n FROM trade_flat GROUP BY ALL")
def _(spark, sf):
    return ct.pair_messages(v.trade_flat(spark, sf))


@query(
    "user_msgs",
    """SELECT 'sender' AS role, sender AS user, count(DISTINCT mid) AS n FROM event_flat GROUP BY ALL
       UNION ALL SELECT 'recipient', recipient, count(DISTINCT mid) FROM event_flat GROUP BY ALL""",
)
def _(spark, sf):
    flat = v.event_flat(spark, sf)
    sent = ct.user_messages(flat).select(F.lit("sender").alias("role"), F.col("sender").alias("user"), "n")
    got = ct.user_messages(flat, "recipient").select(F.lit("recipient").alias("role"), F.col("recipient").alias("user"), "n")
    return sent.unionByName(got)


@query(
    "last_time",
    """SELECT sender, recipient, max(date_diff('second', (SELECT min(date) FROM event_flat), date)) AS last_time
       FROM event_flat GROUP BY ALL""",
)
def _(spark, sf):
    return ct.last_time(rs.relative_time(v.event_flat(spark, sf), "elapsed"))


sql_view(
    "trade_book",
    """SELECT sender, recipient, n, row_number() OVER (PARTITION BY sender ORDER BY n DESC, recipient) AS rank
       FROM (SELECT sender, recipient, count(*) AS n FROM trade_flat GROUP BY ALL)""",
)


@query("address_book", "SELECT * FROM trade_book")
def _(spark, sf):
    return ct.address_book(v.trade_flat(spark, sf))


@query("contacts_sent", "SELECT DISTINCT sender AS user, recipient AS contact FROM trade_flat")
def _(spark, sf):
    return ct.contacts_sent(v.trade_flat(spark, sf))


@query(
    "contacts_all",
    """SELECT sender AS user, recipient AS contact FROM event_flat
       UNION SELECT recipient, sender FROM event_flat""",
)
def _(spark, sf):
    return ct.contacts_all(v.event_flat(spark, sf))


@query(
    "mids_per_pair",
    """SELECT sender, recipient, mid, row_number() OVER (PARTITION BY sender, recipient ORDER BY mid) AS pos
       FROM trade_flat""",
)
def _(spark, sf):
    return ct.messages_in_order(v.trade_flat(spark, sf), ["sender", "recipient"])


@query(
    "edge_dates",
    """SELECT sender AS src, recipient AS dst, date, count(*) OVER (PARTITION BY sender, recipient) AS occ,
         row_number() OVER (PARTITION BY sender, recipient ORDER BY date, mid) AS seq FROM event_flat""",
)
def _(spark, sf):
    return ct.edge_dates(v.event_flat(spark, sf))


@query("all_users", "SELECT sender AS user FROM event_flat UNION SELECT recipient FROM event_flat")
def _(spark, sf):
    return ct.all_users(v.event_flat(spark, sf))


@query("edges_weighted", "SELECT * FROM event_edges")
def _(spark, sf):
    return ct.edges(v.event_flat(spark, sf))


@query("neighbors", "SELECT src AS user, dst AS contact FROM event_edges")
def _(spark, sf):
    return ct.neighbors(ct.edges(v.event_flat(spark, sf)), directed=True)


@query("neighbors_undirected", "SELECT * FROM event_neighbors")
def _(spark, sf):
    return ct.neighbors(ct.edges(v.event_flat(spark, sf)))


# --- split -------------------------------------------------------------------


def _split_sql(small: str) -> str:
    return f"""SELECT sender, mid, date, CASE WHEN rn > n - nd OR (nd = 0 AND '{small}' = 'dev') THEN 'dev' ELSE 'train' END AS part
      FROM (SELECT *, CAST(floor(n * CAST(0.2 AS DOUBLE)) AS BIGINT) AS nd FROM (
        SELECT *, count(*) OVER (PARTITION BY sender) AS n,
               row_number() OVER (PARTITION BY sender ORDER BY date, mid) AS rn FROM trade_messages))"""


sql_view("trade_split", _split_sql("dev"))


@query("chrono_split", "SELECT * FROM trade_split")
def _(spark, sf):
    return chrono_split(v.trade_messages(spark, sf))


@query("chrono_split_keep_small", _split_sql("train"))
def _(spark, sf):
    return chrono_split(v.trade_messages(spark, sf), small_groups="train")


# --- sinks and stages ----------------------------------------------------------


@query("stage_roundtrip", "SELECT sender, recipient, count(*) AS n FROM trade_flat GROUP BY ALL")
def _(spark, sf):
    return stage(ct.address_counts(v.trade_flat(spark, sf)), "address-counts")


@query("stage_reuse", "SELECT sender, recipient, count(*) AS n, 1 AS written FROM trade_flat GROUP BY ALL")
def _(spark, sf):
    """The second store finds what the first has written, and writes nothing."""
    root = stage_path(spark, "store")
    counts = ct.address_counts(v.trade_flat(spark, sf))
    first, second = StageStore(spark, root), StageStore(spark, root)
    first.get(counts, "address-counts", version=1)
    found = second.get(ct.address_counts(v.trade_flat(spark, sf)), "address-counts", version=1)
    return found.withColumn("written", F.lit(first.written + second.written))


sql_view(
    "event_ids",
    """SELECT user, row_number() OVER (ORDER BY user) - 1 AS id FROM (
         SELECT src AS user FROM event_edges UNION SELECT dst FROM event_edges)""",
)


@query(
    "edgelist_export",
    """SELECT s.id || ' ' || d.id || ' ' || weight AS line FROM event_edges
       JOIN event_ids s ON s.user = src JOIN event_ids d ON d.user = dst""",
)
def _(spark, sf):
    from letterloom.sources.exports import write_edge_list

    flat = v.event_flat(spark, sf)
    path = stage_path(spark, "edge-list")
    write_edge_list(ct.edges(flat), rs.dense_ids(ct.all_users(flat), "user"), path)
    return spark.read.text(path).withColumnRenamed("value", "line")
