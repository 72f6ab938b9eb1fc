"""Temporal features, negative samples, baselines and their scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from letterloom.operators import baselines as bl
from letterloom.operators import contacts as ct
from letterloom.operators import evaluate as ev
from letterloom.operators import sampling as sm
from letterloom.operators import temporal as tm
from letterloom.operators.reshape import relative_time
from letterloom.operators.skew import stage, stage_path
from letterloom.operators.split import chrono_split
from letterloom.plans import views as v
from letterloom.plans.registry import query, sql_view
from letterloom.sources import exports as ex

HORIZON = 20 * 86400  # seconds after the first message; the log goes on beyond it


def timed_events(spark, sf):
    """Event log with its time axis; staged, since every feature reads it several times."""
    return stage(relative_time(v.event_flat(spark, sf), "elapsed").drop("date"), "timed-log")


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


sql_view(
    "timed",
    """SELECT sender, recipient, mid, date_diff('second', (SELECT min(date) FROM event_flat), date) AS time
       FROM event_flat""",
)
for _name, _user, _contact in (("out", "sender", "recipient"), ("in", "recipient", "sender")):
    sql_view(
        f"x_{_name}_ratio",
        f"""SELECT p.{_user} AS user, p.{_contact} AS contact, n / total AS ratio
            FROM (SELECT {_user}, {_contact}, count(DISTINCT mid) AS n FROM timed WHERE time < {HORIZON} GROUP BY ALL) p
            JOIN (SELECT {_user}, CAST(count(DISTINCT mid) AS DOUBLE) AS total FROM timed WHERE time < {HORIZON} GROUP BY ALL) t
              USING ({_user})""",
    )
    sql_view(
        f"x_{_name}_since",
        f"""SELECT l.{_user} AS user, l.{_contact} AS contact, l.last_time,
              (SELECT count(DISTINCT mid) FROM timed t WHERE t.{_user} = l.{_user}
                 AND t.time >= l.last_time AND t.time < {HORIZON}) AS n
            FROM (SELECT {_user}, {_contact}, max(time) AS last_time FROM timed GROUP BY ALL) l""",
    )
    sql_view(
        f"x_{_name}_recent",
        f"""SELECT s.user, s.contact, n / (2.0 * total) AS ratio FROM x_{_name}_since s
            JOIN (SELECT {_user} AS user, CAST(count(DISTINCT mid) AS DOUBLE) AS total FROM timed GROUP BY ALL) t USING (user)""",
    )
sql_view(
    "x_all",
    """SELECT user, contact,
         CASE WHEN user IN (SELECT sender FROM timed) THEN coalesce(o, 0) ELSE 1 END AS OUT_ratio,
         CASE WHEN user IN (SELECT sender FROM timed) THEN coalesce(orec, 0) ELSE 1 END AS OUT_ratio_recent,
         CASE WHEN user IN (SELECT recipient FROM timed) THEN coalesce(i, 0) ELSE 1 END AS IN_ratio,
         CASE WHEN user IN (SELECT recipient FROM timed) THEN coalesce(irec, 0) ELSE 1 END AS IN_ratio_recent
       FROM (SELECT a.user, a.contact, a.ratio AS o, b.ratio AS orec FROM x_out_ratio a
             JOIN x_out_recent b ON a.user = b.user AND a.contact = b.contact)
       FULL JOIN (SELECT a.user, a.contact, a.ratio AS i, b.ratio AS irec FROM x_in_ratio a
             JOIN x_in_recent b ON a.user = b.user AND a.contact = b.contact) USING (user, contact)""",
)
_X_SQL = """SELECT user, contact, round(OUT_ratio, 6) AS OUT_ratio, round(OUT_ratio_recent, 6) AS OUT_ratio_recent,
         round(IN_ratio, 6) AS IN_ratio, round(IN_ratio_recent, 6) AS IN_ratio_recent FROM x_all"""


@query("out_ratio", "SELECT user, contact, round(ratio, 6) AS OUT_ratio FROM x_out_ratio")
def _(spark, sf):
    return _rounded(tm.out_ratio(timed_events(spark, sf), HORIZON))


@query("in_ratio", "SELECT user, contact, round(ratio, 6) AS IN_ratio FROM x_in_ratio")
def _(spark, sf):
    return _rounded(tm.in_ratio(timed_events(spark, sf), HORIZON))


@query(
    "count_since_last",
    """SELECT 'out' AS direction, user, contact, last_time, n FROM x_out_since
       UNION ALL SELECT 'in', user, contact, last_time, n FROM x_in_since""",
)
def _(spark, sf):
    flat = timed_events(spark, sf)
    sides = [
        tm.count_since_last(flat, HORIZON, d).select(F.lit(name).alias("direction"), "user", "contact", "last_time", "n")
        for name, d in (("out", tm.OUT), ("in", tm.IN))
    ]
    return sides[0].unionByName(sides[1])


@query("out_recent", "SELECT user, contact, round(ratio, 6) AS OUT_ratio_recent FROM x_out_recent")
def _(spark, sf):
    return _rounded(tm.out_recent(timed_events(spark, sf), HORIZON))


@query("in_recent", "SELECT user, contact, round(ratio, 6) AS IN_ratio_recent FROM x_in_recent")
def _(spark, sf):
    return _rounded(tm.in_recent(timed_events(spark, sf), HORIZON))


@query(
    "outer_out_in",
    """SELECT user, contact, round(o.ratio, 6) AS OUT_ratio, round(i.ratio, 6) AS IN_ratio
       FROM x_out_ratio o FULL JOIN x_in_ratio i USING (user, contact)""",
)
def _(spark, sf):
    return _rounded(tm.out_in(timed_events(spark, sf), HORIZON))


@query("time_features", _X_SQL)
def _(spark, sf):
    return _rounded(tm.time_features(timed_events(spark, sf), HORIZON))


@query("feature_roundtrip", _X_SQL)
def _(spark, sf):
    features = tm.time_features(timed_events(spark, sf), HORIZON)
    path = stage_path(spark, "time-features")
    ex.write_features(features, path)
    return _rounded(ex.read_features(spark, path, features.schema))


# --- negative samples ----------------------------------------------------------


def _hash(seed_tag: str, *parts: str) -> str:
    text = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5('{seed_tag}|' || {text}), 1, 15) AS BIGINT)"


sql_view(
    "ring",
    """SELECT sender, contact, size, row_number() OVER (PARTITION BY sender ORDER BY md5('42|' || sender || '|' || contact), contact) - 1 AS idx
       FROM (SELECT sender, contact, count(*) OVER (PARTITION BY sender) AS size
             FROM (SELECT DISTINCT sender, recipient AS contact FROM trade_flat))""",
)
sql_view(
    "neg_a",
    f"""SELECT sender, contact, mid FROM (
          SELECT w.sender, r.contact, w.mid, want, row_number() OVER (PARTITION BY w.mid ORDER BY d) AS place
          FROM (SELECT *, unnest(range(steps)) AS d FROM (
                  SELECT *, least(size, want + r) AS steps FROM (
                    SELECT m.sender, m.mid, r, size, CAST(ceil(CAST(0.3 AS DOUBLE) * r) AS BIGINT) AS want FROM
                      (SELECT sender, mid, count(DISTINCT recipient) AS r FROM trade_flat GROUP BY ALL) m
                      JOIN (SELECT DISTINCT sender, size FROM ring) s USING (sender)))) w
          JOIN ring r ON r.sender = w.sender AND r.idx = ({_hash('42start', 'mid')} % w.size + d * (1 + {_hash('42step', 'mid')} %
             greatest((w.size - 1) // greatest(steps - 1, 1), 1))) % w.size
          WHERE NOT EXISTS (SELECT 1 FROM trade_flat t WHERE t.mid = w.mid AND t.recipient = r.contact))
        WHERE place <= want""",
)


@query(
    "neg_pairs_contacts",
    """SELECT sender, recipient, mid, 1 AS label FROM trade_flat
       UNION ALL SELECT sender, contact, mid, 0 FROM neg_a""",
)
def _(spark, sf):
    flat = v.trade_flat(spark, sf)
    return sm.labelled_pairs(flat, sm.negative_contacts(flat, ct.contacts_sent(flat)))


sql_view(
    "hub_ring",
    """SELECT user AS sender, contact, row_number() OVER (PARTITION BY user ORDER BY md5('42|' || user || '|' || contact), contact) - 1 AS idx
       FROM event_neighbors""",
)
sql_view(
    "hub_message",
    """SELECT sender, mid, r AS want, least(r, (SELECT count(*) FROM event_neighbors n WHERE n.user = m.sender AND NOT EXISTS (
              SELECT 1 FROM event_flat e WHERE e.mid = m.mid AND e.recipient = n.contact))) AS near
       FROM (SELECT sender, mid, count(*) AS r FROM event_flat GROUP BY ALL) m""",
)
sql_view(
    "hub_near",
    f"""SELECT f.sender, f.contact, f.mid, d AS draw FROM (
          SELECT h.sender, h.mid, g.contact, count(*) OVER (PARTITION BY h.mid) AS free,
                 row_number() OVER (PARTITION BY h.mid ORDER BY g.idx) - 1 AS place
          FROM hub_message h JOIN hub_ring g USING (sender)
          WHERE NOT EXISTS (SELECT 1 FROM event_flat e WHERE e.mid = h.mid AND e.recipient = g.contact)) f
        JOIN (SELECT mid, unnest(range(near)) AS d FROM hub_message) w ON w.mid = f.mid
        WHERE place = {_hash('42near', 'f.mid', 'd')} % free""",
)
sql_view(
    "hub_far",
    f"""SELECT f.sender, f.contact, f.mid, d AS draw FROM (
          SELECT h.sender, h.mid, u.user AS contact, count(*) OVER (PARTITION BY h.mid) AS free,
                 row_number() OVER (PARTITION BY h.mid ORDER BY u.user) - 1 AS place
          FROM (SELECT * FROM hub_message WHERE near < want) h, event_ids u
          WHERE NOT EXISTS (SELECT 1 FROM event_flat e WHERE e.mid = h.mid AND e.recipient = u.user)
            AND NOT EXISTS (SELECT 1 FROM hub_near e WHERE e.mid = h.mid AND e.contact = u.user)) f
        JOIN (SELECT mid, unnest(range(near, want)) AS d FROM hub_message) w ON w.mid = f.mid
        WHERE place = {_hash('42far', 'f.mid', 'd')} % free""",
)


@query(
    "neg_pairs_graph",
    """SELECT sender, contact, mid, draw FROM hub_near UNION ALL SELECT sender, contact, mid, draw FROM hub_far""",
)
def _(spark, sf):
    flat = v.event_flat(spark, sf)
    return sm.negative_neighbors(flat, ct.neighbors(ct.edges(flat)), ct.all_users(flat))


@query(
    "neg_pairs_graph_labelled",
    """SELECT sender, recipient, mid, 1 AS label FROM event_flat
       UNION ALL SELECT sender, contact, mid, 0 FROM hub_near UNION ALL SELECT sender, contact, mid, 0 FROM hub_far""",
)
def _(spark, sf):
    flat = v.event_flat(spark, sf)
    return sm.labelled_pairs(flat, sm.negative_neighbors(flat, ct.neighbors(ct.edges(flat)), ct.all_users(flat)))


# --- baselines -------------------------------------------------------------------

sql_view("trade_dev_flat", "SELECT * FROM trade_flat WHERE mid IN (SELECT mid FROM trade_split WHERE part = 'dev')")
sql_view(
    "freq_top",
    """SELECT mid, rank, recipient AS contact FROM trade_split JOIN (
         SELECT sender, recipient, row_number() OVER (PARTITION BY sender ORDER BY n DESC, recipient) AS rank
         FROM (SELECT sender, recipient, count(*) AS n FROM trade_flat
               WHERE mid IN (SELECT mid FROM trade_split WHERE part = 'train') GROUP BY ALL)) USING (sender)
       WHERE part = 'dev' AND rank <= 10""",
)


def _ap_sql(predicted: str) -> str:
    """Average precision of distinct predictions against trade_dev_flat."""
    return f"""SELECT mid, coalesce(sum(hits / rank), 0) / least(any_value(n), 10) AS ap FROM (
        SELECT a.mid, a.n, p.rank, CAST(row_number() OVER (PARTITION BY a.mid ORDER BY p.rank) AS DOUBLE) AS hits
        FROM (SELECT mid, count(*) AS n FROM trade_dev_flat GROUP BY mid) a
        LEFT JOIN (SELECT DISTINCT p.mid, p.rank FROM {predicted} p JOIN trade_dev_flat t
                   ON t.mid = p.mid AND t.recipient = p.contact) p ON p.mid = a.mid) GROUP BY mid"""


sql_view("freq_ap", _ap_sql("freq_top"))


def trade_parts(spark, sf):
    """(train flat, dev messages, dev flat); the split is staged, as it is read often."""
    split = stage(chrono_split(v.trade_messages(spark, sf)).select("mid", "sender", "part"), "split")
    flat = v.trade_flat(spark, sf).join(split.select("mid", "part"), "mid")
    dev = split.where("part = 'dev'").select("mid", "sender")
    return flat.where("part = 'train'"), dev, flat.where("part = 'dev'")


@query("freq_baseline", "SELECT * FROM freq_top")
def _(spark, sf):
    train, dev, _ = trade_parts(spark, sf)
    return bl.frequency_baseline(train, dev)


@query("ap_at_k", "SELECT mid, round(ap, 6) AS ap FROM freq_ap")
def _(spark, sf):
    train, dev, truth = trade_parts(spark, sf)
    return _rounded(ev.average_precision(bl.frequency_baseline(train, dev), truth))


@query("map_at_k", "SELECT round(avg(ap), 6) AS map FROM freq_ap")
def _(spark, sf):
    train, dev, truth = trade_parts(spark, sf)
    return _rounded(ev.mean_average_precision(bl.frequency_baseline(train, dev), truth))


@query(
    "map_macro",
    """SELECT round(avg(m), 6) AS map FROM (
         SELECT avg(ap) AS m FROM freq_ap JOIN trade_split USING (mid) GROUP BY sender)""",
)
def _(spark, sf):
    train, dev, truth = trade_parts(spark, sf)
    return _rounded(ev.macro_map(bl.frequency_baseline(train, dev), truth, dev))


@query(
    "predictions_sink",
    "SELECT mid, string_agg(CAST(contact AS VARCHAR), ' ' ORDER BY rank) AS recipients FROM freq_top GROUP BY mid",
)
def _(spark, sf):
    train, dev, _ = trade_parts(spark, sf)
    path = stage_path(spark, "predictions")
    ex.write_predictions(bl.frequency_baseline(train, dev), path)
    return spark.read.schema("mid bigint, recipients string").option("header", True).csv(path)


sql_view(
    "trade_ring",
    """SELECT user, row_number() OVER (ORDER BY md5('42|' || user), user) - 1 AS idx
       FROM (SELECT sender AS user FROM trade_flat UNION SELECT recipient FROM trade_flat)""",
)


@query(
    "random_baseline",
    f"""SELECT p.mid, p.rank, u.user AS contact FROM (
          SELECT mid, d + 1 AS rank, (start % size + d * (1 + step % greatest((size - 1) // 9, 1))) % size AS idx
          FROM (SELECT mid, unnest(range(10)) AS d, {_hash('42start', 'mid')} AS start, {_hash('42step', 'mid')} AS step,
                       (SELECT count(*) FROM trade_ring) AS size FROM trade_messages)) p
        JOIN trade_ring u USING (idx)""",
)
def _(spark, sf):
    return bl.random_baseline(v.trade_messages(spark, sf), ct.all_users(v.trade_flat(spark, sf)))


# --- topic-weighted books ------------------------------------------------------

sql_view(
    "doc_topic_book",
    """SELECT sender, recipient, topic, sum(score) AS score FROM doc_mail JOIN topic_scores USING (mid) GROUP BY ALL""",
)


@query("topic_address_book", "SELECT sender, recipient, topic, round(score, 6) AS score FROM doc_topic_book")
def _(spark, sf):
    return _rounded(bl.topic_address_book(v.doc_mail(spark, sf), v.topic_scores(spark, sf)))


@query(
    "topic_book_ranked",
    """SELECT sender, recipient, topic, round(score, 6) AS score,
         row_number() OVER (PARTITION BY sender, topic ORDER BY round(score, 6) DESC, recipient) AS rank
       FROM doc_topic_book""",
)
def _(spark, sf):
    book = _rounded(bl.topic_address_book(v.doc_mail(spark, sf), v.topic_scores(spark, sf)))
    return bl.topic_book_ranked(book)


@query(
    "topic_rank",
    """SELECT mid, contact, round(score, 6) AS score, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY mid ORDER BY round(score, 9) DESC, contact) AS rank FROM (
           SELECT m.mid, b.recipient AS contact, sum(b.score * t.score) AS score
           FROM doc_mail m JOIN doc_topic_book b USING (sender) JOIN topic_scores t ON t.mid = m.mid AND t.topic = b.topic
           GROUP BY ALL)) WHERE rank <= 10""",
)
def _(spark, sf):
    docs, scores = v.doc_mail(spark, sf), v.topic_scores(spark, sf)
    return _rounded(bl.topic_rank(docs, scores, bl.topic_address_book(docs, scores)))
