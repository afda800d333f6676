"""Support and survey reports.

Binding: a conversation is a ticket / mail thread (turn order is time; user
turns are received, assistant turns are sent; system turns are not
correspondence); an order is a ticket created on its order day and closed on
its last ship day when fulfilled; event value / 10 (floored) is a 0-10 survey
score; document labels are satisfaction ratings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.aggregates import quantile
from ..operators import support as sp
from ..operators.sketches import rank_bounds
from .common import finalize, load, sql_date

BACKLOG_AS_OF = "2002-01-01"


def _messages(spark, d):
    c = load(spark, d, "conversations").where(F.col("role").isin("user", "assistant"))
    return c.withColumn("direction", F.when(F.col("role") == "user", "received").otherwise("sent"))


def reply_waits(spark, d):
    w = sp.reply_waits(_messages(spark, d), "conv_id", "turn", "direction", bucket=F.floor(F.col("turn") / 64))
    return w.withColumn("wait_turns", F.col("replied_at") - F.col("waiting_since"))


def conversation_lifecycle(spark, d):
    m = _messages(spark, d)
    t = m.groupBy("conv_id").agg(F.min("turn").alias("created_turn"))
    return sp.ticket_lifecycle(t, m, "conv_id", "created_turn", "turn", F.col("role") == "assistant")


def _order_tickets(spark, d):
    o = load(spark, d, "orders")
    shipped = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("last_ship"))
    return o.join(shipped, "o_orderkey", "left").withColumn(
        "closed_at", F.when(F.col("o_orderstatus") == "F", F.col("last_ship")))


def order_backlog(spark, d):
    t = _order_tickets(spark, d)
    return finalize(sp.volume_backlog(t, "o_orderdate", "closed_at", ["o_orderpriority"], BACKLOG_AS_OF))


def shipping_response_stats(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    j = li.join(o, "l_orderkey").select(
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"), "o_orderpriority",
        F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).cast("double").alias("days_to_ship"))
    return finalize(sp.response_stats(j, ["o_orderpriority"], "month", "days_to_ship", sla=60, exact=True))


def document_csat(spark, d):
    lab = load(spark, d, "labels")
    docs = load(spark, d, "documents").select("doc_id", "source", "lang")
    return sp.csat(lab.join(docs, "doc_id"), ["source", "lang"], F.col("quality") == 1)


def _scores(spark, d):
    e = load(spark, d, "events")
    return e.select(F.to_date(F.date_trunc("month", "ts")).alias("month"), "event_type",
                    F.floor(F.col("value") / 10).cast("double").alias("score"))


def event_nps(spark, d):
    return finalize(sp.nps(_scores(spark, d), "score", ["month", "event_type"]))


def event_scale_scores(spark, d):
    return sp.scale_scores(_scores(spark, d), "score", ["event_type"], scale_max=10)


def source_topic_share(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "source", "lang")
    return sp.topic_share(docs, "doc_id", "source", ["lang"])


def delivery_times(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority")
    return li.join(o, "l_orderkey").select(
        "o_orderpriority", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days_to_ship"))


def delivery_quantiles(j):
    """A6 on the scalable path: mergeable approximate percentiles."""
    return j.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("lines"),
        quantile("days_to_ship", 0.5).alias("p50_days"), quantile("days_to_ship", 0.9).alias("p90_days"))


def delivery_time_quantiles(spark, d):
    """The approximate percentiles' exact ranks are counted and must lie within a thousandth of the asked ones."""
    j = delivery_times(spark, d)
    ps = {"p50_days": 0.5, "p90_days": 0.9}
    checked = rank_bounds(j, delivery_quantiles(j), ["o_orderpriority"], "days_to_ship", ps, 0.001)
    return checked.select("o_orderpriority", "lines", "p50_days_in_bound", "p90_days_in_bound")


QUERIES = {
    "delivery_time_quantiles": delivery_time_quantiles,
    "reply_waits": reply_waits,
    "conversation_lifecycle": conversation_lifecycle,
    "order_backlog": order_backlog,
    "shipping_response_stats": shipping_response_stats,
    "document_csat": document_csat,
    "event_nps": event_nps,
    "event_scale_scores": event_scale_scores,
    "source_topic_share": source_topic_share,
}

_MSG = """
WITH m AS (SELECT *, CASE WHEN role = 'user' THEN 'received' ELSE 'sent' END AS direction FROM conversations
           WHERE role IN ('user', 'assistant'))
"""

_TICKETS = """
WITH s AS (SELECT l_orderkey, MAX(l_shipdate) AS last_ship FROM lineitem GROUP BY 1),
t AS (SELECT o.*, CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS closed_at
      FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey)
"""

ORACLE = {
    # any value whose exact rank lies in the bound is right: the check itself is the expected value
    "delivery_time_quantiles": """
SELECT o_orderpriority, COUNT(*) AS lines, true AS p50_days_in_bound, true AS p90_days_in_bound
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY o_orderpriority
""",
    "reply_waits": _MSG + """
, w AS (SELECT conv_id, turn, direction, LAG(direction) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_dir,
               MIN(CASE WHEN direction = 'sent' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS reply FROM m)
SELECT conv_id, turn AS waiting_since, reply AS replied_at, reply IS NOT NULL AS is_answered, reply - turn AS wait_turns
FROM w WHERE direction = 'received' AND (prev_dir IS NULL OR prev_dir = 'sent')
""",
    "conversation_lifecycle": _MSG + """
SELECT conv_id, MIN(turn) AS created_turn, MIN(CASE WHEN role = 'assistant' THEN turn END) AS first_reply_at,
       COUNT(*) FILTER (WHERE role = 'assistant') AS reply_count, COUNT(*) AS message_count, MAX(turn) AS last_message_at,
       MIN(CASE WHEN role = 'assistant' THEN turn END) IS NOT NULL AS is_answered
FROM m GROUP BY conv_id
""",
    "order_backlog": _TICKETS + f"""
, ev AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, 'created' AS m FROM t WHERE o_orderdate IS NOT NULL
         UNION ALL SELECT o_orderpriority, CAST(closed_at AS DATE), 'closed' FROM t WHERE closed_at IS NOT NULL),
daily AS (SELECT o_orderpriority, date, COUNT(*) FILTER (WHERE m = 'created') AS created,
                 COUNT(*) FILTER (WHERE m = 'closed') AS closed FROM ev GROUP BY 1, 2),
span AS (SELECT o_orderpriority, MIN(CASE WHEN created > 0 THEN date END) AS s, MAX(date) AS e FROM daily GROUP BY 1),
grid AS (SELECT o_orderpriority, CAST(unnest(generate_series(s, GREATEST(e, DATE '{BACKLOG_AS_OF}'), INTERVAL 1 DAY)) AS DATE)
           AS date FROM span WHERE s IS NOT NULL),
g AS (SELECT grid.o_orderpriority, grid.date, COALESCE(daily.created, 0) AS created, COALESCE(daily.closed, 0) AS closed
      FROM grid LEFT JOIN daily USING (o_orderpriority, date))
SELECT o_orderpriority, {sql_date('date')} AS date, created, closed,
       CAST(SUM(created - closed) OVER (PARTITION BY o_orderpriority ORDER BY date
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS open_backlog
FROM g
""",
    "shipping_response_stats": f"""
WITH j AS (SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month, o.o_orderpriority,
                  CAST(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS DOUBLE) AS d
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
g AS (SELECT month, o_orderpriority, COUNT(*) AS responses, ROUND(AVG(d), 4) AS mean_value,
             ROUND(quantile_cont(d, 0.5), 4) AS median_value, ROUND(quantile_cont(d, 0.9), 4) AS p90_value,
             COUNT(*) FILTER (WHERE d <= 60) AS within_sla FROM j WHERE d IS NOT NULL GROUP BY 1, 2)
SELECT {sql_date('month')} AS month, o_orderpriority, responses, mean_value, median_value, p90_value, within_sla,
       ROUND(within_sla::DOUBLE / NULLIF(responses, 0), 6) AS sla_attainment FROM g
""",
    "document_csat": """
SELECT d.source, d.lang, COUNT(*) AS ratings, COUNT(*) FILTER (WHERE l.quality = 1) AS satisfied,
       ROUND(COUNT(*) FILTER (WHERE l.quality = 1)::DOUBLE / NULLIF(COUNT(*), 0), 6) AS csat
FROM labels l JOIN documents d ON d.doc_id = l.doc_id GROUP BY 1, 2
""",
    "event_nps": f"""
WITH s AS (SELECT CAST(date_trunc('month', ts) AS DATE) AS month, event_type, CAST(FLOOR(value / 10) AS DOUBLE) AS score
           FROM events),
v AS (SELECT *, score IS NOT NULL AND score >= 0 AND score <= 10 AND score = FLOOR(score) AS valid FROM s),
g AS (SELECT month, event_type, COUNT(*) FILTER (WHERE valid AND score >= 9) AS promoters,
             COUNT(*) FILTER (WHERE valid AND score >= 7 AND score < 9) AS passives,
             COUNT(*) FILTER (WHERE valid AND score <= 6) AS detractors, COUNT(*) FILTER (WHERE valid) AS valid_responses,
             COUNT(*) FILTER (WHERE NOT valid OR score IS NULL) AS invalid_responses FROM v GROUP BY 1, 2)
SELECT {sql_date('month')} AS month, event_type, promoters, passives, detractors, valid_responses, invalid_responses,
       ROUND(100.0 * (promoters - detractors) / NULLIF(valid_responses, 0), 4) AS nps FROM g
""",
    "event_scale_scores": """
WITH s AS (SELECT event_type, CAST(FLOOR(value / 10) AS DOUBLE) AS score FROM events),
g AS (SELECT event_type, COUNT(*) FILTER (score <= 10) AS answers, ROUND(AVG(score) FILTER (score <= 10), 4) AS avg_score,
             COUNT(*) FILTER (score BETWEEN 9 AND 10) AS top_two_box, COUNT(*) FILTER (score > 10) AS off_scale
      FROM s WHERE score IS NOT NULL GROUP BY 1)
SELECT *, ROUND(top_two_box::DOUBLE / NULLIF(answers, 0), 6) AS top_two_box_share FROM g
""",
    "source_topic_share": """
WITH t AS (SELECT lang, COUNT(DISTINCT doc_id) AS commenting_records FROM documents GROUP BY 1),
g AS (SELECT lang, source, COUNT(DISTINCT doc_id) AS records FROM documents GROUP BY 1, 2)
SELECT g.lang, g.source, g.records, t.commenting_records,
       ROUND(g.records::DOUBLE / NULLIF(t.commenting_records, 0), 6) AS topic_share
FROM g LEFT JOIN t ON t.lang = g.lang
""",
}
