"""Event-log reports bound to ``events`` (user_id, ts, event_type, event_id)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import rnd

from ..operators import events as ev
from .common import finalize, load, sql_date, sql_secs, sql_ts

FUNNEL_STEPS = ["signup", "view", "click", "purchase"]


def sessions(spark, d):
    e = load(spark, d, "events")
    return finalize(ev.sessionize(e, "user_id", "ts", event="event_type", tiebreak="event_id", gap_minutes=30))


def active_users_daily(spark, d):
    return finalize(ev.active_users(load(spark, d, "events"), "user_id", "ts"))


def event_counts_daily(spark, d):
    return finalize(ev.event_counts(load(spark, d, "events"), "ts", "event_type", "user_id"))


def funnel_daily(spark, d):
    steps = ev.step_counts_from_events(load(spark, d, "events"), "user_id", "ts", "event_type", FUNNEL_STEPS,
                                       funnel_id="signup_to_purchase")
    return finalize(ev.funnel_metrics(steps, "funnel_id", "date", "step_number", "users"))


def monthly_active_users(spark, d):
    e = load(spark, d, "events")
    signups = e.where(F.col("event_type") == "signup").select("user_id", F.col("ts").alias("created_at"))
    return finalize(ev.monthly_active(e, signups, "user_id", "ts", "created_at", as_of="2024-03-01"))


def cohort_funnel_daily(spark, d):
    o = load(spark, d, "orders")
    s = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("converted_at"), F.max("l_shipdate").alias("_last"))
    leads = o.join(s, "o_orderkey", "left").withColumn(
        "won_at", F.when(F.col("o_orderstatus") == "F", F.col("_last")))
    return finalize(ev.cohort_funnel(leads, "o_orderdate", "converted_at", "won_at", ["o_orderpriority"]))


def audience_growth_daily(spark, d):
    e = load(spark, d, "events")
    g = e.groupBy("event_type", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("follower_gain"))
    g = g.withColumn("current_follower_count", F.sum("follower_gain").over(Window.partitionBy("event_type")))
    return finalize(ev.audience_growth(g, "event_type", "date", gain="follower_gain", total="current_follower_count")
                    .withColumnRenamed("followers_total", "followers_estimated"))


def _campaign_events(spark, d):
    e = load(spark, d, "events")
    return e.select(F.to_date("ts").alias("date"), "event_type",
                    F.get_json_object("props", "$.k").try_cast("int").alias("campaign_id"))


def search_performance_daily(spark, d):
    e = _campaign_events(spark, d).select(
        "date", "campaign_id", F.lit(1).alias("impressions"),
        F.when(F.col("event_type") == "click", 1).otherwise(0).alias("clicks"),
        (F.coalesce(F.col("campaign_id"), F.lit(0)) / 10.0).alias("position"))
    out = ev.search_performance(e, ["date", "campaign_id"], "clicks", "impressions", "position", share_part=["date"])
    return finalize(out.withColumn("position_weighted_sum", rnd("position_weighted_sum", 4)))


def content_performance(spark, d):
    long = _campaign_events(spark, d).groupBy("campaign_id", "event_type").agg(F.count(F.lit(1)).alias("value"))
    mapping = {"view": "impressions", "click": "clicks", "purchase": "conversions", "signup": "signups"}
    rates = {"ctr": ("clicks", "impressions"), "conversion_rate": ("conversions", "clicks")}
    return ev.content_performance(long, "campaign_id", "event_type", "value", mapping, rates)


def weekly_purchasers(spark, d):
    from ..operators.joins import trailing_join
    e = load(spark, d, "events").where(F.col("event_type") == "purchase")
    ud = e.select("user_id", F.to_date("ts").alias("date")).distinct()
    days = ud.select("date").distinct()
    # Every purchase day is emitted onto the 7 days whose trailing window holds it
    win = trailing_join(ud, ["user_id"], "date", 7, out_col="window_date")
    counted = win.groupBy(F.col("window_date").alias("date")).agg(F.count_distinct("user_id").alias("purchasers_7d"))
    return finalize(days.join(counted, "date", "left"))


QUERIES = {
    "weekly_purchasers": weekly_purchasers,
    "cohort_funnel_daily": cohort_funnel_daily,
    "audience_growth_daily": audience_growth_daily,
    "search_performance_daily": search_performance_daily,
    "content_performance": content_performance,
    "sessions": sessions,
    "active_users_daily": active_users_daily,
    "event_counts_daily": event_counts_daily,
    "funnel_daily": funnel_daily,
    "monthly_active_users": monthly_active_users,
}

ORACLE = {
    "weekly_purchasers": f"""
WITH ud AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS date FROM events WHERE event_type = 'purchase'),
d AS (SELECT DISTINCT date FROM ud)
SELECT {sql_date('d.date')} AS date, COUNT(DISTINCT u.user_id) AS purchasers_7d
FROM d JOIN ud u ON u.date > d.date - INTERVAL 7 DAY AND u.date <= d.date GROUP BY d.date
""",
    "cohort_funnel_daily": f"""
WITH s AS (SELECT l_orderkey, MIN(l_shipdate) AS fs, MAX(l_shipdate) AS ls FROM lineitem GROUP BY 1),
t AS (SELECT o.o_orderpriority, o.o_orderdate, s.fs AS conv, CASE WHEN o.o_orderstatus = 'F' THEN s.ls END AS won
      FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey),
cohort AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS created, COUNT(conv) AS cohort_converted,
                  COUNT(won) AS cohort_won FROM t GROUP BY 1, 2),
ev AS (SELECT o_orderpriority, CAST(conv AS DATE) AS date, 'c' AS m FROM t WHERE conv IS NOT NULL
       UNION ALL SELECT o_orderpriority, CAST(won AS DATE), 'w' FROM t WHERE won IS NOT NULL),
act AS (SELECT o_orderpriority, date, COUNT(*) FILTER (WHERE m = 'c') AS converted_on_day,
               COUNT(*) FILTER (WHERE m = 'w') AS won_on_day FROM ev GROUP BY 1, 2),
facts AS (SELECT COALESCE(c.o_orderpriority, a.o_orderpriority) AS o_orderpriority, COALESCE(c.date, a.date) AS date,
                 c.created, c.cohort_converted, c.cohort_won, a.converted_on_day, a.won_on_day
          FROM cohort c FULL JOIN act a ON a.o_orderpriority = c.o_orderpriority AND a.date = c.date),
f AS (SELECT o_orderpriority, MIN(date) AS s FROM facts GROUP BY 1),
e AS (SELECT MAX(date) AS e FROM facts),
grid AS (SELECT f.o_orderpriority, CAST(unnest(generate_series(f.s, GREATEST(e.e, f.s), INTERVAL 1 DAY)) AS DATE) AS date
         FROM f CROSS JOIN e),
j AS (SELECT grid.o_orderpriority, grid.date, COALESCE(created, 0) AS created, COALESCE(cohort_converted, 0) AS cohort_converted,
             COALESCE(cohort_won, 0) AS cohort_won, COALESCE(converted_on_day, 0) AS converted_on_day,
             COALESCE(won_on_day, 0) AS won_on_day
      FROM grid LEFT JOIN facts ON facts.o_orderpriority = grid.o_orderpriority AND facts.date = grid.date)
SELECT o_orderpriority, {sql_date('date')} AS date, created, cohort_converted, cohort_won, converted_on_day, won_on_day,
       ROUND(cohort_converted::DOUBLE / NULLIF(created, 0), 6) AS cohort_conversion_rate FROM j
""",
    "audience_growth_daily": f"""
WITH g AS (SELECT event_type, CAST(ts AS DATE) AS date, COUNT(*) AS follower_gain FROM events GROUP BY 1, 2),
t AS (SELECT *, CAST(SUM(follower_gain) OVER (PARTITION BY event_type) AS BIGINT) AS current_follower_count FROM g)
SELECT event_type, {sql_date('date')} AS date, follower_gain, current_follower_count,
       CAST(current_follower_count - COALESCE(SUM(follower_gain) OVER (PARTITION BY event_type ORDER BY date
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS BIGINT) AS followers_estimated
FROM t
""",
    "search_performance_daily": f"""
WITH e AS (SELECT CAST(ts AS DATE) AS date, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS campaign_id,
                  event_type FROM events),
g AS (SELECT date, campaign_id, CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
             CAST(COUNT(*) AS BIGINT) AS impressions, SUM(COALESCE(campaign_id, 0) / 10.0) AS pws FROM e GROUP BY 1, 2)
SELECT {sql_date('date')} AS date, campaign_id, clicks, impressions, ROUND(pws, 4) AS position_weighted_sum,
       ROUND(clicks::DOUBLE / NULLIF(impressions, 0), 6) AS ctr, ROUND(pws / NULLIF(impressions, 0), 6) AS avg_position,
       ROUND(clicks::DOUBLE / NULLIF(SUM(clicks) OVER (PARTITION BY date), 0), 6) AS click_share
FROM g
""",
    "content_performance": """
WITH l AS (SELECT TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS campaign_id, event_type, COUNT(*) AS value
           FROM events GROUP BY 1, 2),
p AS (SELECT campaign_id, MAX(CASE WHEN event_type = 'view' THEN value END) AS impressions,
             MAX(CASE WHEN event_type = 'click' THEN value END) AS clicks,
             MAX(CASE WHEN event_type = 'purchase' THEN value END) AS conversions,
             MAX(CASE WHEN event_type = 'signup' THEN value END) AS signups FROM l GROUP BY 1)
SELECT *, ROUND(clicks::DOUBLE / NULLIF(impressions, 0), 6) AS ctr,
       ROUND(conversions::DOUBLE / NULLIF(clicks, 0), 6) AS conversion_rate FROM p
""",
    "sessions": f"""
WITH ordered AS (
  SELECT user_id, event_type, ts, event_id, CAST(ts AS DATE) AS d,
         LAG(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS prev_ts
  FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
flagged AS (
  SELECT *, CASE WHEN prev_ts IS NULL OR {sql_secs('prev_ts', 'ts')} > 1800 THEN 1 ELSE 0 END AS st FROM ordered),
numbered AS (
  SELECT *, SUM(st) OVER (PARTITION BY user_id, d ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq FROM flagged)
SELECT CAST(user_id AS VARCHAR) || ':' || CAST(d AS VARCHAR) || ':' || CAST(seq AS VARCHAR) AS session_id,
       user_id, {sql_date('d')} AS session_date, CAST(seq AS BIGINT) AS session_number_of_day,
       {sql_ts('MIN(ts)')} AS session_started_at, {sql_ts('MAX(ts)')} AS session_ended_at,
       {sql_secs('MIN(ts)', 'MAX(ts)')} AS duration_seconds,
       COUNT(*) AS events, COUNT(DISTINCT event_type) AS distinct_event_names,
       FIRST(event_type ORDER BY ts, event_id) AS first_event_name
FROM numbered GROUP BY user_id, d, seq
""",
    # every user-day is counted on itself and on the 27 days after it; the smallest age decides the window
    "active_users_daily": f"""
WITH active AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL GROUP BY ALL),
spread AS (SELECT user_id, day + CAST(age AS INTEGER) AS report_day, age FROM active, range(28) AS ages(age)),
recent AS (SELECT report_day, user_id, MIN(age) AS age FROM spread GROUP BY ALL),
debut AS (SELECT user_id, MIN(day) AS day FROM active GROUP BY user_id),
per_day AS (
  SELECT report_day, COUNT(*) FILTER (age = 0) AS dau, COUNT(*) FILTER (age < 7) AS wau, COUNT(*) AS mau,
         COUNT(*) FILTER (age = 0 AND debut.day = report_day) AS new_users
  FROM recent JOIN debut USING (user_id) GROUP BY report_day)
SELECT {sql_date('report_day')} AS date, dau, wau, mau, new_users, dau - new_users AS returning_users,
       dau / mau AS dau_mau_stickiness, report_day - (SELECT MIN(day) FROM active) >= 27 AS is_full_window
FROM per_day WHERE dau > 0
""",
    "event_counts_daily": f"""
SELECT {sql_date('CAST(ts AS DATE)')} AS date, event_type AS event_name, COUNT(*) AS events,
       COUNT(DISTINCT user_id) AS unique_users,
       ROUND(COUNT(*)::DOUBLE / NULLIF(COUNT(DISTINCT user_id), 0), 6) AS events_per_user
FROM events GROUP BY CAST(ts AS DATE), event_type
""",
    # users per step as a list in step order; each step reads the first and the one before it
    "funnel_daily": f"""
WITH steps(step_number, step_event) AS (VALUES (1, 'signup'), (2, 'view'), (3, 'click'), (4, 'purchase')),
reached AS (SELECT CAST(ts AS DATE) AS day, step_number, step_event, COUNT(DISTINCT user_id) AS users
            FROM events JOIN steps ON step_event = event_type WHERE user_id IS NOT NULL GROUP BY ALL),
lists AS (SELECT day, list(users ORDER BY step_number) AS users, list(step_number ORDER BY step_number) AS numbers,
                 list(step_event ORDER BY step_number) AS names FROM reached GROUP BY day),
rows AS (SELECT *, unnest(range(1, len(users) + 1)) AS i FROM lists)
SELECT 'signup_to_purchase' AS funnel_id, {sql_date('day')} AS date, CAST(numbers[i] AS INTEGER) AS step_number, names[i] AS step_event,
       users[i] AS users, users[1] AS users_entered,
       CASE WHEN i > 1 THEN users[i - 1] - users[i] END AS drop_off,
       CASE WHEN i > 1 THEN ROUND(users[i] / users[i - 1], 6) END AS step_conversion,
       ROUND(users[i] / users[1], 6) AS overall_conversion
FROM rows
""",
    "monthly_active_users": f"""
WITH a AS (SELECT DISTINCT CAST(date_trunc('month', ts) AS DATE) AS month_start, user_id FROM events
           WHERE user_id IS NOT NULL),
u AS (SELECT user_id, MIN(CAST(date_trunc('month', ts) AS DATE)) AS cm FROM events
      WHERE event_type = 'signup' GROUP BY user_id),
c AS (SELECT MIN(CAST(ts AS DATE)) AS first_log FROM events)
SELECT {sql_date('a.month_start')} AS month_start, COUNT(*) AS monthly_active_users,
       COUNT(*) FILTER (WHERE u.cm = a.month_start) AS new_active_users,
       COUNT(*) FILTER (WHERE u.cm < a.month_start) AS returning_active_users,
       COUNT(*) FILTER (WHERE u.cm IS NULL) AS active_users_not_in_users_table,
       (ANY_VALUE(c.first_log) <= a.month_start AND a.month_start < DATE '2024-03-01') AS is_complete_month
FROM a LEFT JOIN u ON u.user_id = a.user_id CROSS JOIN c GROUP BY a.month_start
""",
}
