"""Advertising and messaging reports. Binding: events are ad delivery / message
events of the campaign named by the event's JSON ``k`` (view = impression, click =
click, purchase = conversion worth ``value``; spend = value of views / 100)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import json_any
from ..operators import marketing as mk
from ..functions.columns import rnd
from .common import finalize, load, sql_date


def _events(spark, d):
    e = load(spark, d, "events")
    return e.select("user_id", "event_type", "value", F.to_date("ts").alias("date"), "ts",
                    json_any("props", ["$.k"]).try_cast("int").alias("campaign_id"))


def _delivery(e):
    return e.select("date", "campaign_id",
                    F.when(F.col("event_type") == "view", 1).otherwise(0).cast("long").alias("impressions"),
                    F.when(F.col("event_type") == "click", 1).otherwise(0).cast("long").alias("clicks"),
                    F.when(F.col("event_type") == "view", F.col("value") / 100).otherwise(0.0).alias("spend"))


def ad_performance_daily(spark, d):
    e = _events(spark, d)
    out = mk.ad_performance(_delivery(e), ["date", "campaign_id"], e.withColumnRenamed("event_type", "action_type"))
    return finalize(out)


def ad_performance_by_day(spark, d):
    e = _events(spark, d)
    ad = mk.ad_performance(_delivery(e), ["date", "campaign_id"], e.withColumnRenamed("event_type", "action_type"))
    return finalize(mk.roll_up(ad, ["date"], ["impressions", "clicks", "spend", "conversions", "conversion_value"]))


def email_campaign_performance(spark, d):
    return mk.email_campaign_performance_by_kind(_events(spark, d), "campaign_id", "user_id", "event_type",
                                                 {"sends": "view", "bounces": "error", "opens": "click", "clicks": "purchase",
                                                  "unsubscribes": "signup"})


def messaging_daily(spark, d):
    return finalize(mk.messaging_daily(_events(spark, d), "event_type", "ts", [], ["view", "click", "purchase", "error"],
                                       cost="value"))


def cross_channel_daily(spark, d):
    e = _events(spark, d)
    display = (e.where(F.col("event_type") == "view").groupBy("date")
               .agg(F.count(F.lit(1)).alias("impressions"), rnd(F.sum(F.col("value") / 100), 2).alias("spend")))
    search = (e.where(F.col("event_type") == "click").groupBy("date")
              .agg(F.count(F.lit(1)).alias("clicks"), rnd(F.sum(F.col("value") / 100), 2).alias("spend")))
    return finalize(mk.cross_channel({"display": display, "search": search}, ["date"]))


QUERIES = {
    "cross_channel_daily": cross_channel_daily,
    "ad_performance_daily": ad_performance_daily,
    "ad_performance_by_day": ad_performance_by_day,
    "email_campaign_performance": email_campaign_performance,
    "messaging_daily": messaging_daily,
}

_E = """
WITH e AS (SELECT user_id, event_type, value, CAST(ts AS DATE) AS date, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER)
                  AS campaign_id FROM events),
ad AS (SELECT date, campaign_id, SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS impressions,
              SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicks,
              ROUND(SUM(CASE WHEN event_type = 'view' THEN value / 100 ELSE 0.0 END), 2) AS spend,
              COUNT(*) FILTER (WHERE event_type IN ('purchase')) AS conversions,
              ROUND(SUM(CASE WHEN event_type IN ('purchase') THEN value ELSE 0.0 END), 2) AS conversion_value
       FROM e GROUP BY 1, 2)
"""


def _rates(prefix=""):
    return ", ".join(
        f"ROUND({'1000.0 * ' if s != 1 else ''}{prefix}{n}::DOUBLE / NULLIF({prefix}{dn}::DOUBLE, 0), 6) AS {k}"
        for k, (n, dn, s) in mk.AD_RATES.items())


ORACLE = {
    "cross_channel_daily": f"""
WITH u AS (SELECT CAST(ts AS DATE) AS date, 'display' AS channel, COUNT(*) AS impressions, CAST(NULL AS BIGINT) AS clicks,
                  ROUND(SUM(value / 100), 2) AS spend FROM events WHERE event_type = 'view' GROUP BY 1
           UNION ALL
           SELECT CAST(ts AS DATE), 'search', NULL, COUNT(*), ROUND(SUM(value / 100), 2) FROM events
           WHERE event_type = 'click' GROUP BY 1)
SELECT {sql_date('date')} AS date, channel, impressions, clicks, spend,
       ROUND(spend / NULLIF(SUM(spend) OVER (PARTITION BY date), 0), 6) AS share_of_spend FROM u
""",
    "ad_performance_daily": _E + f"""
SELECT {sql_date('date')} AS date, campaign_id, CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks,
       spend, conversions, conversion_value, {_rates()}
FROM ad
""",
    "ad_performance_by_day": _E + f"""
, g AS (SELECT date, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) AS BIGINT) AS clicks,
               ROUND(SUM(spend), 2) AS spend, CAST(SUM(conversions) AS BIGINT) AS conversions,
               ROUND(SUM(conversion_value), 2) AS conversion_value FROM ad GROUP BY 1)
SELECT {sql_date('date')} AS date, impressions, clicks, spend, conversions, conversion_value, {_rates()} FROM g
""",
    "email_campaign_performance": """
WITH e AS (SELECT user_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS campaign_id FROM events
           WHERE event_type IN ('view', 'error', 'click', 'purchase', 'signup')),
g AS (SELECT campaign_id,
             COUNT(*) FILTER (event_type = 'view') AS sends_total, COUNT(DISTINCT user_id) FILTER (event_type = 'view') AS sends_unique,
             COUNT(*) FILTER (event_type = 'error') AS bounces_total, COUNT(DISTINCT user_id) FILTER (event_type = 'error') AS bounces_unique,
             COUNT(*) FILTER (event_type = 'click') AS opens_total, COUNT(DISTINCT user_id) FILTER (event_type = 'click') AS opens_unique,
             COUNT(*) FILTER (event_type = 'purchase') AS clicks_total,
             COUNT(DISTINCT user_id) FILTER (event_type = 'purchase') AS clicks_unique,
             COUNT(*) FILTER (event_type = 'signup') AS unsubscribes_total,
             COUNT(DISTINCT user_id) FILTER (event_type = 'signup') AS unsubscribes_unique
      FROM e GROUP BY campaign_id)
SELECT *, sends_total - bounces_total AS delivered,
       ROUND((sends_total - bounces_total) / NULLIF(sends_total, 0), 6) AS delivery_rate,
       ROUND(opens_unique / NULLIF(sends_total - bounces_total, 0), 6) AS opens_rate,
       ROUND(clicks_unique / NULLIF(sends_total - bounces_total, 0), 6) AS clicks_rate,
       ROUND(clicks_unique / NULLIF(opens_unique, 0), 6) AS clicks_to_opens_rate,
       ROUND(unsubscribes_unique / NULLIF(sends_total - bounces_total, 0), 6) AS unsubscribe_rate
FROM g
""",
    "messaging_daily": f"""
SELECT {sql_date('CAST(ts AS DATE)')} AS date, COUNT(*) FILTER (WHERE event_type = 'view') AS view,
       COUNT(*) FILTER (WHERE event_type = 'click') AS click, COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase,
       COUNT(*) FILTER (WHERE event_type = 'error') AS error, ROUND(SUM(value), 2) AS cost
FROM events GROUP BY CAST(ts AS DATE)
""",
}
