"""Bindings of incremental publishing (S3) and of one-pass audits (Q1, Q3-Q6, Q8, Q10, Q13).

Stand-in for loads: orders whose key ends in 0 and that are dated 2001 arrive with the second load.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..functions.columns import parse_hhmm
from ..operators import checks as q
from ..session import ensure_checkpoint_dir, tasks_for
from ..sources.published import published, refresh
from . import q_marketing
from .common import finalize, load, sql_date


def published_monthly_sales(spark, d):
    """Published after the first load and refreshed with the second: equals a full rebuild."""
    o = load(spark, d, "orders").withColumn(
        "load", F.when((F.col("o_orderkey") % 10 == 0) & (F.col("o_orderdate") >= "2001-01-01"), 2).otherwise(1))
    month = F.trunc(F.to_date("o_orderdate"), "month")

    def build(rows):
        return rows.groupBy(month.alias("period"), "o_orderstatus").agg(
            F.count(F.lit(1)).alias("orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    refresh(spark, o.where("load = 1"), "load", month, build, path)
    refresh(spark, o, "load", month, build, path)
    return finalize(published(spark, path))


def audits(spark, d):
    ad = q_marketing.ad_performance_daily(spark, d)
    e = load(spark, d, "events").withColumn("clock", F.date_format("ts", "H:mm"))
    li = load(spark, d, "lineitem")
    from_events = tasks_for(e, q.AUDIT_ROWS_A_TASK)     # no more days and campaigns than events
    return reduce(lambda a, b: a.unionByName(b), [
        q.audit(ad, {"ad_spend_not_negative": F.col("spend") >= 0, "ad_clicks_within_impressions": F.col("clicks") <= F.col("impressions")},
                {"ad_day_and_campaign_unique": ["date", "campaign_id"]}, tasks=from_events),
        q.audit(e, {"event_type_accepted": F.col("event_type").isin("view", "click", "purchase", "signup", "error"),
                    "event_value_in_range": F.col("value").between(0, 90), "event_clock_parses": parse_hhmm("clock").isNotNull()},
                {"event_unique": ["event_id"]}, tasks=from_events),
        q.audit(li, {"line_discount_in_range": F.col("l_discount").between(0, 0.1), "line_not_returned": F.col("l_returnflag") != "R"},
                {"line_key_unique": ["l_orderkey", "l_linenumber"], "line_part_unique": ["l_orderkey", "l_partkey"]})])


QUERIES = {"published_monthly_sales": published_monthly_sales, "report_audits": audits}

ORACLE = {
    "published_monthly_sales": f"""
SELECT {sql_date("date_trunc('month', o_orderdate)")} AS period, o_orderstatus, COUNT(*) AS orders,
       CAST(SUM(CAST(ROUND(o_totalprice * 100, 0) AS BIGINT)) AS BIGINT) AS cents
FROM orders GROUP BY {sql_date("date_trunc('month', o_orderdate)")}, o_orderstatus
""",
    "report_audits": f"""
WITH ad AS ({q_marketing.ORACLE['ad_performance_daily']}),
k AS (
  SELECT 'ad_day_and_campaign_unique' AS "check", COUNT(*) FILTER (n > 1) AS violations, SUM(n) AS rows FROM (SELECT COUNT(*) AS n FROM ad GROUP BY date, campaign_id)
  UNION ALL SELECT 'event_unique', COUNT(*) FILTER (n > 1), SUM(n) FROM (SELECT COUNT(*) AS n FROM events GROUP BY event_id)
  UNION ALL SELECT 'line_key_unique', COUNT(*) FILTER (n > 1), SUM(n) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
  UNION ALL SELECT 'line_part_unique', COUNT(*) FILTER (n > 1), SUM(n) FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)
  UNION ALL SELECT 'ad_spend_not_negative', COUNT(*) FILTER ((spend >= 0) IS NOT TRUE), COUNT(*) FROM ad
  UNION ALL SELECT 'ad_clicks_within_impressions', COUNT(*) FILTER ((clicks <= impressions) IS NOT TRUE), COUNT(*) FROM ad
  UNION ALL SELECT 'event_type_accepted', COUNT(*) FILTER ((event_type IN ('view', 'click', 'purchase', 'signup', 'error')) IS NOT TRUE), COUNT(*) FROM events
  UNION ALL SELECT 'event_value_in_range', COUNT(*) FILTER ((value BETWEEN 0 AND 90) IS NOT TRUE), COUNT(*) FROM events
  UNION ALL SELECT 'event_clock_parses', COUNT(*) FILTER (ts IS NULL), COUNT(*) FROM events
  UNION ALL SELECT 'line_discount_in_range', COUNT(*) FILTER ((l_discount BETWEEN 0 AND 0.1) IS NOT TRUE), COUNT(*) FROM lineitem
  UNION ALL SELECT 'line_not_returned', COUNT(*) FILTER ((l_returnflag <> 'R') IS NOT TRUE), COUNT(*) FROM lineitem)
SELECT "check", CAST(violations AS BIGINT) AS violations, CAST(rows AS BIGINT) AS rows FROM k
""",
}
