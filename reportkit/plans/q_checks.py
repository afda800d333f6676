"""Data-quality checks (Q1-Q15) run on the reports built from the driver tables.
Each returns the offending rows: an empty result is a pass."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as q
from ..operators import commerce as cm
from ..operators import events as ev
from ..operators import ledger as lg
from . import q_commerce, q_events, q_ledger, q_support


def _oracle_of(module: str):
    import importlib
    mod = importlib.import_module(f"{__package__}.{module}")
    return lambda name: mod.ORACLE[name]


q_commerce_oracle = _oracle_of("q_commerce")
q_marketing_oracle = _oracle_of("q_marketing")
q_content_oracle = _oracle_of("q_content")
q_staging_oracle = _oracle_of("q_staging")
q_crm_oracle = _oracle_of("q_crm")
q_revenue_oracle = _oracle_of("q_revenue")
from .common import finalize, load


def check_sales_equation(spark, d):
    s = cm.sales_over_time(q_commerce.order_lines(spark, d), ["report_date", "channel", "row_type"])
    bad = q.check_identity(s, F.col("net_sales"), F.col("gross_sales") + F.col("discounts") + F.col("returns"))
    return finalize(bad.select("report_date", "channel", "row_type", "lhs", "rhs"))


def check_sessions_unique(spark, d):
    s = ev.sessionize(load(spark, d, "events"), "user_id", "ts", event="event_type", tiebreak="event_id")
    return q.check_unique(s, "session_id")


def check_vouchers_balance(spark, d):
    return q.check_balances(q_ledger.entries(spark, d), ["company", "l_orderkey", "l_linenumber"])


def check_trial_balance_bridge(spark, d):
    tb = lg.trial_balance(q_ledger.entries(spark, d), "company", "account", "entry_date", "debit", "credit",
                          q_ledger.AS_OF)
    return finalize(q.check_bridge(tb, ["company", "account"], "month", "opening_balance", "closing_balance")
                    .select("company", "account", "month", "opening_balance", "prev_closing"))


def check_item_mix_shares(spark, d):
    return finalize(q.check_shares(q_commerce.item_mix(spark, d), "date", "share_of_day_sales"))


def check_fx_no_gaps(spark, d):
    f = lg.fill_rates(q_ledger._rates(spark, d), "currency", "rate_date", "rate", q_ledger.FX_AS_OF)
    return finalize(q.check_no_gaps(f, "currency", "rate_date"))


def check_line_parts_resolve(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return q.check_resolves(li, load(spark, d, "part"), "p_partkey")


def check_nps_in_range(spark, d):
    n = q_support.event_nps(spark, d)
    return q.check_expr(n, F.col("nps").between(-100, 100) | F.col("nps").isNull())


def check_product_reconciles(spark, d):
    from . import q_commerce as qc
    ps = qc.product_sales_over_time(spark, d).select("report_date", "amount")
    o = load(spark, d, "orders").select(F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("report_date"),
                                        F.col("o_totalprice").alias("amount"))
    return q.check_reconciles(ps, o, "report_date", ["amount"], tol=0.05)


def check_ad_non_negative(spark, d):
    from . import q_marketing as qm
    return q.check_non_negative(qm.ad_performance_daily(spark, d), ["impressions", "clicks", "spend"])


def check_clicks_within_impressions(spark, d):
    from . import q_events as qe
    return q.check_within(qe.search_performance_daily(spark, d), "clicks", "impressions")


def check_funnel_monotonic(spark, d):
    from . import q_content as qc
    return q.check_monotonic(qc.distribution_funnel(spark, d), ["signup", "view", "click", "purchase"]).select(
        "campaign_id", "signup", "view", "click", "purchase")


def check_event_classes_accepted(spark, d):
    from . import q_staging as qs
    return q.check_accepted(qs.staged_events(spark, d), "event_class",
                            ["conversion", "acquisition", "error", "engagement"]).select("event_id", "event_class")


def check_clock_text_parses(spark, d):
    from ..functions.columns import parse_hhmm
    e = load(spark, d, "events").select("event_id", F.date_format("ts", "H:mm").alias("clock_text"))
    return q.check_parses(e.withColumn("minutes", parse_hhmm("clock_text")), "clock_text", "minutes")


def check_single_current_stage(spark, d):
    from . import q_crm as qc
    return q.check_single_current(qc.stage_history(spark, d), "user_id", "is_current")


def check_mrr_bridge_continuity(spark, d):
    from . import q_revenue as qr
    b = qr.mrr_bridge(spark, d)
    return q.check_bridge(b, "currency", "month", "opening_mrr", "closing_mrr").select(
        "currency", "month", "opening_mrr", "prev_closing")


QUERIES = {
    "check_mrr_bridge_continuity": check_mrr_bridge_continuity,
    "check_product_reconciles": check_product_reconciles,
    "check_ad_non_negative": check_ad_non_negative,
    "check_clicks_within_impressions": check_clicks_within_impressions,
    "check_funnel_monotonic": check_funnel_monotonic,
    "check_event_classes_accepted": check_event_classes_accepted,
    "check_clock_text_parses": check_clock_text_parses,
    "check_single_current_stage": check_single_current_stage,
    "check_sales_equation": check_sales_equation,
    "check_sessions_unique": check_sessions_unique,
    "check_vouchers_balance": check_vouchers_balance,
    "check_trial_balance_bridge": check_trial_balance_bridge,
    "check_item_mix_shares": check_item_mix_shares,
    "check_fx_no_gaps": check_fx_no_gaps,
    "check_line_parts_resolve": check_line_parts_resolve,
    "check_nps_in_range": check_nps_in_range,
}

ORACLE = {
    "check_mrr_bridge_continuity": f"""
WITH b AS (SELECT *, LAG(closing_mrr) OVER (PARTITION BY currency ORDER BY month) AS prev_closing
           FROM ({q_revenue_oracle('mrr_bridge')}) s)
SELECT currency, month, opening_mrr, prev_closing FROM b
WHERE prev_closing IS NOT NULL AND ABS(opening_mrr - prev_closing) > 0.01
""",
    "check_product_reconciles": f"""
WITH a AS (SELECT report_date, SUM(amount) AS a_amount FROM ({q_commerce_oracle('product_sales_over_time')}) s GROUP BY 1),
b AS (SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS report_date, SUM(o_totalprice) AS b_amount FROM orders GROUP BY 1),
j AS (SELECT * FROM a FULL JOIN b USING (report_date))
SELECT * FROM j WHERE ABS(COALESCE(a_amount, 0.0) - COALESCE(b_amount, 0.0)) > 0.05
""",
    "check_ad_non_negative": f"""
SELECT * FROM ({q_marketing_oracle('ad_performance_daily')}) s WHERE impressions < 0 OR clicks < 0 OR spend < 0
""",
    "check_clicks_within_impressions": f"""
SELECT * FROM ({q_events.ORACLE['search_performance_daily']}) s WHERE clicks > impressions
""",
    "check_funnel_monotonic": f"""
SELECT campaign_id, signup, view, click, purchase FROM ({q_content_oracle('distribution_funnel')}) s
WHERE view > signup OR click > view OR purchase > click
""",
    "check_event_classes_accepted": f"""
SELECT event_id, event_class FROM ({q_staging_oracle('staged_events')}) s
WHERE event_class IS NULL OR event_class NOT IN ('conversion', 'acquisition', 'error', 'engagement')
""",
    "check_clock_text_parses": """
WITH e AS (SELECT event_id, CAST(hour(ts) AS VARCHAR) || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS clock_text FROM events),
p AS (SELECT *, CASE WHEN regexp_full_match(trim(clock_text), '[0-9]{1,3}:[0-5][0-9]')
                     THEN TRY_CAST(split_part(trim(clock_text), ':', 1) AS INTEGER) * 60
                          + TRY_CAST(split_part(trim(clock_text), ':', 2) AS INTEGER) END AS minutes FROM e)
SELECT * FROM p WHERE clock_text IS NOT NULL AND trim(clock_text) <> '' AND minutes IS NULL
""",
    "check_single_current_stage": f"""
SELECT user_id, COUNT(*) FILTER (WHERE is_current) AS n_current FROM ({q_crm_oracle('stage_history')}) s
GROUP BY 1 HAVING COUNT(*) FILTER (WHERE is_current) <> 1
""",
    "check_sales_equation": f"""
SELECT report_date, channel, row_type, net_sales AS lhs, gross_sales + discounts + returns AS rhs
FROM ({q_commerce.ORACLE['sales_over_time']}) s WHERE ABS(net_sales - (gross_sales + discounts + returns)) > 0.01
""",
    "check_sessions_unique": f"""
SELECT session_id, COUNT(*) AS n_rows FROM ({q_events.ORACLE['sessions']}) s GROUP BY 1 HAVING COUNT(*) > 1
""",
    "check_vouchers_balance": q_ledger._ENTRIES + """
SELECT company, l_orderkey, l_linenumber, SUM(debit) AS total_debit, SUM(credit) AS total_credit FROM entries
GROUP BY 1, 2, 3 HAVING ABS(SUM(debit) - SUM(credit)) > 0.01
""",
    "check_trial_balance_bridge": f"""
WITH t AS ({q_ledger.ORACLE['trial_balance']}),
b AS (SELECT *, LAG(closing_balance) OVER (PARTITION BY company, account ORDER BY month) AS prev_closing FROM t)
SELECT company, account, month, opening_balance, prev_closing FROM b
WHERE prev_closing IS NOT NULL AND ABS(opening_balance - prev_closing) > 0.01
""",
    "check_item_mix_shares": f"""
SELECT date, SUM(share_of_day_sales) AS share_total FROM ({q_commerce.ORACLE['item_mix']}) s GROUP BY 1
HAVING ABS(SUM(share_of_day_sales) - 1) > 0.01
""",
    "check_fx_no_gaps": f"""
WITH f AS ({q_ledger.ORACLE['fx_daily_rates']}),
g AS (SELECT currency, MIN(CAST(rate_date AS DATE)) AS first_date, MAX(CAST(rate_date AS DATE)) AS last_date,
             COUNT(DISTINCT rate_date) AS n_days FROM f GROUP BY 1)
SELECT currency, strftime(first_date, '%Y-%m-%d') AS first_date, strftime(last_date, '%Y-%m-%d') AS last_date, n_days
FROM g WHERE date_diff('day', first_date, last_date) + 1 <> n_days
""",
    "check_line_parts_resolve": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS p_partkey FROM lineitem l
WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
""",
    "check_nps_in_range": f"""
SELECT * FROM ({q_support.ORACLE['event_nps']}) s WHERE NOT COALESCE(nps BETWEEN -100 AND 100 OR nps IS NULL, FALSE)
""",
}
