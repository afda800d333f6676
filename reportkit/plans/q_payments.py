"""Payments and settlement reports.

Binding: a user's event log is a payment life cycle (steps signup -> view ->
click -> purchase, amount = value); an order is a payout settled by its lines
(gross line value in cents), with line return flags as settlement categories.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import payments as pm
from .common import finalize, load, sql_date, sql_ts, sx
from .q_ledger import entries

STEPS = ["signup", "view", "click", "purchase"]
NET = "ROUND(l_extendedprice * (1 - l_discount), 2)"
GROSS = f"{NET} + ROUND({NET} * l_tax, 2)"
DISC = "ROUND(l_extendedprice * l_discount, 2)"
# Settlement categories by line return flag; ledger accounts as activity categories.
SETTLEMENT_CATEGORIES = {"N": "new_sales", "A": "adjusted_sales", "R": "returned_sales"}
ACTIVITY_CATEGORIES = {"1100": "receivables", "4000": "sales", "2200": "tax", "4100": "returns"}


def payment_lifecycle(spark, d):
    e = load(spark, d, "events")
    return finalize(pm.lifecycle(e, "user_id", "event_type", "ts", "value", STEPS, tiebreak="event_id"))


def settlement_ledger(spark, d):
    li = load(spark, d, "lineitem").select("l_orderkey", "l_returnflag", sx(NET).alias("amount"))
    return pm.settlement_ledger(li, "l_orderkey", "l_returnflag", "amount", SETTLEMENT_CATEGORIES)


def payout_reconciliation(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    t = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("total").alias("type"),
                                          sx(GROSS).alias("amount"))
    return pm.reconcile_payouts(o, t, "o_orderkey", {"total": "o_totalprice"}, "type", "amount")


def fees_by_type(spark, d):
    li = load(spark, d, "lineitem").select(
        "l_linestatus", F.to_date(F.date_trunc("month", "l_shipdate")).alias("month"),
        sx(DISC).alias("fee"), "l_extendedprice")
    return finalize(pm.fee_rates(li, "l_linestatus", [], "month", "fee", "l_extendedprice"))


def daily_activity(spark, d):
    e = entries(spark, d).withColumn("amount", F.col("debit") - F.col("credit"))
    return finalize(pm.daily_activity(e, ["company"], "entry_date", "account", "amount", ACTIVITY_CATEGORIES, spine=True))


def balance_reconciliation(spark, d):
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("reported_balance"))
    o = load(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), "o_totalprice")
    return pm.implied_opening(c, o, "custkey", "reported_balance", "o_totalprice").withColumn(
        "net_activity", F.expr("CAST(ROUND(CAST(net_activity AS DECIMAL(38,9)), 2) AS DOUBLE)"))


def authorisation_rate(spark, d):
    e = load(spark, d, "events")
    lc = pm.lifecycle(e, "user_id", "event_type", "ts", "value", ["purchase", "error"], tiebreak="event_id")
    return finalize(pm.decision_rate(lc, "date", [], "first_purchase_at", "first_error_at", "purchase_amount"))


QUERIES = {
    "authorisation_rate": authorisation_rate,
    "payment_lifecycle": payment_lifecycle,
    "settlement_ledger": settlement_ledger,
    "payout_reconciliation": payout_reconciliation,
    "fees_by_type": fees_by_type,
    "daily_activity": daily_activity,
    "balance_reconciliation": balance_reconciliation,
}

_steps_sql = ",\n".join(
    f"{sql_ts(f'MIN(CASE WHEN event_type = {chr(39)}{s}{chr(39)} THEN ts END)')} AS first_{s}_at, "
    f"ROUND(SUM(CASE WHEN event_type = '{s}' THEN value END), 2) AS {s}_amount, "
    f"BOOL_OR(event_type = '{s}') AS has_{s}" for s in STEPS)

ORACLE = {
    "authorisation_rate": f"""
WITH decisions AS (SELECT user_id, MIN(ts) AS first_decision, BOOL_OR(event_type = 'purchase') AS ever_authorised,
                          ROUND(SUM(value) FILTER (event_type = 'purchase'), 2) AS amount
                   FROM events WHERE event_type IN ('purchase', 'error') AND ts IS NOT NULL GROUP BY user_id),
per_day AS (SELECT CAST(first_decision AS DATE) AS day, COUNT(*) AS decided, COUNT(*) FILTER (ever_authorised) AS authorised,
                   COUNT(*) FILTER (NOT ever_authorised) AS refused,
                   ROUND(COALESCE(SUM(amount) FILTER (ever_authorised), 0.0), 2) AS authorised_amount
            FROM decisions GROUP BY day)
SELECT {sql_date('day')} AS date, decided, authorised, refused, authorised_amount,
       ROUND(authorised::DOUBLE / NULLIF(decided, 0), 6) AS authorisation_rate
FROM per_day
""",
    "payment_lifecycle": f"""
SELECT user_id, {_steps_sql},
       FIRST(event_type ORDER BY ts DESC, event_id DESC) FILTER (WHERE event_type IS NOT NULL) AS latest_step,
       COUNT(*) AS event_count
FROM events GROUP BY user_id
""",
    "settlement_ledger": f"""
SELECT l_orderkey,
  {", ".join(f"ROUND(SUM(CASE WHEN l_returnflag = '{k}' THEN {NET} ELSE 0.0 END), 2) AS {v}" for k, v in SETTLEMENT_CATEGORIES.items())},
  ROUND(SUM(CASE WHEN l_returnflag NOT IN ('N', 'A', 'R') OR l_returnflag IS NULL THEN {NET} ELSE 0.0 END), 2) AS other_amount,
  ROUND(SUM({NET}), 2) AS net_settlement
FROM lineitem GROUP BY l_orderkey
""",
    "payout_reconciliation": f"""
WITH s AS (SELECT l_orderkey, COUNT(*) AS n, SUM({GROSS}) AS s FROM lineitem GROUP BY 1)
SELECT o.o_orderkey, o.o_totalprice, COALESCE(s.n, 0) AS transaction_count, ROUND(COALESCE(s.s, 0.0), 2) AS total_rebuilt,
       ROUND(COALESCE(s.s, 0.0) - ABS(o.o_totalprice), 2) AS total_difference,
       COALESCE(COALESCE(s.n, 0) > 0 AND ABS(ROUND(COALESCE(s.s, 0.0) - ABS(o.o_totalprice), 2)) <= 0.01, FALSE) AS ties_out
FROM orders o LEFT JOIN s ON s.l_orderkey = o.o_orderkey
""",
    "fees_by_type": f"""
WITH g AS (SELECT l_linestatus, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, ROUND(SUM({DISC}), 2) AS fees,
                  ROUND(SUM(l_extendedprice), 2) AS sales FROM lineitem GROUP BY 1, 2)
SELECT l_linestatus, {sql_date('month')} AS month, fees, sales, ROUND(fees / NULLIF(sales, 0), 6) AS effective_fee_rate FROM g
""",
    "balance_reconciliation": """
WITH a AS (SELECT o_custkey AS custkey, SUM(o_totalprice) AS net_activity FROM orders GROUP BY 1)
SELECT COALESCE(c.c_custkey, a.custkey) AS custkey, c.c_acctbal AS reported_balance,
       ROUND(COALESCE(a.net_activity, 0.0), 2) AS net_activity,
       ROUND(c.c_acctbal - COALESCE(a.net_activity, 0.0), 2) AS implied_opening_balance
FROM customer c FULL JOIN a ON a.custkey = c.c_custkey
""",
}


def _daily_activity_sql():
    from .q_ledger import _ENTRIES
    cats = ", ".join(f"SUM(CASE WHEN account = '{k}' THEN debit - credit ELSE 0.0 END) AS {v}"
                     for k, v in ACTIVITY_CATEGORIES.items())
    names = list(ACTIVITY_CATEGORIES.values()) + ["net_movement"]
    return _ENTRIES + f"""
, g AS (SELECT company, entry_date AS date, {cats}, SUM(debit - credit) AS net_movement FROM entries GROUP BY 1, 2),
f AS (SELECT company, MIN(date) AS s FROM g GROUP BY 1),
e AS (SELECT MAX(date) AS e FROM g),
grid AS (SELECT f.company, CAST(unnest(generate_series(f.s, GREATEST(e.e, f.s), INTERVAL 1 DAY)) AS DATE) AS date
         FROM f CROSS JOIN e)
SELECT grid.company, {sql_date('grid.date')} AS date, {", ".join(f"ROUND(COALESCE(g.{n}, 0.0), 2) AS {n}" for n in names)}
FROM grid LEFT JOIN g ON g.company = grid.company AND g.date = grid.date
"""


ORACLE["daily_activity"] = _daily_activity_sql()
