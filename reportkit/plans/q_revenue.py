"""Recurring-revenue reports: every order is a service line of its customer.

Binding: service starts on the order day and runs (end exclusive) for a term set
by the order priority; the line amount is ``o_totalprice``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rnd
from ..operators import revenue as rv
from ..operators.windows import flag_extreme
from .common import finalize, load, sql_date

AS_OF = "2001-12-31"
# Service term in days per order priority.
TERM_DAYS = {"1-URGENT": 30, "2-HIGH": 90, "3-MEDIUM": 365, "4-NOT SPECIFIED": 45, "5-LOW": 7}


def _term():
    e = None
    for k, v in TERM_DAYS.items():
        e = F.when(F.col("o_orderpriority") == k, v) if e is None else e.when(F.col("o_orderpriority") == k, v)
    return e.otherwise(30)


def _lines(spark, d):
    o = load(spark, d, "orders")
    lines = o.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("service_start"),
                     F.date_add(F.to_date("o_orderdate"), _term()).alias("service_end"), "o_totalprice")
    return rv.normalise_recurring(lines, "service_start", "service_end", "o_totalprice")


def recurring_lines(spark, d):
    n = _lines(spark, d)
    return finalize(n.select("o_orderkey", "o_custkey", "service_start", "service_end", "service_days",
                             rnd("service_months", 6).alias("service_months"),
                             rnd("monthly_amount", 2).alias("monthly_amount")))


def _mrr(spark, d):
    return rv.mrr_by_customer_month(_lines(spark, d), "o_custkey", "service_start", "service_end",
                                    "monthly_amount", AS_OF)


def mrr_by_customer_month(spark, d):
    return finalize(_mrr(spark, d))


def mrr_movements(spark, d):
    m = rv.classify_movement(_mrr(spark, d), "o_custkey", "month", "mrr")
    return finalize(m.select("o_custkey", "month", "mrr", rnd("opening_mrr", 2).alias("opening_mrr"),
                             "movement_type", "movement_amount"))


def mrr_bridge(spark, d):
    m = rv.classify_movement(_mrr(spark, d).withColumn("currency", F.lit("USD")), ["o_custkey", "currency"])
    return finalize(rv.customer_churn(rv.mrr_bridge(m, ["currency"])))


def billing_by_month(spark, d):
    o = load(spark, d, "orders").withColumn("month", F.to_date(F.date_trunc("month", "o_orderdate")))
    li = load(spark, d, "lineitem").where(F.col("l_returnflag") == "R").withColumn(
        "month", F.to_date(F.date_trunc("month", "l_shipdate")))
    parts = {
        "invoiced": (o, {"invoiced": F.sum("o_totalprice")}),
        "credited": (li, {"credited": F.sum(rnd(F.col("l_extendedprice") * (1 - F.col("l_discount")), 2))}),
        "paid": (o.where(F.col("o_orderstatus") == "F"), {"paid": F.sum("o_totalprice")}),
    }
    b = rv.billing_by_month(parts, ["month"])
    return finalize(b.withColumn("amount_due", rnd(F.col("invoiced") - F.col("credited") - F.col("paid"), 2)))


def daily_orders_month_end(spark, d):
    o = load(spark, d, "orders")
    daily = o.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("orders"), rnd(F.sum("o_totalprice"), 2).alias("order_value"))
    daily = rv.month_end_flag(daily, "o_orderpriority", "date")
    return finalize(flag_extreme(daily, "o_orderpriority", "order_value", "max", out="is_best_day"))


# the binding's expiry reason per order priority (5-LOW has none)
EXPIRY_REASONS = {"1-URGENT": "canceled", "2-HIGH": "nonpayment", "3-MEDIUM": "fixed_billing_cycles",
                  "4-NOT SPECIFIED": "nonpayment_trial"}


def subscription_churn(spark, d):
    n = _lines(spark, d)
    subs = n.select("o_orderkey", "o_custkey", F.when(F.col("service_end") <= F.lit(AS_OF).cast("date"),
                                                      F.col("service_end")).alias("ended_on"),
                    )
    reason = F.create_map(*[F.lit(x) for pair in EXPIRY_REASONS.items() for x in pair])
    subs = subs.join(load(spark, d, "orders").select("o_orderkey", reason[F.col("o_orderpriority")].alias("reason")), "o_orderkey")
    ch = rv.subscription_churn(subs, "o_custkey", "ended_on", "reason", n, "o_custkey", "service_start", "service_end",
                               "monthly_amount")
    return finalize(ch.withColumn("mrr_before_churn", rnd("mrr_before_churn", 2)))


def mrr_time_series(spark, d):
    o = load(spark, d, "orders").select("o_custkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("month"),
                                        "o_totalprice")
    t = rv.mrr_time_series(o, "o_custkey", "month", "o_totalprice")
    return finalize(t.withColumns({"mrr": rnd("mrr", 2), "mrr_change": rnd("mrr_change", 2)}))


QUERIES = {
    "mrr_time_series": mrr_time_series,
    "subscription_churn": subscription_churn,
    "recurring_lines": recurring_lines,
    "mrr_by_customer_month": mrr_by_customer_month,
    "mrr_movements": mrr_movements,
    "mrr_bridge": mrr_bridge,
    "billing_by_month": billing_by_month,
    "daily_orders_month_end": daily_orders_month_end,
}

_TERM_SQL = ("CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TERM_DAYS.items())
             + " ELSE 30 END")

_LINES_SQL = f"""
WITH l0 AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS service_start,
                   CAST(CAST(o_orderdate AS DATE) + ({_TERM_SQL}) * INTERVAL 1 DAY AS DATE) AS service_end, o_totalprice
            FROM orders),
l1 AS (SELECT *, CAST(date_diff('day', service_start, service_end) AS INTEGER) AS service_days FROM l0 WHERE service_end > service_start),
l2 AS (SELECT *, service_days / 30.4375 AS m, ROUND(service_days / 30.4375, 0) AS rm FROM l1),
lines AS (SELECT *, CASE WHEN rm >= 1 AND ABS(service_days - rm * 30.4375) <= 3 THEN rm ELSE m END AS service_months,
                 o_totalprice / (CASE WHEN rm >= 1 AND ABS(service_days - rm * 30.4375) <= 3 THEN rm ELSE m END)
                   AS monthly_amount FROM l2)
"""

_MRR_SQL = _LINES_SQL + f"""
, months AS (SELECT CAST(unnest(generate_series(CAST(date_trunc('month', (SELECT MIN(service_start) FROM lines)) AS DATE),
                                               DATE '{AS_OF[:8]}01', INTERVAL 1 MONTH)) AS DATE) AS month),
per AS (SELECT l.o_custkey, mo.month, SUM(l.monthly_amount) AS mrr FROM lines l JOIN months mo
        ON l.service_start <= LEAST(last_day(mo.month), DATE '{AS_OF}') AND LEAST(last_day(mo.month), DATE '{AS_OF}') < l.service_end
        GROUP BY 1, 2),
firsts AS (SELECT o_custkey, MIN(month) AS f FROM per WHERE ROUND(mrr, 2) > 0 GROUP BY 1),
grid AS (SELECT o_custkey, CAST(unnest(generate_series(f, DATE '{AS_OF[:8]}01', INTERVAL 1 MONTH)) AS DATE) AS month
         FROM firsts),
mrr AS (SELECT g.o_custkey, g.month, LEAST(last_day(g.month), DATE '{AS_OF}') AS snapshot_date,
               GREATEST(ROUND(COALESCE(p.mrr, 0.0), 2), 0.0) AS mrr
        FROM grid g LEFT JOIN per p ON p.o_custkey = g.o_custkey AND p.month = g.month)
"""

_MOV_SQL = _MRR_SQL + """
, w AS (SELECT *, COALESCE(LAG(mrr) OVER (PARTITION BY o_custkey ORDER BY month), 0.0) AS opening_mrr,
               COALESCE(MAX(mrr) OVER (PARTITION BY o_custkey ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)
                 AS prior_max FROM mrr),
kinds(had, has, direction, seen, movement_type) AS (VALUES  -- signs of opening, current, their difference, earlier maximum
      (0, 1, 1, 0, 'new'), (0, 1, 1, 1, 'reactivation'), (1, 0, -1, 1, 'churn'), (1, 1, 1, 1, 'expansion'),
      (1, 1, -1, 1, 'contraction'), (1, 1, 0, 1, 'unchanged')),
mov AS (SELECT w.*, k.movement_type, ROUND(w.mrr - w.opening_mrr, 2) AS movement_amount
        FROM w JOIN kinds k ON k.had = SIGN(w.opening_mrr) AND k.has = SIGN(w.mrr)
         AND k.direction = SIGN(w.mrr - w.opening_mrr) AND k.seen = SIGN(w.prior_max))
"""

ORACLE = {
    "mrr_time_series": f"""
WITH g AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS mrr
           FROM orders GROUP BY 1, 2),
f AS (SELECT o_custkey, MIN(month) AS s FROM g GROUP BY 1),
e AS (SELECT MAX(month) AS e FROM g),
grid AS (SELECT f.o_custkey, CAST(unnest(generate_series(f.s, GREATEST(e.e, f.s), INTERVAL 1 MONTH)) AS DATE) AS month
         FROM f CROSS JOIN e),
j AS (SELECT grid.o_custkey, grid.month, g.mrr AS raw FROM grid LEFT JOIN g USING (o_custkey, month)),
c AS (SELECT *, COALESCE(raw, LAST_VALUE(raw IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY month
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS mrr FROM j)
SELECT o_custkey, {sql_date('month')} AS month, ROUND(mrr, 2) AS mrr,
       ROUND(mrr - LAG(mrr) OVER (PARTITION BY o_custkey ORDER BY month), 2) AS mrr_change,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY month) AS INTEGER) AS month_number,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY month DESC) AS INTEGER) AS months_from_latest
FROM c
""",
    "subscription_churn": _LINES_SQL + f"""
, why(o_orderpriority, reason, class) AS (VALUES ('1-URGENT', 'canceled', 'voluntary'), ('2-HIGH', 'nonpayment', 'involuntary'),
        ('3-MEDIUM', 'fixed_billing_cycles', 'term_ended'), ('4-NOT SPECIFIED', 'nonpayment_trial', 'trial_not_converted')),
e AS (SELECT l.o_orderkey, l.o_custkey, l.service_end AS ended_on, why.reason, IFNULL(why.class, 'other') AS churn_type,
             l.service_end - INTERVAL 1 DAY AS day_before
      FROM lines l JOIN orders o ON o.o_orderkey = l.o_orderkey LEFT JOIN why USING (o_orderpriority)
      WHERE l.service_end <= DATE '{AS_OF}'),
m AS (SELECT e.o_custkey, e.day_before, SUM(l.monthly_amount) AS mrr
      FROM (SELECT DISTINCT o_custkey, day_before FROM e) e JOIN lines l
        ON l.o_custkey = e.o_custkey AND e.day_before >= l.service_start AND e.day_before < l.service_end GROUP BY 1, 2)
SELECT e.o_orderkey, e.o_custkey, {sql_date('e.ended_on')} AS ended_on, e.reason, ROUND(GREATEST(IFNULL(m.mrr, 0.0), 0.0), 2) AS mrr_before_churn,
       e.churn_type
FROM e LEFT JOIN m ON m.o_custkey = e.o_custkey AND m.day_before = e.day_before
""",
    "recurring_lines": _LINES_SQL + f"""
SELECT o_orderkey, o_custkey, {sql_date('service_start')} AS service_start, {sql_date('service_end')} AS service_end,
       service_days, ROUND(service_months, 6) AS service_months, ROUND(monthly_amount, 2) AS monthly_amount FROM lines
""",
    "mrr_by_customer_month": _MRR_SQL + f"""
SELECT o_custkey, {sql_date('month')} AS month, {sql_date('snapshot_date')} AS snapshot_date, mrr FROM mrr
""",
    "mrr_movements": _MOV_SQL + f"""
SELECT o_custkey, {sql_date('month')} AS month, mrr, ROUND(opening_mrr, 2) AS opening_mrr, movement_type, movement_amount
FROM mov
""",
    "mrr_bridge": _MOV_SQL + f"""
, g AS (SELECT month, 'USD' AS currency, ROUND(SUM(opening_mrr), 2) AS opening_mrr,
          ROUND(SUM(CASE WHEN movement_type = 'new' THEN movement_amount ELSE 0.0 END), 2) AS new_mrr,
          ROUND(SUM(CASE WHEN movement_type = 'reactivation' THEN movement_amount ELSE 0.0 END), 2) AS reactivation_mrr,
          ROUND(SUM(CASE WHEN movement_type = 'expansion' THEN movement_amount ELSE 0.0 END), 2) AS expansion_mrr,
          ROUND(SUM(CASE WHEN movement_type = 'contraction' THEN movement_amount ELSE 0.0 END), 2) AS contraction_mrr,
          ROUND(SUM(CASE WHEN movement_type = 'churn' THEN movement_amount ELSE 0.0 END), 2) AS churned_mrr,
          ROUND(SUM(mrr), 2) AS closing_mrr, COUNT(*) FILTER (WHERE mrr > 0) AS customers,
          COUNT(*) FILTER (WHERE movement_type = 'new') AS new_customers,
          COUNT(*) FILTER (WHERE movement_type = 'churn') AS churned_customers,
          COUNT(*) FILTER (WHERE movement_type = 'reactivation') AS reactivated_customers,
          COUNT(*) FILTER (WHERE opening_mrr > 0) AS opening_customers
        FROM mov GROUP BY month)
SELECT {sql_date('month')} AS month, currency, opening_mrr, new_mrr, reactivation_mrr, expansion_mrr, contraction_mrr,
       churned_mrr, closing_mrr, customers, new_customers, churned_customers, reactivated_customers, opening_customers,
       ROUND(churned_customers / NULLIF(opening_customers, 0), 6) AS customer_churn_rate,
       ROUND(-(churned_mrr + contraction_mrr) / NULLIF(opening_mrr, 0), 6) AS gross_mrr_churn_rate,
       ROUND((opening_mrr + expansion_mrr + contraction_mrr + churned_mrr) / NULLIF(opening_mrr, 0), 6) AS net_mrr_retention
FROM g
""",
    "billing_by_month": f"""
WITH i AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS invoiced FROM orders GROUP BY 1),
c AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, SUM(ROUND(l_extendedprice * (1 - l_discount), 2)) AS credited
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, SUM(o_totalprice) AS paid FROM orders
      WHERE o_orderstatus = 'F' GROUP BY 1),
k AS (SELECT month FROM i UNION SELECT month FROM c UNION SELECT month FROM p),
j AS (SELECT k.month, ROUND(COALESCE(i.invoiced, 0.0), 2) AS invoiced, ROUND(COALESCE(c.credited, 0.0), 2) AS credited,
             ROUND(COALESCE(p.paid, 0.0), 2) AS paid
      FROM k LEFT JOIN i USING (month) LEFT JOIN c USING (month) LEFT JOIN p USING (month))
SELECT {sql_date('month')} AS month, invoiced, credited, paid, ROUND(invoiced - credited - paid, 2) AS amount_due FROM j
""",
    "daily_orders_month_end": f"""
WITH d AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS date, COUNT(*) AS orders,
                  ROUND(SUM(o_totalprice), 2) AS order_value FROM orders GROUP BY 1, 2)
SELECT o_orderpriority, {sql_date('date')} AS date, orders, order_value,
       date = MAX(date) OVER (PARTITION BY o_orderpriority, date_trunc('month', date)) AS is_month_end,
       order_value = MAX(order_value) OVER (PARTITION BY o_orderpriority) AS is_best_day
FROM d
""",
}
