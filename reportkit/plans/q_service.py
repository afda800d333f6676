"""Bindings of the restaurant, coaching, time-tracking, workforce, reservation and stability reports.

Stand-ins: an order is a restaurant order, a reservation (customer number mod 20 is the venue), a reviewed scorecard (the customer
number mod 50 is the rep) and pays once; its lines are items, checks by line status, service charges (line 1), answers, time
entries (the supplier is person and project), pay lines and absences; a supplier's nation is its home unit. An event is a call of
its user, and a session or (type error) a crash of version ``props.k`` mod 5. A conversation is a call of rep ``conv_id`` mod 20.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crm
from ..operators import service as sv
from .common import finalize, load, sql_date

CALLS_AS_OF = "2024-02-05"
UNIT_ZONE = "America/New_York"


def _cents(c):
    return F.round(F.col(c) * 100).cast("long")


def _lines(spark, d):
    return load(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("person"), "l_returnflag", "l_linestatus",
        F.col("l_quantity").cast("long").alias("qty"), _cents("l_extendedprice").alias("gross"), _cents("l_discount").alias("discount"),
        _cents("l_tax").alias("tax"), F.to_date("l_shipdate").alias("day"), "l_shipdate")


def restaurant_sales_summary(spark, d):
    o = load(spark, d, "orders")
    k = F.col("o_orderkey")
    orders = o.select(k.alias("order_id"), F.to_date("o_orderdate").alias("day"), "o_orderpriority", (k % 11 == 0).alias("voided"),
                      F.when(k % 3 > 0, (k % 4).cast("int")).alias("guests"))
    payments = o.select(k.alias("order_id"), _cents("o_totalprice").alias("amount"), (k % 500).alias("tip"),
                        F.when(k % 13 == 0, "VOIDED").otherwise("CAPTURED").alias("status"))
    li = _lines(spark, d)
    items = li.select("order_id", F.col("qty").alias("quantity"), "gross", (F.col("gross") - F.col("qty") * F.col("discount")).alias("net"), "tax",
                      F.when(F.col("l_returnflag") == "R", F.col("qty")).otherwise(0).alias("refund"),
                      ((F.col("line") == 7) & (F.col("l_linestatus") == "O")).alias("deferred"), ((F.col("l_returnflag") == "A") & (F.col("line") % 3 == 0)).alias("voided"))
    checks = li.groupBy("order_id", "l_linestatus").agg(F.sum("gross").alias("amount")).withColumn("voided", F.col("order_id") % 17 == 0)
    charges = li.where("line = 1").select("order_id", (F.col("qty") * 100).alias("amount"), (F.col("l_returnflag") == "N").alias("gratuity"))
    return finalize(sv.sales_summary(orders, checks, items, charges, payments, "order_id", "day", ["o_orderpriority"]))


def rep_calls_by_day(spark, d):
    e = load(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    calls = e.select(F.col("user_id").alias("rep"), "ts", F.when(F.col("event_type").isin("purchase", "click"), "External").when(
        F.col("event_type") == "view", "Internal").alias("scope"), F.when(k % 3 == 0, "Inbound").when(k % 3 == 1, "Outbound").otherwise("Conference").alias("direction"),
        F.floor(F.col("value")).cast("long").alias("seconds"), (k > 90).alias("linked"))
    reps = load(spark, d, "supplier").select((F.col("s_suppkey") + 100).alias("rep"))
    return finalize(sv.rep_calls_by_day(calls, reps, "rep", "ts", "scope", "direction", "seconds", CALLS_AS_OF, F.col("linked")))


def scorecard_scores_by_rep(spark, d):
    o = load(spark, d, "orders").select(
        F.col("o_orderkey").alias("card"), (F.col("o_custkey") % 50).alias("rep"), F.col("o_orderpriority").alias("scorecard"),
        F.when(F.col("o_orderkey") % 17 > 0, F.col("o_orderdate")).alias("reviewed_at"), F.col("o_custkey").alias("call_id"), (F.col("o_custkey") % 7).alias("reviewer"))
    li = _lines(spark, d)
    answers = li.select(F.col("order_id").alias("card"), F.col("line").alias("question"), F.col("l_returnflag").alias("revision"),
                        F.when(F.col("discount") > 0, F.col("qty")).alias("score"), (F.col("line") == 1).alias("is_overall"),
                        ((F.col("l_linestatus") == "F") & (F.col("line") == 5)).alias("not_applicable"))
    questions = answers.where(~((F.col("revision") == "R") & (F.col("question") == 3))).groupBy("question", "revision").agg(
        F.lit(0).cast("long").alias("min_range"), F.max("score").alias("max_range"))
    return finalize(sv.scorecard_scores(o, answers, questions, "card", "rep", "scorecard", "reviewed_at", "call_id", "reviewer", ["question", "revision"]))


def rep_interaction_by_week(spark, d):
    t = load(spark, d, "conversations")
    calls = crm.call_analytics(t, "conv_id", "role", "text", ["user", "assistant"]).select(
        "*", (F.col("conv_id") % 20).alias("rep"), F.expr("date_add(DATE'2024-01-01', cast(conv_id % 200 AS INT))").alias("call_date"))
    return finalize(sv.rep_interaction_by_week(calls, "rep", "call_date", F.col("conv_id") % 3 != 0, "assistant_chars", "total_chars",
                                               ["questions", "longest_turn_chars"]))


def _entries(spark, d):
    li = _lines(spark, d)
    return li.select(F.col("person").alias("user"), (F.col("person") % 10).alias("project_group"), F.col("person").alias("project"), F.col("line").alias("task"),
                     "day", (F.col("qty") / 4).alias("hours"), F.ceil(F.col("qty") / 4).cast("double").alias("rounded_hours"), (F.col("l_returnflag") != "A").alias("billable"),
                     (F.col("l_linestatus") == "F").alias("billed"), F.when(F.col("tax") > 0, F.col("tax") * 10.0).alias("rate"),
                     F.when(F.col("discount") > 0, F.col("discount") * 5.0).alias("cost_rate"))


def time_report(spark, d):
    return finalize(sv.time_report(_entries(spark, d), ["user", "project_group", "task"], "day"))


def project_budget(spark, d):
    k = F.col("s_suppkey")
    projects = load(spark, d, "supplier").select(k.alias("project"), (k % 4 == 0).alias("is_fixed_fee"), (k * 1000.0).alias("fee"), (k * 500.0).alias("budget"),
                                                 (k * 300.0).alias("budget_spent"), F.when(F.col("s_nationkey") % 2 == 0, "EUR").otherwise("USD").alias("currency"),
                                                 F.lit("USD").alias("account_currency"))
    li = _lines(spark, d)
    expenses = li.where("l_returnflag = 'R'").select(F.col("person").alias("project"), (F.col("tax") * 2.0).alias("total_cost"), (F.col("line") % 2 == 0).alias("billable"))
    invoiced = li.select(F.col("person").alias("project"), (F.col("qty") * 3.0).alias("amount"),
                         F.when(F.col("line") == 1, "draft").when(F.col("line") == 2, "open").otherwise("paid").alias("state"))
    return finalize(sv.project_budget(projects, _entries(spark, d), expenses, invoiced, "project", "day"))


def _people(spark, d):
    return load(spark, d, "supplier").select(F.col("s_suppkey").alias("person"), F.when(F.col("s_suppkey") % 9 > 0, F.col("s_nationkey")).alias("unit"))


def paid_hours_daily(spark, d):
    lines = _lines(spark, d).select("person", (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(hours=F.col("line"))).alias("starts_at"),
                                    F.col("l_returnflag").alias("pay_type"), F.col("l_linestatus").alias("entry_type"), (F.col("qty") * 10).alias("minutes"))
    units = load(spark, d, "nation").select(F.col("n_nationkey").alias("unit"), F.when(F.col("n_nationkey") % 2 == 0, F.lit(UNIT_ZONE)).alias("timezone"))
    return finalize(sv.hours_daily(lines, _people(spark, d), units, "person", "unit", "starts_at", "minutes", ["pay_type", "entry_type"]))


def absence_days_daily(spark, d):
    """A returned line is an absence of as many days as its number."""
    li = _lines(spark, d).where("l_returnflag = 'R'")
    key = ["order_id", "line", "person", "day", "qty", "gross", "discount", "tax", "l_linestatus"]
    a = li.select(F.concat_ws("-", *key).alias("absence"), "person", "line", "day", (F.col("tax") > 0).alias("paid"), (F.col("l_linestatus") == "O").alias("sick"),
                  (F.col("discount") > 5).alias("note"), (F.col("line") % 4).alias("absence_type")).distinct()
    days = a.select("absence", F.explode(F.sequence("day", F.date_add("day", F.col("line") - 1))).alias("date")).withColumn(
        "day_status", F.when(F.dayofweek("date").isin(1, 7), "weekend").otherwise("approved"))
    return finalize(sv.absence_daily(days, a.drop("day", "line"), _people(spark, d), "absence", "person", "unit", "date", "absence_type", "day_status"))


def _reservations(spark, d):
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        F.to_date("o_orderdate").alias("date"), (F.col("o_custkey") % 20).alias("venue"), F.col("o_orderstatus").alias("shift"),
        F.when(k % 10 == 0, "canceled").when(k % 10 == 1, "no_show").when(k % 97 > 0, "booked").alias("outcome"), (k % 8 + 1).alias("party"),
        F.when(k % 6 > 0, k % 8).alias("arrived"), (k % 5 == 0).alias("vip"), _cents("o_totalprice").alias("spend"))


def covers_by_day(spark, d):
    return finalize(sv.covers_by_day(_reservations(spark, d), "date", ["venue", "shift"], "outcome", "party", "arrived", "vip", "spend"))


def guest_feedback(spark, d):
    li = _lines(spark, d)
    f = li.select("day", (F.col("person") % 20).alias("venue"), F.col("l_linestatus").alias("feedback_type"), (F.col("qty") % 5 + 1).alias("overall"),
                  F.when(F.col("discount") > 2, F.col("discount") % 5 + 1).alias("food"), F.when(F.col("tax") > 0, F.col("tax") % 5 + 1).alias("service"),
                  F.when(F.col("l_returnflag") == "A", "Yes").when(F.col("l_returnflag") == "N", "no").alias("recommend"))
    return finalize(sv.feedback(f, ["day", "venue", "feedback_type"], ["overall", "food", "service"], "recommend"))


def app_stability(spark, d):
    e = load(spark, d, "events").select(F.to_date("ts").alias("date"), (F.get_json_object("props", "$.k").cast("int") % 5).alias("version"),
                                        F.when(F.col("user_id") % 4 > 0, F.col("user_id") % 4).alias("device"), "event_type",
                                        F.floor(F.col("value") * 60).cast("long").alias("seconds"), F.lit(1).alias("one"))
    return finalize(sv.stability(e.where("event_type = 'view'"), e.where("event_type = 'error'"), ["date", "version", "device"], "one", "seconds", "one"))


QUERIES = {f.__name__: f for f in (restaurant_sales_summary, rep_calls_by_day, scorecard_scores_by_rep, rep_interaction_by_week, time_report, project_budget,
                                   paid_hours_daily, absence_days_daily, covers_by_day, guest_feedback, app_stability)}

_LI = """
WITH li AS (SELECT l_orderkey AS order_id, l_linenumber AS line, l_suppkey AS person, l_returnflag, l_linestatus, CAST(l_quantity AS BIGINT) AS qty,
                   CAST(ROUND(l_extendedprice * 100, 0) AS BIGINT) AS gross, CAST(ROUND(l_discount * 100, 0) AS BIGINT) AS discount,
                   CAST(ROUND(l_tax * 100, 0) AS BIGINT) AS tax, CAST(l_shipdate AS DATE) AS day, l_shipdate FROM lineitem)
"""
_TIME = """
, t AS (SELECT *, qty / 4.0 AS hours, CAST(ceil(qty / 4.0) AS DOUBLE) AS rounded, l_returnflag <> 'A' AS billable, l_linestatus = 'F' AS billed,
               IF(tax > 0, tax * 10.0, NULL)::DOUBLE AS rate, IF(discount > 0, discount * 5.0, NULL)::DOUBLE AS cost_rate FROM li)
"""
_PEOPLE = ", people AS (SELECT s_suppkey AS person, IF(s_suppkey % 9 > 0, s_nationkey, NULL) AS unit FROM supplier)\n"

ORACLE = {
    "restaurant_sales_summary": _LI + f"""
, o AS (SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS day, o_orderpriority, IF(o_orderkey % 3 > 0, o_orderkey % 4, 0) AS guests,
               CAST(ROUND(o_totalprice * 100, 0) AS BIGINT) AS paid FROM orders WHERE o_orderkey % 11 <> 0),
i AS (SELECT order_id, SUM(qty) FILTER (NOT def) AS items, SUM(gross) FILTER (NOT def) AS gross, SUM(gross - qty * discount) FILTER (NOT def) AS net,
             SUM(gross - qty * discount) FILTER (def) AS deferred, SUM(tax) AS tax, SUM(IF(l_returnflag = 'R', qty, 0)) AS refunds
      FROM (SELECT *, line = 7 AND l_linestatus = 'O' AS def FROM li WHERE NOT (l_returnflag = 'A' AND line % 3 = 0)) GROUP BY order_id),
k AS (SELECT order_id, COUNT(DISTINCT l_linestatus) AS checks, SUM(gross) AS amount FROM li WHERE order_id % 17 <> 0 GROUP BY order_id),
c AS (SELECT order_id, SUM(IF(l_returnflag = 'N', 0, qty * 100)) AS charges, SUM(IF(l_returnflag = 'N', qty * 100, 0)) AS gratuities FROM li WHERE line = 1 GROUP BY order_id)
SELECT {sql_date('day')} AS business_date, o_orderpriority, COUNT(*) AS orders, CAST(SUM(guests) AS BIGINT) AS guests, CAST(SUM(IFNULL(checks, 0)) AS BIGINT) AS checks,
       CAST(SUM(IFNULL(items, 0)) AS BIGINT) AS items_sold, CAST(SUM(IFNULL(gross, 0)) AS BIGINT) AS gross_sales, CAST(SUM(IFNULL(net, 0)) AS BIGINT) AS net_sales,
       CAST(SUM(IFNULL(gross, 0) - IFNULL(net, 0)) AS BIGINT) AS discounts, CAST(SUM(IFNULL(refunds, 0)) AS BIGINT) AS refunds,
       CAST(SUM(IFNULL(net, 0) - IFNULL(refunds, 0)) AS BIGINT) AS net_sales_after_refunds, CAST(SUM(IFNULL(deferred, 0)) AS BIGINT) AS deferred_sales,
       CAST(SUM(IFNULL(tax, 0)) AS BIGINT) AS tax, CAST(SUM(IFNULL(charges, 0)) AS BIGINT) AS service_charges, CAST(SUM(IFNULL(gratuities, 0)) AS BIGINT) AS gratuities,
       CAST(SUM(IF(o.order_id % 13 = 0, 0, o.order_id % 500)) AS BIGINT) AS tips, CAST(SUM(IF(o.order_id % 13 = 0, 0, paid)) AS BIGINT) AS payments,
       CAST(SUM(IFNULL(k.amount, 0)) AS BIGINT) AS check_amount
FROM o LEFT JOIN i USING (order_id) LEFT JOIN k USING (order_id) LEFT JOIN c USING (order_id) GROUP BY day, o_orderpriority
""",
    "rep_calls_by_day": f"""
WITH e AS (SELECT IFNULL(CAST(user_id AS VARCHAR), 'unknown') AS rep, CAST(ts AS DATE) AS date, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                  CAST(floor(value) AS BIGINT) AS s FROM events WHERE ts IS NOT NULL),
d AS (SELECT rep, date, COUNT(*) AS calls, COUNT(*) FILTER (event_type IN ('purchase', 'click')) AS external_calls, COUNT(*) FILTER (event_type = 'view') AS internal_calls,
             COUNT(*) FILTER (k % 3 = 0) AS inbound_calls, COUNT(*) FILTER (k % 3 = 1) AS outbound_calls, COUNT(*) FILTER (k % 3 = 2 OR k IS NULL) AS conference_calls,
             CAST(SUM(IFNULL(s, 0)) AS BIGINT) AS call_seconds, CAST(SUM(IF(event_type IN ('purchase', 'click'), IFNULL(s, 0), 0)) AS BIGINT) AS external_call_seconds,
             COUNT(*) FILTER (k > 90) AS calls_linked_to_deal FROM e GROUP BY rep, date),
reps AS (SELECT rep FROM d UNION SELECT CAST(s_suppkey + 100 AS VARCHAR) FROM supplier),
cal AS (SELECT CAST(unnest(generate_series((SELECT MIN(date) FROM d), DATE '{CALLS_AS_OF}', INTERVAL 1 DAY)) AS DATE) AS date)
SELECT reps.rep, {sql_date('cal.date')} AS date, {", ".join(f"IFNULL({c}, 0) AS {c}" for c in ("calls", "external_calls", "internal_calls", "inbound_calls", "outbound_calls", "conference_calls", "call_seconds", "external_call_seconds", "calls_linked_to_deal"))}
FROM reps CROSS JOIN cal LEFT JOIN d ON d.rep = reps.rep AND d.date = cal.date
""",
    "scorecard_scores_by_rep": _LI + f"""
, h AS (SELECT o_orderkey AS card, o_custkey % 50 AS rep, o_orderpriority AS scorecard, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_custkey AS call_id
        FROM orders WHERE o_orderkey % 17 > 0),
a AS (SELECT order_id AS card, line, l_returnflag, IF(discount > 0, qty, NULL) AS score, l_linestatus = 'F' AND line = 5 AS na FROM li),
q AS (SELECT line, l_returnflag, MAX(score) AS top FROM a WHERE NOT (l_returnflag = 'R' AND line = 3) GROUP BY ALL),
s AS (SELECT a.card, line = 1 AS overall, score, score / NULLIF(top, 0)::DOUBLE AS norm FROM a LEFT JOIN q USING (line, l_returnflag) WHERE NOT na AND score IS NOT NULL),
n AS (SELECT month, rep, scorecard, COUNT(*) AS scorecards_answered, COUNT(DISTINCT call_id) AS calls_reviewed, COUNT(DISTINCT call_id % 7) AS reviewers FROM h GROUP BY ALL),
m AS (SELECT month, rep, scorecard, COUNT(*) FILTER (NOT overall) AS scored, AVG(score) FILTER (overall) AS o, AVG(norm) FILTER (overall) AS onorm,
             AVG(score) FILTER (NOT overall) AS qs, AVG(norm) FILTER (NOT overall) AS qnorm FROM h JOIN s USING (card) GROUP BY ALL)
SELECT {sql_date('month')} AS review_month, rep, scorecard, scorecards_answered, calls_reviewed, reviewers, IFNULL(scored, 0) AS scored_answers, ROUND(o, 6) AS avg_overall_score,
       ROUND(onorm, 6) AS avg_overall_score_normalised, ROUND(qs, 6) AS avg_question_score, ROUND(qnorm, 6) AS avg_question_score_normalised
FROM n LEFT JOIN m USING (month, rep, scorecard)
""",
    "rep_interaction_by_week": f"""
WITH c AS (SELECT conv_id, conv_id % 20 AS rep, DATE '2024-01-01' + CAST(conv_id % 200 AS INTEGER) AS day, SUM(length(text)) AS total, SUM(IF(role = 'assistant', length(text), 0)) AS talk,
                  COUNT(*) FILTER (contains(text, '?')) AS questions, MAX(length(text)) AS longest FROM conversations WHERE conv_id % 3 <> 0 GROUP BY conv_id),
r AS (SELECT *, talk / NULLIF(total, 0)::DOUBLE AS ratio FROM c)
SELECT {sql_date("date_trunc('week', day)")} AS week_start, rep, COUNT(*) AS external_calls, COUNT(ratio) AS talk_ratio_calls, ROUND(SUM(ratio), 6) AS talk_ratio_sum,
       ROUND(AVG(ratio), 6) AS avg_talk_ratio, CAST(SUM(talk) AS BIGINT) AS rep_talk, CAST(SUM(total) AS BIGINT) AS total_talk, ROUND(AVG(questions), 6) AS avg_questions,
       ROUND(AVG(longest), 6) AS avg_longest_turn_chars, ROUND(SUM(talk) / NULLIF(SUM(total), 0)::DOUBLE, 6) AS weighted_talk_ratio
FROM r GROUP BY {sql_date("date_trunc('week', day)")}, rep
""",
    "time_report": _LI + _TIME + f"""
SELECT {sql_date('day')} AS spent_date, person AS user, person % 10 AS project_group, line AS task, COUNT(*) AS time_entries, ROUND(SUM(hours), 4) AS hours,
       ROUND(SUM(rounded), 4) AS rounded_hours, ROUND(SUM(IF(billable, rounded, 0)), 4) AS billable_hours, ROUND(SUM(IF(billable, 0, rounded)), 4) AS non_billable_hours,
       ROUND(SUM(IF(billable, rounded * IFNULL(rate, 0), 0)), 2) AS billable_amount, ROUND(SUM(IF(billable AND NOT billed, rounded * IFNULL(rate, 0), 0)), 2) AS uninvoiced_amount,
       ROUND(SUM(hours * IFNULL(cost_rate, 0)), 2) AS cost_amount, COUNT(*) FILTER (cost_rate IS NULL) AS entries_without_cost_rate
FROM t GROUP BY day, person, line
""",
    "project_budget": _LI + _TIME + f"""
, p AS (SELECT person, ROUND(SUM(hours), 4) AS hours, ROUND(SUM(rounded), 4) AS rounded_hours, ROUND(SUM(IF(billable, rounded, 0)), 4) AS billable_hours,
               ROUND(SUM(IF(billable, rounded * IFNULL(rate, 0), 0)), 2) AS billable_amount, ROUND(SUM(hours * IFNULL(cost_rate, 0)), 2) AS time_cost, MIN(day) AS lo, MAX(day) AS hi
        FROM t GROUP BY person),
e AS (SELECT person, SUM(tax * 2) AS expenses, SUM(IF(line % 2 = 0, tax * 2, 0)) AS billable FROM li WHERE l_returnflag = 'R' GROUP BY person),
i AS (SELECT person, SUM(qty * 3) AS amount FROM li WHERE line > 1 GROUP BY person),
j AS (SELECT s_suppkey AS project, s_suppkey % 4 = 0 AS fixed, s_suppkey * 1000.0::DOUBLE AS fee, s_suppkey * 500.0::DOUBLE AS budget, s_suppkey * 300.0::DOUBLE AS budget_spent,
             IF(s_nationkey % 2 = 0, 'EUR', 'USD') AS currency, p.*, IFNULL(CAST(e.expenses AS DOUBLE), 0) AS expenses, IFNULL(CAST(e.billable AS DOUBLE), 0) AS billable_expenses,
             IFNULL(CAST(i.amount AS DOUBLE), 0) AS invoiced_amount
      FROM supplier LEFT JOIN p ON p.person = s_suppkey LEFT JOIN e ON e.person = s_suppkey LEFT JOIN i ON i.person = s_suppkey),
r AS (SELECT *, IF(fixed, fee, IFNULL(billable_amount, 0) + billable_expenses) AS revenue FROM j)
SELECT project, fixed AS is_fixed_fee, fee, budget, budget_spent, currency, 'USD' AS account_currency, IFNULL(hours, 0) AS hours, IFNULL(rounded_hours, 0) AS rounded_hours,
       IFNULL(billable_hours, 0) AS billable_hours, IFNULL(billable_amount, 0) AS billable_amount, IFNULL(time_cost, 0) AS time_cost, {sql_date('lo')} AS first_entry_date,
       {sql_date('hi')} AS last_entry_date, expenses, billable_expenses, invoiced_amount, ROUND(budget - budget_spent, 2) AS budget_remaining,
       ROUND(budget_spent / NULLIF(budget, 0), 6) AS budget_used_pct, ROUND(revenue, 2) AS revenue,
       IF(currency = 'USD', ROUND(revenue - IFNULL(time_cost, 0) - expenses, 2), NULL) AS profit
FROM r
""",
    "paid_hours_daily": _LI + _PEOPLE + f"""
, l AS (SELECT li.*, unit, IF(unit % 2 = 0, CAST(timezone('{UNIT_ZONE}', (CAST(l_shipdate AS TIMESTAMP) + line * INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AS DATE),
                              CAST(CAST(l_shipdate AS TIMESTAMP) + line * INTERVAL 1 HOUR AS DATE)) AS pay_day
        FROM li LEFT JOIN people USING (person))
SELECT {sql_date('pay_day')} AS pay_date, unit, l_returnflag AS pay_type, l_linestatus AS entry_type, COUNT(*) AS pay_lines, COUNT(DISTINCT person) AS people_paid,
       ROUND(SUM(qty * 10) / 60.0, 2) AS paid_hours
FROM l GROUP BY {sql_date('pay_day')}, unit, l_returnflag, l_linestatus
""",
    "absence_days_daily": _LI + _PEOPLE + f"""
, a AS (SELECT DISTINCT order_id, line, person, day, qty, gross, discount, tax, l_linestatus FROM li WHERE l_returnflag = 'R'),
x AS (SELECT *, CAST(unnest(generate_series(day, day + line - 1, INTERVAL 1 DAY)) AS DATE) AS date FROM a)
SELECT {sql_date('date')} AS absence_date, unit, line % 4 AS absence_type, IF(isodow(date) >= 6, 'weekend', 'approved') AS day_status, COUNT(*) AS absence_days,
       COUNT(DISTINCT person) AS people_absent, COUNT(*) FILTER (tax > 0) AS paid_absence_days, COUNT(*) FILTER (l_linestatus = 'O' AND discount > 5) AS sickness_days_with_note
FROM x LEFT JOIN people USING (person) GROUP BY date, unit, line % 4, IF(isodow(date) >= 6, 'weekend', 'approved')
""",
    "covers_by_day": f"""
WITH r AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey % 20 AS venue, o_orderstatus AS shift, o_orderkey AS k, CAST(ROUND(o_totalprice * 100, 0) AS BIGINT) AS cents,
                  CASE WHEN o_orderkey % 10 = 0 THEN 'canceled' WHEN o_orderkey % 10 = 1 THEN 'no_show' WHEN o_orderkey % 97 > 0 THEN 'booked' END AS outcome FROM orders),
g AS (SELECT day, venue, shift, COUNT(*) AS reservations, COUNT(*) FILTER (outcome = 'canceled') AS canceled, COUNT(*) FILTER (outcome = 'no_show') AS no_shows,
             COUNT(*) FILTER (outcome <> 'canceled') AS kept, SUM(IF(outcome <> 'canceled', k % 8 + 1, 0)) AS covers_booked,
             SUM(IF(outcome = 'booked' AND k % 6 > 0, k % 8, 0)) AS covers_arrived, COUNT(*) FILTER (k % 5 = 0 AND outcome <> 'canceled') AS vip, SUM(cents) AS net_spend FROM r GROUP BY ALL)
SELECT {sql_date('day')} AS date, venue, shift, reservations, canceled, no_shows, kept AS reservations_not_canceled, CAST(covers_booked AS BIGINT) AS covers_booked,
       CAST(covers_arrived AS BIGINT) AS covers_arrived, vip AS vip_reservations, CAST(net_spend AS BIGINT) AS net_spend, ROUND(no_shows / NULLIF(kept, 0), 6) AS no_show_rate,
       ROUND(canceled / reservations, 6) AS cancellation_rate, ROUND(CAST(net_spend AS DOUBLE) / NULLIF(covers_arrived, 0), 6) AS net_spend_per_arrived_cover
FROM g
""",
    "guest_feedback": _LI + f"""
, f AS (SELECT day, person % 20 AS venue, l_linestatus AS feedback_type, l_returnflag, qty % 5 + 1 AS overall, IF(discount > 2, discount % 5 + 1, NULL) AS food, IF(tax > 0, tax % 5 + 1, NULL) AS service FROM li)
SELECT {sql_date('day')} AS day, venue, feedback_type, COUNT(*) AS feedback_received,
       {", ".join(f"CAST(SUM({x}) AS BIGINT) AS {x}_total, COUNT({x}) AS {x}_responses, ROUND(AVG({x}), 6) AS avg_{x}" for x in ("overall", "food", "service"))},
       COUNT(*) FILTER (l_returnflag = 'A') AS would_recommend, COUNT(*) FILTER (l_returnflag IN ('A', 'N')) AS recommend_responses
FROM f GROUP BY ALL
""",
    "app_stability": f"""
WITH e AS (SELECT CAST(ts AS DATE) AS date, CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 AS version, NULLIF(user_id % 4, 0) AS device, event_type,
                  CAST(floor(value * 60) AS BIGINT) AS s FROM events WHERE event_type IN ('view', 'error')),
g AS (SELECT date, version, device, COUNT(*) FILTER (event_type = 'view') AS sessions, CAST(IFNULL(SUM(s) FILTER (event_type = 'view'), 0) AS BIGINT) AS session_seconds,
             COUNT(*) FILTER (event_type = 'error') AS crashes FROM e GROUP BY ALL)
SELECT {sql_date('date')} AS date, version, device, sessions, session_seconds, crashes, ROUND(session_seconds / NULLIF(sessions, 0)::DOUBLE / 60, 2) AS avg_session_minutes,
       ROUND(crashes / NULLIF(sessions, 0)::DOUBLE * 1000, 2) AS crashes_per_1000_sessions
FROM g
""",
}
