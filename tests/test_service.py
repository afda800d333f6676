"""Edge cases of the restaurant, coaching, time, workforce, reservation and stability reports."""

from datetime import date, datetime

from pyspark.sql import functions as F

from reportkit.operators import service as sv

D = date(2024, 1, 1)


def test_sales_summary_sums_each_fact_per_order_before_they_meet(spark):
    o = spark.createDataFrame([(1, D, "a", False, 2), (2, D, "a", None, None), (3, D, "a", True, 9), (4, None, None, False, 1)],
                              "o int, day date, area string, voided boolean, guests int")
    ch = spark.createDataFrame([(1, 100, False), (1, 50, False), (1, 999, True), (3, 5, False)], "o int, amount long, voided boolean")
    it = spark.createDataFrame([(1, 1, 100, 90, 9, 0, False, False), (1, 2, 50, 50, 5, 10, False, None), (1, 1, 30, 30, 0, 0, True, False),
                                (1, 7, 700, 700, 70, 0, False, True), (3, 1, 1, 1, 1, 1, False, False)],
                               "o int, quantity long, gross long, net long, tax long, refund long, deferred boolean, voided boolean")
    cg = spark.createDataFrame([(1, 20, True), (1, 3, False), (1, 4, False)], "o int, amount long, gratuity boolean")
    pay = spark.createDataFrame([(1, 150, 15, "CAPTURED"), (1, 500, 50, "DENIED"), (1, 10, None, "OPEN")], "o int, amount long, tip long, status string")
    got = {r.business_date: r for r in sv.sales_summary(o, ch, it, cg, pay, "o", "day", ["area"]).collect()}
    r = got[D]
    assert (r.orders, r.guests, r.checks, r.check_amount) == (2, 2, 2, 150)
    assert (r.items_sold, r.gross_sales, r.net_sales, r.discounts, r.deferred_sales, r.refunds, r.net_sales_after_refunds, r.tax) == (3, 150, 140, 10, 30, 10, 130, 14)
    assert (r.service_charges, r.gratuities, r.payments, r.tips) == (7, 20, 160, 15)
    assert (got[None].orders, got[None].net_sales, got[None].payments) == (1, 0, 0)


def test_rep_calls_have_a_row_for_every_rep_and_day(spark):
    c = spark.createDataFrame([(1, datetime(2024, 1, 2, 9), "External", "Inbound", 60, True), (None, datetime(2024, 1, 3), "Internal", None, None, None),
                               (1, None, "External", "Inbound", 5, True)], "rep long, ts timestamp, scope string, dir string, s long, linked boolean")
    reps = spark.createDataFrame([(1,), (7,)], "rep long")
    got = {(r.rep, r.date.day): r for r in sv.rep_calls_by_day(c, reps, "rep", "ts", "scope", "dir", "s", "2024-01-04", F.col("linked")).collect()}
    assert len(got) == 9 and {k[0] for k in got} == {"1", "7", "unknown"}
    assert (got["1", 2].calls, got["1", 2].external_call_seconds, got["1", 2].calls_linked_to_deal) == (1, 60, 1)
    assert (got["unknown", 3].calls, got["unknown", 3].call_seconds, got["unknown", 3].internal_calls) == (1, 0, 1) and got["7", 4].calls == 0


def test_scorecards_are_counted_from_headers_and_scores_use_the_answered_revision(spark):
    h = spark.createDataFrame([(1, "r", "s", datetime(2024, 1, 5), 10, "x"), (2, "r", "s", datetime(2024, 1, 9), 10, "y"), (3, "r", "s", None, 11, "z")],
                              "card int, rep string, sc string, at timestamp, call int, by string")
    a = spark.createDataFrame([(1, "q1", 1, 4.0, True, False), (1, "q2", 1, 2.0, False, False), (1, "q2", 2, 8.0, False, False), (1, "q3", 1, 1.0, False, True),
                               (1, "q4", 9, 3.0, False, False), (3, "q1", 1, 9.0, True, False), (1, "q5", 1, None, False, False)],
                              "card int, q string, rev int, score double, is_overall boolean, not_applicable boolean")
    q = spark.createDataFrame([("q1", 1, 0, 5), ("q2", 1, 0, 4), ("q2", 2, 0, 10)], "q string, rev int, min_range int, max_range int")
    r = sv.scorecard_scores(h, a, q, "card", "rep", "sc", "at", "call", "by", ["q", "rev"]).collect()
    assert len(r) == 1 and (r[0].scorecards_answered, r[0].calls_reviewed, r[0].reviewers, r[0].scored_answers) == (2, 1, 2, 3)
    assert (r[0].avg_overall_score, r[0].avg_overall_score_normalised) == (4.0, 0.8)
    assert r[0].avg_question_score == round(13 / 3, 6) and r[0].avg_question_score_normalised == 0.65       # (0.5 + 0.8) / 2: no range for q4


def test_interaction_means_and_weighted_ratio_differ_and_quiet_weeks_have_no_row(spark):
    c = spark.createDataFrame([("r", date(2024, 1, 3), True, 10, 100, 1.0), ("r", date(2024, 1, 7), True, 9, 10, None), ("r", date(2024, 1, 8), False, 1, 1, 1.0),
                               ("r", date(2024, 1, 2), True, 0, 0, 3.0), (None, date(2024, 1, 2), True, 1, 1, 1.0)], "rep string, d date, ext boolean, t long, n long, p double")
    r = sv.rep_interaction_by_week(c, "rep", "d", F.col("ext"), "t", "n", ["p"]).collect()
    assert len(r) == 1 and (r[0].week_start, r[0].external_calls, r[0].talk_ratio_calls) == (D, 3, 2)
    assert (r[0].avg_talk_ratio, r[0].weighted_talk_ratio, r[0].avg_p) == (0.5, round(19 / 110, 6), 2.0)


TIME = "u string, project string, day date, hours double, rounded_hours double, billable boolean, billed boolean, rate double, cost_rate double"


def test_time_report_and_project_budget(spark):
    e = spark.createDataFrame([("a", "p", D, 1.1, 1.25, True, False, 100.0, 50.0), ("a", "p", D, 2.0, 2.0, False, False, 100.0, None),
                               ("a", "p", D, 1.0, 1.0, True, True, None, 10.0), ("a", "x", D, 1.0, 1.0, None, None, 5.0, None)], TIME)
    t = {r.project: r for r in sv.time_report(e, ["u", "project"], "day").collect()}
    p = t["p"]
    assert (p.time_entries, p.hours, p.billable_hours, p.non_billable_hours, p.billable_amount, p.uninvoiced_amount) == (3, 4.1, 2.25, 2.0, 125.0, 125.0)
    assert (p.cost_amount, p.entries_without_cost_rate, t["x"].billable_amount) == (65.0, 1, 0.0)
    pr = spark.createDataFrame([("p", False, 9.0, 200.0, 50.0, "USD", "USD"), ("f", True, 900.0, 0.0, 5.0, "USD", "USD"), ("e", True, 7.0, None, None, "EUR", "USD")],
                               "project string, is_fixed_fee boolean, fee double, budget double, budget_spent double, currency string, account_currency string")
    ex = spark.createDataFrame([("p", 10.0, True), ("p", 4.0, False)], "project string, total_cost double, billable boolean")
    inv = spark.createDataFrame([("p", 60.0, "open"), ("p", 1.0, "draft"), ("p", 2.0, "paid")], "project string, amount double, state string")
    b = {r.project: r for r in sv.project_budget(pr, e, ex, inv, "project", "day").collect()}
    assert (b["p"].revenue, b["p"].profit, b["p"].invoiced_amount, b["p"].budget_used_pct, b["p"].budget_remaining) == (135.0, 56.0, 62.0, 0.25, 150.0)
    assert (b["f"].revenue, b["f"].profit, b["f"].budget_used_pct, b["f"].hours) == (900.0, 900.0, None, 0.0)
    assert b["e"].profit is None and b["e"].first_entry_date is None


def test_paid_hours_fall_on_the_units_local_day(spark):
    li = spark.createDataFrame([("a", datetime(2024, 1, 2, 3), 90, "x"), ("b", datetime(2024, 1, 2, 3), 30, "x"), ("z", datetime(2024, 1, 2, 3), 60, "x")],
                               "person string, ts timestamp, m long, kind string")
    people = spark.createDataFrame([("a", 1), ("b", 2), ("n", None)], "person string, unit int")
    units = spark.createDataFrame([(1, "America/New_York"), (2, None)], "unit int, timezone string")
    got = sorted((str(r.pay_date), r.unit, r.paid_hours, r.people_paid) for r in sv.hours_daily(li, people, units, "person", "unit", "ts", "m", ["kind"]).collect()
                 if r.unit is not None)
    assert got == [("2024-01-01", 1, 1.5, 1), ("2024-01-02", 2, 0.5, 1)]


def test_absences_of_unknown_people_and_unknown_absences(spark):
    days = spark.createDataFrame([(1, D, "ok"), (1, D, "ok"), (2, D, "ok"), (9, D, "ok")], "a int, d date, st string")
    ab = spark.createDataFrame([(1, "p", "t", True, True, False), (2, "q", "t", None, True, True)], "a int, person string, kind string, paid boolean, sick boolean, note boolean")
    people = spark.createDataFrame([("p", 5)], "person string, unit int")
    got = {r.unit: (r.absence_days, r.people_absent, r.paid_absence_days, r.sickness_days_with_note)
           for r in sv.absence_daily(days, ab, people, "a", "person", "unit", "d", "kind", "st").collect()}
    assert got == {5: (2, 1, 2, 0), None: (1, 1, 0, 1)}


def test_covers_feedback_and_stability(spark):
    r = spark.createDataFrame([(D, "booked", 4, 3, True, 100.0), (D, "canceled", 2, None, True, None), (D, "no_show", 5, 1, False, None), (D, None, 9, 9, True, 1.0)],
                              "d date, o string, p long, a long, v boolean, s double")
    c = sv.covers_by_day(r, "d", [], "o", "p", "a", "v", "s").first()
    assert (c.reservations, c.canceled, c.no_shows, c.reservations_not_canceled, c.covers_booked, c.covers_arrived, c.vip_reservations) == (4, 1, 1, 2, 9, 3, 1)
    assert (c.no_show_rate, c.cancellation_rate) == (0.5, 0.25)
    f = spark.createDataFrame([("a", 5, None, "Yes"), ("a", 2, None, None), ("a", None, None, "0")], "v string, x int, y int, rec string")
    g = sv.feedback(f, ["v"], ["x", "y"], "rec").first()
    assert (g.feedback_received, g.x_total, g.x_responses, g.avg_x, g.avg_y, g.would_recommend, g.recommend_responses) == (3, 7, 2, 3.5, None, 1, 2)
    s = spark.createDataFrame([(D, "1", 4, 600), (D, None, 1, 60)], "d date, ver string, n long, sec long")
    k = spark.createDataFrame([(D, "1", 2), (D, "2", 7), (D, None, 1)], "d date, ver string, k long")
    got = {x.ver: (x.sessions, x.crashes, x.avg_session_minutes, x.crashes_per_1000_sessions) for x in sv.stability(s, k, ["d", "ver"], "n", "sec", "k").collect()}
    assert got == {"1": (4, 2, 2.5, 500.0), "2": (0, 7, None, None), None: (1, 1, 1.0, 1000.0)}
