"""Report operators on the edge rows listed for them in FIXTURES.md."""

import datetime as dt

from pyspark.sql import functions as F

from reportkit.operators import crm, ledger, payments, support

D, T = dt.date, dt.datetime


def test_payout_reconciliation_tolerance(spark):
    payouts = spark.createDataFrame([("p1", 100.0), ("p2", 100.0), ("p3", 100.0), ("p4", None)], "pid string, total double")
    tx = spark.createDataFrame([("p1", "sale", 100.01), ("p2", "sale", 100.02), ("p4", "sale", 5.0)],
                               "pid string, type string, amount double")
    got = {r.pid: (r.sale_difference, r.ties_out) for r in
           payments.reconcile_payouts(payouts, tx, "pid", {"sale": "total"}, "type", "amount").collect()}
    assert got["p1"] == (0.01, True) and got["p2"] == (0.02, False)
    assert got["p3"][1] is False  # no transactions
    assert got["p4"][1] is False  # NULL payout total -> not tied out


def test_nps_scores(spark):
    rows = [(s,) for s in [6.0, 7.0, 8.0, 9.0, 10.0, 11.0, -1.0, 7.5, None]]
    r = support.nps(spark.createDataFrame(rows, "score double"), "score", []).first()
    assert (r.promoters, r.passives, r.detractors, r.valid_responses, r.invalid_responses) == (2, 2, 1, 5, 4)
    assert r.nps == 20.0


def test_reply_waits_edges(spark):
    rows = [("t1", 1, "received"), ("t1", 2, "received"), ("t1", 3, "sent"),   # two received before a reply
            ("t2", 1, "sent"), ("t2", 2, "received"),                          # own message first, never answered
            ("t3", 1, "received"), ("t3", 2, "sent"), ("t3", 3, "received"), ("t3", 4, "sent")]
    df = spark.createDataFrame(rows, "th string, n long, dir string")
    got = sorted((r.th, r.waiting_since, r.replied_at) for r in
                 support.reply_waits(df, "th", "n", "dir", bucket=F.floor(F.col("n") / 2)).collect())
    assert got == [("t1", 1, 3), ("t2", 2, None), ("t3", 1, 2), ("t3", 3, 4)]


def test_stage_history_edges(spark):
    rows = [("d", "a", T(2024, 1, 1)), ("d", "a", T(2024, 1, 2)),   # repeated value compressed
            ("d", "b", T(2024, 1, 3)), ("d", None, T(2024, 1, 4)),  # NULL dropped
            ("d", "a", T(2024, 1, 5))]                               # return to an earlier stage, open last stage
    df = spark.createDataFrame(rows, "deal string, stage string, ts timestamp")
    out = crm.stage_history(df, "deal", "stage", "ts", "2024-01-06 00:00:00", {"a": 1, "b": 2}).orderBy("entered_at")
    got = [(r.stage, str(r.exited_at), r.hours_in_stage, r.is_current, r.moved_backwards) for r in out.collect()]
    assert got == [("a", "2024-01-03 00:00:00", 48.0, False, False), ("b", "2024-01-05 00:00:00", 48.0, False, True),
                   ("a", "None", 24.0, True, False)]


def test_fx_fill_and_cross(spark):
    rates = spark.createDataFrame([("EUR", D(2024, 1, 5), 0.9), ("EUR", D(2024, 1, 8), 0.8),   # weekend gap
                                   ("SEK", D(2024, 1, 5), 10.0)], "ccy string, d date, rate double")  # stops
    f = ledger.fill_rates(rates, "ccy", "d", "rate", "2024-01-08")
    got = {(r.ccy, str(r.rate_date)): (r.rate, str(r.source_date), r.is_carried_forward) for r in f.collect()}
    assert got[("EUR", "2024-01-07")] == (0.9, "2024-01-05", True)
    assert got[("EUR", "2024-01-08")] == (0.8, "2024-01-08", False)
    assert got[("SEK", "2024-01-08")] == (10.0, "2024-01-05", True)
    x = ledger.cross_rates(f, "ccy", "rate_date", "rate", "source_date", "is_carried_forward", base="USD")
    xr = {(r.from_currency, r.to_currency): (r.rate, r.rate_type) for r in x.where("rate_date = '2024-01-08'").collect()}
    assert xr[("EUR", "EUR")] == (1.0, "identity") and xr[("USD", "SEK")] == (10.0, "direct")
    assert xr[("SEK", "USD")] == (0.1, "inverse") and xr[("EUR", "SEK")][1] == "cross"


def test_trial_balance_quiet_month_and_bridge(spark):
    rows = [("c", "1100", D(2024, 1, 10), 100.0, 0.0), ("c", "1100", D(2024, 3, 2), 0.0, 30.0)]
    df = spark.createDataFrame(rows, "co string, acct string, d date, dr double, cr double")
    tb = ledger.trial_balance(df, "co", "acct", "d", "dr", "cr", "2024-04-15").orderBy("month").collect()
    assert [(str(r.month), r.opening_balance, r.movement, r.closing_balance) for r in tb] == [
        ("2024-01-01", 0.0, 100.0, 100.0), ("2024-02-01", 100.0, 0.0, 100.0),
        ("2024-03-01", 100.0, -30.0, 70.0), ("2024-04-01", 70.0, 0.0, 70.0)]


def test_ticket_never_answered(spark):
    tickets = spark.createDataFrame([("t1", 0), ("t2", 0)], "t string, created int")
    msgs = spark.createDataFrame([("t1", 1, "agent"), ("t2", 1, "customer")], "t string, n int, who string")
    got = {r.t: (r.first_reply_at, r.reply_count, r.is_answered) for r in
           support.ticket_lifecycle(tickets, msgs, "t", "created", "n", F.col("who") == "agent").collect()}
    assert got == {"t1": (1, 1, True), "t2": (None, 0, False)}


def test_contribution_margin_subset_keyed_reimbursements(spark):
    from reportkit.operators import commerce as cm
    k = ["d", "mkt", "sku"]
    sales = spark.createDataFrame([(D(2024, 1, 1), "de", "a", 100.0, 2.0), (D(2024, 1, 1), "fr", "a", 50.0, 1.0)],
                                  "d date, mkt string, sku string, revenue double, units double")
    fees = spark.createDataFrame([(D(2024, 1, 2), "de", "a", -5.0)], "d date, mkt string, sku string, fees double")
    reimb = spark.createDataFrame([(D(2024, 1, 1), "a", 7.0), (D(2024, 1, 3), "a", 3.0)], "d date, sku string, reimb double")
    cost = spark.createDataFrame([("a", D(2023, 1, 1), None, 10.0)], "sku string, valid_from date, valid_to date, unit_cost double")
    out = cm.contribution_margin([sales, fees], k, cost, "sku", "d", "units", ["revenue", "fees", "reimb"],
                                 subset_parts=[(reimb, ["d", "sku"])])
    got = sorted((str(r.d), r.mkt, r.revenue, r.fees, r.reimb, r.contribution_margin) for r in out.collect())
    assert got == [("2024-01-01", "de", 100.0, 0.0, 7.0, 87.0), ("2024-01-01", "fr", 50.0, 0.0, 7.0, 47.0),
                   ("2024-01-02", "de", 0.0, -5.0, 0.0, -5.0), ("2024-01-03", None, 0.0, 0.0, 3.0, 3.0)]


def test_mrr_snapshot_rules(spark):
    from reportkit.operators import revenue
    lines = spark.createDataFrame([
        ("c", D(2024, 1, 15), D(2024, 2, 29), 100.0),   # ends on Feb 29: not active on the Feb snapshot (exclusive end)
        ("c", D(2024, 4, 1), D(2024, 5, 31), 50.0),     # gap in March, back in April
        ("c", D(2024, 4, 10), D(2024, 5, 31), -80.0),   # credit note: April MRR floored at 0
        ("z", D(2024, 1, 1), D(2024, 1, 20), 0.004)],   # rounds to 0: never starts
        "k string, s date, e date, m double")
    out = {str(r.month): (str(r.snapshot_date), r.mrr)
           for r in revenue.mrr_by_customer_month(lines, "k", "s", "e", "m", "2024-05-20").where("k = 'c'").collect()}
    assert out == {"2024-01-01": ("2024-01-31", 100.0), "2024-02-01": ("2024-02-29", 0.0), "2024-03-01": ("2024-03-31", 0.0),
                   "2024-04-01": ("2024-04-30", 0.0), "2024-05-01": ("2024-05-20", 0.0)}
    assert revenue.mrr_by_customer_month(lines, "k", "s", "e", "m", "2024-05-20").where("k = 'z'").count() == 0


def test_rep_activity_multi_source_equals_single_scan(spark):
    rows = [("r1", T(2024, 1, 1, 9), "call"), ("r1", T(2024, 1, 3, 9), "mail"), ("r2", T(2024, 1, 2, 9), "call")]
    df = spark.createDataFrame(rows, "rep string, ts timestamp, kind string")
    a = crm.rep_activity({k: df.where(F.col("kind") == k) for k in ["call", "mail"]}, "rep", "ts", end="2024-01-04")
    b = crm.rep_activity_by_kind(df, "rep", "ts", "kind", ["call", "mail"], end="2024-01-04")
    cols = ["rep", "date", "call", "mail", "total_activities"]
    assert sorted(tuple(r) for r in a.select(*cols).collect()) == sorted(tuple(r) for r in b.select(*cols).collect())
    assert a.count() == 4 + 3  # r1: Jan 1-4, r2: Jan 2-4


def test_stage_history_pipeline_change_keeps_one_current_stage(spark):
    rows = [("d", "p", "b", T(2024, 1, 1)), ("d", "q", "a", T(2024, 1, 2)), ("e", "p", "b", T(2024, 1, 1)), ("e", "p", "a", T(2024, 1, 2))]
    df = spark.createDataFrame(rows, "deal string, pipe string, stage string, ts timestamp")
    out = crm.stage_history(df, "deal", "stage", "ts", "2024-01-06 00:00:00", {"a": 1, "b": 2}, pipeline="pipe").collect()
    assert sorted((r.deal, r.stage, r.next_stage or "", r.is_current, r.moved_backwards) for r in out) == [
        ("d", "a", "", True, False), ("d", "b", "a", False, False), ("e", "a", "", True, False), ("e", "b", "a", False, True)]


def test_refused_then_authorised_counts_as_authorised(spark):
    from reportkit.operators import payments as pm
    df = spark.createDataFrame([(T(2024, 1, 2), T(2024, 1, 1), 5.0), (None, T(2024, 1, 1), None)], "a timestamp, r timestamp, amt double")
    r = pm.decision_rate(df, "date", [], "a", "r", "amt").collect()
    assert [(x.decided, x.authorised, x.refused, x.authorised_amount, x.authorisation_rate) for x in r] == [(2, 1, 1, 5.0, 0.5)]


def test_null_dims_and_upper_case_addresses(spark):
    from reportkit.operators import marketing as mk
    from reportkit.operators import support as sp
    tags = spark.createDataFrame([(1, "x", None), (2, "x", None), (2, "y", None)], "id int, topic string, dim string")
    assert {(r.topic, r.topic_share) for r in sp.topic_share(tags, "id", "topic", ["dim"]).collect()} == {("x", 1.0), ("y", 0.5)}
    mails = spark.createDataFrame([("m", "To A@X.COM and a@x.com")], "m string, text string")
    assert [(r.address, r.messages) for r in mk.correspondents(mails, ["m"], "text").collect()] == [("a@x.com", 1)]


def test_clock_text_headcount_and_facts_after_the_grid(spark):
    import datetime as dt
    from reportkit.functions.columns import parse_hhmm
    from reportkit.operators import operations as op
    from reportkit.operators.timegrid import densify
    c = spark.createDataFrame([("1:5",), ("1000:00",), ("12:75",), (" 7:05 ",), ("7:5x",), ("",), (None,)], "t string")
    assert [r.m for r in c.select(parse_hhmm("t").alias("m")).collect()] == [65, 60000, 795, 425, None, None, None]
    p = spark.createDataFrame([("a", dt.date(2024, 1, 3), None, "o"), ("b", dt.date(2025, 1, 3), None, "o")],
                              "p string, s date, e date, org string")
    assert {(str(r.month), r.headcount_end) for r in op.headcount(p, "p", "org", "s", "e", "2024-02-10").collect()} == {
        ("2024-01-01", 1), ("2024-02-01", 1)}
    f = spark.createDataFrame([("k", dt.date(2024, 1, 1), 1), ("k", dt.date(2024, 1, 4), 2)], "k string, d date, v int")
    assert sorted(r.v for r in densify(f, "k", "d", ["v"], end="2024-01-02").collect()) == [0, 0, 1, 2]
