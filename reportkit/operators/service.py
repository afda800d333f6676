"""Restaurant, call-coaching, time-tracking, workforce, reservation and app-stability reports (D29, D74, D95, D98, D99, D102).

Facts of unlike grain are each summed to the key they meet on before they are joined, so none multiplies another; every
sum of a rate keeps its numerator and count, so that longer periods can be built from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c_, ratio, rnd, week_start
from .joins import enrich, join_ns
from .sets import union_events

__all__ = ["sales_summary", "rep_calls_by_day", "scorecard_scores", "rep_interaction_by_week", "time_report", "project_budget",
           "hours_daily", "absence_daily", "covers_by_day", "feedback", "stability"]

# Payment states that moved no money.
DEAD_PAYMENTS = ["VOIDED", "DENIED", "CANCELLED", "ERROR"]


def _day(ts, zone: Column | None = None) -> Column:
    t = c_(ts).cast("timestamp")
    return F.to_date(t if zone is None else F.from_utc_timestamp(t, F.coalesce(zone, F.lit("UTC"))))


def _sum_if(cond, c) -> Column:
    return F.sum(F.when(cond, c_(c)).otherwise(0))


def sales_summary(orders: DataFrame, checks: DataFrame, items: DataFrame, charges: DataFrame, payments: DataFrame, order: str,
                  day: str, dims: list[str], guests: str = "guests") -> DataFrame:
    """Orders, checks, guests, items and money per business day x dims.

    Inputs share ``order``; ``orders`` and ``items`` may carry ``voided``, ``checks`` has ``amount`` and ``voided``, items
    ``quantity, gross, net, tax, refund, deferred``, charges ``amount, gratuity``, payments ``amount, tip, status``. Voided
    orders, checks and items do not count; deferred items (gift cards) are no sale but stand in a column of their own; payments
    in a dead state (``DEAD_PAYMENTS``) brought nothing. All four facts are stacked with their measures and summed per order
    in one aggregate before they meet the orders. An order without facts counts with zeros. Amounts are whole cents.
    """
    live = lambda d: d.where(~F.coalesce(F.col("voided"), F.lit(False))) if "voided" in d.columns else d
    it, deferred = live(items), F.coalesce(F.col("deferred"), F.lit(False))
    kept = lambda c, yes: F.when(deferred if yes else ~deferred, F.col(c)).otherwise(0)
    facts = union_events({
        "check": live(checks).select(order, F.lit(1).alias("checks"), F.col("amount").alias("check_amount")),
        "item": it.select(order, kept("quantity", False).alias("items_sold"), kept("gross", False).alias("gross_sales"),
                          kept("net", False).alias("net_sales"), kept("net", True).alias("deferred_sales"), "tax", F.col("refund").alias("refunds")),
        "charge": charges.select(order, F.when(~F.col("gratuity"), F.col("amount")).alias("service_charges"),
                                 F.when(F.col("gratuity"), F.col("amount")).alias("gratuities")),
        "payment": payments.where(~F.col("status").isin(DEAD_PAYMENTS)).select(order, F.col("amount").alias("payments"), F.col("tip").alias("tips"))})
    measures = ["checks", "items_sold", "gross_sales", "net_sales", "refunds", "deferred_sales", "tax", "service_charges", "gratuities", "tips",
                "payments", "check_amount"]
    per = facts.groupBy(order).agg(*[F.sum(m).alias(m) for m in measures])
    o = live(orders).join(per, order, "left")
    g = o.groupBy(F.col(day).alias("business_date"), *dims).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.coalesce(guests, F.lit(0))).alias("guests"), *[F.sum(F.coalesce(m, F.lit(0))).alias(m) for m in measures])
    return g.withColumns({"discounts": F.col("gross_sales") - F.col("net_sales"), "net_sales_after_refunds": F.col("net_sales") - F.col("refunds")})


def rep_calls_by_day(calls: DataFrame, reps: DataFrame, rep: str, ts: str, scope: str, direction: str, seconds: str, as_of,
                     linked: Column | None = None) -> DataFrame:
    """Calls of every rep on every day from the first call to ``as_of``; a quiet day is a row of zeros. Reps are those
    who called and those of ``reps``; calls without a rep belong to 'unknown', calls without a time are left out."""
    m = lambda c: F.coalesce(F.col(c), F.lit(0))
    c = calls.where(F.col(ts).isNotNull()).withColumn(rep, F.coalesce(F.col(rep).cast("string"), F.lit("unknown")))
    external = F.col(scope) == "External"
    d = c.groupBy(rep, _day(ts).alias("date")).agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(external).alias("external_calls"), F.count_if(F.col(scope) == "Internal").alias("internal_calls"),
        *[F.count_if(F.col(direction) == x).alias(f"{x.lower()}_calls") for x in ("Inbound", "Outbound", "Conference")],
        F.sum(m(seconds)).alias("call_seconds"), _sum_if(external, m(seconds)).alias("external_call_seconds"),
        (F.count_if(linked) if linked is not None else F.lit(0).cast("long")).alias("calls_linked_to_deal"))
    first = d.agg(F.min("date").alias("_lo"))                                   # one row
    people = d.select(rep).unionByName(reps.select(F.col(rep).cast("string").alias(rep))).distinct()
    grid = people.crossJoin(F.broadcast(first)).select(rep, F.explode(F.sequence("_lo", F.greatest(F.col("_lo"), F.lit(as_of).cast("date")))).alias("date"))
    out = grid.join(d, [rep, "date"], "left")
    return out.fillna(0, [x for x in d.columns if x not in (rep, "date")])


def scorecard_scores(headers: DataFrame, answers: DataFrame, questions: DataFrame, card: str, reviewed: str, scorecard: str, at: str,
                     call: str, reviewer: str, question: list[str]) -> DataFrame:
    """Scorecards per month x reviewed rep x scorecard.

    Reviews are counted from the headers, so a scorecard with only free-text answers counts; scores come from the answers
    (``score, is_overall, not_applicable``) and are also normalised to 0..1 by the range (``min_range, max_range``) of the
    question in the revision that was answered (``question``: its key columns; unknown revision or empty range: no
    normalised score). Headers without a time are left out.
    """
    h = headers.where(F.col(at).isNotNull()).withColumn("review_month", F.to_date(F.date_trunc("month", F.col(at).cast("timestamp"))))
    keys = ["review_month", reviewed, scorecard]
    counts = h.groupBy(*keys).agg(F.count(F.lit(1)).alias("scorecards_answered"), F.count_distinct(call).alias("calls_reviewed"),
                                  F.count_distinct(reviewer).alias("reviewers"))
    a = answers.where(~F.coalesce(F.col("not_applicable"), F.lit(False)) & F.col("score").isNotNull())
    a = enrich(a, questions, question, cols=["min_range", "max_range"])
    a = a.withColumn("_norm", ratio(F.col("score") - F.col("min_range"), F.col("max_range") - F.col("min_range")))
    overall = F.col("is_overall")
    # answers are summed per card before they meet the headers
    per = a.groupBy(card).agg(*[x for n, cond in (("o", overall), ("q", ~overall)) for x in (
        F.sum(F.when(cond, F.col("score"))).alias(f"_{n}s"), F.count(F.when(cond, F.col("score"))).alias(f"_{n}n"),
        F.sum(F.when(cond, F.col("_norm"))).alias(f"_{n}ns"), F.count(F.when(cond, F.col("_norm"))).alias(f"_{n}nn"))])
    s = h.select(card, *keys).join(per, card).groupBy(*keys).agg(*[F.sum(x).alias(x) for x in per.columns if x != card])
    mean = lambda n: rnd(ratio(f"_{n}s", f"_{n}n"), 6)
    return join_ns(counts, s, keys, "left").select(
        *counts.columns, F.coalesce("_qn", F.lit(0)).alias("scored_answers"), mean("o").alias("avg_overall_score"),
        rnd(ratio("_ons", "_onn"), 6).alias("avg_overall_score_normalised"), mean("q").alias("avg_question_score"),
        rnd(ratio("_qns", "_qnn"), 6).alias("avg_question_score_normalised"))


def rep_interaction_by_week(calls: DataFrame, rep: str, date: str, external: Column, talk: str, total: str, stats: list[str]) -> DataFrame:
    """External calls per ISO week x rep: the mean of each statistic over the calls that have it, the mean talk ratio per
    call with its sum and count, and the talk ratio weighted by talk time. Calls without a date or rep are left out; a week
    without calls has no row, because a zero would read as a ratio."""
    c = calls.where(external & F.col(date).isNotNull() & F.col(rep).isNotNull()).withColumn("_ratio", ratio(talk, total))
    g = c.groupBy(week_start(F.col(date), 2).alias("week_start"), rep).agg(
        F.count(F.lit(1)).alias("external_calls"), F.count("_ratio").alias("talk_ratio_calls"), rnd(F.sum("_ratio"), 6).alias("talk_ratio_sum"),
        rnd(F.avg("_ratio"), 6).alias("avg_talk_ratio"), F.sum(talk).alias("rep_talk"), F.sum(total).alias("total_talk"),
        *[rnd(F.avg(s), 6).alias(f"avg_{s}") for s in stats])
    return g.withColumn("weighted_talk_ratio", rnd(ratio("rep_talk", "total_talk"), 6))


def _time(entries: DataFrame, keys: list, extra=()) -> DataFrame:
    """Hours, billable hours and money of time entries (``hours, rounded_hours, billable, billed, rate, cost_rate``)."""
    bill, rounded = F.coalesce(F.col("billable"), F.lit(False)), F.col("rounded_hours")
    worth = rounded * F.coalesce("rate", F.lit(0))
    return entries.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("time_entries"), rnd(F.sum("hours"), 4).alias("hours"), rnd(F.sum(rounded), 4).alias("rounded_hours"),
        rnd(_sum_if(bill, rounded), 4).alias("billable_hours"), rnd(_sum_if(~bill, rounded), 4).alias("non_billable_hours"),
        rnd(_sum_if(bill, worth), 2).alias("billable_amount"),
        rnd(_sum_if(bill & ~F.coalesce(F.col("billed"), F.lit(False)), worth), 2).alias("uninvoiced_amount"),
        rnd(F.sum(F.col("hours") * F.coalesce("cost_rate", F.lit(0))), 2).alias("cost_amount"),
        F.count_if(F.col("cost_rate").isNull()).alias("entries_without_cost_rate"), *extra)


def time_report(entries: DataFrame, dims: list[str], spent: str) -> DataFrame:
    """Hours and money per day x dims (user, project, task). Billable money is rounded hours x billable rate, in the client's
    currency; cost is hours x cost rate, in the account's: the two do not add up across currencies."""
    return _time(entries, [_day(spent).alias("spent_date"), *dims])


def project_budget(projects: DataFrame, entries: DataFrame, expenses: DataFrame, invoiced: DataFrame, project: str, spent: str,
                   currency: str = "currency", account_currency: str = "account_currency") -> DataFrame:
    """Budget, spend and profit of every project over its whole life.

    ``projects``: ``is_fixed_fee, fee, budget, budget_spent`` and the client's and the account's currency; ``expenses``:
    ``total_cost, billable``; ``invoiced``: ``amount, state`` (open and paid ones count). Revenue is the fee, or billable time plus
    billable expenses; profit is NULL where the two currencies differ. Each fact is summed per project before the join.
    """
    t = _time(entries, [project], [F.min(_day(spent)).alias("first_entry_date"), F.max(_day(spent)).alias("last_entry_date")])
    t = t.select(project, "hours", "rounded_hours", "billable_hours", "billable_amount", F.col("cost_amount").alias("time_cost"), "first_entry_date", "last_entry_date")
    e = expenses.groupBy(project).agg(rnd(F.sum("total_cost"), 2).alias("expenses"), rnd(_sum_if(F.col("billable"), "total_cost"), 2).alias("billable_expenses"))
    i = invoiced.where(F.col("state").isin("open", "paid")).groupBy(project).agg(rnd(F.sum("amount"), 2).alias("invoiced_amount"))
    j = projects.join(t, project, "left").join(e, project, "left").join(i, project, "left")
    j = j.fillna(0.0, ["hours", "rounded_hours", "billable_hours", "billable_amount", "time_cost", "expenses", "billable_expenses", "invoiced_amount"])
    revenue = F.when(F.col("is_fixed_fee"), F.col("fee")).otherwise(F.col("billable_amount") + F.col("billable_expenses"))
    return j.withColumns({
        "budget_remaining": rnd(F.col("budget") - F.col("budget_spent"), 2), "budget_used_pct": ratio("budget_spent", "budget", digits=6),
        "revenue": rnd(revenue, 2),
        "profit": F.when(F.col(currency) == F.col(account_currency), rnd(revenue - F.col("time_cost") - F.col("expenses"), 2))})


def hours_daily(lines: DataFrame, people: DataFrame, units: DataFrame, person: str, unit: str, starts: str, minutes: str,
                dims: list[str]) -> DataFrame:
    """Paid hours per local day x home unit x dims (pay and entry type): lines, people, hours. The day is that of the home
    unit's ``timezone`` (UTC if it has none); a person without a unit counts under NULL."""
    j = enrich(enrich(lines, people, person, cols=[unit]), units, unit, cols=["timezone"])
    return j.groupBy(_day(starts, F.col("timezone")).alias("pay_date"), unit, *dims).agg(
        F.count(F.lit(1)).alias("pay_lines"), F.count_distinct(person).alias("people_paid"), rnd(F.sum(minutes) / 60.0, 2).alias("paid_hours"))


def absence_daily(days: DataFrame, absences: DataFrame, people: DataFrame, absence: str, person: str, unit: str, date: str, kind: str,
                  status: str) -> DataFrame:
    """Absence days per day x home unit x type x day status: days, people, paid days, sickness days with a note.
    ``absences``: ``paid, sick, note``. Days of an unknown absence are left out."""
    j = days.join(absences, absence).join(people.select(person, unit), person, "left")
    return j.groupBy(F.col(date).alias("absence_date"), unit, kind, status).agg(
        F.count(F.lit(1)).alias("absence_days"), F.count_distinct(person).alias("people_absent"), F.count_if("paid").alias("paid_absence_days"),
        F.count_if(F.col("sick") & F.col("note")).alias("sickness_days_with_note"))


def covers_by_day(reservations: DataFrame, date: str, dims: list[str], outcome: str, party: str, arrived: str, vip: str, spend: str) -> DataFrame:
    """Reservations and covers per day x dims: what was booked, cancelled, missed, who arrived, and spend per arrived cover.
    Days ahead show what is on the books. A reservation without outcome is neither cancelled nor kept, but is a reservation."""
    o = F.col(outcome)
    kept, came = o != "canceled", _sum_if(o == "booked", F.coalesce(arrived, F.lit(0)))
    g = reservations.groupBy(F.col(date).alias("date"), *dims).agg(
        F.count(F.lit(1)).alias("reservations"), F.count_if(o == "canceled").alias("canceled"), F.count_if(o == "no_show").alias("no_shows"),
        F.count_if(kept).alias("reservations_not_canceled"), _sum_if(kept, party).alias("covers_booked"), came.alias("covers_arrived"),
        F.count_if(F.col(vip) & kept).alias("vip_reservations"), F.sum(spend).alias("net_spend"))
    return g.withColumns({"no_show_rate": ratio("no_shows", "reservations_not_canceled", digits=6),
                          "cancellation_rate": ratio("canceled", "reservations", digits=6),
                          "net_spend_per_arrived_cover": ratio("net_spend", "covers_arrived", digits=6)})


def feedback(df: DataFrame, dims: list[str], ratings: list[str], recommend: str) -> DataFrame:
    """Per dims the sum, number and mean of each rating (guests skip questions), and who would recommend."""
    g = df.groupBy(*dims).agg(F.count(F.lit(1)).alias("feedback_received"),
                              *[x for r in ratings for x in (F.sum(r).alias(f"{r}_total"), F.count(r).alias(f"{r}_responses"))],
                              F.count_if(F.lower(recommend).isin("true", "yes", "1")).alias("would_recommend"),
                              F.count(recommend).alias("recommend_responses"))
    return g.withColumns({f"avg_{r}": ratio(f"{r}_total", f"{r}_responses", digits=6) for r in ratings})


def stability(sessions: DataFrame, crashes: DataFrame, keys: list[str], count: str, seconds: str, crashed: str) -> DataFrame:
    """D102: sessions and crashes per keys (day, version, device): each summed first, then merged, so a version that only
    crashed keeps its row; mean session minutes and crashes per 1,000 sessions (NULL without sessions)."""
    s = sessions.groupBy(*keys).agg(F.sum(count).alias("sessions"), F.sum(seconds).alias("session_seconds"))
    c = crashes.groupBy(*keys).agg(F.sum(crashed).alias("crashes"))
    j = join_ns(s, c, keys, "full").fillna(0, ["sessions", "session_seconds", "crashes"])
    return j.withColumns({"avg_session_minutes": rnd(ratio("session_seconds", "sessions") / 60, 2),
                          "crashes_per_1000_sessions": rnd(ratio("crashes", "sessions") * 1000, 2)})
