"""Ledger, trial balances, aging, exchange rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import band, rnd
from .joins import anti_join, bounded_broadcast, range_join


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def _d(c):
    return F.to_date(F.col(c).cast("timestamp")) if isinstance(c, str) else c


def general_ledger(lines: DataFrame, accounts: DataFrame, account: str, debit: str, credit: str,
                   natural_side: str = "natural_side", groups: DataFrame | None = None,
                   deleted: DataFrame | None = None, doc_key: str | None = None) -> DataFrame:
    """Posted lines + account attributes; deleted documents removed (anti-join);
    account-range group (``[from, to]`` range join on the account number); amount also
    signed to the account's natural side (debit-normal: debit - credit)."""
    gl = lines if deleted is None else anti_join(lines, deleted, doc_key)
    acc = accounts
    if groups is not None:
        # the range join runs on the chart of accounts (a dimension), never on the lines
        g = range_join(accounts.select(account).withColumn("_acct_no", F.col(account).try_cast("int")),
                       groups, None, "_acct_no", "range_from", "range_to", "[]", seed=True)
        acc = acc.join(g.drop("_acct_no", "range_from", "range_to"), account, "left")
    # the enriched chart of accounts is a small dimension (checked): the lines are not shuffled on
    # their few, heavy accounts
    gl = gl.join(bounded_broadcast(acc), account, "left")
    amount = F.col(debit) - F.col(credit)
    return gl.withColumns({"net_amount": rnd(amount, 2),
                           "natural_amount": rnd(F.when(F.col(natural_side) == "credit", -amount).otherwise(amount), 2)})


def trial_balance(ledger: DataFrame, entity, account: str, date: str, debit: str, credit: str,
                  as_of) -> DataFrame:
    """Account x month opening, debit, credit, closing on a dense grid.

    Months run from the entity's first month to greatest(its last month, as_of
    month); every account that ever moved gets every month. Closing is the running
    sum of movements (no fiscal reset), opening = closing - movement. The grid is
    generated per (entity, account) row and the running sum is a window per
    (entity, account) over months -- bounded by the calendar, not by the data.
    """
    ent = _l(entity)
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    from .timegrid import densify
    m = ledger.groupBy(*ent, account, F.trunc(_d(date), "month").alias("month")).agg(
        F.sum(debit).alias("debit"), F.sum(credit).alias("credit"))
    # every account of an entity spans the entity's months (windows over the entity's
    # aggregated account-months, bounded by accounts x calendar); one pass (densify)
    we = Window.partitionBy(*ent)
    g = densify(m, ent + [account], "month", ["debit", "credit"], step="month", fill=0.0,
                start=F.min("month").over(we), end=F.greatest(F.max("month").over(we), F.trunc(a, "month")))
    g = g.withColumn("movement", F.col("debit") - F.col("credit"))
    w = Window.partitionBy(*ent, account).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("closing_balance", F.sum("movement").over(w))
    return g.select(*ent, account, "month", rnd(F.col("closing_balance") - F.col("movement"), 2).alias("opening_balance"),
                    rnd("debit", 2).alias("debit"), rnd("credit", 2).alias("credit"),
                    rnd("movement", 2).alias("movement"), rnd("closing_balance", 2).alias("closing_balance"))


def fiscal_trial_balance(tb: DataFrame, entity, account: str, is_pnl: str, fiscal_start_month: int = 1,
                         equity_account: str = "retained_earnings") -> DataFrame:
    """P&L accounts show fiscal year-to-date, balance-sheet accounts cumulative;
    an equity row per month carries the P&L of earlier fiscal years, so each month sums
    to zero again."""
    from ..functions.columns import fiscal_year_start
    from .sets import append_row
    ent = _l(entity)
    fy = fiscal_year_start(F.col("month"), fiscal_start_month)
    t = tb.withColumn("fiscal_year_start", fy)
    w = Window.partitionBy(*ent, account, "fiscal_year_start").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_ytd", F.sum("movement").over(w))
    t = t.withColumn("reported_balance", rnd(F.when(F.col(is_pnl), F.col("_ytd")).otherwise(F.col("closing_balance")), 2))
    eq = (t.where(F.col(is_pnl)).groupBy(*ent, "month", "fiscal_year_start")
          .agg(rnd(F.sum(F.col("closing_balance") - F.col("_ytd")), 2).alias("reported_balance"))
          .withColumns({account: F.lit(equity_account), is_pnl: F.lit(False)}))
    keep = [*ent, account, "month", "fiscal_year_start", is_pnl, "reported_balance"]
    return append_row(t.select(*keep), eq.select(*keep))


def profit_and_loss(ledger: DataFrame, keys: list[str], date: str, amount: str, classes: list[str],
                    class_col: str, closing_docs: DataFrame | None = None, doc_key: str | None = None) -> DataFrame:
    """Month x account for income-statement classes, sign-flipped (income positive);
    closing documents excluded."""
    src = ledger if closing_docs is None else anti_join(ledger, closing_docs, doc_key)
    return (src.where(F.col(class_col).isin(classes))
            .groupBy(F.trunc(_d(date), "month").alias("month"), *keys)
            .agg(rnd(-F.sum(amount), 2).alias("amount")))


# Aging bands (days past due) and their labels, in order.
AGING_EDGES = [0, 30, 60, 90]
AGING_LABELS = ["Current", "1-30", "31-60", "61-90", "91 and over"]


def aging(docs: DataFrame, due: str | None, date: str, open_amount: str, as_of,
          closed: str | None = None) -> DataFrame:
    """Days past due = as_of - coalesce(due, document date) -> ordered bucket.

    NULL dates -> 'Unknown' (order 6); zero balances are excluded; closed
    documents (``closed``) get a NULL bucket.
    """
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    ref = F.coalesce(_d(due), _d(date)) if due else _d(date)
    days = F.datediff(a, ref)
    lab, order = band(days, AGING_EDGES, AGING_LABELS, null_label="Unknown")
    order = F.when(days.isNull(), F.lit(6)).otherwise(order)
    out = docs.where(F.coalesce(F.col(open_amount), F.lit(0.0)) != 0).withColumns(
        {"days_past_due": days, "aging_bucket": lab, "aging_bucket_order": order})
    if closed:
        out = out.withColumns({"aging_bucket": F.when(~F.col(closed), F.col("aging_bucket")),
                               "aging_bucket_order": F.when(~F.col(closed), F.col("aging_bucket_order"))})
    return out


def fill_rates(rates: DataFrame, currency: str, date: str, rate: str, as_of) -> DataFrame:
    """A daily rate from each currency's first date to greatest(as_of, first date),
    the last known rate carried forward with its source date and a carried flag.

    Grid rows are generated per currency; the carry-forward window is per currency
    over days (calendar-bounded).
    """
    a = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    from .timegrid import densify
    r = rates.select(F.col(currency).alias(currency), _d(date).alias("rate_date"), F.col(rate).alias("_rate"))
    j = densify(r, currency, "rate_date", [], end=a, fill=None).withColumn(
        "_src", F.when(F.col("_rate").isNotNull(), F.col("rate_date")))
    w = Window.partitionBy(currency).orderBy("rate_date").rowsBetween(Window.unboundedPreceding, 0)
    return j.select(currency, "rate_date",
                    F.last("_rate", ignorenulls=True).over(w).alias("rate"),
                    F.last("_src", ignorenulls=True).over(w).alias("source_date"),
                    F.col("_rate").isNull().alias("is_carried_forward"))


def cross_rates(base_rates: DataFrame, currency: str, date: str = "rate_date", rate: str = "rate",
                source_date: str | None = None, carried: str | None = None, base: str | None = None,
                currencies: list[str] | None = None) -> DataFrame:
    """Every ordered currency pair via the common base on the same date.

    ``rate(from -> to) = rate_to / rate_from``; equal currencies exactly 1.0;
    type identity / direct (from is base) / inverse (to is base) / cross. With
    ``base`` the base currency joins every date at rate 1. An equi self-join on
    date; an optional currency list is pushed to both sides before it.
    """
    names = [currency, rate] + ([source_date] if source_date else []) + ([carried] if carried else [])
    b = base_rates.select(date, *names)
    if base is not None:
        # every rate row also emits the base currency's row (rate 1); one aggregate per
        # (date, currency) collapses them -- the rates are read once, not once more per day
        base_row = F.struct(F.lit(base).alias(currency), F.lit(1.0).alias(rate),
                            *([F.col(source_date).alias(source_date)] if source_date else []),
                            *([F.lit(False).alias(carried)] if carried else []))
        own_row = F.struct(*[F.col(n).alias(n) for n in names])
        b = b.select(date, F.explode(F.array(own_row, base_row)).alias("_r")).select(date, "_r.*")
        b = b.groupBy(date, currency).agg(F.max(rate).alias(rate),
                                          *([F.min(source_date).alias(source_date)] if source_date else []),
                                          *([F.bool_or(carried).alias(carried)] if carried else []))
    if currencies is not None:
        b = b.where(F.col(currency).isin(currencies))
    f = b.select(date, *[F.col(n).alias(f"from_{n}") for n in names])
    t = b.select(date, *[F.col(n).alias(f"to_{n}") for n in names])
    j = f.join(t, date)
    fc, tc = F.col(f"from_{currency}"), F.col(f"to_{currency}")
    rtype = F.when(fc == tc, "identity")
    if base is not None:
        rtype = rtype.when(fc == F.lit(base), "direct").when(tc == F.lit(base), "inverse")
    extra = []
    if source_date:
        extra.append(F.least(f"from_{source_date}", f"to_{source_date}").alias("source_date"))
    if carried:
        extra.append((F.col(f"from_{carried}") | F.col(f"to_{carried}")).alias("is_carried_forward"))
    return j.select(date, fc.alias("from_currency"), tc.alias("to_currency"),
                    F.when(fc == tc, F.lit(1.0)).otherwise(
                        F.try_divide(F.col(f"to_{rate}"), F.nullif(F.col(f"from_{rate}"), F.lit(0.0)))).alias("rate"),
                    rtype.otherwise("cross").alias("rate_type"), *extra)


def convert(df: DataFrame, amount: str, ccy: str, date: str, rates: DataFrame, rate_ccy: str = "currency",
            rate_date: str = "rate_date", rate: str = "rate", out: str = "amount_base") -> DataFrame:
    """Convert to the base currency with the day's (carried-forward) rate: amount / rate."""
    r = rates.select(F.col(rate_ccy).alias("_rc"), F.col(rate_date).alias("_rd"), F.col(rate).alias("_rate"))
    j = df.join(r, (F.col(ccy) == F.col("_rc")) & (_d(date) == F.col("_rd")), "left")
    return j.withColumn(out, rnd(F.try_divide(F.col(amount), F.nullif("_rate", F.lit(0.0))), 2)).drop("_rc", "_rd")


def trial_balance_year(openings: DataFrame, movements: DataFrame, on: list[str], opening: str = "opening_balance",
                       movement: str = "movement") -> DataFrame:
    """Per financial year, the reported opening balance full-outer-joined with the
    year's movements (either side may be missing), closing = opening + movement."""
    from .joins import merge_full
    m = merge_full([openings, movements], on, fill=0.0)
    return m.withColumn("closing_balance", rnd(F.col(opening) + F.col(movement), 2))


def invoice_lines(headers: DataFrame, lines: DataFrame, key: str, dims: dict) -> DataFrame:
    """Invoice lines with header attributes and dimension attributes attached
    (lookups made unique first, so nothing fans out). ``dims = {key: dim_df}``."""
    from .joins import enrich
    out = lines.join(headers, key, "left")
    for k, dim in dims.items():
        out = enrich(out, dim, k)
    return out


def aging_union(receivables: DataFrame, payables: DataFrame, due: str | None, date: str, open_amount: str,
                as_of, closed: str | None = None) -> DataFrame:
    """D50 variant: receivable and payable documents unioned with a side label, then aged."""
    u = (receivables.withColumn("side", F.lit("receivable"))
         .unionByName(payables.withColumn("side", F.lit("payable")), allowMissingColumns=True))
    return aging(u, due, date, open_amount, as_of, closed)
