"""Payments and settlement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import pick_last
from ..functions.columns import ratio, rnd


def _l(x):
    return [x] if isinstance(x, str) else list(x)


def lifecycle(events: DataFrame, key, category: str, ts: str, amount: str, steps: list[str],
              tiebreak: str | None = None) -> DataFrame:
    """Event log -> one row per payment: first time and amount of each step, the
    latest step (ties broken by ``tiebreak``) and a flag per step. One hash aggregate."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    aggs = []
    for s in steps:
        hit = F.col(category) == F.lit(s)
        aggs += [F.min(F.when(hit, F.col(ts))).alias(f"first_{s}_at"),
                 rnd(F.sum(F.when(hit, F.col(amount))), 2).alias(f"{s}_amount"),
                 F.bool_or(hit).alias(f"has_{s}")]
    aggs += [pick_last(F.col(category), order).alias("latest_step"), F.count(F.lit(1)).alias("event_count")]
    return events.groupBy(*_l(key)).agg(*aggs)


def decision_rate(lifecycle_df: DataFrame, date: str, dims: list[str], authorised: str, refused: str,
                  amount: str | None = None) -> DataFrame:
    """Per day x dims of the first decision: decided payments, those authorised at any
    time (a refusal first does not matter), those only refused, the authorised amount and
    the authorised share."""
    a, r = F.col(authorised), F.col(refused)
    first_decision = F.least(a, r)  # Spark LEAST skips NULLs: the first decision that happened
    g = (lifecycle_df.where(first_decision.isNotNull())
         .groupBy(F.to_date(first_decision.cast("timestamp")).alias(date), *dims)
         .agg(F.count(F.lit(1)).alias("decided"),
              F.count_if(a.isNotNull()).alias("authorised"), F.count_if(a.isNull()).alias("refused"),
              *([rnd(F.sum(F.when(a.isNotNull(), F.col(amount)).otherwise(0.0)), 2).alias("authorised_amount")]
                if amount else [])))
    return g.withColumn("authorisation_rate", rnd(ratio("authorised", "decided"), 6))


def settlement_ledger(rows: DataFrame, keys, category: str, amount: str, mapping: dict) -> DataFrame:
    """Categorised transactions pivoted to one P&L row per settlement (+ net total)."""
    g = rows.groupBy(*_l(keys)).agg(
        *[rnd(F.sum(F.when(F.col(category) == F.lit(k), F.col(amount)).otherwise(0.0)), 2).alias(v)
          for k, v in mapping.items()],
        rnd(F.sum(F.when(~F.col(category).isin(list(mapping)) | F.col(category).isNull(), F.col(amount)).otherwise(0.0)), 2)
        .alias("other_amount"),
        rnd(F.sum(amount), 2).alias("net_settlement"))
    return g


def reconcile_payouts(payouts: DataFrame, txns: DataFrame, on, pairs: dict, type_col: str, amount: str,
                      tol: float = 0.01) -> DataFrame:
    """The payout's own breakdown vs sums rebuilt from the ledger, per type.

    ``pairs = {txn type: payout field}``; per type ``diff = round(sum(txn) - abs(field), 2)``;
    ``ties_out = coalesce(n > 0 and all abs(diff) <= tol, false)``.
    """
    keys = _l(on)
    sums = txns.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        *[F.sum(F.when(F.col(type_col) == F.lit(t), F.col(amount)).otherwise(0.0)).alias(f"_s_{t}") for t in pairs])
    j = payouts.join(sums, keys, "left")
    cols = {}
    ok = F.coalesce(F.col("transaction_count"), F.lit(0)) > 0
    for t, field in pairs.items():
        d = rnd(F.coalesce(F.col(f"_s_{t}"), F.lit(0.0)) - F.abs(F.col(field)), 2)
        cols[f"{t}_rebuilt"] = rnd(F.coalesce(F.col(f"_s_{t}"), F.lit(0.0)), 2)
        cols[f"{t}_difference"] = d
        ok = ok & (F.abs(d) <= tol)
    return (j.withColumns(cols).withColumn("ties_out", F.coalesce(ok, F.lit(False)))
            .withColumn("transaction_count", F.coalesce("transaction_count", F.lit(0)))
            .drop(*[f"_s_{t}" for t in pairs]))


def implied_opening(balances: DataFrame, activity: DataFrame, on, balance: str, amount: str) -> DataFrame:
    """Implied opening = reported closing balance - net activity (full outer)."""
    keys = _l(on)
    act = activity.groupBy(*keys).agg(F.sum(amount).alias("net_activity"))
    j = balances.join(act, keys, "full").withColumn("net_activity", F.coalesce("net_activity", F.lit(0.0)))
    return j.withColumn("implied_opening_balance", rnd(F.col(balance) - F.col("net_activity"), 2))


def fee_rates(txns: DataFrame, type_col: str, dims: list[str], period: str, fee: str, base: str) -> DataFrame:
    """Fees by type x period with the effective rate over that period's sales base."""
    g = txns.groupBy(*dims, period, type_col).agg(rnd(F.sum(fee), 2).alias("fees"), rnd(F.sum(base), 2).alias("sales"))
    return g.withColumn("effective_fee_rate", rnd(ratio("fees", "sales"), 6))


def daily_activity(txns: DataFrame, dims: list[str], date: str, category: str, amount: str,
                   categories: dict, spine: bool = False, end=None) -> DataFrame:
    """Per-day net movement split by category; ``spine`` zero-fills quiet days."""
    from .timegrid import densify
    d = F.to_date(F.col(date).cast("timestamp"))
    g = txns.groupBy(*dims, d.alias("date")).agg(
        *[F.sum(F.when(F.col(category) == F.lit(k), F.col(amount)).otherwise(0.0)).alias(v) for k, v in categories.items()],
        F.sum(amount).alias("net_movement"))
    names = list(categories.values()) + ["net_movement"]
    if spine:
        g = densify(g, dims, "date", names, end=end)
    return g.withColumns({n: rnd(n, 2) for n in names})
