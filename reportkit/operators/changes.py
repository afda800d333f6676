"""D11 as a change log: what an order's later changes do to its sale.

An order's changes (order, edit, cancellation, refund) are folded in time order. Everything that needs the order's whole
history is a hash aggregate per order or a running figure in two levels (order x day, then across the order's days), so an
order with most of the changes is spread over its days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c_
from .commerce import edit_flags, sale_row_type
from .joins import enrich
from .timegrid import follow_chain
from .windows import seq_running_min, seq_running_sum

__all__ = ["fold_edits", "report_orders", "cap_over_time"]


def fold_edits(changes: DataFrame, order: str, ts: str, kind: str, window_seconds: int = 90,
               ordered=("ORDER",), edits=("ORDER_EDIT",)) -> DataFrame:
    """Edits within ``window_seconds`` of the order's creation are part of the sale, later ones restate it.

    Adds ``order_created_at`` (first ``ordered`` change; NULL if the log holds none), ``row_type`` (SALE / RETURN /
    CANCELLATION; other kinds NULL), ``is_checkout_edit``, ``is_later_edit`` and ``report_date``: the day of the change, but
    for a checkout edit the day the order was created, so that an edit past midnight stays on the sale's day. An edit of an
    order without creation, or before it, is no checkout edit.
    """
    k = F.upper(c_(kind))
    starts = changes.where(k.isin(*ordered)).groupBy(order).agg(F.min(ts).alias("order_created_at"))
    d = enrich(changes, starts, order, dedupe=False)
    after = F.timestamp_diff("SECOND", F.col("order_created_at"), c_(ts)) >= 0
    edit = k.isin(*edits)
    checkout = F.coalesce(edit & after & edit_flags(c_(ts), F.col("order_created_at"), window_seconds), F.lit(False))
    return d.withColumns({
        "row_type": F.when(k.isin(*edits), "SALE").otherwise(sale_row_type(kind)),
        "is_checkout_edit": checkout, "is_later_edit": edit & ~checkout,
        "report_date": F.to_date(F.when(checkout, F.col("order_created_at")).otherwise(c_(ts)))})


def report_orders(orders: DataFrame, order: str, parent: str) -> DataFrame:
    """The order that a child order's refunds are reported against: its parent's parent and so on, however deep.
    Returns ``order``, ``report_order_id``, ``levels``. A parent that does not exist still counts as the order; orders in a loop
    of parents report against themselves."""
    known = orders.select(order, parent)
    lone = known.where(F.col(parent).isNull()).select(order, F.col(order).alias("report_order_id"), F.lit(0).cast("long").alias("levels"))
    child = known.where(F.col(parent).isNotNull())
    # only child orders are walked; the last child's own parent is the order itself
    walked = follow_chain(child, order, parent).select(F.col("id").alias(order), "final_id", "hops", "in_loop")
    last = child.select(F.col(order).alias("final_id"), F.col(parent).alias("_top"))
    w = walked.join(last, "final_id", "left").select(
        order, F.when(F.col("in_loop"), F.col(order)).otherwise(F.col("_top")).alias("report_order_id"),
        F.when(F.col("in_loop"), F.lit(0)).otherwise(F.col("hops") + 1).cast("long").alias("levels"))
    return lone.unionByName(w)


def cap_over_time(changes: DataFrame, keys, order: list[str], ordered: Column, cancelled: Column, bucket: Column,
                  out: str = "cancelled_capped") -> DataFrame:
    """Units that each change really cancels, when cancelled units never exceed the units ordered so far.

    The state after a change is ``min(state before + cancelled, ordered so far)``: surplus cancellations are lost, and an
    edit that takes units back also takes back what was cancelled beyond them (a negative figure). In closed form the state
    is ``C + min(0, running min(O - C))`` with the running totals O and C of ordered and cancelled units, so no row-by-row
    fold is needed. ``bucket`` must be non-decreasing in ``order``; ``order`` must be total up to equal rows.
    """
    d = changes.withColumns({"_o": F.coalesce(ordered, F.lit(0)), "_c": F.coalesce(cancelled, F.lit(0))})
    d = seq_running_sum(d, keys, order, "_o", "_so", bucket)
    d = seq_running_sum(d, keys, order, "_c", "_sc", bucket)
    d = d.withColumn("_slack", F.col("_so") - F.col("_sc"))
    d = seq_running_min(d, keys, order, "_slack", "_low", bucket, before_out="_low_before")
    state = F.col("_sc") + F.least(F.lit(0), F.col("_low"))
    before = F.col("_sc") - F.col("_c") + F.least(F.lit(0), F.coalesce("_low_before", F.lit(0)))
    return d.withColumn(out, state - before).drop("_o", "_c", "_so", "_sc", "_slack", "_low", "_low_before")
