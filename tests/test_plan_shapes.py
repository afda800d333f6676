"""Regression guards for plan shapes that matter at scale (checked on sf0.001 plans)."""

import re

import pytest

from reportkit.plans import QUERIES

SF = "/root/testdata/sf0.001"


# queries that must read each raw table exactly once
ONE_SCAN = ["sales_over_time", "sessions", "active_users_daily", "trial_balance", "mrr_by_customer_month",
            "order_backlog", "rep_activity", "email_campaign_performance", "campaign_roi", "agent_performance",
            "profile_activity", "event_counts_daily", "general_ledger"]
# contribution_margin: the cost history is a second
# lineitem roll-up -- it reads lineitem twice by design


def _plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ONE_SCAN)
def test_each_table_read_once(spark, name):
    tables = re.findall(r"/(\w+)\.parquet\]", _plan(spark, name))
    assert tables and len(tables) == len(set(tables)), tables


def test_no_cartesian_products(spark):
    bad = [n for n in sorted(QUERIES) if "CartesianProduct" in _plan(spark, n)]
    assert not bad, bad


def test_wide_steps_are_dealt_by_the_rows_of_their_input(spark, monkeypatch):
    from reportkit import session
    from reportkit.operators import commerce, revenue
    n = session.tasks_for(spark.range(1000), 10)
    assert n == 100 and session.tasks_for(spark.range(3), 10) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(revenue, "tasks_for", lambda rows: 77)
    monkeypatch.setattr(commerce, "tasks_for", lambda rows: 77)
    for name in ("mrr_bridge", "sales_velocity"):
        assert "77), REPARTITION_BY_NUM" in _plan(spark, name), name


def _dealt_otherwise(plan, n):
    """Grouping columns of the exchanges not dealt to ``n`` partitions."""
    return {m[1] for m in re.finditer(r"Exchange hashpartitioning\((.*), (\d+)\), (\w+)", plan) if (m[2], m[3]) != (str(n), "REPARTITION_BY_NUM")}


def test_prices_of_a_day_and_their_carry_are_dealt_by_lines(spark, monkeypatch):
    from reportkit.plans import q_commerce
    monkeypatch.setattr(q_commerce, "tasks_for", lambda rows, rows_a_task=0: 77)
    plan = _plan(spark, "point_in_time_cost")
    assert "77), REPARTITION_BY_NUM" in plan and not _dealt_otherwise(plan, 77)


def test_days_of_a_person_and_their_months_are_dealt_by_orders(spark, monkeypatch):
    from reportkit.plans import q_activity
    monkeypatch.setattr(q_activity, "tasks_for", lambda rows: 77)
    plan = _plan(spark, "headcount_monthly")
    (report,) = _dealt_otherwise(plan, 77)      # the report's own groups, combined before they are shuffled
    assert "77), REPARTITION_BY_NUM" in plan and report.startswith("month#")
