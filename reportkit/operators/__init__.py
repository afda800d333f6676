"""Primitive operators (joins, aggregates, windows, time grids, sets, arrays, checks)
and report operators (events, commerce, payments, revenue, ledger, marketing, crm,
support, operations)."""
