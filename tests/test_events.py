"""Edge fixtures for sessions and active users."""

import datetime as dt

from reportkit.operators import events as ev

T = dt.datetime


def _events(spark, rows):
    return spark.createDataFrame(rows, "user string, event string, ts timestamp, h string")


def test_sessionize_gap_edges(spark):
    rows = [
        ("a", "x", T(2024, 1, 1, 10, 0, 0), "1"),
        ("a", "y", T(2024, 1, 1, 10, 30, 0), "2"),    # exactly 30 min: same session
        ("a", "z", T(2024, 1, 1, 11, 0, 1), "3"),     # 30 min + 1 s: new session
        ("a", "z", T(2024, 1, 1, 11, 0, 1), "4"),     # equal timestamp
        ("a", "w", T(2024, 1, 1, 23, 50, 0), "5"),
        ("a", "w", T(2024, 1, 2, 0, 5, 0), "6"),      # across midnight: new session
        (None, "q", T(2024, 1, 1, 9, 0, 0), "7"),     # NULL user dropped
        ("b", "s", T(2024, 1, 1, 9, 0, 0), "8"),      # single event
    ]
    out = ev.sessionize(_events(spark, rows), "user", "ts", event="event", tiebreak="h").collect()
    got = sorted((r.user, str(r.session_date), r.session_number_of_day, r.events, r.duration_seconds,
                  r.first_event_name, r.distinct_event_names) for r in out)
    assert got == [
        ("a", "2024-01-01", 1, 2, 1800, "x", 2),
        ("a", "2024-01-01", 2, 2, 0, "z", 1),
        ("a", "2024-01-01", 3, 1, 0, "w", 1),
        ("a", "2024-01-02", 1, 1, 0, "w", 1),
        ("b", "2024-01-01", 1, 1, 0, "s", 1),
    ]


def test_sessionize_fractional_second_over_gap_continues(spark):
    # 1800.5 s apart: whole seconds = 1800, not > 1800, so one session (bucket boundary case)
    rows = [("a", "x", T(2024, 1, 1, 10, 29, 59, 600000), "1"),
            ("a", "y", T(2024, 1, 1, 11, 0, 0, 100000), "2")]
    out = ev.sessionize(_events(spark, rows), "user", "ts", event="event", tiebreak="h").collect()
    assert [r.events for r in out] == [2]


def test_active_users_matches_brute_force(spark):
    import random
    random.seed(7)
    rows = [(str(random.randint(1, 12)), "e", T(2024, 1, 1) + dt.timedelta(days=random.randint(0, 60)), str(i))
            for i in range(300)]
    df = _events(spark, rows)
    got = {str(r.date): (r.dau, r.wau, r.mau, r.new_users) for r in ev.active_users(df, "user", "ts").collect()}
    ud = {(u, ts.date()) for u, _, ts, _ in rows}
    first = {}
    for u, d in ud:
        first[u] = min(first.get(u, d), d)
    for d in {d for _, d in ud}:
        dau = {u for u, x in ud if x == d}
        wau = {u for u, x in ud if d - dt.timedelta(days=7) < x <= d}
        mau = {u for u, x in ud if d - dt.timedelta(days=28) < x <= d}
        new = {u for u in dau if first[u] == d}
        assert got[str(d)] == (len(dau), len(wau), len(mau), len(new))
