"""Calendar steps in gap statistics."""

import datetime as dt

import pytest

from tablens.operators import timeseries as TS


def days(first, n, keep):
    return [d for d in (dt.datetime(*first) + dt.timedelta(days=i) for i in range(n)) if keep(d)]


END = lambda d: (d + dt.timedelta(days=1)).day == 1
CASES = {
    "month start": days((1968, 11, 1), 500, lambda d: d.day == 1), "month end": days((2023, 1, 1), 500, END),
    "quarter start": days((2020, 1, 1), 900, lambda d: d.day == 1 and d.month % 3 == 1), "quarter end": days((2020, 1, 1), 900, lambda d: END(d) and d.month % 3 == 0),
    "year start": days((1999, 1, 1), 2500, lambda d: d.day == 1 and d.month == 1), "business day": days((1969, 12, 1), 60, lambda d: d.weekday() < 5),
}


def test_calendar_steps_are_regular(spark):
    rows = [(k, t) for k, ts in CASES.items() for t in ts]
    month = CASES["month start"]
    rows += [("gap in months", t) for t in month if t != month[3]] + [("noon", t + dt.timedelta(hours=12)) for t in month]
    rows += [("twice", t) for t in month * 2] + [("two", t) for t in month[:2]] + [("daily", t) for t in days((2024, 1, 1), 30, lambda d: True)]
    got = {r.s: r for r in TS.gap_stats(spark.createDataFrame(rows, "s string, ts timestamp_ntz"), "ts", "s").collect()}
    for k in CASES:
        assert got[k].calendar == k and got[k].regularity == 1 and got[k].step_seconds is None, k
    for k in ("gap in months", "noon", "twice", "two", "daily"):
        assert got[k].calendar is None, k
    assert got["daily"].step_seconds == 86400 and got["daily"].regularity == pytest.approx(1)
    assert got["gap in months"].regularity < 1
