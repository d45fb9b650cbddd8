"""Captured reports keep what was said when."""

from datetime import date

from closebook.calendar import AsOf
from closebook.operators import report
from closebook.streaming import captures
from tests.conftest import money, values


def said(frame):
    return {(r["grain"], r["as_of"], r["metric"]): r["value"] for r in frame.collect()}


def test_period_ends():
    first, last = date(2000, 2, 25), date(2000, 3, 6)
    assert captures.period_ends("week", first, last) == [date(2000, 2, 27), date(2000, 3, 5)]
    assert captures.period_ends("month", first, last) == [date(2000, 2, 29)]
    assert len(captures.period_ends("day", first, last)) == 11


def test_late_captures_and_corrections_are_added(spark, small, tmp_path):
    path, week = f"{tmp_path}/captures", date(2001, 7, 8)
    without = small.replace(budget_items=small.budget_items.limit(0))
    assert captures.as_known(spark, path, week).count() == 0
    captures.capture(without, [week], path, date(2001, 7, 9), "week")
    captures.capture(small, [week], path, date(2001, 7, 20), "week")
    # a retry of the first capture changes nothing
    captures.capture(without, [week], path, date(2001, 7, 9), "week")
    assert captures.captured(spark, path).count() == 72
    before = said(captures.as_known(spark, path, date(2001, 7, 19)))
    after = said(captures.as_known(spark, path, date(2001, 7, 20)))
    for got, rel in ((before, without), (after, small)):
        assert {m: v for (_, _, m), v in got.items()} == values(report.kpi_report(rel, AsOf(week)))
    assert captures.as_known(spark, path, date(2001, 7, 8)).count() == 0
    changed = captures.corrections(spark, path).collect()
    assert [(r["metric"], r["before"], r["captured_on"]) for r in changed] == [
        ("TotalBudgetForOpenWIPProjectsAsOfEOM", None, date(2001, 7, 20))]
    assert changed[0]["value"] == after["week", week, changed[0]["metric"]]


def test_due_period_ends_are_captured_once(spark, make, tmp_path):
    rel = make(budget_items=[(1, money(3))])
    path, since = f"{tmp_path}/captures", date(2001, 6, 28)
    captures.capture_due(rel, path, date(2001, 7, 2), since)
    captures.capture_due(rel, path, date(2001, 7, 9), since)
    found = {(r["grain"], r["as_of"], r["captured_on"]) for r in
             captures.captured(spark, path).select(*captures.KEYS).distinct().collect()}
    assert found == {
        ("week", date(2001, 7, 1), date(2001, 7, 2)), ("month", date(2001, 6, 30), date(2001, 7, 2)),
        ("week", date(2001, 7, 8), date(2001, 7, 9))}


def test_a_null_replaces_a_value(spark, make, tmp_path):
    path, day = f"{tmp_path}/captures", date(2001, 7, 8)
    known = make(retainage=[(1, date(2001, 1, 1), money(5))])
    captures.capture(known, [day], path, date(2001, 7, 9))
    captures.capture(make(), [day], path, date(2001, 7, 10))
    late = said(captures.as_known(spark, path, date(2001, 7, 10)))
    early = said(captures.as_known(spark, path, date(2001, 7, 9)))
    key = ("day", day, "ARAgingReportUnbilledRetainage")
    assert early[key] == 5.0 and late[key] is None
