"""Control totals see the lines that no metric sees."""

from datetime import date

import pytest

from closebook.calendar import AsOf
from closebook.operators import controls, report
from closebook.streaming import refresh
from tests.conftest import day, money, values


def totals(rel) -> dict:
    return {r["total"]: r["value"] for r in controls.control_totals(rel).collect()}


def ledger(make, *lines):
    return make(
        accounts=[(1, 9, "Income", "1", 0, 0, False), (2, 5, "Cost of Goods Sold", "2", 0, 0, False)],
        gl_debit_credit=list(lines))


LINES = (
    (7, 1, 1, day("2001-01-01"), None, money("10.00")),
    (None, 2, 1, day("2001-01-02"), money("4.00"), None),
    (7, 99, 1, day("2001-01-02"), money("5.00"), money("1.00")),
    (7, 1, 67, None, None, money("2.00")),
    (7, None, 1, None, money("1.00"), None),
)


def test_lines_that_metrics_miss(make):
    got = totals(ledger(make, *LINES))
    assert got == {
        "lines": 5, "net": -3.0, "lines_without_account": 2, "net_without_account": 5.0,
        "lines_without_date": 2, "lines_not_profit_and_loss": 1,
        "result_lines_without_contract": 1, "result_net": -6.0}
    assert set(totals(ledger(make)).values()) == {0.0}


def test_totals_come_with_the_report(make):
    rel, seen = controls.observed(ledger(make, *LINES))
    today = AsOf(date(2001, 1, 31))
    got = values(report.kpi_report(rel, today))
    assert got == values(report.kpi_report(ledger(make, *LINES), today))
    assert (seen.get["lines"], seen.get["lines_without_date"]) == (5, 2)
    assert seen.get["net"] == money("-3.00")


def test_a_refresh_that_loses_lines_fails(spark, make, tmp_path):
    path, today = f"{tmp_path}/checked", AsOf(date(2001, 1, 31))
    refresh.checked_refresh(ledger(make, *LINES[:3]), today, path)
    refresh.checked_refresh(ledger(make, *LINES), AsOf(date(2001, 2, 1)), path)
    refresh.checked_refresh(ledger(make, *LINES), AsOf(date(2001, 2, 1)), path)  # a retry
    with pytest.raises(controls.LostLines, match="lines: 5"):
        refresh.checked_refresh(ledger(make, *LINES[:4]), AsOf(date(2001, 2, 2)), path)
    stored = refresh.read_snapshots(spark, f"{path}/reports")
    assert {r["as_of"] for r in stored.select("as_of").distinct().collect()} == {
        date(2001, 1, 31), date(2001, 2, 1)}
