"""Histories equal the report of each date, restated from what was known by then."""

from datetime import date

import pytest

from closebook.calendar import AsOf
from closebook.operators import contracts, positions, report, snapshot
from tests.conftest import day, money, values
from tests.test_snapshot import by_date


def restated(rel, today, metrics):
    whole = values(report.kpi_report(rel.known_by(today), AsOf(today)))
    return {m.name: whole[m.name] for m in metrics}


def test_all_36_metrics_equal_the_restated_report(small):
    found = by_date(positions.history(small))
    dates = sorted(found)
    assert len(dates) > 70 and all(len(found[d]) == 36 for d in dates)
    for today in (dates[0], dates[len(dates) // 2], dates[-1]):
        assert found[today] == restated(small, today, report.METRICS)


@pytest.mark.parametrize("grain", [snapshot.WEEK, snapshot.DAY])
def test_other_grains(small, grain):
    found = by_date(positions.positions(small, grain, date(1999, 12, 28), date(2000, 1, 5)))
    for today, metrics in found.items():
        assert metrics == restated(small, today, positions.CONTRACT_METRICS)
    assert len(found) == (9 if grain == snapshot.DAY else 1)


def test_a_task_sweeps_few_contracts_however_small_their_rows(small, monkeypatch):
    before = by_date(positions.positions(small, snapshot.WEEK))
    monkeypatch.setitem(positions.CONTRACTS_PER_TASK, snapshot.WEEK, 1)
    swept = positions._swept(
        small, snapshot.WEEK, [positions._moved(small, snapshot.WEEK)], [])
    contracts_known = small.contract_values.count()
    assert contracts_known > 4  # as many partitions as the session has would not do
    assert swept.rdd.getNumPartitions() == contracts_known
    assert by_date(positions.positions(small, snapshot.WEEK)) == before


def test_open_contracts_of_a_date_are_one_interval_each(small):
    states = positions.contract_states(small)
    for today in (date(1996, 2, 29), date(1999, 7, 1), date(2001, 7, 15)):
        then = states.filter(
            f"coalesce(valid_from, DATE'0001-01-01') <= DATE'{today}'"
            f" AND coalesce(valid_to, DATE'9999-01-01') > DATE'{today}'")
        assert then.count() == small.projects.count()
        got = {r["contract_id"] for r in then.filter("is_open").collect()}
        assert got == {r["contract_id"] for r in contracts.open_contracts(small, today).collect()}


def test_edges(make):
    rel = make(
        contract_values=[(1, money("100.00")), (2, None), (3, money("5.00")), (4, money("9.00"))],
        projects=[(1, 2, "1.000", "a"), (2, 2, "2.000", "a"), (3, 2, "00.000 ", "a"),
                  (5, 2, "5.000", "a")],
        contract_activity=[
            (1, day("2000-01-10"), None, money("60.00")), (1, day("2000-02-10"), None, money("40.00")),
            (1, day("2000-03-05"), money("10.00"), None), (1, None, None, money("500.00")),
            (2, day("2000-02-01"), money("7.00"), None), (4, day("2000-04-01"), None, money("1.00"))],
        budget_items=[(1, money("30.00")), (2, None)],
        contract_tasks=[(1, money("8.00"), money("0.00")), (2, money("0.00"), money("4.00"))],
        retainage=[(1, day("2000-02-28"), money("3.00")), (1, day("2000-03-01"), money("-1.00"))],
        ar_inquiry=[
            (1, "PAYAPP", day("2000-01-05"), money("0.00"), 1),
            (1, "PAYAPP-PMT", day("2000-01-25"), money("0.00"), 1),
            (1, "PAYAPP", day("2000-02-01"), money("50.00"), 1),
            (1, "PAYAPP-PMT", day("2000-03-31"), money("0.00"), 1),
            (2, "PAYAPP", None, money("70.00"), 1), (2, "PAYAPP-PMT", day("2000-02-01"), money("0.00"), 1),
            (3, "PAYAPP", day("2000-03-10"), money("20.00"), None)],
    )
    found = by_date(positions.positions(rel, snapshot.MONTH))
    assert sorted(found) == [date(2000, 1, 31), date(2000, 2, 29), date(2000, 3, 31), date(2000, 4, 30)]
    pay, aging = (by_date(f(rel)) for f in (positions.days_to_pay_history, positions.aging_history))
    for today in found:
        assert found[today] == restated(rel, today, positions.CONTRACT_METRICS)
    for today in pay:
        assert pay[today] == restated(rel, today, positions.PAY_METRICS)
        assert aging[today] == restated(rel, today, positions.AGING_METRICS)
    turns = sorted((r["contract_id"], str(r["valid_from"]), str(r["valid_to"]), r["is_open"])
                   for r in positions.contract_states(rel).collect())
    assert turns == [
        (1, "2000-02-10", "2000-03-05", False), (1, "2000-03-05", "None", True),
        (1, "None", "2000-02-10", True),
        (2, "2000-02-01", "None", True), (2, "None", "2000-02-01", False),
        (3, "None", "None", False)]


def test_empty(make):
    rel = make()
    for frame in (positions.positions(rel, snapshot.MONTH), positions.days_to_pay_history(rel),
                  positions.contract_states(rel)):
        assert frame.count() == 0


def test_a_hot_contract_is_summed_before_it_is_swept(make, spark):
    rel = make(contract_values=[(1, money("100.00"))], projects=[(1, 2, "1.000", "a")])
    moves = spark.range(20_000).selectExpr(
        "1L AS contract_id", "date_add(DATE'2000-01-01', CAST(id % 40 AS INT)) AS tran_date",
        "CAST(1 AS DECIMAL(18,2)) AS change_order", "CAST(NULL AS DECIMAL(18,2)) AS billed")
    rel = rel.replace(contract_activity=moves.repartition(6))
    # a sweep sees one row for each interval of the calendar, not one for each movement
    assert positions._moved(rel, snapshot.WEEK).count() < 10
    found = by_date(positions.positions(rel, snapshot.WEEK))
    last = found[max(found)]
    assert last["Pipeline"] == 20_100.0
    assert max(found) >= date(2000, 2, 9)
