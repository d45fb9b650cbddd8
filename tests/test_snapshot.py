"""Snapshots equal the report of each date; refreshes repeat safely."""

from datetime import date, timedelta

import pytest

from closebook.calendar import AsOf
from closebook.operators import report, snapshot
from closebook.sources import retail
from closebook.streaming import refresh, rollup
from tests.conftest import SMALL, at, day, money, values


def by_date(frame):
    found = {}
    for row in frame.collect():
        found.setdefault(row["as_of"], {})[row["metric"]] = row["value"]
    return found


def report_at(rel, today):
    whole = values(report.kpi_report(rel, AsOf(today)))
    return {m.name: whole[m.name] for m in report.RESTATABLE}


@pytest.mark.parametrize("grain", [snapshot.MONTH, snapshot.WEEK])
def test_equals_the_report_of_each_date(small, grain):
    found = by_date(snapshot.snapshot(small, grain))
    dates = sorted(found)
    step = (dates[1] - dates[0]).days
    assert all((b - a).days <= 31 for a, b in zip(dates, dates[1:])) and step >= 7
    for today in (dates[0], dates[1], dates[len(dates) // 2], dates[-30], dates[-1]):
        assert found[today] == report_at(small, today)


def test_every_day_of_a_range(small):
    days = by_date(snapshot.daily_snapshot(small, date(2000, 12, 30), date(2001, 1, 3)))
    assert len(days) == 5
    for today, metrics in days.items():
        assert metrics == report_at(small, today)


def test_weeks_end_on_sunday_and_are_dense(small):
    dates = sorted(by_date(snapshot.weekly_snapshot(small)))
    assert {d.weekday() for d in dates} == {6}
    assert {b - a for a, b in zip(dates, dates[1:])} == {timedelta(days=7)}


@pytest.mark.parametrize("grain", [snapshot.MONTH, snapshot.WEEK])
def test_a_range_is_part_of_the_whole(small, grain):
    start, end = date(2001, 2, 10), date(2001, 6, 30)
    whole = by_date(snapshot.snapshot(small, grain))
    part = by_date(snapshot.snapshot(small, grain, start, end))
    assert part == {d: v for d, v in whole.items() if start <= d <= end}
    open_ended = by_date(snapshot.snapshot(small, grain, start))
    assert open_ended == {d: v for d, v in whole.items() if start <= d}


def test_range_beyond_the_ledger(small):
    late = by_date(snapshot.monthly_snapshot(small, date(2002, 1, 31), date(2002, 12, 31)))
    assert len(late) == 12
    for today in (date(2002, 1, 31), date(2002, 12, 31)):
        assert late[today] == report_at(small, today)


def test_months_without_lines_and_contracts_that_stop_counting(make):
    def line(account, text, debit, credit):
        return (1, account, 1, day(text), money(debit), money(credit))
    rel = make(
        accounts=[(1, 9, "Income", "a", 0, 0, False), (2, 5, "Cost of Goods Sold", "b", 0, 0, True)],
        employees=[(1, money(10), 0)],
        daily_time=[(1, 1, None, None, at("2001-01-10T08:00"), at("2001-01-10T10:00"))],
        gl_debit_credit=[
            line(1, "2001-01-10", None, 100), line(2, "2001-01-10", 50, None),
            # a refund turns the revenue negative in April, and a sale positive in June
            line(1, "2001-04-10", 200, None), line(1, "2001-06-10", None, 300),
            line(1, "2002-02-01", None, 10),
        ],
    )
    found = by_date(snapshot.monthly_snapshot(rel))
    assert len(found) == 14
    for today, metrics in found.items():
        assert metrics == report_at(rel, today), today
    rates = {d.isoformat()[:7]: m["InStaffLaborHourlyRateYTD"] for d, m in found.items()}
    assert rates["2001-03"] == 50 and rates["2001-04"] is None and rates["2001-12"] == 100
    assert rates["2002-01"] is None


def test_empty_ledger_has_no_dates(make):
    assert snapshot.monthly_snapshot(make()).count() == 0


def test_wide_has_one_column_per_period(small):
    periods = [date(2001, 4, 30), date(2001, 5, 31)]
    series = snapshot.monthly_snapshot(small, *periods)
    wide = snapshot.wide(series, periods)
    assert wide.columns == ["ordinal", "metric", "p_2001_04_30", "p_2001_05_31"]
    long = by_date(series)
    for row in wide.collect():
        for period in periods:
            assert row[f"p_{period:%Y_%m_%d}"] == long[period][row["metric"]]


def test_trend_compares_with_the_period_before(spark):
    series = spark.createDataFrame(
        [(day("2001-01-31"), "a", 2.0), (day("2001-02-28"), "a", 3.0), (day("2001-03-31"), "a", None),
         (day("2001-04-30"), "a", -4.0), (day("2001-01-31"), "b", 0.0), (day("2001-02-28"), "b", 1.0)],
        "as_of DATE, metric STRING, value DOUBLE",
    )
    rows = {(r["metric"], r["as_of"].month): (r["change"], r["change_ratio"])
            for r in snapshot.trend(series).collect()}
    assert rows == {
        ("a", 1): (None, None), ("a", 2): (1.0, 0.5), ("a", 3): (None, None),
        ("a", 4): (None, None), ("b", 1): (None, None), ("b", 2): (1.0, None),
    }


def test_refresh_replaces_only_its_own_date(spark, small, tmp_path):
    path = str(tmp_path / "snapshots")
    first, second = AsOf.parse("2001-07-14"), AsOf.parse("2001-07-15")
    for as_of in (first, second, second):
        refresh.refresh(small, as_of, path)
    stored = refresh.read_snapshots(spark, path)
    assert stored.count() == 72
    kept = values(stored.filter("as_of = DATE'2001-07-14'"))
    refresh.refresh(small.replace(gl_debit_credit=small.gl_debit_credit.limit(0)), second, path)
    assert values(stored.filter("as_of = DATE'2001-07-14'")) == kept
    spark.catalog.refreshByPath(path)
    emptied = values(refresh.read_snapshots(spark, path).filter("as_of = DATE'2001-07-15'"))
    assert emptied["CashBalanceAsOfEOM"] is None


def test_sums_of_arriving_files_equal_the_whole(spark, tmp_path):
    lines = retail.RetailTables(spark, SMALL).file("lineitem")
    inbox, store = str(tmp_path / "inbox"), str(tmp_path / "sums")
    # three arrivals, the second one with dates of all years again
    parts = [lines.filter(f"l_orderkey % 3 = {n}") for n in range(3)]

    def arrive():
        stream = spark.readStream.schema(retail.FILES["lineitem"]).parquet(inbox)
        arriving = retail.relations(spark, SMALL, lineitem=stream)
        for ledger in rollup.LEDGERS:
            rollup.add_new_lines(ledger, arriving[ledger], store)

    parts[0].write.parquet(inbox)
    arrive()
    for part in parts[1:]:
        part.write.mode("append").parquet(inbox)
        arrive()
    arrive()  # nothing new
    rel = retail.relations(spark, SMALL)
    for grain in (snapshot.MONTH, snapshot.WEEK):
        kept = rollup.snapshot_from_rollup(spark, store, rel, grain)
        assert by_date(kept) == by_date(snapshot.snapshot(rel, grain))
    for today in ("2001-07-15", "2000-02-29", "1994-01-01"):
        as_of = AsOf.parse(today)
        kept = rollup.report_from_rollup(spark, store, rel, as_of)
        assert values(kept) == values(report.kpi_report(rel, as_of))


def test_a_retried_batch_counts_once(spark, small, tmp_path):
    path = str(tmp_path / "sums")
    for ledger in 2 * rollup.LEDGERS:
        rollup.store_batch(ledger, small[ledger], 0, path)
    kept = rollup.snapshot_from_rollup(spark, path, small, snapshot.MONTH)
    assert by_date(kept) == by_date(snapshot.monthly_snapshot(small))


def _ledgers(make):
    def line(account, when, debit, credit):
        return (1, account, 1, when and day(when), money(debit), money(credit))
    return make(
        contract_values=[(1, money(1000))], projects=[(1, 2, "1.000", None)],
        accounts=[(1, 9, "Income", "a", 0, 0, False), (2, 5, "Cost of Goods Sold", "b", 0, 0, True),
                  (3, 3, "Bank", "c", 1, 0, False)],
        cost_codes=[(1, "90"), (2, "10")],
        gl=[(1, 2, day("2001-01-05"), money(60)), (2, 2, day("2001-01-05"), money(7)),
            (1, 2, None, money(9))],
        gl_debit_credit=[line(1, "2001-01-10", None, 100), line(2, "2001-01-10", 50, None),
                         line(1, None, None, 300), line(3, "2000-12-31", 20, None)],
    )


def test_sums_keep_undated_lines_and_follow_the_accounts(spark, make, tmp_path):
    rel, as_of, store = _ledgers(make), AsOf.parse("2001-02-15"), str(tmp_path / "sums")

    def both(now):
        kept = values(rollup.report_from_rollup(spark, store, now, as_of))
        assert kept == values(report.kpi_report(now, as_of))
        return kept

    empty = rel.replace(gl_debit_credit=rel.gl_debit_credit.limit(0), gl=rel.gl.limit(0))
    before = both(empty)  # nothing has arrived
    assert len(before) == 36 and before["CashBalanceAsOfEOM"] is None
    # two ledgers in two batches each, the accounts after the lines
    for ledger in rollup.LEDGERS:
        rows = rel[ledger].collect()
        for batch in range(2):
            part = spark.createDataFrame(rows[batch::2], rel[ledger].schema)
            rollup.store_batch(ledger, part, batch, store)
    none_yet = rel.replace(accounts=rel.accounts.limit(0), cost_codes=rel.cost_codes.limit(0))
    assert both(none_yet)["CashBalanceAsOfEOM"] is None
    found = both(rel)
    assert found["WIP_GM_Percent"] == 0.875 and found["CashBalanceAsOfEOM"] == 20
    moved = rel.replace(accounts=rel.accounts.replace(3, 2, subset=["account_type_id"]))
    assert both(moved)["CashBalanceAsOfEOM"] is None


def test_balances_round_lines_and_profit_does_not(spark, make, tmp_path):
    rel, as_of, store = _ledgers(make), AsOf.parse("2001-02-15"), str(tmp_path / "sums")
    fine = spark.createDataFrame(
        [(1, account, 1, day("2001-01-03"), debit, credit)
         for account, debit, credit in ((3, money("0.0050"), None), (1, None, money("0.0050")))
         for _ in range(4)],
        "contract_id long, account_id long, gl_type_id int, tran_date date,"
        " debit decimal(18,4), credit decimal(18,4)")
    rel = rel.replace(gl_debit_credit=fine)
    rollup.store_batch("gl_debit_credit", fine, 0, store)
    whole = values(report.kpi_report(rel, as_of))
    assert whole["CashBalanceAsOfEOM"] == 0.04
    assert whole["NetIncomeLastCompletedMonth"] == 0.02
    for key in ("cash_balance_eom", "net_income_last_month"):
        row = report.kpi(rel, as_of, key).first()
        assert row["value"] == whole[row["metric"]]
    at_end = day("2001-02-28")
    of_date = by_date(snapshot.monthly_snapshot(rel, at_end, at_end))[at_end]
    assert {name: whole[name] for name in of_date} == of_date
    kept = by_date(rollup.snapshot_from_rollup(spark, store, rel, snapshot.MONTH, at_end, at_end))
    assert {n: v for n, v in kept[at_end].items() if "IDC" not in n} == {
        n: v for n, v in of_date.items() if "IDC" not in n}


def test_known_by_reaches_the_rollup(small, tmp_path):
    # later lines must not count in a restated report, stored as sums or not
    today = AsOf(date(1998, 3, 31))
    for ledger in rollup.LEDGERS:
        rollup.store_batch(ledger, small[ledger], 0, str(tmp_path))
    kept = rollup.from_rollup(small.spark, str(tmp_path), small)
    assert values(report.kpi_report(kept.known_by(today.today), today)) == values(
        report.kpi_report(small.known_by(today.today), today))
