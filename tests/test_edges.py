"""Hand-made rows for the rules that data alone does not show."""

import pytest

from closebook.calendar import AsOf
from closebook.operators import contracts, labor, ledger, receivables, report
from closebook.sources.relations import normalise_text
from tests.conftest import at, day, money, one, values

TODAY = AsOf.parse("2001-07-15")

ACCOUNTS = [
    # id, type, description, code name, asset, liability, in staff
    (1, 9, "Income", "40000 Sales", 0, 0, False),
    (2, 5, "Cost of Goods Sold", "50000 Labor", 0, 0, True),
    (3, 7, "Expense", "60000 Rent", 0, 0, False),
    (4, 12, "Other Income", "70000 Interest", 0, 0, False),
    (5, 3, "Bank", "10000 Cash", 1, 0, False),
    (6, 2, "Accounts Receivable", "11000 AR", 1, 0, False),
    (7, 4, "accounts payable  ", "20000 AP", 0, 1, False),
    (8, 8, "Other Current Liability", "20700 OVERBILLINGS ", 0, 1, False),
    (9, 10, "Long Term Liability", "25000 Loan", 0, 1, False),
    (10, 8, "Other Current Liability", "21000 Tax", 0, 1, False),
]


def line(account, tran_date, debit=None, credit=None, contract=1, gl_type=1):
    return (contract, account, gl_type, tran_date and day(tran_date), money(debit), money(credit))


def report_of(make, as_of=TODAY, **rows):
    return values(report.kpi_report(make(accounts=ACCOUNTS, **rows), as_of))


def test_empty_inputs_give_every_row(make):
    rows = values(report.kpi_report(make(), TODAY))
    assert len(rows) == 36
    # only the payable change turns a missing balance into zero
    assert {k for k, v in rows.items() if v is not None} == {"AP_MoM_Delta_LastCompletedMonth"}
    assert rows["AP_MoM_Delta_LastCompletedMonth"] == 0


@pytest.mark.parametrize("metric", report.METRICS, ids=lambda m: m.key)
def test_empty_inputs_give_one_row_per_metric(make, metric):
    row = one(report.kpi(make(), TODAY, metric.key))
    assert row["value"] == (0 if metric.key == "ap_mom_delta" else None)


def test_missing_sides_count_as_zero(make):
    rows = report_of(make, gl_debit_credit=[
        line(1, "2001-06-10", credit="100.00"), line(1, "2001-06-11", debit="30.00"),
        line(1, "2001-06-12"), line(2, "2001-06-30", debit="20.00"),
        line(3, "2001-06-01", debit="5.00"), line(4, "2001-06-02", credit="7.00"),
    ])
    assert rows["TotalIncomeLastCompletedMonth"] == 70
    assert rows["NetOrdinaryIncomeLastCompletedMonth"] == 45
    assert rows["NetIncomeLastCompletedMonth"] == 52
    assert rows["YTD_GM_Percent"] == rows["GrossProfitPercentYTD"] == round(50 / 70, 4)
    assert rows["NetProfitPercentYTD"] == round(52 / 70, 4)


def test_excluded_and_missing_ledger_types(make):
    rows = report_of(make, gl_debit_credit=[
        line(1, "2001-06-10", credit="100.00", gl_type=67),
        line(1, "2001-06-10", credit="10.00", gl_type=None),
        line(1, "2001-06-10", credit="1.00"),
        # balances ignore the ledger type
        line(5, "2001-06-10", debit="50.00", gl_type=68),
        line(5, "2001-06-10", debit="5.00", gl_type=None),
    ])
    assert rows["TotalIncomeLastCompletedMonth"] == 1
    assert rows["CashBalanceAsOfEOM"] == 55


def test_window_edges(make):
    ledger_rows = [
        line(1, d, credit=str(10 ** n)) for n, d in enumerate(
            ["2000-12-31", "2001-01-01", "2001-05-31", "2001-06-01", "2001-06-30", "2001-07-15",
             "2001-07-16"])
    ] + [line(1, None, credit="5.00")]
    rows = report_of(make, gl_debit_credit=ledger_rows)
    assert rows["TotalIncomeLastCompletedMonth"] == 1000 + 10000
    ytd = one(ledger.ledger_totals(
        make(accounts=ACCOUNTS, gl_debit_credit=ledger_rows), TODAY, ["ytd_revenue"]))
    assert float(ytd["ytd_revenue"]) == 10 + 100 + 1000 + 10000 + 100000


def test_january_report_uses_december(make):
    rows = report_of(make, AsOf.parse("2001-01-10"), gl_debit_credit=[
        line(1, "2000-12-01", credit="3.00"), line(1, "2000-12-31", credit="4.00"),
        line(1, "2001-01-05", credit="100.00"),
    ])
    assert rows["TotalIncomeLastCompletedMonth"] == 7


def test_receivable_and_payable_changes_have_opposite_signs(make):
    both = report_of(make, gl_debit_credit=[
        line(6, "2001-05-31", debit="100.00"), line(6, "2001-06-30", debit="40.00"),
        line(7, "2001-05-31", credit="100.00"), line(8, "2001-06-30", credit="40.00"),
    ])
    assert both["AR_MoM_Delta_LastCompletedMonth"] == -40
    assert both["AP_MoM_Delta_LastCompletedMonth"] == 40
    # with no earlier balance the receivable change is unknown, the payable change is not
    first = report_of(make, gl_debit_credit=[
        line(6, "2001-06-30", debit="40.00"), line(7, "2001-06-30", credit="40.00")])
    assert first["AR_MoM_Delta_LastCompletedMonth"] is None
    assert first["AP_MoM_Delta_LastCompletedMonth"] == 40


def test_payables_are_found_despite_case_and_trailing_blanks(make):
    rows = report_of(make, gl_debit_credit=[
        line(7, "2001-06-30", credit="1.00"), line(8, "2001-06-30", credit="2.00"),
        line(9, "2001-06-30", credit="4.00"), line(10, "2001-06-30", credit="8.00"),
    ])
    assert rows["AP_MoM_Delta_LastCompletedMonth"] == 3
    assert rows["TotalCurrentLiabilitiesAsOfEOM"] == 11


def test_average_divides_by_twelve_and_rounds_half_up(make):
    rows = report_of(make, gl_debit_credit=[line(2, "2001-06-30", debit="0.06")],
                     gl=[(1, 2, day("2001-06-30"), money("-0.06"))], cost_codes=[(1, "9100")])
    assert rows["AvgMonthlyCOGSSpendLast12CompleteMonths"] == 0.01
    assert rows["AvgMonthlyIDCSpendLast12CompleteMonths"] == -0.01


def test_cost_code_prefix_and_types(make):
    rows = report_of(make, cost_codes=[(1, "9100"), (2, "19"), (3, None)], gl=[
        (1, 2, day("2001-06-30"), money("12.00")), (1, 3, day("2001-06-30"), money("120.00")),
        (2, 2, day("2001-06-30"), money("1200.00")), (3, 2, day("2001-06-30"), money("12000.00")),
        (1, 45, day("2000-07-01"), money("24.00")), (1, 45, day("2000-06-30"), money("240.00")),
    ])
    assert rows["AvgMonthlyIDCSpendLast12CompleteMonths"] == 3


def test_missing_cost_keeps_the_margin(make):
    only_revenue = report_of(make, gl_debit_credit=[line(1, "2001-07-01", credit="10.00")])
    assert only_revenue["YTD_GM_Percent"] == 1
    no_revenue = report_of(make, gl_debit_credit=[line(2, "2001-07-01", debit="10.00")])
    assert no_revenue["YTD_GM_Percent"] is None
    assert no_revenue["GrossProfitPercentYTD"] is None


PROJECTS = [
    # id, status, number, department
    (1, 2, "01.000", "North"), (2, 1, "02.000", "North"), (3, 2, "00.000", "South"),
    (4, 2, "04.000", "South"), (5, 2, "05.000", "South"),
]
CONTRACTS = dict(
    projects=PROJECTS,
    contract_values=[(1, money(100)), (2, money(100)), (3, money(100)), (4, money(100)), (5, None)],
    contract_activity=[
        (1, day("2001-06-01"), money(10), money(50)), (1, day("2001-07-10"), None, money(60)),
        (4, day("2001-07-10"), None, money(100)),
        (5, day("2001-07-10"), money(5), None), (5, day("2001-07-16"), None, money(5)),
    ],
)


def test_open_contracts_and_backlog(make):
    rel = make(**CONTRACTS)
    def open_on(text):
        return {r["contract_id"] for r in contracts.open_contracts(rel, day(text)).collect()}
    # contract 1 is billed in full by July 10, contract 5 opens with its change order
    assert open_on("2001-06-30") == {1, 4}
    assert open_on("2001-07-15") == {5}
    rows = values(report.kpi_report(rel, TODAY))
    # billed contracts stay in the backlog sum: 1 at 0, 4 at 0, 5 at 5
    assert rows["Pipeline"] == 5
    assert rows["WIPSumRevisedContractValues"] == 110 + 100


def test_budget_needs_an_open_contract_and_hours(make):
    rel = make(
        **CONTRACTS,
        contract_tasks=[(5, None, money(70)), (5, money(0), money(30)), (1, money(9), money(9)),
                        (None, money(1), money(1))],
        daily_time=[(5, 1, money(2), money(3), None, None)],
        employees=[(1, money(10), None)],
        budget_items=[(1, money(7)), (5, money(8)), (None, money(9))],
    )
    rows = values(report.kpi_report(rel, TODAY))
    assert rows["WIPTotalBudgetedHours"] is None and rows["WIPActualHoursToBudgetedHoursRatio"] is None
    assert rows["WIPTotalBudgetedLabor"] == 100
    assert rows["TotalActualHoursForProjectsWithBudgetedLabor"] == 3
    assert rows["TotalBudgetForOpenWIPProjectsAsOfEOM"] == 7
    assert rows["InStaffLaborEfficiencyWIP"] == 10


def test_hours_without_timesheets_count_as_zero(make):
    rel = make(**CONTRACTS, contract_tasks=[(5, money(4), money(1))])
    row = one(labor.combined_hours(rel, TODAY))
    assert (float(row["budgeted_hours"]), float(row["actual_hours"])) == (4, 0)
    assert values(report.kpi_report(rel, TODAY))["WIPActualHoursToBudgetedHoursRatio"] == 0


def test_temporary_staff_count_in_hours_but_not_in_cost(make):
    rel = make(
        **CONTRACTS, contract_tasks=[(5, money(10), money(10))],
        employees=[(1, money(10), 0), (2, money(10), 1), (3, money(0), 0), (4, money(20), None)],
        daily_time=[(5, e, money(1), money(2), None, None) for e in (1, 2, 3, 4)],
    )
    rows = values(report.kpi_report(rel, TODAY))
    assert rows["WIPTotalActualHours"] == 8
    assert rows["InStaffLaborEfficiencyWIP"] == 15
    assert labor.wip_time_cost(rel, TODAY).count() == 2


def test_minutes_are_boundaries_and_the_as_of_day_is_out(make):
    def clock(start, end):
        return (1, 1, money(1), money(1), at(start), at(end))
    rel = make(
        accounts=ACCOUNTS, employees=[(1, money(10), 0)],
        daily_time=[clock("2001-07-01T08:00:59", "2001-07-01T08:01:01"),
                    clock("2001-07-15T00:00:00", "2001-07-15T00:30:00"),
                    clock("2001-07-15T10:00:00", "2001-07-15T11:00:00"),
                    clock("2000-12-31T10:00:00", "2000-12-31T11:00:00")],
        gl_debit_credit=[line(1, "2001-07-01", credit="100.00"), line(2, "2001-07-01", debit="50.00")],
    )
    hours = one(labor.in_staff_hours(rel, TODAY))["in_staff_hours"]
    assert hours == pytest.approx(31 / 60)
    rate = values(report.kpi_report(rel, TODAY))["InStaffLaborHourlyRateYTD"]
    assert rate == round(50 / 50 * 100 / (31 / 60), 2)


def test_payment_timing(make):
    def doc(number, kind, text):
        return (number, kind, day(text), money(0), 1)
    rel = make(ar_inquiry=[
        # the latest of two payments counts
        doc(1, "PAYAPP", "2001-07-01"), doc(1, "PAYAPP-PMT", "2001-07-05"),
        doc(1, "PAYAPP-PMT", "2001-07-11"),
        # paid on the invoice day, and before it: left out
        doc(2, "PAYAPP", "2001-07-01"), doc(2, "PAYAPP-PMT", "2001-07-01"),
        doc(3, "PAYAPP", "2001-07-02"), doc(3, "PAYAPP-PMT", "2001-07-01"),
        # never paid, and another document type
        doc(4, "PAYAPP", "2001-07-01"), doc(5, "CHECK", "2001-07-01"),
        # exactly 30 days back is outside the 30-day window
        doc(6, "PAYAPP", "2001-06-15"), doc(6, "PAYAPP-PMT", "2001-06-20"),
    ])
    assert receivables.invoice_pairs(rel).count() == 4
    rows = values(report.kpi_report(rel, TODAY))
    assert rows["ARAvgDaysToPayLast30Days"] == 10
    assert rows["ARAvgDaysToPayLast60Days"] == 8  # 7.5 rounds away from zero


def test_aging_bucket_edges(make):
    def due(text, balance="10.00", project=1):
        return (1, "PAYAPP", text and day(text), money(balance), project)
    rel = make(ar_inquiry=[
        due("2001-07-15"), due("2001-06-15"), due("2001-06-14"), due("2001-05-16"),
        due("2001-05-15"), due("2001-04-16"), due("2001-04-15"), due("2001-01-16"),
        due("2001-01-15"), due("1990-01-01"),
        due("2001-07-25"), due(None), due("2001-07-01", project=None), due("2001-07-01", "1.00"),
    ])
    rows = values(report.kpi_report(rel, TODAY))
    buckets = [v for k, v in rows.items() if k.startswith("Outstanding AR")]
    assert buckets == [20, 20, 20, 20, 20]
    singles = [values(report.kpi(rel, TODAY, k)) for k in report.BY_KEY if k.startswith("ar_aging")]
    assert [next(iter(s.values())) for s in singles] == buckets
    # the future row counts in the average age
    ages = [0, 30, 31, 60, 61, 90, 91, 180, 181, 4213, -10]
    assert rows["ARAvgDaysOutstanding"] == round(sum(ages) / len(ages))


def test_normalised_document_types_match(make):
    rel = make(ar_inquiry=[(1, "PayApp ", day("2001-07-01"), money(0), 1),
                           (1, "payapp-pmt", day("2001-07-04"), money(0), 1)])
    assert receivables.invoice_pairs(rel).count() == 0
    clean = rel.replace(ar_inquiry=normalise_text(rel.ar_inquiry, "gl_type_name"))
    assert receivables.invoice_pairs(clean).count() == 1


def test_repeated_keys_are_refused(make):
    make(projects=PROJECTS).check_unique_keys()
    with pytest.raises(ValueError, match="projects: repeated contract_id"):
        make(projects=[*PROJECTS, (1, 2, "x", "y")]).check_unique_keys()
