"""Known values, identities between metrics, and options of the report."""

import pytest

from closebook.calendar import AsOf
from closebook.operators import contracts, receivables, report
from tests.conftest import values

# ingredients checked in FIXTURES.md at sf0.01, finished here
KNOWN = {
    "Pipeline": 817015915.81,
    "AvgMonthlyIDCSpendLast12CompleteMonths": round(3432539.28 / 12, 2),
    "AvgMonthlyCOGSSpendLast12CompleteMonths": round(-5313893.53 / 12, 2),
    "CashBalanceAsOfEOM": -208678364.73,
    "TotalBudgetForOpenWIPProjectsAsOfEOM": 587311071.87,
    "NetIncomeLastCompletedMonth": 1571929.11,
    "AR_MoM_Delta_LastCompletedMonth": 807002.94,
    "WIPTotalBudgetedHours": 209357.00,
    "WIPTotalActualHours": 3002.9856,
    "WIPSumRevisedContractValues": 2402562131.28,
    "TotalIncomeLastCompletedMonth": 44257.62,
    "NetOrdinaryIncomeLastCompletedMonth": 528393.43,
    "ARAgingReportUnbilledRetainage": 126166672.24,
    "ARAvgDaysToPayLast30Days": round(1828 / 31),
    "ARAvgDaysToPayLast60Days": round(4113 / 61),
    "ARAvgDaysToPayLast90Days": round(6970 / 92),
    "ARAvgDaysToPayLast180Days": round(23391 / 212),
    "ARAvgDaysToPayLast365Days": round(99258 / 591),
    "ARAvgDaysToPaySinceDawnOfTime": round(9874604 / 10028),
    "AP_MoM_Delta_LastCompletedMonth": 1736536.20,
    "TotalCurrentLiabilitiesAsOfEOM": 219805647.15,
    "ARAvgDaysOutstanding": round(9590575 / 8055),
    "Outstanding AR (0-30 days old)": 25225321.45,
    "Outstanding AR (31-60 days old)": 24424691.66,
    "Outstanding AR (61-90 days old)": 24964474.37,
    "Outstanding AR (91-180 days old)": 68975751.92,
    "Outstanding AR (181-365+ days old)": 1856916943.32,
    "WIPTotalBudgetedLabor": 507747007.39,
    "TotalActualHoursForProjectsWithBudgetedLabor": 3002.9856,
    "WIP_GM_Percent": round((18100860.79 + 14411364.81) / 18100860.79, 4),
    "YTD_GM_Percent": 2.1064,
    "NetProfitPercentYTD": round(13768845.51 / 3273109.97, 4),
    "InStaffLaborHourlyRateYTD": round(441239.63 / 381885.49 * 900337.18 / (36007 / 60), 2),
    "GrossProfitPercentYTD": 2.1064,
    "InStaffLaborEfficiencyWIP": round(119985.14997904 / 2469.5610, 2),
}


@pytest.fixture(scope="module")
def found(spark, as_of):
    from closebook.sources import retail
    from tests.conftest import MEDIUM
    return values(report.kpi_report(retail.relations(spark, MEDIUM), as_of))


@pytest.mark.parametrize("metric", KNOWN)
def test_known_value(found, metric):
    assert found[metric] == pytest.approx(KNOWN[metric], abs=1e-9)


def test_open_contract_count(medium, as_of):
    assert contracts.open_contracts(medium, as_of.today).count() == 37


def test_identities(found, medium, as_of):
    assert found["YTD_GM_Percent"] == found["GrossProfitPercentYTD"]
    other_income = found["NetIncomeLastCompletedMonth"] - found["NetOrdinaryIncomeLastCompletedMonth"]
    assert other_income == pytest.approx(1043535.68)
    # the buckets hold every unpaid row that is not dated after the run date
    unpaid = medium.ar_inquiry.filter(
        "balance_due > 1 AND project IS NOT NULL AND tran_date <= DATE'2001-07-15'"
    ).selectExpr("CAST(sum(balance_due) AS DOUBLE) AS s").first()["s"]
    buckets = sum(v for k, v in found.items() if k.startswith("Outstanding AR"))
    assert buckets == pytest.approx(unpaid)


def test_ordinals_follow_the_report(small, as_of):
    rows = report.kpi_report(small, as_of).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in rows] == list(range(1, 37))
    assert [r["metric"] for r in rows] == [m.name for m in report.METRICS]


@pytest.mark.parametrize("today", ["2001-01-10", "2000-02-29", "1995-01-31", "2001-11-04"])
def test_single_metrics_equal_the_report(small, today):
    at = AsOf.parse(today)
    whole = values(report.kpi_report(small, at))
    # every metric in January, those that follow from dated rows at the other dates
    for metric in report.METRICS if at.today.month == 1 else report.RESTATABLE:
        assert values(report.kpi(small, at, metric.key)) == {metric.name: whole[metric.name]}


def test_knowledge_cut_off_only_changes_undated_metrics(small):
    past = AsOf.parse("2000-06-15")
    now, then = (values(report.kpi_report(rel, past)) for rel in (small, small.known_by(past.today)))
    for metric in report.METRICS:
        if metric.history != "position":
            assert now[metric.name] == then[metric.name]
    assert then["ARAvgDaysToPaySinceDawnOfTime"] != now["ARAvgDaysToPaySinceDawnOfTime"]
    latest = receivables.days_to_pay(small.known_by(past.today)).selectExpr("max(invoice_date)")
    assert latest.first()[0] <= past.today


def test_session_time_zone_does_not_matter(spark, small, as_of, request):
    request.addfinalizer(lambda: spark.conf.set("spark.sql.session.timeZone", "UTC"))
    in_utc = values(report.kpi_report(small, as_of))
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    assert values(report.kpi_report(small, as_of)) == in_utc
