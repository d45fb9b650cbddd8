"""One query per intermediate dataset and per metric, each on its own."""

from __future__ import annotations

from oracles.views import with_views

_YTD = "tran_date BETWEEN DATE '{year_start}' AND DATE '{today}'"
_MONTH = "tran_date BETWEEN DATE '{month_start}' AND DATE '{month_end}'"
_12M = "tran_date BETWEEN DATE '{start_12m}' AND DATE '{month_end}'"
# What counts as payable
PAYABLE = ("is_liability = 1 AND (account_type IN ('Accounts Payable', 'Credit Card Account') "
            "OR code_name = '20700 Overbillings')")
#: exact cents / 12 rounded half away from zero
_TWELFTH = ("sign({cents}) * ((2 * abs({cents}) + 12) // 24) / 100.0")


def twelfth(total: str) -> str:
    return _TWELFTH.format(cents=f"CAST({total} * 100 AS HUGEINT)")


DATASETS: dict[str, str] = {
    "open_contracts": "SELECT contract_id FROM open_today",
    "wip_revenue": """
        SELECT CAST(-sum(net) AS DOUBLE) AS total_revenue
        FROM lines JOIN open_today USING (contract_id) WHERE account_type_id = 9 AND pl""",
    "wip_cost": """
        SELECT CAST(sum(net) AS DOUBLE) AS total_cost
        FROM lines JOIN open_today USING (contract_id) WHERE account_type_id = 5 AND pl""",
    "wip_time_cost": """
        SELECT contract_id, CAST(d.hours AS DOUBLE) AS hours, CAST(wage AS DOUBLE) AS wage,
               CAST(d.hours * wage AS DOUBLE) AS cost
        FROM daily_time d JOIN open_today USING (contract_id) JOIN staff USING (employee_id)""",
    "ytd_revenue": f"""
        SELECT CAST(-sum(net) AS DOUBLE) AS total_revenue
        FROM lines WHERE account_type_id = 9 AND pl AND {_YTD}""",
    "ytd_cogs": f"""
        SELECT CAST(sum(net) AS DOUBLE) AS total_cost
        FROM lines WHERE account_type_id = 5 AND pl AND {_YTD}""",
    "budgeted_hours": """
        SELECT contract_id, CAST(budgeted_hours AS DOUBLE) AS budgeted_hours FROM task_sums""",
    "actual_hours": """
        SELECT contract_id, CAST(actual_hours AS DOUBLE) AS actual_hours FROM time_sums""",
    "combined_hours": """
        SELECT CAST(sum(budgeted_hours) AS DOUBLE) AS budgeted_hours,
               CAST(sum(ifnull(actual_hours, 0)) AS DOUBLE) AS actual_hours
        FROM task_sums LEFT JOIN time_sums USING (contract_id) WHERE budgeted_hours > 0""",
    "invoice_pairs": """
        SELECT trans_doc_id, invoice_date, payment_date
        FROM pairs WHERE invoice_date IS NOT NULL AND payment_date IS NOT NULL""",
    "days_to_pay": "SELECT invoice_date, CAST(days_diff AS INTEGER) AS days_diff FROM lags",
    "wip_budget_labor": """
        SELECT CAST(sum(amount) AS DOUBLE) AS budgeted_labor
        FROM contract_tasks WHERE contract_id IN (FROM open_today)""",
    "contract_budget_labor": """
        SELECT contract_id, CAST(budgeted_labor AS DOUBLE) AS budgeted_labor
        FROM task_sums WHERE budgeted_labor > 0""",
    "hours_with_budget_labor": """
        SELECT contract_id, CAST(actual_hours AS DOUBLE) AS actual_hours
        FROM time_sums SEMI JOIN task_sums USING (contract_id)
        WHERE contract_id IN (SELECT contract_id FROM task_sums WHERE budgeted_labor > 0)""",
    "total_hours_with_budget_labor": """
        SELECT CAST(sum(actual_hours) AS DOUBLE) AS actual_hours FROM time_sums
        WHERE contract_id IN (SELECT contract_id FROM task_sums WHERE budgeted_labor > 0)""",
    "in_staff_hours": """
        SELECT contract_id, minutes / CAST(60 AS DOUBLE) AS in_staff_hours FROM clocked""",
    "project_level_ytd": """
        SELECT contract_id, CAST(revenue AS DOUBLE) AS total_revenue_ytd,
               CAST(labor AS DOUBLE) AS in_staff_labor_ytd, CAST(cogs AS DOUBLE) AS total_cogs_ytd,
               minutes / CAST(60 AS DOUBLE) AS in_staff_hours_ytd
        FROM earning""",
}


def _gm(revenue_rows: str) -> str:
    return f"""
        SELECT round(CAST(revenue - ifnull(cost, 0) AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0), 4)
        FROM (SELECT -sum(net) FILTER (WHERE account_type_id = 9) AS revenue,
                     sum(net) FILTER (WHERE account_type_id = 5) AS cost
              FROM {revenue_rows})"""


def _profit_pct(descriptions: str) -> str:
    return f"""
        SELECT round(CAST(sum(-net) AS DOUBLE)
                     / nullif(CAST(sum(-net) FILTER (WHERE account_type = 'Income') AS DOUBLE), 0), 4)
        FROM lines WHERE account_type IN ({descriptions}) AND pl AND {_YTD}"""


def _paid_within(days: int) -> str:
    return f"""SELECT round(avg(days_diff), 0) FROM lags
               WHERE invoice_date > DATE '{{today}}' - {days}"""


def _aged(condition: str) -> str:
    return f"SELECT sum(balance_due) FROM unpaid WHERE age {condition}"


# The metric names of the report, in report order
METRICS: dict[str, tuple[str, str]] = {
    "open_backlog": ("Pipeline", """
        SELECT sum(ifnull(original_value, 0) + ifnull(change_orders, 0) - ifnull(total_amount, 0))
        FROM wip_today JOIN projects USING (contract_id)
        WHERE status_id = 2 AND (original_value > 0 OR change_orders > 0)
          AND project_number <> '00.000'"""),
    "avg_monthly_idc_12m": ("AvgMonthlyIDCSpendLast12CompleteMonths", f"""
        SELECT {twelfth('sum(tran_amount)')}
        FROM gl JOIN cost_codes USING (cost_code_id)
        WHERE number LIKE '9%' AND gl_type_id IN (2, 7, 8, 12, 17, 18, 19, 44, 45) AND {_12M}"""),
    "avg_monthly_cogs_12m": ("AvgMonthlyCOGSSpendLast12CompleteMonths", f"""
        SELECT {twelfth('sum(net)')} FROM lines WHERE account_type_id = 5 AND pl AND {_12M}"""),
    "cash_balance_eom": ("CashBalanceAsOfEOM", """
        SELECT sum(round(net, 2)) FROM lines
        WHERE is_asset = 1 AND account_type_id IN (0, 1, 3) AND tran_date <= DATE '{month_end}'"""),
    "budget_open_wip_eom": ("TotalBudgetForOpenWIPProjectsAsOfEOM", """
        SELECT sum(amount) FROM budget_items
        WHERE contract_id IN (SELECT contract_id FROM open_eom)"""),
    "net_income_last_month": ("NetIncomeLastCompletedMonth", f"""
        SELECT -sum(net) FROM lines WHERE account_type_id IN (5, 7, 9, 12) AND pl AND {_MONTH}"""),
    "ar_mom_delta": ("AR_MoM_Delta_LastCompletedMonth", """
        SELECT (SELECT sum(round(net, 2)) FROM lines WHERE is_asset = 1 AND account_type_id = 2
                  AND tran_date <= DATE '{prior_month_end}')
             - (SELECT sum(round(net, 2)) FROM lines WHERE is_asset = 1 AND account_type_id = 2
                  AND tran_date <= DATE '{month_end}')"""),
    "wip_budgeted_hours": ("WIPTotalBudgetedHours", """
        SELECT sum(budgeted_hours) FROM task_sums WHERE budgeted_hours > 0"""),
    "wip_actual_hours": ("WIPTotalActualHours", """
        SELECT sum(ifnull(actual_hours, 0)) FROM task_sums LEFT JOIN time_sums USING (contract_id)
        WHERE budgeted_hours > 0"""),
    "wip_hours_ratio": ("WIPActualHoursToBudgetedHoursRatio", """
        SELECT round(CAST(sum(ifnull(actual_hours, 0)) AS DOUBLE)
                     / nullif(CAST(sum(budgeted_hours) AS DOUBLE), 0), 2)
        FROM task_sums LEFT JOIN time_sums USING (contract_id) WHERE budgeted_hours > 0"""),
    "wip_revised_value": ("WIPSumRevisedContractValues", "SELECT sum(revised) FROM open_eom"),
    "total_income_last_month": ("TotalIncomeLastCompletedMonth", f"""
        SELECT sum(CASE WHEN account_type_id IN (5, 7, 11) THEN net ELSE -net END) FROM lines
        WHERE account_type = 'Income' AND account_type_id IN (5, 7, 9, 11, 12) AND pl
          AND {_MONTH}"""),
    "net_ordinary_income_last_month": ("NetOrdinaryIncomeLastCompletedMonth", f"""
        SELECT sum(CASE WHEN account_type = 'Income' THEN total ELSE -total END)
        FROM (SELECT account_type,
                     sum(CASE WHEN account_type_id IN (5, 7, 11) THEN net ELSE -net END) AS total
              FROM lines
              WHERE account_type IN ('Income', 'Cost of Goods Sold', 'Expense')
                AND account_type_id IN (5, 7, 9, 11, 12) AND pl AND {_MONTH}
              GROUP BY account_type)"""),
    "unbilled_retainage": ("ARAgingReportUnbilledRetainage", """
        SELECT sum(unpaid_retainage) FROM retainage WHERE tran_date <= DATE '{today}'"""),
    "days_to_pay_30": ("ARAvgDaysToPayLast30Days", _paid_within(30)),
    "days_to_pay_60": ("ARAvgDaysToPayLast60Days", _paid_within(60)),
    "days_to_pay_90": ("ARAvgDaysToPayLast90Days", _paid_within(90)),
    "days_to_pay_180": ("ARAvgDaysToPayLast180Days", _paid_within(180)),
    "days_to_pay_365": ("ARAvgDaysToPayLast365Days", _paid_within(365)),
    "days_to_pay_all": ("ARAvgDaysToPaySinceDawnOfTime",
                        "SELECT round(avg(days_diff), 0) FROM lags"),
    "ap_mom_delta": ("AP_MoM_Delta_LastCompletedMonth", f"""
        SELECT ifnull((SELECT -sum(round(net, 2)) FROM lines WHERE {PAYABLE}
                         AND tran_date <= DATE '{{month_end}}'), 0)
             - ifnull((SELECT -sum(round(net, 2)) FROM lines WHERE {PAYABLE}
                         AND tran_date <= DATE '{{prior_month_end}}'), 0)"""),
    "current_liabilities_eom": ("TotalCurrentLiabilitiesAsOfEOM", """
        SELECT -sum(round(net, 2)) FROM lines
        WHERE is_liability = 1 AND account_type_id <> 10 AND tran_date <= DATE '{month_end}'"""),
    "ar_avg_days_outstanding": ("ARAvgDaysOutstanding", "SELECT round(avg(age), 0) FROM unpaid"),
    "ar_aging_0_30": ("Outstanding AR (0-30 days old)", _aged("BETWEEN 0 AND 30")),
    "ar_aging_31_60": ("Outstanding AR (31-60 days old)", _aged("BETWEEN 31 AND 60")),
    "ar_aging_61_90": ("Outstanding AR (61-90 days old)", _aged("BETWEEN 61 AND 90")),
    "ar_aging_91_180": ("Outstanding AR (91-180 days old)", _aged("BETWEEN 91 AND 180")),
    "ar_aging_181_plus": ("Outstanding AR (181-365+ days old)", _aged(">= 181")),
    "wip_budgeted_labor": ("WIPTotalBudgetedLabor", "SELECT sum(budgeted_labor) FROM task_sums"),
    "hours_budgeted_projects": ("TotalActualHoursForProjectsWithBudgetedLabor", """
        SELECT sum(actual_hours) FROM time_sums
        WHERE contract_id IN (SELECT contract_id FROM task_sums WHERE budgeted_labor > 0)"""),
    "wip_gm_pct": ("WIP_GM_Percent",
                   _gm("lines WHERE pl AND contract_id IN (FROM open_today)")),
    "ytd_gm_pct": ("YTD_GM_Percent", _gm(f"lines WHERE pl AND {_YTD}")),
    "net_profit_pct_ytd": ("NetProfitPercentYTD", _profit_pct(
        "'Income', 'Cost of Goods Sold', 'Expense', 'Other Income'")),
    "in_staff_hourly_rate_ytd": ("InStaffLaborHourlyRateYTD", """
        SELECT round(CAST(sum(labor) AS DOUBLE) / nullif(CAST(sum(cogs) AS DOUBLE), 0)
                     * CAST(sum(revenue) AS DOUBLE)
                     / nullif(sum(minutes) / CAST(60 AS DOUBLE), 0), 2) FROM earning"""),
    "gross_profit_pct_ytd": ("GrossProfitPercentYTD",
                             _profit_pct("'Income', 'Cost of Goods Sold'")),
    "in_staff_labor_efficiency": ("InStaffLaborEfficiencyWIP", """
        SELECT round(CAST(sum(d.hours * wage) AS DOUBLE)
                     / nullif(CAST(sum(d.hours) AS DOUBLE), 0), 2)
        FROM daily_time d JOIN staff USING (employee_id)
        WHERE contract_id IN (FROM open_today)"""),
}


def metric_row(name: str, query: str) -> str:
    return f"SELECT '{name}' AS metric, CAST(({query}) AS DOUBLE) AS value"


def report_query() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {ordinal} AS ordinal, * FROM ({metric_row(name, query)})"
        for ordinal, (name, query) in enumerate(METRICS.values(), start=1)
    )


def queries(dates: dict[str, str]) -> dict[str, str]:
    """All queries of this module with the as-of dates filled in."""
    raw = {
        **DATASETS,
        **{key: metric_row(*spec) for key, spec in METRICS.items()},
        "kpi_report": report_query(),
    }
    return {key: with_views(sql).format(**dates) for key, sql in raw.items()}
