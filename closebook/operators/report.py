"""The 36 metrics: one at a time, or all of them in one report.

Each metric is a formula over one-row sums.  Alone, it computes only the sums
it names; in the report, all metrics of a subject share the same sums.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.functions.scalars import literal, ratio, zero_if_null
from closebook.operators import contracts as C
from closebook.operators import labor as L
from closebook.operators import ledger as G
from closebook.operators import receivables as R
from closebook.plans.measures import Measure, to_long
from closebook.sources.relations import Relations

MONTHS = 12  # averages divide by twelve even when fewer months have rows


@dataclass(frozen=True)
class Metric:
    ordinal: int
    key: str
    name: str
    #: the sums the formula reads
    sums: tuple[str, ...]
    #: SQL over the sums
    formula: str
    #: "flow" and "balance" can be recomputed for past dates; "position" uses current state
    history: str


def _gross_margin(revenue: str, cost: str) -> str:
    return ratio(f"{revenue} - {zero_if_null(cost)}", revenue, 4)


def _monthly_average(name: str) -> str:
    return f"round({name} / {MONTHS}, 2)"


HOURLY_RATE = (
    "round(CAST(rate_labor AS DOUBLE) / nullif(CAST(rate_cogs AS DOUBLE), 0D)"
    " * CAST(rate_revenue AS DOUBLE) / nullif(rate_minutes / 60D, 0D), 2)"
)


# The metric names of the report, in report order
METRICS: tuple[Metric, ...] = tuple(
    Metric(ordinal, *row) for ordinal, row in enumerate([
        ("open_backlog", "Pipeline", ("backlog",), "backlog", "position"),
        ("avg_monthly_idc_12m", "AvgMonthlyIDCSpendLast12CompleteMonths",
         ("idc_12m",), _monthly_average("idc_12m"), "flow"),
        ("avg_monthly_cogs_12m", "AvgMonthlyCOGSSpendLast12CompleteMonths",
         ("cogs_12m",), _monthly_average("cogs_12m"), "flow"),
        ("cash_balance_eom", "CashBalanceAsOfEOM", ("cash",), "cash", "balance"),
        ("budget_open_wip_eom", "TotalBudgetForOpenWIPProjectsAsOfEOM",
         ("open_budget_eom",), "open_budget_eom", "position"),
        ("net_income_last_month", "NetIncomeLastCompletedMonth",
         ("month_net_income",), "month_net_income", "flow"),
        # previous minus current, null if either balance is missing
        ("ar_mom_delta", "AR_MoM_Delta_LastCompletedMonth",
         ("prior_receivable", "receivable"), "round(prior_receivable - receivable, 2)", "balance"),
        ("wip_budgeted_hours", "WIPTotalBudgetedHours",
         ("wip_budgeted_hours",), "wip_budgeted_hours", "position"),
        ("wip_actual_hours", "WIPTotalActualHours",
         ("wip_actual_hours",), "wip_actual_hours", "position"),
        ("wip_hours_ratio", "WIPActualHoursToBudgetedHoursRatio",
         ("wip_actual_hours", "wip_budgeted_hours"),
         ratio("wip_actual_hours", "wip_budgeted_hours", 2), "position"),
        ("wip_revised_value", "WIPSumRevisedContractValues",
         ("open_value_eom",), "open_value_eom", "position"),
        ("total_income_last_month", "TotalIncomeLastCompletedMonth",
         ("month_income",), "month_income", "flow"),
        ("net_ordinary_income_last_month", "NetOrdinaryIncomeLastCompletedMonth",
         ("month_ordinary_income",), "month_ordinary_income", "flow"),
        ("unbilled_retainage", "ARAgingReportUnbilledRetainage",
         ("retainage",), "retainage", "position"),
        ("days_to_pay_30", "ARAvgDaysToPayLast30Days", ("pay_30",), "round(pay_30, 0)", "position"),
        ("days_to_pay_60", "ARAvgDaysToPayLast60Days", ("pay_60",), "round(pay_60, 0)", "position"),
        ("days_to_pay_90", "ARAvgDaysToPayLast90Days", ("pay_90",), "round(pay_90, 0)", "position"),
        ("days_to_pay_180", "ARAvgDaysToPayLast180Days",
         ("pay_180",), "round(pay_180, 0)", "position"),
        ("days_to_pay_365", "ARAvgDaysToPayLast365Days",
         ("pay_365",), "round(pay_365, 0)", "position"),
        ("days_to_pay_all", "ARAvgDaysToPaySinceDawnOfTime",
         ("pay_all",), "round(pay_all, 0)", "position"),
        # current minus previous, a missing balance counts as zero
        ("ap_mom_delta", "AP_MoM_Delta_LastCompletedMonth", ("payable", "prior_payable"),
         f"round({zero_if_null('payable')} - {zero_if_null('prior_payable')}, 2)",
         "balance"),
        ("current_liabilities_eom", "TotalCurrentLiabilitiesAsOfEOM",
         ("current_liabilities",), "current_liabilities", "balance"),
        ("ar_avg_days_outstanding", "ARAvgDaysOutstanding",
         ("age_avg",), "round(age_avg, 0)", "position"),
        ("ar_aging_0_30", "Outstanding AR (0-30 days old)",
         ("aging_0_30",), "aging_0_30", "position"),
        ("ar_aging_31_60", "Outstanding AR (31-60 days old)",
         ("aging_31_60",), "aging_31_60", "position"),
        ("ar_aging_61_90", "Outstanding AR (61-90 days old)",
         ("aging_61_90",), "aging_61_90", "position"),
        ("ar_aging_91_180", "Outstanding AR (91-180 days old)",
         ("aging_91_180",), "aging_91_180", "position"),
        ("ar_aging_181_plus", "Outstanding AR (181-365+ days old)",
         ("aging_181_plus",), "aging_181_plus", "position"),
        ("wip_budgeted_labor", "WIPTotalBudgetedLabor",
         ("wip_budgeted_labor",), "wip_budgeted_labor", "position"),
        ("hours_budgeted_projects", "TotalActualHoursForProjectsWithBudgetedLabor",
         ("wip_hours_with_budget",), "wip_hours_with_budget", "position"),
        ("wip_gm_pct", "WIP_GM_Percent", ("wip_revenue", "wip_cogs"),
         _gross_margin("wip_revenue", "wip_cogs"), "position"),
        ("ytd_gm_pct", "YTD_GM_Percent", ("ytd_revenue", "ytd_cogs"),
         _gross_margin("ytd_revenue", "ytd_cogs"), "flow"),
        ("net_profit_pct_ytd", "NetProfitPercentYTD", ("ytd_net_profit", "ytd_income_lines"),
         ratio("ytd_net_profit", "ytd_income_lines", 4), "flow"),
        ("in_staff_hourly_rate_ytd", "InStaffLaborHourlyRateYTD",
         ("rate_labor", "rate_cogs", "rate_revenue", "rate_minutes"), HOURLY_RATE, "flow"),
        ("gross_profit_pct_ytd", "GrossProfitPercentYTD", ("ytd_gross_profit", "ytd_income_lines"),
         ratio("ytd_gross_profit", "ytd_income_lines", 4), "flow"),
        ("in_staff_labor_efficiency", "InStaffLaborEfficiencyWIP", ("staff_cost", "staff_hours"),
         ratio("staff_cost", "staff_hours", 2), "position"),
    ], start=1)
)

BY_KEY = {m.key: m for m in METRICS}
#: metrics that can be recomputed for any past date
RESTATABLE = tuple(m for m in METRICS if m.history != "position")

PAY_SUMS = {**{f"pay_{n}": n for n in R.PAY_WINDOWS}, "pay_all": None}
AGING_SUMS = ("age_avg", *R.AGING_BUCKETS)
RATE_SUMS = ("rate_labor", "rate_cogs", "rate_revenue", "rate_minutes")

TODAY, EOM = "_today", "_eom"


def _contract_sums() -> dict[str, tuple[tuple[str, ...], Measure]]:
    """Sums over the contract table: name -> (parts it needs, measure)."""
    open_today, open_eom = C.is_open(TODAY), C.is_open(EOM)
    earns = L.earns_with_staff(
        "contract_ytd_revenue", "contract_ytd_in_staff_labor", "staff_minutes_ytd"
    )
    has_hours, has_money = "budgeted_hours > 0", "budgeted_labor > 0"
    rows = (
        ("backlog", ("today",),
         f"{C.revised_value(TODAY)} - {zero_if_null('total_amount' + TODAY)}", C.in_backlog(TODAY)),
        ("open_budget_eom", ("eom", "budget"), "budget", open_eom),
        ("open_value_eom", ("eom",), C.revised_value(EOM), open_eom),
        ("wip_budgeted_hours", ("today", "tasks"), "budgeted_hours", f"{open_today} AND {has_hours}"),
        ("wip_actual_hours", ("today", "tasks", "time"), zero_if_null("actual_hours"),
         f"{open_today} AND {has_hours}"),
        ("wip_budgeted_labor", ("today", "tasks"), "budgeted_labor", open_today),
        ("wip_hours_with_budget", ("today", "tasks", "time"), "actual_hours",
         f"{open_today} AND {has_money}"),
        ("wip_revenue", ("today", "ledger"), "contract_revenue", open_today),
        ("wip_cogs", ("today", "ledger"), "contract_cogs", open_today),
        ("staff_cost", ("today", "time"), "staff_cost", open_today),
        ("staff_hours", ("today", "time"), "staff_hours", open_today),
        ("rate_labor", ("ledger", "minutes"), "contract_ytd_in_staff_labor", earns),
        ("rate_cogs", ("ledger", "minutes"), zero_if_null("contract_ytd_cogs"), earns),
        ("rate_revenue", ("ledger", "minutes"), "contract_ytd_revenue", earns),
        ("rate_minutes", ("ledger", "minutes"), "staff_minutes_ytd", earns),
    )
    return {name: (parts, Measure(name, value, where)) for name, parts, value, where in rows}


CONTRACT_SUMS = _contract_sums()

#: ledger sums per contract behind each contract sum
_LEDGER_INPUTS = {
    "wip_revenue": ("contract_revenue",),
    "wip_cogs": ("contract_cogs",),
    **{name: ("contract_ytd_revenue", "contract_ytd_cogs", "contract_ytd_in_staff_labor")
       for name in RATE_SUMS},
}


def contract_table(rel: Relations, as_of: AsOf, parts: set[str],
                   ledger: DataFrame | None = None) -> DataFrame:
    """One row per contract with the columns of the requested parts.

    Every part is already summed per contract, so these joins pair single
    rows.  A given `ledger` is kept whole, including rows of contracts that
    have no project.
    """
    dates = {suffix: end for part, suffix, end in (
        ("today", TODAY, as_of.today), ("eom", EOM, as_of.month_end)) if part in parts}
    sides = []
    if dates:
        sides.append(C.contract_positions(rel, dates))
    if "tasks" in parts:
        sides.append(C.tasks_by_contract(rel))
    if "budget" in parts:
        sides.append(C.budget_by_contract(rel))
    if "time" in parts:
        sides.append(L.time_by_contract(rel, as_of))
    elif "minutes" in parts:
        sides.append(L.in_staff_minutes(rel, as_of))
    if dates:
        table, *rest = sides
        for side in rest:
            # a side's contracts without a project can never be open, but may earn
            how = "full" if "staff_minutes_ytd" in side.columns and "ledger" in parts else "left"
            table = table.join(side, "contract_id", how)
        return table if ledger is None else table.join(ledger, "contract_id", "full")
    return ledger.join(sides[0], "contract_id")


def contract_sums(rel: Relations, as_of: AsOf, names: tuple[str, ...]) -> DataFrame:
    """One row with the named contract sums, reading only what they need."""
    parts = {part for name in names for part in CONTRACT_SUMS[name][0]}
    ledger = None
    if "ledger" in parts:
        inputs = dict.fromkeys(i for name in names for i in _LEDGER_INPUTS.get(name, ()))
        ledger = G.ledger_by_contract(rel, as_of, inputs)
    table = contract_table(rel, as_of, parts, ledger)
    return table.agg(*[CONTRACT_SUMS[name][1].sum() for name in names])


def sums_for(rel: Relations, as_of: AsOf, names: tuple[str, ...]) -> DataFrame:
    """One row with sums that belong to the same subject."""
    if names == ("idc_12m",):
        return G.idc_spend(rel, as_of)
    if names == ("retainage",):
        return R.unbilled_retainage(rel, as_of)
    if set(names) <= set(G.WINDOWED):
        return G.ledger_totals(rel, as_of, names)
    if set(names) <= set(PAY_SUMS):
        return R.average_days_to_pay(rel, as_of, [PAY_SUMS[n] for n in names])
    if len(names) == 1 and names[0] in R.AGING_BUCKETS:
        return R.aging_bucket(rel, as_of, names[0])
    if set(names) <= set(AGING_SUMS):
        return R.receivable_aging(rel, as_of)
    return contract_sums(rel, as_of, names)


def kpi(rel: Relations, as_of: AsOf, key: str) -> DataFrame:
    """One metric as a single (metric, value) row."""
    metric = BY_KEY[key]
    sums = sums_for(rel, as_of, metric.sums)
    return sums.selectExpr(
        f"{literal(metric.name)} AS metric", f"CAST({metric.formula} AS DOUBLE) AS value"
    )


def company_sums(rel: Relations, as_of: AsOf, ledger: DataFrame) -> DataFrame:
    """Every ledger and contract sum of the report in one row."""
    table = contract_table(
        rel, as_of, {"today", "eom", "tasks", "budget", "time", "ledger"}, ledger
    )
    return table.agg(
        *[F.sum(name).alias(name) for name in G.WINDOWED],
        *[measure.sum() for _, measure in CONTRACT_SUMS.values()],
    )


def kpi_report(rel: Relations, as_of: AsOf) -> DataFrame:
    """All 36 metrics as (ordinal, metric, value), always 36 rows."""
    return report_from(rel, as_of, G.ledger_report(rel, as_of), G.idc_spend(rel, as_of))


def report_from(rel: Relations, as_of: AsOf, ledger: DataFrame, idc: DataFrame) -> DataFrame:
    """The report with its ledger sums given, computed now or stored before.

    `ledger` has the columns of `ledger.ledger_report`, `idc` the single sum
    of `ledger.idc_spend`; everything else is read from `rel`.
    """
    subjects = (
        (company_sums(rel, as_of, ledger), {*G.WINDOWED, *CONTRACT_SUMS}),
        (idc, {"idc_12m"}),
        (R.average_days_to_pay(rel, as_of), set(PAY_SUMS)),
        (R.receivable_aging(rel, as_of), set(AGING_SUMS)),
        (R.unbilled_retainage(rel, as_of), {"retainage"}),
    )
    parts = [
        to_long(sums, [(m.ordinal, m.name, m.formula) for m in METRICS if set(m.sums) <= names])
        for sums, names in subjects
    ]
    return reduce(DataFrame.unionByName, parts)
