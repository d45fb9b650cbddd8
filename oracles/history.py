"""Histories of position metrics, each date computed on its own from the rows known by then."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from oracles.metrics import METRICS, metric_row, report_query
from oracles.views import with_views

#: fixed values: the metrics of each history, as sums by date of the views below
_CONTRACT = {
    "open_backlog": "backlog",
    "budget_open_wip_eom": "open_budget",
    "wip_budgeted_hours": "budgeted_hours",
    "wip_actual_hours": "worked_hours",
    "wip_hours_ratio": "round(CAST(worked_hours AS DOUBLE)"
                       " / nullif(CAST(budgeted_hours AS DOUBLE), 0), 2)",
    "wip_revised_value": "open_value",
    "unbilled_retainage": "unbilled",
    "wip_budgeted_labor": "budgeted_labor",
    "hours_budgeted_projects": "hours_with_budget",
    "wip_gm_pct": "round(CAST(revenue - ifnull(cost, 0) AS DOUBLE)"
                  " / nullif(CAST(revenue AS DOUBLE), 0), 4)",
    "in_staff_labor_efficiency": "round(CAST(staff_cost AS DOUBLE)"
                                 " / nullif(CAST(staff_hours AS DOUBLE), 0), 2)",
}
_PAY = {f"days_to_pay_{n}": f"round(avg(days) FILTER (WHERE invoice_date > as_of - {n}), 0)"
        for n in (30, 60, 90, 180, 365)} | {"days_to_pay_all": "round(avg(days), 0)"}
_AGING = {"ar_avg_days_outstanding": "round(avg(as_of - tran_date), 0)"} | {
    key: f"sum(balance_due) FILTER (WHERE as_of - tran_date {condition})"
    for key, condition in (
        ("ar_aging_0_30", "BETWEEN 0 AND 30"), ("ar_aging_31_60", "BETWEEN 31 AND 60"),
        ("ar_aging_61_90", "BETWEEN 61 AND 90"), ("ar_aging_91_180", "BETWEEN 91 AND 180"),
        ("ar_aging_181_plus", ">= 181"))}

_STATE = """
    SELECT m.kind, m.as_of, w.contract_id, original_value, moved.change_orders, moved.total_amount,
           ifnull(original_value, 0) + ifnull(moved.change_orders, 0) AS revised,
           status_id = 2 AND project_number <> '00.000'
               AND (ifnull(original_value, 0) > 0 OR ifnull(moved.change_orders, 0) > 0) AS backlog,
           backlog AND ifnull(moved.total_amount, 0) < revised AS is_open
    FROM marks m CROSS JOIN wip_today w JOIN projects USING (contract_id)
    LEFT JOIN moved ON moved.kind = m.kind AND moved.as_of = m.as_of
                   AND moved.contract_id = w.contract_id"""

_VIEWS = {
    "marks": """
        SELECT 'today' AS kind, as_of, as_of AS d FROM dates
        UNION ALL
        SELECT 'eom', as_of, CAST(date_trunc('month', as_of) AS DATE) - 1 FROM dates""",
    "moved": """
        SELECT kind, as_of, contract_id, sum(change_order) AS change_orders,
               sum(billed) AS total_amount
        FROM marks JOIN contract_activity ON tran_date <= d GROUP BY ALL""",
    "states": _STATE,
    "time_so_far": """
        SELECT as_of, d.contract_id, sum(ifnull(total, 0)) AS actual_hours,
               sum(d.hours) FILTER (WHERE wage IS NOT NULL) AS staff_hours, sum(d.hours * wage) AS staff_cost
        FROM dates JOIN daily_time d ON CAST(in_time AS DATE) <= as_of
        LEFT JOIN staff USING (employee_id) GROUP BY ALL""",
    "money_so_far": """
        SELECT as_of, contract_id, -sum(net) FILTER (WHERE account_type_id = 9) AS revenue,
               sum(net) FILTER (WHERE account_type_id = 5) AS cost
        FROM dates JOIN lines ON tran_date <= as_of
        WHERE pl AND account_type_id IN (5, 9) GROUP BY ALL""",
    "all_tasks": """
        SELECT contract_id, sum(ifnull(quantity, 0)) AS budgeted_hours,
               sum(ifnull(amount, 0)) AS budgeted_labor FROM contract_tasks GROUP BY contract_id""",
    "budgets": "SELECT contract_id, sum(amount) AS budget FROM budget_items GROUP BY contract_id",
    "sums_today": """
        SELECT as_of, sum(revised - ifnull(total_amount, 0)) FILTER (WHERE backlog) AS backlog,
               sum(budgeted_hours) FILTER (WHERE is_open AND budgeted_hours > 0) AS budgeted_hours,
               sum(ifnull(actual_hours, 0)) FILTER (WHERE is_open AND budgeted_hours > 0) AS worked_hours,
               sum(budgeted_labor) FILTER (WHERE is_open) AS budgeted_labor,
               sum(actual_hours) FILTER (WHERE is_open AND budgeted_labor > 0) AS hours_with_budget,
               sum(revenue) FILTER (WHERE is_open) AS revenue, sum(cost) FILTER (WHERE is_open) AS cost,
               sum(staff_cost) FILTER (WHERE is_open) AS staff_cost,
               sum(staff_hours) FILTER (WHERE is_open) AS staff_hours
        FROM states LEFT JOIN all_tasks USING (contract_id)
        LEFT JOIN time_so_far USING (as_of, contract_id)
        LEFT JOIN money_so_far USING (as_of, contract_id)
        WHERE kind = 'today' GROUP BY as_of""",
    "sums_eom": """
        SELECT as_of, sum(budget) FILTER (WHERE is_open) AS open_budget,
               sum(revised) FILTER (WHERE is_open) AS open_value
        FROM states LEFT JOIN budgets USING (contract_id) WHERE kind = 'eom' GROUP BY as_of""",
    "retained": """
        SELECT as_of, sum(unpaid_retainage) AS unbilled
        FROM dates LEFT JOIN retainage ON tran_date <= as_of GROUP BY as_of""",
    "contract_sums": """
        SELECT * FROM sums_today JOIN sums_eom USING (as_of) JOIN retained USING (as_of)""",
    "versions": """
        SELECT as_of, trans_doc_id,
               max(tran_date) FILTER (WHERE gl_type_name = 'PAYAPP') AS invoice_date,
               max(tran_date) FILTER (WHERE gl_type_name = 'PAYAPP-PMT') AS payment_date
        FROM dates JOIN ar_inquiry ON tran_date <= as_of GROUP BY ALL""",
    "pay_sums": f"""
        SELECT as_of, {", ".join(f"{value} AS {key}" for key, value in _PAY.items())}
        FROM dates LEFT JOIN (
            SELECT as_of, invoice_date, payment_date - invoice_date AS days
            FROM versions WHERE payment_date > invoice_date) USING (as_of) GROUP BY as_of""",
    "aging_sums": f"""
        SELECT as_of, {", ".join(f"{value} AS {key}" for key, value in _AGING.items())}
        FROM dates LEFT JOIN (
            SELECT * FROM ar_inquiry WHERE balance_due > 1 AND project IS NOT NULL)
        ON tran_date <= as_of GROUP BY as_of""",
}


def _long(sums: str, formulas: dict[str, str]) -> str:
    keys = list(METRICS)
    return " UNION ALL ".join(
        f"SELECT as_of, {keys.index(key) + 1} AS ordinal, '{METRICS[key][0]}' AS metric, "
        f"CAST({formula} AS DOUBLE) AS value FROM {sums}" for key, formula in formulas.items())


POSITIONS = _long("contract_sums", _CONTRACT)
DAYS_TO_PAY = _long("pay_sums", {key: key for key in _PAY})
AGING = _long("aging_sums", {key: key for key in _AGING})

#: month ends from the first to the last dated receivable
RECEIVABLE_MONTHS = """
    SELECT last_day(CAST(m AS DATE)) AS as_of
    FROM generate_series(
        (SELECT CAST(date_trunc('month', min(tran_date)) AS TIMESTAMP) FROM ar_inquiry),
        (SELECT CAST(max(tran_date) AS TIMESTAMP) FROM ar_inquiry), INTERVAL 1 MONTH) s(m)"""

_STATES = """
    SELECT contract_id, valid_from,
           lead(valid_from) OVER (PARTITION BY contract_id ORDER BY valid_from NULLS FIRST) AS valid_to,
           in_backlog, is_open
    FROM (SELECT *, lag(in_backlog) OVER w AS was_in, lag(is_open) OVER w AS was_open FROM swept
          WINDOW w AS (PARTITION BY contract_id ORDER BY valid_from NULLS FIRST))
    WHERE was_in IS NULL OR was_in <> in_backlog OR was_open <> is_open"""

_SWEPT = {
    "by_day": """
        SELECT contract_id, tran_date AS valid_from, sum(change_order) AS change_orders,
               sum(billed) AS billed FROM contract_activity GROUP BY ALL
        UNION ALL
        SELECT s_suppkey, NULL, NULL, NULL FROM supplier""",
    "so_far": """
        SELECT contract_id, valid_from, ifnull(sum(change_orders) OVER w, 0) AS change_orders,
               ifnull(sum(billed) OVER w, 0) AS billed FROM by_day
        WINDOW w AS (PARTITION BY contract_id ORDER BY valid_from NULLS FIRST)""",
    "swept": """
        SELECT f.contract_id, valid_from,
               status_id = 2 AND project_number <> '00.000'
                   AND (ifnull(original_value, 0) > 0 OR f.change_orders > 0) AS in_backlog,
               in_backlog AND f.billed < ifnull(original_value, 0) + f.change_orders AS is_open
        FROM so_far f JOIN projects p ON p.contract_id = f.contract_id
        JOIN wip_today w ON w.contract_id = f.contract_id""",
}


def _needed(sql: str, views: dict[str, str]) -> dict[str, str]:
    """The views that a query uses, directly or not, in their order."""
    wanted, text = set(), sql
    for name in reversed(views):
        if name in text:
            wanted.add(name)
            text += views[name]
    return {name: body for name, body in views.items() if name in wanted}


def _dated(sql: str, dates: str, **more: str) -> str:
    views = {**_VIEWS, **more}
    return with_views(sql, **_needed(sql, {"dates": dates, **views}))


def queries(months: str, weeks: str, snapshot: str, snapshot_views: dict[str, str]) -> dict[str, str]:
    """The histories; `snapshot` is the query of the other 13 metrics over its views."""
    views = {**_VIEWS, **{k: v for k, v in snapshot_views.items() if k != "dates"}}
    whole = f"{snapshot} UNION ALL {POSITIONS} UNION ALL {DAYS_TO_PAY} UNION ALL {AGING}"
    return {
        "monthly_positions": _dated(POSITIONS, months),
        "weekly_positions": _dated(POSITIONS, weeks),
        "contract_states": with_views(_STATES, **_SWEPT),
        "days_to_pay_history": _dated(DAYS_TO_PAY, RECEIVABLE_MONTHS),
        "aging_history": _dated(AGING, RECEIVABLE_MONTHS),
        "monthly_history": with_views(whole, dates=months, **views),
    }


#: the tasks that the first captures did not have yet
_TASKS = "l_suppkey % 5 <> 0"
_LATE_TASKS = f"{_TASKS} AND CAST(l_extendedprice AS DECIMAL(18,2)) > 30000"


def captured(weeks: list[date], corrected: date, dates_of: Callable[[date], dict[str, str]]) -> str:
    """Two weeks captured on the day after each, the first again when its tasks were complete."""
    def report(week: date, captured_on: date, known_on: date) -> str:
        sql = with_views(report_query()).format(**dates_of(week))
        if captured_on != corrected:
            sql = sql.replace(_TASKS, _LATE_TASKS)
        return (f"SELECT DATE '{known_on}' AS known_on, 'week' AS grain, DATE '{week}' AS as_of, "
                f"DATE '{captured_on}' AS captured_on, * FROM ({sql})")

    first, second = weeks
    days = [week + timedelta(days=1) for week in weeks]
    return " UNION ALL ".join([
        report(first, days[0], days[0]), report(first, days[0], days[1]),
        report(second, days[1], days[1]), report(first, corrected, corrected),
        report(second, days[1], corrected)])


#: fixed values: the metrics that functions of a date determine
GIVEN = ("open_backlog", "budget_open_wip_eom", "wip_revised_value", "unbilled_retainage")


def given(dates: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT * FROM ({with_views(metric_row(*METRICS[key])).format(**dates)})" for key in GIVEN)
