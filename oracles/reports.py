"""Queries for snapshots, trend, departments, survey and sheets."""

from __future__ import annotations

from datetime import date

from oracles import history
from oracles.metrics import METRICS, PAYABLE, report_query, twelfth
from oracles.views import with_views

_MONTHS = """
    SELECT last_day(CAST(m AS DATE)) AS as_of
    FROM generate_series((SELECT CAST(date_trunc('month', min(l_shipdate)) AS TIMESTAMP) FROM lineitem),
                         (SELECT CAST(max(l_shipdate) AS TIMESTAMP) FROM lineitem),
                         INTERVAL 1 MONTH) s(m)"""
# Monday of the week plus six days is its Sunday
_WEEKS = """
    SELECT CAST(m AS DATE) + 6 AS as_of
    FROM generate_series((SELECT CAST(date_trunc('week', min(l_shipdate)) AS TIMESTAMP) FROM lineitem),
                         (SELECT CAST(max(l_shipdate) AS TIMESTAMP) FROM lineitem),
                         INTERVAL 7 DAY) s(m)"""

_CALENDAR = """
    SELECT as_of,
           CAST(date_trunc('year', as_of) AS DATE) AS y0,
           CAST(date_trunc('month', as_of) AS DATE) - 1 AS m1,
           CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE) AS m0,
           CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE) - 1 AS p1,
           CAST(date_trunc('month', as_of) - INTERVAL 12 MONTH AS DATE) AS t0
    FROM dates"""

_YTD, _MONTH = "tran_date >= y0", "tran_date BETWEEN m0 AND m1"
_IS_INCOME = "account_type = 'Income'"


def _f(condition: str, value: str = "net") -> str:
    return f"sum({value}) FILTER (WHERE {condition})"


_TOTALS = f"""
    SELECT as_of,
           {_f(f'account_type_id = 5 AND pl AND tran_date BETWEEN t0 AND m1')} AS cogs_12m,
           {_f('is_asset = 1 AND account_type_id IN (0, 1, 3) AND tran_date <= m1', 'round(net, 2)')} AS cash,
           {_f(f'account_type_id IN (5, 7, 9, 12) AND pl AND {_MONTH}', '-net')} AS net_income,
           {_f('is_asset = 1 AND account_type_id = 2 AND tran_date <= m1', 'round(net, 2)')} AS ar,
           {_f('is_asset = 1 AND account_type_id = 2 AND tran_date <= p1', 'round(net, 2)')} AS ar_prior,
           {_f(f'{_IS_INCOME} AND pl AND {_MONTH}', '-net')} AS income,
           {_f(f"account_type IN ('Income', 'Cost of Goods Sold', 'Expense') AND pl AND {_MONTH}", '-net')}
               AS ordinary,
           {_f(f'{PAYABLE} AND tran_date <= m1', '-round(net, 2)')} AS ap,
           {_f(f'{PAYABLE} AND tran_date <= p1', '-round(net, 2)')} AS ap_prior,
           {_f('is_liability = 1 AND account_type_id <> 10 AND tran_date <= m1', '-round(net, 2)')} AS liabilities,
           {_f(f'account_type_id = 9 AND pl AND {_YTD}', '-net')} AS revenue,
           {_f(f'account_type_id = 5 AND pl AND {_YTD}')} AS cost,
           {_f(f'{_IS_INCOME} AND pl AND {_YTD}', '-net')} AS income_ytd,
           {_f(f"account_type IN ('Income', 'Cost of Goods Sold', 'Expense', 'Other Income') AND pl AND {_YTD}",
               '-net')} AS net_ytd,
           {_f(f"account_type IN ('Income', 'Cost of Goods Sold') AND pl AND {_YTD}", '-net')} AS gross_ytd
    FROM cal LEFT JOIN lines ON tran_date <= as_of
    GROUP BY as_of"""

_IDC = """
    SELECT as_of, sum(tran_amount) AS idc
    FROM cal JOIN (SELECT * FROM gl JOIN cost_codes USING (cost_code_id)
                   WHERE number LIKE '9%' AND gl_type_id IN (2, 7, 8, 12, 17, 18, 19, 44, 45))
         ON tran_date BETWEEN t0 AND m1
    GROUP BY as_of"""

_CLOCK = """
    SELECT as_of, d.contract_id, sum(date_diff('minute', in_time, out_time)) AS minutes
    FROM daily_time d JOIN staff USING (employee_id)
         JOIN cal ON in_time BETWEEN CAST(y0 AS TIMESTAMP) AND CAST(as_of AS TIMESTAMP)
    WHERE d.contract_id IS NOT NULL
    GROUP BY as_of, d.contract_id"""

_EARN = """
    SELECT cal.as_of, l.contract_id, any_value(k.minutes) AS minutes,
           -sum(net) FILTER (WHERE account_type_id = 9) AS revenue,
           sum(net) FILTER (WHERE is_in_staff) AS labor,
           ifnull(sum(net) FILTER (WHERE account_type_id = 5), 0) AS cogs
    FROM cal JOIN lines l ON tran_date BETWEEN y0 AND cal.as_of
         JOIN clock k ON k.as_of = cal.as_of AND k.contract_id = l.contract_id
    WHERE account_type_id IN (5, 9) AND pl
    GROUP BY cal.as_of, l.contract_id
    HAVING -sum(net) FILTER (WHERE account_type_id = 9) > 0
       AND sum(net) FILTER (WHERE is_in_staff) > 0 AND any_value(k.minutes) > 0"""

_RATES = """
    SELECT as_of, round(CAST(sum(labor) AS DOUBLE) / nullif(CAST(sum(cogs) AS DOUBLE), 0)
                        * CAST(sum(revenue) AS DOUBLE)
                        / nullif(sum(minutes) / CAST(60 AS DOUBLE), 0), 2) AS rate
    FROM earn GROUP BY as_of"""


def _pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), 4)"


_FORMULAS = {
    "avg_monthly_idc_12m": twelfth("idc"),
    "avg_monthly_cogs_12m": twelfth("cogs_12m"),
    "cash_balance_eom": "cash",
    "net_income_last_month": "net_income",
    "ar_mom_delta": "ar_prior - ar",
    "total_income_last_month": "income",
    "net_ordinary_income_last_month": "ordinary",
    "ap_mom_delta": "ifnull(ap, 0) - ifnull(ap_prior, 0)",
    "current_liabilities_eom": "liabilities",
    "ytd_gm_pct": _pct("revenue - ifnull(cost, 0)", "revenue"),
    "net_profit_pct_ytd": _pct("net_ytd", "income_ytd"),
    "in_staff_hourly_rate_ytd": "rate",
    "gross_profit_pct_ytd": _pct("gross_ytd", "income_ytd"),
}


def _snapshot_views(dates: str) -> dict[str, str]:
    keys = list(METRICS)
    long = " UNION ALL ".join(
        f"SELECT as_of, {keys.index(key) + 1} AS ordinal, '{METRICS[key][0]}' AS metric, "
        f"CAST({formula} AS DOUBLE) AS value FROM totals LEFT JOIN idc_sums USING (as_of) "
        f"LEFT JOIN rates USING (as_of)"
        for key, formula in _FORMULAS.items()
    )
    return {
        "dates": dates, "cal": _CALENDAR, "totals": _TOTALS, "idc_sums": _IDC, "clock": _CLOCK,
        "earn": _EARN, "rates": _RATES, "snap": long,
    }


def _wide(periods: list[date]) -> str:
    columns = ", ".join(
        f"max(value) FILTER (WHERE as_of = DATE '{p}') AS p_{p:%Y_%m_%d}" for p in periods
    )
    return f"SELECT ordinal, metric, {columns} FROM snap GROUP BY ordinal, metric"


_TREND = """
    SELECT as_of, metric, value, previous, value - previous AS change,
           round((value - previous) / nullif(abs(previous), 0), 4) AS change_ratio
    FROM (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY as_of) AS previous FROM snap)"""

_MORALE = """
    SELECT grain, department, period_start, responses, round(score, 4) AS avg_score,
           round(score - lag(score) OVER (PARTITION BY grain, department ORDER BY period_start), 4)
               AS change
    FROM (SELECT 'week' AS grain, department,
                 CAST(date_trunc('week', submitted_at) AS DATE) AS period_start,
                 count(*) AS responses, avg(score) AS score
          FROM survey GROUP BY ALL
          UNION ALL
          SELECT 'month', department, CAST(date_trunc('month', submitted_at) AS DATE),
                 count(*), avg(score)
          FROM survey GROUP BY ALL)"""

_HEALTH = """
    SELECT department, week_start, CAST(revenue AS DOUBLE) AS revenue, CAST(cogs AS DOUBLE) AS cogs,
           CAST(net_income AS DOUBLE) AS net_income, CAST(worked AS DOUBLE) AS hours,
           round(CAST(revenue - ifnull(cogs, 0) AS DOUBLE) / nullif(CAST(revenue AS DOUBLE), 0), 4)
               AS gm_pct,
           CAST(sum(revenue) OVER so_far AS DOUBLE) AS ytd_revenue,
           CAST(sum(net_income) OVER so_far AS DOUBLE) AS ytd_net_income
    FROM money FULL JOIN worked USING (department, week_start)
    WINDOW so_far AS (PARTITION BY department ORDER BY week_start)"""

_MONEY = """
    SELECT department, CAST(date_trunc('week', tran_date) AS DATE) AS week_start,
           -sum(net) FILTER (WHERE account_type_id = 9) AS revenue,
           sum(net) FILTER (WHERE account_type_id = 5) AS cogs, -sum(net) AS net_income
    FROM lines JOIN projects USING (contract_id)
    WHERE account_type_id IN (5, 7, 9, 12) AND pl
      AND tran_date BETWEEN DATE '{year_start}' AND DATE '{today}'
    GROUP BY ALL"""

_WORKED = """
    SELECT department, CAST(date_trunc('week', in_time) AS DATE) AS week_start,
           sum(ifnull(total, 0)) AS worked
    FROM daily_time JOIN projects USING (contract_id)
    WHERE CAST(in_time AS DATE) BETWEEN DATE '{year_start}' AND DATE '{today}'
    GROUP BY ALL"""


def _by_department(value: str, rows: str) -> str:
    return f"SELECT department, CAST({value} AS DOUBLE) AS value FROM {rows} GROUP BY department"


_DEPARTMENT = {
    "open_backlog": _by_department(
        "sum(ifnull(original_value, 0) + ifnull(change_orders, 0) - ifnull(total_amount, 0))",
        """wip_today JOIN projects USING (contract_id)
           WHERE status_id = 2 AND (original_value > 0 OR change_orders > 0)
             AND project_number <> '00.000'"""),
    "budget_open_wip_eom": _by_department(
        "sum(amount)",
        "budget_items JOIN open_eom USING (contract_id) JOIN projects USING (contract_id)"),
    "wip_budgeted_hours": _by_department(
        "sum(budgeted_hours)",
        "task_sums JOIN projects USING (contract_id) WHERE budgeted_hours > 0"),
    "wip_actual_hours": _by_department(
        "sum(ifnull(actual_hours, 0))",
        """task_sums JOIN projects USING (contract_id) LEFT JOIN time_sums USING (contract_id)
           WHERE budgeted_hours > 0"""),
    "wip_hours_ratio": _by_department(
        """round(CAST(sum(ifnull(actual_hours, 0)) AS DOUBLE)
                 / nullif(CAST(sum(budgeted_hours) AS DOUBLE), 0), 2)""",
        """task_sums JOIN projects USING (contract_id) LEFT JOIN time_sums USING (contract_id)
           WHERE budgeted_hours > 0"""),
    "wip_revised_value": _by_department(
        "sum(revised)", "open_eom JOIN projects USING (contract_id)"),
    "wip_budgeted_labor": _by_department(
        "sum(budgeted_labor)", "task_sums JOIN projects USING (contract_id)"),
    "hours_budgeted_projects": _by_department(
        "sum(actual_hours)",
        """time_sums JOIN projects USING (contract_id) JOIN task_sums USING (contract_id)
           WHERE budgeted_labor > 0"""),
    "wip_gm_pct": _by_department(
        """round(CAST(-sum(net) FILTER (WHERE account_type_id = 9)
                      - ifnull(sum(net) FILTER (WHERE account_type_id = 5), 0) AS DOUBLE)
                 / nullif(CAST(-sum(net) FILTER (WHERE account_type_id = 9) AS DOUBLE), 0), 4)""",
        "lines JOIN open_today USING (contract_id) JOIN projects USING (contract_id) WHERE pl"),
    "in_staff_hourly_rate_ytd": _by_department(
        """round(CAST(sum(labor) AS DOUBLE) / nullif(CAST(sum(cogs) AS DOUBLE), 0)
                 * CAST(sum(revenue) AS DOUBLE)
                 / nullif(sum(minutes) / CAST(60 AS DOUBLE), 0), 2)""",
        "earning JOIN projects USING (contract_id)"),
    "in_staff_labor_efficiency": _by_department(
        """round(CAST(sum(d.hours * wage) AS DOUBLE) / nullif(CAST(sum(d.hours) AS DOUBLE), 0), 2)""",
        """daily_time d JOIN staff USING (employee_id) JOIN open_today USING (contract_id)
           JOIN projects USING (contract_id)"""),
}


def _performance() -> str:
    keys = list(METRICS)
    return " UNION ALL ".join(
        f"SELECT d.department, {keys.index(key) + 1} AS ordinal, '{METRICS[key][0]}' AS metric, value "
        f"FROM (SELECT DISTINCT department FROM projects) d LEFT JOIN ({query}) USING (department)"
        for key, query in _DEPARTMENT.items()
    )


def _external(year: int) -> str:
    return f"""
        SELECT 'computed' AS source, metric, DATE '{{today}}' AS period, value FROM ({report_query()})
        UNION ALL
        SELECT 'sheet', o_orderpriority, last_day(CAST(o_orderdate AS DATE)),
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
        FROM orders WHERE year(o_orderdate) = {year}
        GROUP BY o_orderpriority, last_day(CAST(o_orderdate AS DATE))"""


_CONTROLS = """
    SELECT unnest(['lines', 'net', 'lines_without_account', 'net_without_account',
                   'lines_without_date', 'lines_not_profit_and_loss',
                   'result_lines_without_contract', 'result_net']) AS total,
           unnest([CAST(count(*) AS DOUBLE), CAST(ifnull(sum(net), 0) AS DOUBLE),
                   CAST(count(*) FILTER (WHERE a_id IS NULL) AS DOUBLE),
                   CAST(ifnull(sum(net) FILTER (WHERE a_id IS NULL), 0) AS DOUBLE),
                   CAST(count(*) FILTER (WHERE tran_date IS NULL) AS DOUBLE),
                   CAST(count(*) FILTER (WHERE NOT pl) AS DOUBLE),
                   CAST(count(*) FILTER (WHERE pl AND contract_id IS NULL AND result) AS DOUBLE),
                   CAST(ifnull(sum(net) FILTER (WHERE pl AND result), 0) AS DOUBLE)]) AS value
    FROM (SELECT g.*, a.account_id AS a_id, ifnull(debit, 0) - ifnull(credit, 0) AS net,
                 gl_type_id NOT IN (67, 68, 69) AS pl, account_type_id IN (5, 9) AS result
          FROM gl_debit_credit g LEFT JOIN accounts a ON a.account_id = g.account_id)"""


def queries(dates: dict[str, str], periods: list[date], sheet_year: int) -> dict[str, str]:
    months, weeks = _snapshot_views(_MONTHS), _snapshot_views(_WEEKS)
    raw = {
        "monthly_snapshot": with_views("SELECT * FROM snap", **months),
        "incremental_report": with_views(report_query()),
        "incremental_snapshot": with_views("SELECT * FROM snap", **months),
        "weekly_snapshot": with_views("SELECT * FROM snap", **weeks),
        "snapshot_refresh": with_views(
            f"SELECT *, 'day' AS grain, DATE '{{today}}' AS as_of FROM ({report_query()})"
        ),
        "kpi_wide": with_views(_wide(periods), **months),
        "kpi_trend": with_views(_TREND, **months),
        "morale_by_department": with_views(_MORALE),
        "department_performance": with_views(_performance()),
        "department_health": with_views(_HEALTH, money=_MONEY, worked=_WORKED),
        "control_totals": with_views(_CONTROLS),
        "external_metrics": with_views(_external(sheet_year)),
        **history.queries(_MONTHS, _WEEKS, "SELECT * FROM snap", months),
    }
    return {key: sql.format(**dates) for key, sql in raw.items()}
