"""The input relations spelled in DuckDB SQL over the test tables."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "gl_debit_credit": """
        SELECT l_suppkey AS contract_id, l_partkey AS account_id,
               l_linenumber + 62 AS gl_type_id, CAST(l_shipdate AS DATE) AS tran_date,
               CASE l_returnflag
                   WHEN 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2))
                   WHEN 'R' THEN CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                                            * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
               END AS debit,
               CASE WHEN l_returnflag IN ('N', 'R')
                    THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS credit
        FROM lineitem""",
    "gl": """
        SELECT l_partkey AS cost_code_id, l_linenumber + 1 AS gl_type_id,
               CAST(l_shipdate AS DATE) AS tran_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS tran_amount
        FROM lineitem""",
    "cost_codes": """
        SELECT p_partkey AS cost_code_id, CAST(p_size AS VARCHAR) AS number FROM part""",
    "accounts": """
        SELECT p_partkey AS account_id, CAST(p_partkey % 13 AS INTEGER) AS account_type_id,
               CASE p_partkey % 13
                   WHEN 9 THEN 'Income' WHEN 5 THEN 'Cost of Goods Sold' WHEN 7 THEN 'Expense'
                   WHEN 11 THEN 'Other Expense' WHEN 12 THEN 'Other Income'
                   WHEN 2 THEN 'Accounts Receivable' WHEN 4 THEN 'Accounts Payable'
                   WHEN 6 THEN 'Credit Card Account' WHEN 8 THEN 'Other Current Liability'
                   WHEN 10 THEN 'Long Term Liability' WHEN 3 THEN 'Bank' ELSE 'Other Asset'
               END AS account_type,
               CASE WHEN p_partkey % 26 = 8 THEN '20700 Overbillings'
                    ELSE concat(p_partkey, ' ', p_name) END AS code_name,
               CASE WHEN p_partkey % 13 <= 3 THEN 1 ELSE 0 END AS is_asset,
               CASE WHEN p_partkey % 13 IN (4, 6, 8, 10) THEN 1 ELSE 0 END AS is_liability,
               p_partkey % 26 = 5 AS is_in_staff
        FROM part""",
    "projects": """
        SELECT s_suppkey AS contract_id,
               CASE WHEN s_nationkey % 3 = 0 THEN 1 ELSE 2 END AS status_id,
               CASE WHEN s_suppkey % 17 = 0 THEN '00.000'
                    ELSE concat(s_suppkey, '.000') END AS project_number,
               r_name AS department
        FROM supplier JOIN nation ON n_nationkey = s_nationkey
                      JOIN region ON r_regionkey = n_regionkey""",
    "contract_activity": """
        SELECT l_suppkey AS contract_id, CAST(l_shipdate AS DATE) AS tran_date,
               CASE WHEN l_returnflag = 'R' AND l_linenumber = 1
                    THEN CAST(round(CAST(l_extendedprice AS DECIMAL(18,2))
                                    * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2))
               END AS change_order,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS billed
        FROM lineitem""",
    "wip_today": """
        SELECT s_suppkey AS contract_id, CAST(any_value(s_acctbal) * 10000 AS DECIMAL(18,2))
                   AS original_value,
               sum(change_order) AS change_orders, sum(billed) AS total_amount
        FROM supplier LEFT JOIN contract_activity a
             ON a.contract_id = s_suppkey AND a.tran_date <= DATE '{today}'
        GROUP BY s_suppkey""",
    "wip_eom": """
        SELECT s_suppkey AS contract_id, CAST(any_value(s_acctbal) * 10000 AS DECIMAL(18,2))
                   AS original_value,
               sum(change_order) AS change_orders, sum(billed) AS total_amount
        FROM supplier LEFT JOIN contract_activity a
             ON a.contract_id = s_suppkey AND a.tran_date <= DATE '{month_end}'
        GROUP BY s_suppkey""",
    "contract_tasks": """
        SELECT l_suppkey AS contract_id,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
        FROM lineitem WHERE l_linestatus = 'O' AND l_suppkey % 5 <> 0""",
    "budget_items": """
        SELECT l_suppkey AS contract_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
        FROM lineitem WHERE l_linestatus = 'F'""",
    "daily_time": """
        SELECT CASE WHEN user_id % 10 <> 0
                    THEN event_id % (SELECT count(*) FROM supplier) END AS contract_id,
               user_id AS employee_id, worked AS hours,
               CAST(worked + CASE WHEN event_type = 'error' THEN 0.25 ELSE 0.00 END
                    AS DECIMAL(18,4)) AS total,
               ts - INTERVAL 8400 DAY AS in_time,
               ts - INTERVAL 8400 DAY + to_seconds(CAST(round(value * 72) AS BIGINT)) AS out_time
        FROM (SELECT *, CAST(CAST(value AS DECIMAL(18,2)) * CAST(0.02 AS DECIMAL(3,2))
                             AS DECIMAL(18,4)) AS worked FROM events)""",
    "employees": """
        SELECT c_custkey AS employee_id,
               CAST(CAST(c_acctbal AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(18,4)) AS wage,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN NULL ELSE 0 END
                   AS temp_hire
        FROM customer""",
    "ar_inquiry": """
        SELECT o_orderkey AS trans_doc_id, 'PAYAPP' AS gl_type_name,
               CAST(o_orderdate AS DATE) AS tran_date,
               CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS DECIMAL(18,2))
                    ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS balance_due,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS project
        FROM orders
        UNION ALL
        SELECT l_orderkey, 'PAYAPP-PMT', CAST(l_shipdate AS DATE), CAST(0 AS DECIMAL(18,2)),
               l_suppkey
        FROM lineitem WHERE l_returnflag <> 'N'""",
    "retainage": """
        SELECT CAST(o_orderdate AS DATE) AS tran_date,
               CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.1 AS DECIMAL(4,2)), 2)
                    AS DECIMAL(18,2)) AS unpaid_retainage
        FROM orders WHERE o_orderstatus = 'P'""",
    "survey": """
        SELECT event_id AS response_id, ts AS submitted_at, user_id AS employee_id,
               r_name AS department, CAST(floor(value) AS INTEGER) % 5 + 1 AS score
        FROM events JOIN customer ON c_custkey = user_id
                    JOIN nation ON n_nationkey = c_nationkey
                    JOIN region ON r_regionkey = n_regionkey
        WHERE event_type = 'view'""",
    # ledger lines with account attributes and debit minus credit
    "lines": """
        SELECT g.contract_id, g.tran_date, a.*,
               g.gl_type_id NOT IN (67, 68, 69) AS pl,
               ifnull(g.debit, 0) - ifnull(g.credit, 0) AS net
        FROM gl_debit_credit g JOIN accounts a USING (account_id)""",
    "open_today": """
        SELECT w.contract_id
        FROM wip_today w JOIN projects p USING (contract_id)
        WHERE p.status_id = 2 AND p.project_number <> '00.000'
          AND greatest(ifnull(original_value, 0), ifnull(change_orders, 0)) > 0
          AND ifnull(original_value, 0) + ifnull(change_orders, 0) > ifnull(total_amount, 0)""",
    "open_eom": """
        SELECT w.contract_id, ifnull(original_value, 0) + ifnull(change_orders, 0) AS revised
        FROM wip_eom w JOIN projects p USING (contract_id)
        WHERE p.status_id = 2 AND p.project_number <> '00.000'
          AND greatest(ifnull(original_value, 0), ifnull(change_orders, 0)) > 0
          AND ifnull(original_value, 0) + ifnull(change_orders, 0) > ifnull(total_amount, 0)""",
    "staff": """
        SELECT employee_id, wage FROM employees WHERE ifnull(temp_hire, 0) <> 1 AND wage > 0""",
    "task_sums": """
        SELECT contract_id, sum(ifnull(quantity, 0)) AS budgeted_hours,
               sum(ifnull(amount, 0)) AS budgeted_labor
        FROM contract_tasks JOIN open_today USING (contract_id) GROUP BY contract_id""",
    "time_sums": """
        SELECT contract_id, sum(ifnull(total, 0)) AS actual_hours
        FROM daily_time JOIN open_today USING (contract_id) GROUP BY contract_id""",
    "pairs": """
        SELECT trans_doc_id,
               max(tran_date) FILTER (WHERE gl_type_name = 'PAYAPP') AS invoice_date,
               max(tran_date) FILTER (WHERE gl_type_name = 'PAYAPP-PMT') AS payment_date
        FROM ar_inquiry WHERE gl_type_name LIKE 'PAYAPP%' GROUP BY trans_doc_id""",
    "lags": """
        SELECT invoice_date, date_diff('day', invoice_date, payment_date) AS days_diff
        FROM pairs WHERE payment_date > invoice_date""",
    "unpaid": """
        SELECT balance_due, date_diff('day', tran_date, DATE '{today}') AS age
        FROM ar_inquiry WHERE balance_due > 1 AND tran_date IS NOT NULL AND project IS NOT NULL""",
    "clocked": """
        SELECT d.contract_id, sum(date_diff('minute', in_time, out_time)) AS minutes
        FROM daily_time d SEMI JOIN staff s ON s.employee_id = d.employee_id
        WHERE d.contract_id IS NOT NULL
          AND in_time BETWEEN TIMESTAMP '{year_start} 00:00:00' AND TIMESTAMP '{today} 00:00:00'
        GROUP BY d.contract_id""",
    "earning": """
        SELECT l.contract_id, c.minutes,
               -sum(ifnull(net, 0)) FILTER (WHERE account_type_id = 9) AS revenue,
               sum(net) FILTER (WHERE is_in_staff) AS labor,
               ifnull(sum(net) FILTER (WHERE account_type_id = 5), 0) AS cogs
        FROM lines l JOIN clocked c ON c.contract_id = l.contract_id
        WHERE account_type_id IN (5, 9) AND pl
          AND tran_date BETWEEN DATE '{year_start}' AND DATE '{today}'
        GROUP BY l.contract_id, c.minutes
        HAVING revenue > 0 AND labor > 0 AND c.minutes > 0""",
}

_NAME = re.compile(r"\b(" + "|".join(VIEWS) + r")\b")


def _needed(sql: str, found: list[str]) -> list[str]:
    for name in _NAME.findall(sql):
        if name not in found:
            _needed(VIEWS[name], found)
            if name not in found:
                found.append(name)
    return found


def with_views(sql: str, **extra: str) -> str:
    """Prefix `sql` with the views it uses, in order of dependence."""
    text = sql + " ".join(extra.values())
    parts = [f"{name} AS ({VIEWS[name]})" for name in _needed(text, [])]
    parts += [f"{name} AS ({body})" for name, body in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql
