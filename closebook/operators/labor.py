"""Timesheet hours and their cost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.functions.scalars import literal, minutes_crossed
from closebook.operators.contracts import (
    budgeted_hours,
    contract_budget_labor,
    of_open_contracts,
    open_contracts,
)
from closebook.operators.ledger import ledger_by_contract
from closebook.sources.relations import Relations

#: permanent employees with a wage
IN_STAFF = "coalesce(temp_hire, 0) <> 1 AND coalesce(wage, 0) > 0"

MINUTES = minutes_crossed("in_time", "out_time")


def clocked_ytd(as_of: AsOf) -> str:
    """Clock-in from the start of the year up to the start of the as-of day."""
    return f"in_time BETWEEN {literal(as_of.year_start)} AND {literal(as_of.today)}"


def wip_time_cost(rel: Relations, as_of: AsOf) -> DataFrame:
    """Timesheet lines of open contracts by permanent staff, with their cost."""
    lines = rel.daily_time.filter("contract_id IS NOT NULL").select(
        "contract_id", "employee_id", "hours"
    )
    staff = rel.employees.filter(IN_STAFF).select("employee_id", "wage")
    return (
        lines.join(open_contracts(rel, as_of.today), "contract_id", "left_semi")
        .join(staff, "employee_id")
        .selectExpr("contract_id", "hours", "wage", "hours * wage AS cost")
    )


def time_by_contract(rel: Relations, as_of: AsOf) -> DataFrame:
    """All timesheet sums per contract in one read.

    Lines are summed per contract and employee first, so the lookup of wages
    handles pairs instead of lines and a busy employee or contract is already
    combined in the tasks that read it.  Cost is the wage times the summed
    hours, which equals the sum of line costs because both are exact decimals.
    """
    pairs = rel.daily_time.filter("contract_id IS NOT NULL").groupBy(
        "contract_id", "employee_id"
    ).agg(
        F.expr("CAST(sum(hours) AS DECIMAL(22,4)) AS hours"),
        F.expr("sum(coalesce(total, 0)) AS total"),
        F.expr(f"sum(CASE WHEN {clocked_ytd(as_of)} THEN {MINUTES} END) AS minutes"),
    )
    wages = rel.employees.selectExpr(
        "employee_id", "CAST(wage AS DECIMAL(15,4)) AS wage", f"{IN_STAFF} AS in_staff"
    )
    return pairs.join(wages, "employee_id", "left").groupBy("contract_id").agg(
        F.expr("sum(total) AS actual_hours"),
        F.expr("sum(CASE WHEN in_staff THEN hours END) AS staff_hours"),
        F.expr("sum(CASE WHEN in_staff THEN hours * wage END) AS staff_cost"),
        F.expr("sum(CASE WHEN in_staff THEN minutes END) AS staff_minutes_ytd"),
    )


def total_hours_by_contract(rel: Relations) -> DataFrame:
    return rel.daily_time.filter("contract_id IS NOT NULL").groupBy("contract_id").agg(
        F.expr("sum(coalesce(total, 0)) AS actual_hours")
    )


def actual_hours(rel: Relations, as_of: AsOf) -> DataFrame:
    """Timesheet hours per open contract, temporary staff included."""
    return of_open_contracts(total_hours_by_contract(rel), rel, as_of)


def combined_hours(rel: Relations, as_of: AsOf) -> DataFrame:
    """Budgeted and actual hours over open contracts with a budget, one row."""
    return (
        budgeted_hours(rel, as_of).filter("budgeted_hours > 0")
        .join(total_hours_by_contract(rel), "contract_id", "left")
        .agg(
            F.sum("budgeted_hours").alias("budgeted_hours"),
            F.expr("sum(coalesce(actual_hours, 0)) AS actual_hours"),
        )
    )


def hours_with_budget_labor(rel: Relations, as_of: AsOf) -> DataFrame:
    """Timesheet hours per open contract that has budgeted money."""
    return total_hours_by_contract(rel).join(
        contract_budget_labor(rel, as_of), "contract_id", "left_semi"
    )


def total_hours_with_budget_labor(rel: Relations, as_of: AsOf) -> DataFrame:
    return hours_with_budget_labor(rel, as_of).agg(F.sum("actual_hours").alias("actual_hours"))


def in_staff_minutes(rel: Relations, as_of: AsOf) -> DataFrame:
    """Clock minutes of permanent staff per contract in the year to date."""
    pairs = rel.daily_time.filter(f"contract_id IS NOT NULL AND {clocked_ytd(as_of)}").groupBy(
        "contract_id", "employee_id"
    ).agg(F.expr(f"sum({MINUTES}) AS minutes"))
    staff = rel.employees.filter(IN_STAFF).select("employee_id")
    return pairs.join(staff, "employee_id", "left_semi").groupBy("contract_id").agg(
        F.sum("minutes").alias("staff_minutes_ytd")
    )


def in_staff_hours(rel: Relations, as_of: AsOf) -> DataFrame:
    return in_staff_minutes(rel, as_of).selectExpr(
        "contract_id", "staff_minutes_ytd / 60D AS in_staff_hours"
    )


def earns_with_staff(revenue: str, labor: str, minutes: str) -> str:
    """Contracts that count in the hourly rate: all three are positive."""
    return f"{revenue} > 0 AND {labor} > 0 AND {minutes} > 0"


def project_level_ytd(rel: Relations, as_of: AsOf) -> DataFrame:
    """Year-to-date revenue, labour, cost and hours of contracts that count.

    Ledger and timesheets are both summed per contract before they meet.
    """
    money = ledger_by_contract(
        rel, as_of,
        ["contract_ytd_revenue", "contract_ytd_cogs", "contract_ytd_in_staff_labor"],
    )
    return (
        money.join(in_staff_minutes(rel, as_of), "contract_id")
        .filter(earns_with_staff(
            "contract_ytd_revenue", "contract_ytd_in_staff_labor", "staff_minutes_ytd"
        ))
        .selectExpr(
            "contract_id",
            "contract_ytd_revenue AS total_revenue_ytd",
            "contract_ytd_in_staff_labor AS in_staff_labor_ytd",
            "coalesce(contract_ytd_cogs, 0) AS total_cogs_ytd",
            "staff_minutes_ytd / 60D AS in_staff_hours_ytd",
        )
    )
