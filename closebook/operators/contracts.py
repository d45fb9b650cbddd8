"""Contract positions, the open contract set and contract budgets."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.functions.scalars import literal, zero_if_null
from closebook.operators.ledger import ledger_by_contract
from closebook.plans.measures import Measure
from closebook.sources.relations import Relations

# Project status that counts as open, number of the overhead project
OPEN_STATUS = 2
OVERHEAD_PROJECT = "00.000"


def wip_totals(rel: Relations, dates: Mapping[str, date]) -> DataFrame:
    """Value, approved change orders and amount billed per contract.

    `dates` maps a column suffix to a date; all dates are answered by one pass
    over the contract activity, one row per contract.  With several dates the
    activity is first summed between them, so a line enters each sum once.
    A given function of a date is asked for all of them instead.
    """
    if "wip_totals" in rel.given:
        return _given_totals(rel, dates)
    ends = sorted(set(dates.values()))
    moved = rel.contract_activity.filter(f"tran_date <= {literal(ends[-1])}")
    if len(ends) > 1:
        between = " ".join(f"WHEN tran_date <= {literal(e)} THEN {literal(e)}" for e in ends)
        moved = moved.groupBy(
            "contract_id", F.expr(f"CASE {between} END").alias("tran_date")
        ).agg(F.sum("change_order").alias("change_order"), F.sum("billed").alias("billed"))
    sums = [
        Measure(f"{target}{suffix}", source, f"tran_date <= {literal(end)}").sum()
        for suffix, end in dates.items()
        for source, target in (("change_order", "change_orders"), ("billed", "total_amount"))
    ]
    return rel.contract_values.join(moved.groupBy("contract_id").agg(*sums), "contract_id", "left")


def _given_totals(rel: Relations, dates: Mapping[str, date]) -> DataFrame:
    """The totals that a function of a date returns; the value is that of the last date."""
    ends = sorted(set(dates.values()))
    value = Measure("original_value", "original_value", f"as_of = {literal(ends[-1])}")
    totals = [
        Measure(f"{name}{suffix}", name, f"as_of = {literal(end)}")
        for suffix, end in dates.items() for name in ("change_orders", "total_amount")
    ]
    return rel.given["wip_totals"](ends).groupBy("contract_id").agg(
        *[measure.sum() for measure in (value, *totals)])


def contract_positions(rel: Relations, dates: Mapping[str, date]) -> DataFrame:
    """`wip_totals` of the contracts that have a project."""
    return rel.projects.join(wip_totals(rel, dates), "contract_id")


def revised_value(suffix: str = "") -> str:
    return f"{zero_if_null('original_value')} + {zero_if_null('change_orders' + suffix)}"


def in_backlog(suffix: str = "") -> str:
    """Open status, a value, and not the overhead project."""
    return (
        f"status_id = {OPEN_STATUS} AND (original_value > 0 OR change_orders{suffix} > 0)"
        f" AND rtrim(project_number) <> {literal(OVERHEAD_PROJECT)}"
    )


def is_open(suffix: str = "") -> str:
    """In backlog and not yet billed in full."""
    billed = zero_if_null(f"total_amount{suffix}")
    return f"{in_backlog(suffix)} AND {billed} < {revised_value(suffix)}"


def open_contracts(rel: Relations, end: date) -> DataFrame:
    """Contracts open on a date.  Project status is always the current one."""
    return contract_positions(rel, {"": end}).filter(is_open()).select("contract_id")


def of_open_contracts(per_contract: DataFrame, rel: Relations, as_of: AsOf) -> DataFrame:
    """Keep the rows of contracts open on the as-of date.

    Callers pass rows already summed per contract, so the join never moves a
    contract's detail rows.
    """
    return per_contract.join(open_contracts(rel, as_of.today), "contract_id", "left_semi")


def tasks_by_contract(rel: Relations) -> DataFrame:
    return rel.contract_tasks.filter("contract_id IS NOT NULL").groupBy("contract_id").agg(
        F.expr("sum(coalesce(quantity, 0)) AS budgeted_hours"),
        F.expr("sum(coalesce(amount, 0)) AS budgeted_labor"),
    )


def budget_by_contract(rel: Relations) -> DataFrame:
    return rel.budget_items.filter("contract_id IS NOT NULL").groupBy("contract_id").agg(
        F.sum("amount").alias("budget")
    )


def wip_revenue(rel: Relations, as_of: AsOf) -> DataFrame:
    """Revenue to date of open contracts, one row."""
    rows = ledger_by_contract(rel, as_of, ["contract_revenue"])
    return of_open_contracts(rows, rel, as_of).agg(
        F.sum("contract_revenue").alias("total_revenue")
    )


def wip_cost(rel: Relations, as_of: AsOf) -> DataFrame:
    """Cost to date of open contracts, one row."""
    rows = ledger_by_contract(rel, as_of, ["contract_cogs"])
    return of_open_contracts(rows, rel, as_of).agg(F.sum("contract_cogs").alias("total_cost"))


def budgeted_hours(rel: Relations, as_of: AsOf) -> DataFrame:
    rows = tasks_by_contract(rel).select("contract_id", "budgeted_hours")
    return of_open_contracts(rows, rel, as_of)


def wip_budget_labor(rel: Relations, as_of: AsOf) -> DataFrame:
    """Budgeted money over all open contracts, one row."""
    return of_open_contracts(tasks_by_contract(rel), rel, as_of).agg(
        F.sum("budgeted_labor").alias("budgeted_labor")
    )


def contract_budget_labor(rel: Relations, as_of: AsOf) -> DataFrame:
    """Budgeted money per open contract, where there is any."""
    rows = tasks_by_contract(rel).select("contract_id", "budgeted_labor")
    return of_open_contracts(rows, rel, as_of).filter("budgeted_labor > 0")
