"""The metrics by department: contract metrics now, ledger and labour by week."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.functions.scalars import literal, ratio, week_start
from closebook.operators import ledger as G
from closebook.operators import report as K
from closebook.plans.measures import sum_measures, to_long
from closebook.sources.relations import Relations

FLOWS = ("revenue", "cogs", "net_income")

#: metrics made of sums per contract, so that contracts can be grouped by department
PER_DEPARTMENT = tuple(m for m in K.METRICS if set(m.sums) <= set(K.CONTRACT_SUMS))


def department_performance(rel: Relations, as_of: AsOf) -> DataFrame:
    """Every contract-based metric of the report per department.

    (department, ordinal, metric, value); the department is the project's, and null
    for projects without one, so that departments add up to the company.
    """
    table = K.contract_table(
        rel, as_of, {"today", "eom", "tasks", "budget", "time", "ledger"},
        G.ledger_by_contract(rel, as_of),
    )
    # contracts without a project have no department to count in; a project without one does
    projects = rel.projects.select("contract_id")
    sums = table.join(projects, "contract_id", "left_semi").groupBy("department").agg(
        *[measure.sum() for _, measure in K.CONTRACT_SUMS.values()]
    )
    return to_long(sums, [(m.ordinal, m.name, m.formula) for m in PER_DEPARTMENT], "department")


def department_health(rel: Relations, as_of: AsOf) -> DataFrame:
    """Weekly flows and hours of the year to date per department.

    Weeks start on Monday; the first one is cut at the start of the year and
    the last one at the as-of date.  Facts are summed per contract and week
    before the contract is turned into its department, so the lookup handles
    sums and a large contract or department costs no more than a small one.
    """
    ytd = G.window("ytd", as_of)
    money = sum_measures(
        G.ledger_lines(rel).filter(f"{ytd} AND contract_id IS NOT NULL"),
        [G.FLOWS[name] for name in FLOWS],
        by=["contract_id", F.expr(f"{week_start('tran_date')} AS week_start")],
    )
    first, after = literal(as_of.year_start), literal(as_of.today + timedelta(days=1))
    hours = (
        rel.daily_time.filter(
            f"contract_id IS NOT NULL AND in_time >= {first} AND in_time < {after}"
        )
        .groupBy("contract_id", F.expr(f"{week_start('in_time')} AS week_start"))
        .agg(F.expr("sum(coalesce(total, 0)) AS hours"))
    )
    sums = (*FLOWS, "hours")
    weeks = (
        money.unionByName(hours, allowMissingColumns=True)
        .join(rel.projects.select("contract_id", "department"), "contract_id")
        .groupBy("department", "week_start")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )
    so_far = Window.partitionBy("department").orderBy("week_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return weeks.select(
        "department", "week_start", *sums,
        F.expr(ratio("revenue - coalesce(cogs, 0)", "revenue", 4)).alias("gm_pct"),
        F.sum("revenue").over(so_far).alias("ytd_revenue"),
        F.sum("net_income").over(so_far).alias("ytd_net_income"),
    )
