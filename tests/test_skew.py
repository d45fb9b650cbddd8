"""Hot keys and lost broadcasts change neither results nor the size of any group."""

import pytest
from pyspark.sql import functions as F

from closebook.operators import departments, ledger, report, snapshot
from closebook.sources import retail
from tests.conftest import SMALL, values


@pytest.fixture
def hot(spark):
    """A third of all rows on one contract, one account, one employee and one document."""
    tables = retail.RetailTables(spark, SMALL)
    lines, events = tables.file("lineitem"), tables.file("events")
    third = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    lines = lines.withColumns({
        "l_partkey": F.when(third, F.lit(9)).otherwise(F.col("l_partkey")),
        "l_suppkey": F.when(third, F.lit(4)).otherwise(F.col("l_suppkey")),
        "l_orderkey": F.when(third, F.lit(1)).otherwise(F.col("l_orderkey")),
    })
    events = events.withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(3)).otherwise(F.col("user_id"))
    )
    return retail.relations(spark, SMALL, lineitem=lines, events=events)


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold",
             "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    # splits already tiny partitions, as a cluster does with large ones
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.1")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    yield
    for name in (*names, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        spark.conf.unset(name)


def _all(rel, as_of):
    health = {(r["department"], r["week_start"]): tuple(r)
              for r in departments.department_health(rel, as_of).collect()}
    months = {(r["as_of"], r["metric"]): r["value"]
              for r in snapshot.monthly_snapshot(rel).collect()}
    return values(report.kpi_report(rel, as_of)), health, months


def test_sort_merge_joins_give_the_same_results(hot, as_of, request):
    with_broadcast = _all(hot, as_of)
    request.getfixturevalue("no_broadcast")
    assert _all(hot, as_of) == with_broadcast


def test_hot_ledger_equals_a_plain_sum(hot, as_of):
    found = values(report.kpi_report(hot, as_of))
    accounts = {r["account_id"]: r for r in hot.accounts.collect()}
    cash = 0
    for r in hot.gl_debit_credit.collect():
        account = accounts[r["account_id"]]
        if account["is_asset"] and account["account_type_id"] in (0, 1, 3) and (
                r["tran_date"] <= as_of.month_end):
            cash += (r["debit"] or 0) - (r["credit"] or 0)
    assert found["CashBalanceAsOfEOM"] == float(cash)


def test_cells_shrink_hot_accounts_before_the_shuffle(hot, as_of):
    from closebook.operators.ledger import ledger_cells
    cells = ledger_cells(hot, as_of)
    lines = hot.gl_debit_credit.count()
    assert cells.filter("contract_id IS NULL").count() < lines / 20
    assert cells.agg(F.sum("lines")).first()[0] == lines


def test_a_hot_account_is_split_when_accounts_do_not_fit_a_broadcast(hot, as_of, no_broadcast, capsys):
    from closebook.operators.ledger import ledger_report
    # lines must come from several tasks for their shuffle output to be split
    spread = hot.replace(gl_debit_credit=hot.gl_debit_credit.repartition(8))
    result = ledger_report(spread, as_of)
    result.collect()
    result.explain()
    final = capsys.readouterr().out.split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true) [account_id" in final


def test_lines_carry_one_number_for_their_account(medium, as_of):
    # the account side of the join is narrow, and sums are grouped by the class
    cells = ledger.sum_cells(medium, ledger.class_lines(medium), "contract_id")
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(x for x in plan.split("\n") if "Aggregate [contract_id" in x)
    assert "class" in grouped and "account_type" not in grouped
    classes = ledger.class_attributes(medium)
    assert classes.count() < 40 < medium.accounts.count()
