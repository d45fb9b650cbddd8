"""Settings, pruned scans of single metrics, grains and departments without a name."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from closebook.operators import departments, report, snapshot
from closebook.sources import retail
from closebook.sources.relations import Relations
from tests.conftest import SMALL


def value(rel, as_of, key):
    return report.kpi(rel, as_of, key).first()["value"]


def test_in_staff_accounts_can_be_given(spark, as_of):
    rel = retail.relations(spark, SMALL)
    marked = [r[0] for r in rel.accounts.filter("is_in_staff").select("account_id").collect()]
    same = Relations({n: rel[n] for n in rel}, in_staff_accounts=marked)
    none = Relations({n: rel[n] for n in rel}, in_staff_accounts=[])
    key = "in_staff_hourly_rate_ytd"
    assert value(same, as_of, key) == value(rel, as_of, key)
    assert value(none, as_of, key) != value(rel, as_of, key) or value(rel, as_of, key) is None


def test_overbillings_name_can_be_given(spark, as_of):
    rel = retail.relations(spark, SMALL)
    other = Relations({n: rel[n] for n in rel}, overbillings="no such account")
    assert other.replace().overbillings == "no such account"
    assert value(other, as_of, "ap_mom_delta") != value(rel, as_of, "ap_mom_delta")


@pytest.mark.parametrize("days", [30, 60, 90, 180, 365])
def test_days_to_pay_bounds_reach_the_scan(spark, as_of, days):
    rel = retail.relations(spark, SMALL)
    frame = report.kpi(rel, as_of, f"days_to_pay_{days}")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert str(as_of.days_back(days)) in plan.replace("GreaterThan(", "")
    full = report.R.average_days_to_pay(rel, as_of, [days, None]).first()[f"pay_{days}"]
    assert full is None or abs(frame.first()["value"] - full) <= 0.5  # the metric is rounded


def test_departments_add_up_to_the_company(spark, as_of):
    rel = retail.relations(spark, SMALL)
    blank = rel.projects.withColumn(
        "department", F.when(F.col("contract_id") % 2 == 0, F.col("department")))
    rel = rel.replace(projects=blank)
    rows = departments.department_performance(rel, as_of).filter("metric = 'Pipeline'").collect()
    assert any(r["department"] is None for r in rows)
    assert sum(r["value"] or 0 for r in rows) == pytest.approx(value(rel, as_of, "open_backlog"))


def test_trend_keeps_grains_apart(spark):
    rows = [("month", date(2001, 1, 31), 1, "m", 1.0), ("week", date(2001, 2, 4), 1, "m", 9.0),
            ("month", date(2001, 2, 28), 1, "m", 3.0)]
    frame = spark.createDataFrame(
        rows, "grain string, as_of date, ordinal int, metric string, value double")
    got = {(r["grain"], r["as_of"].month): r["previous"] for r in snapshot.trend(frame).collect()}
    assert got == {("month", 1): None, ("week", 2): None, ("month", 2): 1.0}
    assert snapshot.wide(frame, [date(2001, 1, 31), date(2001, 2, 4)]).count() == 2
