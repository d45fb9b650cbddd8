"""Metrics kept in sheets outside the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.operators.report import kpi_report
from closebook.sources.relations import Relations


def sheet_to_long(sheet: DataFrame, year: int) -> DataFrame:
    """One row per metric and month from a sheet with a column per month.

    The period is the month end; empty cells are left out.
    """
    months = ", ".join(
        f"last_day(DATE'{year}-{m:02d}-01'), CAST(m{m:02d} AS DOUBLE)" for m in range(1, 13)
    )
    return sheet.selectExpr("metric", f"stack(12, {months}) AS (period, value)").filter(
        "value IS NOT NULL"
    )


def external_metrics(rel: Relations, as_of: AsOf, sheet_year: int) -> DataFrame:
    """The sheet's months and the computed report in one (source, metric, period, value) list."""
    computed = kpi_report(rel, as_of).select(
        F.lit("computed").alias("source"), "metric",
        F.lit(as_of.today).alias("period"), "value",
    )
    external = sheet_to_long(rel.external_sheet, sheet_year).withColumn("source", F.lit("sheet"))
    return computed.unionByName(external)
