"""The relations as temporary views and as-of table functions for Spark SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from closebook.functions.scalars import literal
from closebook.sources.relations import Relations

_WIP_TOTALS = """
CREATE OR REPLACE TEMPORARY FUNCTION wip_totals(as_of DATE)
RETURNS TABLE (contract_id {contract}, original_value DECIMAL(38,6), change_orders DECIMAL(38,6),
               total_amount DECIMAL(38,6))
RETURN
  SELECT v.contract_id, CAST(any_value(v.original_value) AS DECIMAL(38,6)),
         CAST(sum(a.change_order) AS DECIMAL(38,6)), CAST(sum(a.billed) AS DECIMAL(38,6))
  FROM contract_values v
  LEFT JOIN contract_activity a
    ON a.contract_id = v.contract_id AND a.tran_date <= wip_totals.as_of
  GROUP BY v.contract_id
"""

# both dates bound the rows; the second one allows a cut-off before the run date
_AR_AGING = """
CREATE OR REPLACE TEMPORARY FUNCTION ar_aging(as_of DATE, cut_off DATE)
RETURNS TABLE (contract_id {contract}, unpaid_retainage DECIMAL(38,6))
RETURN
  SELECT contract_id, CAST(sum(unpaid_retainage) AS DECIMAL(38,6))
  FROM retainage
  WHERE tran_date <= least(ar_aging.as_of, ar_aging.cut_off)
  GROUP BY contract_id
"""


def register(rel: Relations) -> None:
    """Make every relation a temporary view and define `wip_totals` and `ar_aging`.

    The functions are for single dates: under LATERAL they pair rows with dates.
    `contracts.wip_totals` takes several dates, `snapshot` any number.
    """
    for name in rel:
        rel[name].createOrReplaceTempView(name)
    spark = rel.spark
    for name, function in (("contract_values", _WIP_TOTALS), ("retainage", _AR_AGING)):
        kind = rel[name].schema["contract_id"].dataType.simpleString()
        spark.sql(function.format(contract=kind))


def given_function(spark: SparkSession, call: str) -> Callable[[Sequence[date]], DataFrame]:
    """A table function known to SQL as a relation of dates, for `Relations.with_functions`.

    `call` is the call with `{day}` in the place of the date, as `wip_totals({day})` or
    `ar_aging({day}, {day})`.  All dates are asked in one query.
    """
    def asked(dates: Sequence[date]) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            spark.sql(f"SELECT {literal(day)} AS as_of, * FROM {call.format(day=literal(day))}")
            for day in dates])
    return asked
