"""Many conditional sums in one pass, and one-row results as a long table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from closebook.functions.scalars import literal


@dataclass(frozen=True)
class Measure:
    """A named sum of `value` over the rows where `where` holds, both SQL text."""

    name: str
    value: str
    where: str

    def within(self, name: str, period: str) -> Measure:
        """The same sum limited to a period."""
        return Measure(name, self.value, f"({self.where}) AND ({period})")

    def sum(self) -> Column:
        return F.expr(f"sum(CASE WHEN {self.where} THEN {self.value} END)").alias(self.name)


def sum_measures(rows: DataFrame, measures: Iterable[Measure], by: Iterable = (),
                 prefilter: bool = True) -> DataFrame:
    """Compute every measure in one aggregate over `rows`.

    Rows that count in no measure are filtered first, so that the date and
    code conditions of a few measures reach the scan.  Pass `prefilter=False`
    for rows that are sums already: their conditions would be tested on every
    detail row below.  A measure that no row qualifies for is null.
    """
    measures = list(measures)
    if prefilter:
        rows = rows.filter(" OR ".join(f"({m.where})" for m in measures))
        if len(measures) == 1:
            only = F.expr(f"sum({measures[0].value})").alias(measures[0].name)
            return rows.groupBy(*by).agg(only)
    return rows.groupBy(*by).agg(*[m.sum() for m in measures])


def to_long(wide: DataFrame, rows: Iterable[tuple[int, str, str]], *keys: str) -> DataFrame:
    """Turn wide results into (ordinal, metric, value) rows, nulls included.

    `rows` holds the ordinal, the name and the SQL formula of each metric.
    """
    items = [
        f"{ordinal}, {literal(metric)}, CAST({formula} AS DOUBLE)"
        for ordinal, metric, formula in rows
    ]
    stacked = f"stack({len(items)}, {', '.join(items)}) AS (ordinal, metric, value)"
    return wide.selectExpr(*keys, stacked)
