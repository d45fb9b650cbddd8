"""Control totals: what a run read, and what of it no metric can see.

Lines without a known account, without a date or without a contract drop out of metrics without a
word.  The totals count them in the pass that a refresh makes anyway, are stored with it, and a
refresh that has lost lines since an earlier one fails instead of reporting less.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from closebook.functions.scalars import one_of
from closebook.operators import ledger as G
from closebook.sources.relations import Relations

#: totals of the ledger: name -> SQL over a line with the account it found, if any
_INCOME_OR_COST = one_of("account_type_id", (G.COGS, G.INCOME))
TOTALS: dict[str, str] = {
    "lines": "sum(lines)",
    "net": "sum(net)",
    "lines_without_account": "sum(CASE WHEN known IS NULL THEN lines END)",
    "net_without_account": "sum(CASE WHEN known IS NULL THEN net END)",
    "lines_without_date": "sum(CASE WHEN tran_date IS NULL THEN lines END)",
    "lines_not_profit_and_loss": "sum(CASE WHEN NOT is_pl THEN lines END)",
    "result_lines_without_contract":
        f"sum(CASE WHEN is_pl AND contract_id IS NULL AND {_INCOME_OR_COST} THEN lines END)",
    "result_net": f"sum(CASE WHEN is_pl AND {_INCOME_OR_COST} THEN net END)",
}
#: totals that must not shrink from one refresh to the next; rows are only ever added
GROWING = ("lines",)


def checked_lines(rel: Relations) -> DataFrame:
    """Ledger amounts, each with the type of its account; `known` is null where there is none.

    Every line is kept, in contrast to `ledger.ledger_lines`.
    """
    accounts = rel.accounts.select("account_id", "account_type_id", F.lit(True).alias("known"))
    return G.amounts_of(rel).join(accounts, "account_id", "left")


def control_totals(rel: Relations) -> DataFrame:
    """(total, value) of the ledger in one pass; a total of nothing is 0."""
    row = checked_lines(rel).agg(*[
        F.expr(f"CAST(coalesce({value}, 0) AS DOUBLE) AS {name}")
        for name, value in TOTALS.items()])
    items = ", ".join(f"'{name}', {name}" for name in TOTALS)
    return row.selectExpr(f"stack({len(TOTALS)}, {items}) AS (total, value)")


def observed(rel: Relations, name: str = "controls") -> tuple[Relations, Observation]:
    """`rel` whose ledger counts its lines while a report reads them, and the observation.

    The observation holds `lines`, `net` and `lines_without_date` after the report was written: no
    second read.
    """
    seen = Observation(name)
    amounts = G.amounts_of(rel).observe(
        seen, F.sum("lines").alias("lines"), F.sum("net").alias("net"),
        F.sum(F.when(F.col("tran_date").isNull(), F.col("lines"))).alias("lines_without_date"))
    return rel.replace(ledger_sums=amounts), seen


class LostLines(ValueError):
    """A refresh read fewer lines than an earlier one."""


def refuse_losses(before: Mapping[str, float], now: Mapping[str, float]) -> None:
    """Raise if a total that can only grow has become smaller."""
    lost = {name: (before[name], now.get(name) or 0) for name in GROWING
            if (before.get(name) or 0) > (now.get(name) or 0)}
    if lost:
        raise LostLines(", ".join(f"{name}: {a} before, {b} now" for name, (a, b) in lost.items()))
