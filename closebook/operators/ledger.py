"""Metrics that are sums over ledger lines.

A metric is a *flow* (which lines, which sign) limited to a *window* of dates
around the as-of date.  One metric alone filters the ledger by its own codes
and dates.  Several metrics together share one pass: lines are first summed
into cells (account attributes x date interval), which needs one sum per line
however many metrics there are, and the metrics are then sums over cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.functions.scalars import is_text, latest_boundary, literal, one_of
from closebook.plans.measures import Measure, sum_measures
from closebook.sources.relations import Relations

# Ledger codes
NOT_PROFIT_AND_LOSS = (67, 68, 69)
IDC_GL_TYPES = (2, 7, 8, 12, 17, 18, 19, 44, 45)
IDC_CODE_PREFIX = "9"
INCOME, COGS, EXPENSE, OTHER_INCOME, OTHER_EXPENSE = 9, 5, 7, 12, 11
RECEIVABLE, LONG_TERM_LIABILITY = 2, 10
CASH_TYPES = (3, 0, 1)

ATTRIBUTES = (
    "account_type_id", "account_type", "is_asset", "is_liability", "is_overbillings",
    "is_in_staff",
)


def account_attributes(rel: Relations) -> DataFrame:
    """What the metrics look at, after the settings of `rel`."""
    in_staff = F.coalesce("is_in_staff", F.lit(False))
    if rel.in_staff_accounts is not None:
        in_staff = F.col("account_id").isin(*rel.in_staff_accounts)
    return rel.accounts.select(
        "account_id", "account_type_id", "account_type", "is_asset", "is_liability",
        F.expr(f"{is_text('code_name', rel.overbillings)} AS is_overbillings"),
        in_staff.alias("is_in_staff"),
    )


def _class(attributes: DataFrame) -> DataFrame:
    """`attributes` with `class`, a number for each combination of what the metrics look at."""
    told = F.concat_ws("|", *[
        F.coalesce(F.lower(F.rtrim(F.col(c).cast("string"))), F.lit("-")) for c in ATTRIBUTES])
    return attributes.withColumn("class", F.xxhash64(told))


def account_classes(rel: Relations) -> DataFrame:
    """(account_id, class, is_result): the account side of a join with lines is narrow.

    `is_result` says whether lines of the account keep their contract.
    """
    return _class(account_attributes(rel)).select(
        "account_id", "class",
        F.expr(one_of("account_type_id", (COGS, INCOME))).alias("is_result"))


def class_attributes(rel: Relations) -> DataFrame:
    """The attributes of each class, a few rows whatever the number of accounts."""
    return _class(account_attributes(rel)).groupBy("class").agg(
        *[F.min(c).alias(c) for c in ATTRIBUTES])


def line_amounts(lines: DataFrame) -> DataFrame:
    """What the metrics look at in a ledger line; `net` is debit minus credit.

    A missing ledger type counts as not profit and loss.  `rounded` is what
    balances add up.
    """
    excluded = one_of("gl_type_id", NOT_PROFIT_AND_LOSS)
    return lines.selectExpr(
        "account_id", "contract_id", "tran_date",
        f"gl_type_id IS NOT NULL AND NOT {excluded} AS is_pl",
        "coalesce(debit, 0) - coalesce(credit, 0) AS net",
        "1L AS lines",
    ).withColumn("rounded", F.round("net", 2))


def amounts_of(rel: Relations) -> DataFrame:
    """Lines, or the sums of lines that are kept in their place (`ledger_sums`)."""
    return rel.ledger_sums if "ledger_sums" in rel else line_amounts(rel.gl_debit_credit)


def ledger_lines(rel: Relations) -> DataFrame:
    """Ledger amounts with the attributes of their account.

    The join carries no hint: Spark broadcasts the chart of accounts while its
    size is under `spark.sql.autoBroadcastJoinThreshold`, and otherwise sorts
    both sides, where adaptive execution splits an account with many lines.
    """
    return amounts_of(rel).join(account_attributes(rel), "account_id").select(
        "contract_id", "tran_date", "is_pl", "net", "rounded", "lines", *ATTRIBUTES
    )


def _flows() -> dict[str, Measure]:
    """Every signed sum the metrics need, without dates, over `ledger_lines`.

    Balances add up lines that are rounded one by one.
    """
    cash = one_of("account_type_id", CASH_TYPES)
    contract_types = one_of("account_type_id", (COGS, INCOME))
    statement_types = one_of("account_type_id", (COGS, EXPENSE, INCOME, OTHER_EXPENSE, OTHER_INCOME))
    debit_types = one_of("account_type_id", (COGS, EXPENSE, OTHER_EXPENSE))
    statement = f"CASE WHEN {debit_types} THEN net ELSE -net END"

    # The account descriptions below
    def described(*texts: str) -> str:
        return is_text("account_type", *texts)

    income = described("Income")
    payable = described("Accounts Payable", "Credit Card Account")
    return {m.name: m for m in (
        Measure("revenue", "-net", f"account_type_id = {INCOME} AND is_pl"),
        Measure("cogs", "net", f"account_type_id = {COGS} AND is_pl"),
        Measure("in_staff_labor", "net", f"is_in_staff AND {contract_types} AND is_pl"),
        Measure("net_income", "-net",
                f"{one_of('account_type_id', (COGS, EXPENSE, INCOME, OTHER_INCOME))} AND is_pl"),
        Measure("income", statement, f"{income} AND {statement_types} AND is_pl"),
        Measure(
            "ordinary_income",
            f"CASE WHEN {income} THEN 1 ELSE -1 END * {statement}",
            f"{described('Income', 'Cost of Goods Sold', 'Expense')} AND {statement_types} AND is_pl",
        ),
        Measure("income_lines", "-net", f"{income} AND is_pl"),
        Measure(
            "net_profit", "-net",
            f"{described('Income', 'Cost of Goods Sold', 'Expense', 'Other Income')} AND is_pl",
        ),
        Measure("gross_profit", "-net", f"{described('Income', 'Cost of Goods Sold')} AND is_pl"),
        Measure("cash", "rounded", f"is_asset = 1 AND {cash}"),
        Measure("receivable", "rounded",
                f"is_asset = 1 AND account_type_id = {RECEIVABLE}"),
        Measure("payable", "-rounded", f"is_liability = 1 AND ({payable} OR is_overbillings)"),
        Measure("current_liabilities", "-rounded",
                f"is_liability = 1 AND account_type_id <> {LONG_TERM_LIABILITY}"),
    )}


FLOWS = _flows()

#: measure -> (flow, window)
WINDOWED = {
    "ytd_revenue": ("revenue", "ytd"),
    "ytd_cogs": ("cogs", "ytd"),
    "ytd_income_lines": ("income_lines", "ytd"),
    "ytd_net_profit": ("net_profit", "ytd"),
    "ytd_gross_profit": ("gross_profit", "ytd"),
    "cogs_12m": ("cogs", "last_12m"),
    "month_net_income": ("net_income", "last_month"),
    "month_income": ("income", "last_month"),
    "month_ordinary_income": ("ordinary_income", "last_month"),
    "cash": ("cash", "balance"),
    "receivable": ("receivable", "balance"),
    "prior_receivable": ("receivable", "prior_balance"),
    "payable": ("payable", "balance"),
    "prior_payable": ("payable", "prior_balance"),
    "current_liabilities": ("current_liabilities", "balance"),
}

#: the same for sums kept per contract; no window means all dates
PER_CONTRACT = {
    "contract_revenue": ("revenue", None),
    "contract_cogs": ("cogs", None),
    "contract_ytd_revenue": ("revenue", "ytd"),
    "contract_ytd_cogs": ("cogs", "ytd"),
    "contract_ytd_in_staff_labor": ("in_staff_labor", "ytd"),
}


def window(name: str, as_of: AsOf) -> str:
    """Condition on `tran_date` for one of the reporting windows."""
    bounds = {
        "ytd": (as_of.year_start, as_of.today),
        "last_12m": (as_of.start_12m, as_of.month_end),
        "last_month": (as_of.month_start, as_of.month_end),
        "balance": (None, as_of.month_end),
        "prior_balance": (None, as_of.prior_month_end),
    }
    first, last = bounds[name]
    if first is None:
        return f"tran_date <= {literal(last)}"
    return f"tran_date BETWEEN {literal(first)} AND {literal(last)}"


def measures_at(as_of: AsOf, wanted: dict[str, tuple[str, str | None]]) -> list[Measure]:
    return [
        FLOWS[flow].within(name, window(period, as_of)) if period
        else Measure(name, FLOWS[flow].value, FLOWS[flow].where)
        for name, (flow, period) in wanted.items()
    ]


def ledger_totals(rel: Relations, as_of: AsOf, names=None) -> DataFrame:
    """One row with the named measures, filtered to the lines that matter."""
    wanted = {n: WINDOWED[n] for n in names or WINDOWED}
    return sum_measures(ledger_lines(rel), measures_at(as_of, wanted))


def ledger_by_contract(rel: Relations, as_of: AsOf, names=None) -> DataFrame:
    """Income and cost sums per contract."""
    wanted = {n: PER_CONTRACT[n] for n in names or PER_CONTRACT}
    return sum_measures(ledger_lines(rel), measures_at(as_of, wanted), by=["contract_id"])


def class_lines(rel: Relations) -> DataFrame:
    """Ledger amounts with the class of their account, for sums over many flows."""
    return amounts_of(rel).join(account_classes(rel), "account_id").drop("account_id")


def sum_cells(rel: Relations, lines: DataFrame, *keys: str) -> DataFrame:
    """Sum `class_lines` by `keys` and class; the sums get what the flows look at."""
    cells = lines.groupBy(*keys, "is_pl", "class").agg(
        *[F.sum(c).alias(c) for c in ("net", "rounded", "lines")]
    )
    return cells.join(class_attributes(rel), "class").drop("class")


def ledger_cells(rel: Relations, as_of: AsOf) -> DataFrame:
    """The ledger summed by account class and date interval.

    Only income and cost lines keep their contract, so all other lines shrink
    to a handful of cells before they leave the task that read them.  A cell
    carries the opening day of its interval as `tran_date`; windows start and
    end on interval borders, so the measures apply to cells unchanged.
    """
    lines = class_lines(rel).withColumns({
        "contract_id": F.expr("CASE WHEN is_result AND is_pl THEN contract_id END"),
        "tran_date": F.expr(latest_boundary("tran_date", as_of.boundaries)),
    })
    return sum_cells(rel, lines, "contract_id", "tran_date")


def ledger_report(rel: Relations, as_of: AsOf) -> DataFrame:
    """All measures per contract from one read of the ledger.

    The row without a contract holds everything that needs none; summing a
    column of WINDOWED over all rows gives the company total.
    """
    return sum_measures(
        ledger_cells(rel, as_of), measures_at(as_of, {**WINDOWED, **PER_CONTRACT}),
        by=["contract_id"], prefilter=False,
    )


def idc_lines(rel: Relations, period: str) -> DataFrame:
    """Indirect cost lines of a period: listed ledger types, cost codes with the prefix."""
    codes = rel.cost_codes.filter(f"startswith(number, {literal(IDC_CODE_PREFIX)})")
    spent = rel.gl.filter(f"{one_of('gl_type_id', IDC_GL_TYPES)} AND {period}")
    return spent.join(codes, "cost_code_id")


def idc_spend(rel: Relations, as_of: AsOf) -> DataFrame:
    """Indirect cost posted in the last twelve complete months."""
    return idc_lines(rel, window("last_12m", as_of)).agg(F.sum("tran_amount").alias("idc_12m"))
