"""History of the metrics that depend on state: contract positions, payment times, aging.

The report of a past date, restated from the rows known by then (`rel.known_by(date)`), for every
date of a calendar at once and with one read of each fact.

* Facts are summed by contract and calendar interval in the tasks that read them, so no contract
  has more rows than the calendar has intervals, whatever share of the facts it holds.
* Each contract is swept once: running sums give its state after each interval, and only the
  change of what it adds to each metric leaves the contract.  There is no row per contract and
  date unless the contract moved.
* A document's latest invoice and payment are versions with a validity; a version enters the window
  of n days when it becomes known and leaves it n days after the invoice, or when the next
  version replaces it.  Unpaid balances enter and leave the age buckets in the same way.
* What is left are signed changes by day, at most a few for each day of the calendar, which
  window frames over days and months add up.

Relations without dates (project status, budgets, tasks, wages) are as they are now; rows
without a date count from the beginning, as `known_by` has it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.functions.scalars import literal, one_of
from closebook.operators import contracts as C
from closebook.operators import labor as L
from closebook.operators import ledger as G
from closebook.operators import receivables as R
from closebook.operators import report
from closebook.operators import snapshot as S
from closebook.plans.measures import sum_measures, to_long
from closebook.sources.relations import Relations

#: stands for the beginning, before every calendar
ALWAYS = date(1, 1, 1)
_TOTAL = "DECIMAL(38,8)"
_RUNNING = ("change_orders", "total_amount", "contract_revenue", "contract_cogs",
            "actual_hours", "staff_hours", "staff_cost")
#: contracts that one task sweeps, about 80,000 rows of seven years; the rows are wide but compress
#: to a few bytes, so that adaptive execution, which goes by bytes, would give a task millions
CONTRACTS_PER_TASK = {S.DAY: 32, S.WEEK: 192, S.MONTH: 960}
#: sums of the report that contract states determine
CONTRACT_SUMS = {
    name: measure for name, (parts, measure) in report.CONTRACT_SUMS.items()
    if name not in report.RATE_SUMS
}
#: sums that are wanted as of the last month end
_AT_MONTH_END = ("open_budget_eom", "open_value_eom")
CONTRACT_METRICS = tuple(
    m for m in report.METRICS if set(m.sums) <= {*CONTRACT_SUMS, "retainage"})
PAY_METRICS = tuple(m for m in report.METRICS if set(m.sums) <= set(report.PAY_SUMS))
AGING_METRICS = tuple(m for m in report.METRICS if set(m.sums) <= set(report.AGING_SUMS))


def _at(grain: str) -> str:
    """The calendar interval of `tran_date`; undated rows count from the beginning."""
    return f"coalesce({S.interval_end(grain)}, {literal(ALWAYS)}) AS at"


# --- contract states ----------------------------------------------------------------------------

def _moved(rel: Relations, grain: str) -> DataFrame:
    return rel.contract_activity.filter("tran_date IS NOT NULL").groupBy(
        "contract_id", F.expr(_at(grain))
    ).agg(F.sum("change_order").alias("change_orders"), F.sum("billed").alias("total_amount"))


def _earned(rel: Relations, grain: str) -> DataFrame:
    lines = G.ledger_lines(rel).filter(
        f"contract_id IS NOT NULL AND is_pl AND {one_of('account_type_id', (G.COGS, G.INCOME))}"
    ).withColumn("at", F.expr(_at(grain)))
    return sum_measures(lines, [
        G.FLOWS[flow].within(name, "true") for name, (flow, period) in G.PER_CONTRACT.items()
        if period is None
    ], by=["contract_id", "at"])


def _worked(rel: Relations, grain: str) -> DataFrame:
    """Hours, and what permanent staff costs; a line counts from the day it begins on."""
    pairs = rel.daily_time.filter("contract_id IS NOT NULL").withColumn(
        "tran_date", F.expr("CAST(in_time AS DATE)")
    ).groupBy("contract_id", "employee_id", F.expr(_at(grain))).agg(
        F.expr("CAST(sum(hours) AS DECIMAL(22,4)) AS hours"),
        F.expr("sum(coalesce(total, 0)) AS total"),
    )
    wages = rel.employees.selectExpr(
        "employee_id", "CAST(wage AS DECIMAL(15,4)) AS wage", f"{L.IN_STAFF} AS in_staff")
    return pairs.join(wages, "employee_id", "left").groupBy("contract_id", "at").agg(
        F.expr("sum(total) AS actual_hours"),
        F.expr("sum(CASE WHEN in_staff THEN hours END) AS staff_hours"),
        F.expr("sum(CASE WHEN in_staff THEN hours * wage END) AS staff_cost"),
    )


def _tasks(rel: Relations, grain: str) -> int:
    """Partitions in which the contracts are swept; no fewer than the session has."""
    contracts = rel.contract_values.count()
    return max(int(rel.spark.conf.get("spark.sql.shuffle.partitions")),
               -(-contracts // CONTRACTS_PER_TASK[grain]))


def _swept(rel: Relations, grain: str, moves: list[DataFrame],
           sides: list[DataFrame]) -> DataFrame:
    """For each contract with a project its running sums after each interval that moved them.

    Every contract has a first row at the beginning.  `sides` hold one row per contract.  The
    memory of a task is that of `CONTRACTS_PER_TASK` contracts, whatever their number.
    """
    known = rel.projects.join(rel.contract_values, "contract_id")
    for side in sides:
        known = known.join(side, "contract_id", "left")
    events = known.select("contract_id", F.expr(literal(ALWAYS)).alias("at"))
    for move in moves:
        events = events.unionByName(move, allowMissingColumns=True)
    amounts = [c for c in events.columns if c not in ("contract_id", "at")]
    # each source has one row per contract and interval already
    events = events.repartition(_tasks(rel, grain), "contract_id").groupBy(
        "contract_id", "at").agg(*[F.sum(c).alias(c) for c in amounts])
    so_far = Window.partitionBy("contract_id").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return events.select(
        "contract_id", "at", *[F.sum(c).over(so_far).alias(c) for c in amounts]
    ).join(known, "contract_id")


def contract_states(rel: Relations) -> DataFrame:
    """`contract_id`, `valid_from`, `valid_to`, `in_backlog`, `is_open`: intervals of equal state.

    `valid_from` is null for the state before any movement, `valid_to`, exclusive, for the current
    one.  The contracts open on a date are those of one interval each: the sets of all dates in one
    table.
    """
    states = _swept(rel, S.DAY, [_moved(rel, S.DAY)], []).selectExpr(
        "contract_id", "at", f"coalesce({C.in_backlog()}, false) AS in_backlog",
        f"coalesce({C.is_open()}, false) AS is_open")
    order = Window.partitionBy("contract_id").orderBy("at")
    state = F.struct("in_backlog", "is_open")
    turns = states.withColumn("before", F.lag(state).over(order)).filter(
        "before IS NULL OR before <> struct(in_backlog, is_open)")
    return turns.select(
        "contract_id", F.expr(f"nullif(at, {literal(ALWAYS)}) AS valid_from"),
        F.lead("at").over(order).alias("valid_to"), "in_backlog", "is_open")


def contract_changes(rel: Relations, grain: str) -> DataFrame:
    """(name, at, amount, n): changes of the contract sums of the report, by interval.

    `n` counts what adds to a sum, because a sum of nothing is null.
    """
    states = _swept(
        rel, grain, [_moved(rel, grain), _earned(rel, grain), _worked(rel, grain)],
        [C.tasks_by_contract(rel), C.budget_by_contract(rel)])
    # conditions and values of the report; both of its dates are this one here
    both = [F.col(c).alias(f"{c}{suffix}") for c in ("change_orders", "total_amount")
            for suffix in (report.TODAY, report.EOM)]
    order = Window.partitionBy("contract_id").orderBy("at")
    added = states.select("*", *both).select("contract_id", "at", *[
        F.expr(f"CASE WHEN {m.where} THEN CAST({m.value} AS {_TOTAL}) END AS {name}")
        for name, m in CONTRACT_SUMS.items()])
    changes = []
    for name in CONTRACT_SUMS:
        amount, counts = F.coalesce(F.col(name), F.lit(0)), F.col(name).isNotNull().cast("long")
        changes += [
            (amount - F.coalesce(F.lag(amount).over(order), F.lit(0))).alias(name),
            (counts - F.coalesce(F.lag(counts).over(order), F.lit(0))).alias(f"n_{name}")]
    by_day = added.select("at", *changes).groupBy("at").agg(*[
        F.sum(c).alias(c) for name in CONTRACT_SUMS for c in (name, f"n_{name}")])
    items = ", ".join(f"'{name}', at, CAST({name} AS {_TOTAL}), n_{name}" for name in CONTRACT_SUMS)
    return by_day.selectExpr(
        f"stack({len(CONTRACT_SUMS)}, {items}) AS (name, at, amount, n)"
    ).filter("n <> 0 OR amount <> 0")


def retainage_changes(rel: Relations, grain: str) -> DataFrame:
    return rel.retainage.filter("tran_date IS NOT NULL").groupBy(F.expr(_at(grain))).agg(
        F.expr(f"CAST(sum(unpaid_retainage) AS {_TOTAL}) AS amount"),
        F.count("unpaid_retainage").alias("n"),
    ).withColumn("name", F.lit("retainage"))


# --- receivables ---------------------------------------------------------------------------------

def document_versions(rel: Relations) -> DataFrame:
    """(trans_doc_id, valid_from, valid_to, invoice_date, payment_date): what was known when.

    One version for each day on which a document got an invoice or a payment, valid until the next.
    """
    kinds = {"invoice_date": R.INVOICE, "payment_date": R.PAYMENT}
    days = rel.ar_inquiry.filter(one_of("gl_type_name", kinds.values())).filter(
        "tran_date IS NOT NULL"
    ).groupBy("trans_doc_id", "tran_date").agg(*[
        F.expr(f"max(CASE WHEN gl_type_name = {literal(kind)} THEN tran_date END) AS {name}")
        for name, kind in kinds.items()])
    order = Window.partitionBy("trans_doc_id").orderBy("tran_date")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select(
        "trans_doc_id", F.col("tran_date").alias("valid_from"),
        F.lead("tran_date").over(order).alias("valid_to"),
        *[F.max(name).over(so_far).alias(name) for name in kinds])


def payment_changes(rel: Relations) -> DataFrame:
    """(name, at, amount, n): days to pay of the documents that enter and leave each window."""
    paid = document_versions(rel).filter("payment_date > invoice_date").selectExpr(
        "valid_from", "valid_to", "invoice_date",
        "datediff(payment_date, invoice_date) AS days")
    windows = ", ".join(
        f"struct('{name}' AS name, valid_from AS opens, "
        + (f"least(date_add(invoice_date, {n}), valid_to)" if n else "valid_to") + " AS closes)"
        for name, n in report.PAY_SUMS.items())
    # a null `closes` never comes; `least` passes over a missing end
    held = paid.selectExpr("days", f"inline(array({windows}))").filter(
        "closes IS NULL OR closes > opens")
    return held.selectExpr(
        "name", "days",
        "inline(array(struct(opens AS at, 1 AS sign), struct(closes AS at, -1 AS sign)))"
    ).filter("at IS NOT NULL").groupBy("name", "at").agg(
        F.expr(f"CAST(sum(days * sign) AS {_TOTAL}) AS amount"),
        F.expr("CAST(sum(sign) AS BIGINT) AS n"))


def aging_changes(rel: Relations) -> DataFrame:
    """(name, at, amount, n): balances that enter and leave each age bucket.

    `age_avg` adds up the days since 1970 on which unpaid rows are dated, from which the sum of ages
    on any day follows.
    """
    days = rel.ar_inquiry.filter(
        "balance_due > 1 AND tran_date IS NOT NULL AND project IS NOT NULL"
    ).groupBy("tran_date").agg(F.sum("balance_due").alias("balance"), F.count("*").alias("rows"))
    events = [
        "struct('age_avg' AS name, tran_date AS at, "
        f"CAST(unix_date(tran_date) * rows AS {_TOTAL}) AS amount, rows AS n)"]
    for name, (low, high) in R.AGING_BUCKETS.items():
        for day, sign in ((low, ""), (None if high is None else high + 1, "-")):
            if day is not None:
                events.append(f"struct('{name}' AS name, date_add(tran_date, {day}) AS at, "
                              f"CAST({sign}balance AS {_TOTAL}) AS amount, {sign}rows AS n)")
    return days.selectExpr(f"inline(array({', '.join(events)}))").groupBy("name", "at").agg(
        F.expr(f"CAST(sum(amount) AS {_TOTAL}) AS amount"), F.sum("n").alias("n"))


# --- calendar --------------------------------------------------------------------------------------

def levels(changes: DataFrame, calendar: DataFrame, names: list[str]) -> DataFrame:
    """One row per wanted as-of date with the sum and the count of each name.

    `<name>` is null where nothing counts.  A window partition holds the days of one name.
    """
    marks = calendar.filter("wanted").select(
        F.col("as_of").alias("at"), F.explode(F.array(*[F.lit(n) for n in names])).alias("name"),
        F.lit(True).alias("is_mark"))
    series = changes.filter(F.col("name").isin(names)).withColumn("is_mark", F.lit(False))
    series = series.unionByName(marks, allowMissingColumns=True).withColumn(
        "month", F.year("at") * 12 + F.month("at"))
    by_day = Window.partitionBy("name").orderBy("at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    by_month = Window.partitionBy("name").orderBy("month").rangeBetween(
        Window.unboundedPreceding, -1)
    at_month_end = F.col("name").isin(*_AT_MONTH_END)
    framed = series.select("at", "name", "is_mark", *[
        F.when(at_month_end, F.sum(c).over(by_month)).otherwise(F.sum(c).over(by_day)).alias(c)
        for c in ("amount", "n")]).filter("is_mark")
    return framed.groupBy(F.col("at").alias("as_of")).agg(*[
        F.max(F.when((F.col("name") == name) & (F.col(value) != 0 if value == "n" else
                                                F.col("n") != 0), F.col(value))).alias(alias)
        for name in names for value, alias in (("amount", name), ("n", f"n_{name}"))])


def _calendar(days: DataFrame, grain: str, start: date | None, end: date | None) -> DataFrame:
    """The as-of dates of the days given (`tran_date`), as snapshots have them."""
    return S.as_of_dates(days.withColumn("flow", F.lit("lines")), grain, start, end)


def _long(sums: DataFrame, metrics) -> DataFrame:
    return to_long(sums, [(m.ordinal, m.name, m.formula) for m in metrics], "as_of")


def positions_at(rel: Relations, grain: str, calendar: DataFrame) -> DataFrame:
    """Contract metrics and retainage for the wanted dates, which must be period ends."""
    changes = contract_changes(rel, grain).unionByName(retainage_changes(rel, grain))
    return _long(levels(changes, calendar, [*CONTRACT_SUMS, "retainage"]), CONTRACT_METRICS)


def days_to_pay_at(rel: Relations, calendar: DataFrame) -> DataFrame:
    """Average days to pay for the wanted dates."""
    sums = levels(payment_changes(rel), calendar, list(report.PAY_SUMS))
    return _long(sums.select("as_of", *[
        F.expr(f"CAST({name} AS DOUBLE) / n_{name} AS {name}") for name in report.PAY_SUMS
    ]), PAY_METRICS)


def aging_at(rel: Relations, calendar: DataFrame) -> DataFrame:
    """Average age and balance by age for the wanted dates, from the rows dated by then."""
    sums = levels(aging_changes(rel), calendar, list(report.AGING_SUMS))
    age = "CAST(n_age_avg * unix_date(as_of) - age_avg AS DOUBLE) / n_age_avg AS age_avg"
    return _long(sums.select("as_of", F.expr(age), *R.AGING_BUCKETS), AGING_METRICS)


def positions(rel: Relations, grain: str, start: date | None = None,
              end: date | None = None) -> DataFrame:
    """(as_of, ordinal, metric, value) of the contract metrics and retainage, every period end.

    The calendar covers the contracts' movements unless told otherwise.
    """
    days = rel.contract_activity.filter("tran_date IS NOT NULL").select("tran_date")
    return positions_at(rel, grain, _calendar(days, grain, start, end))


def _receivable_days(rel: Relations) -> DataFrame:
    return rel.ar_inquiry.filter("tran_date IS NOT NULL").select("tran_date")


def days_to_pay_history(rel: Relations, grain: str = S.MONTH, start: date | None = None,
                        end: date | None = None) -> DataFrame:
    """Days to pay for every period end that the receivables span."""
    return days_to_pay_at(rel, _calendar(_receivable_days(rel), grain, start, end))


def aging_history(rel: Relations, grain: str = S.MONTH, start: date | None = None,
                  end: date | None = None) -> DataFrame:
    """Ages of receivables for every period end that they span."""
    return aging_at(rel, _calendar(_receivable_days(rel), grain, start, end))


def history(rel: Relations, grain: str = S.MONTH, start: date | None = None,
            end: date | None = None) -> DataFrame:
    """All 36 metrics for every period end that the ledger spans."""
    days = G.amounts_of(rel).filter("tran_date IS NOT NULL").select("tran_date")
    calendar = _calendar(days, grain, start, end)
    return S.snapshot(rel, grain, start, end).unionByName(
        positions_at(rel, grain, calendar)).unionByName(
        days_to_pay_at(rel, calendar)).unionByName(aging_at(rel, calendar))
