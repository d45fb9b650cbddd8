"""Metrics for every as-of date of a calendar, in one job.

Only metrics that follow from dated rows can be restated for past dates
(`report.RESTATABLE`).  The ledger is read once whatever the number of dates:
it is summed by calendar interval and, for income and cost, by contract.  Both
the company's flows and the contracts' earnings come from these sums.  The
intervals of each flow are merged with the as-of dates, and window frames over
days and months give every date its year-to-date, monthly, yearly and balance sums.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from closebook.calendar import AsOf
from closebook.functions.scalars import literal
from closebook.operators import labor as L
from closebook.operators import ledger as G
from closebook.operators.report import RATE_SUMS, RESTATABLE
from closebook.plans.measures import Measure, sum_measures, to_long
from closebook.sources.relations import Relations

DAY, WEEK, MONTH = "day", "week", "month"

_TOTAL = "DECIMAL(38,6)"

#: flows that are kept by contract
_BY_CONTRACT = ("revenue", "cogs", "in_staff_labor")


def period_end(day: str, grain: str) -> str:
    """The as-of date whose period holds `day`: month end, the week's Sunday, or the day."""
    return {
        DAY: day,
        WEEK: f"next_day(date_sub({day}, 1), 'Sunday')",
        MONTH: f"last_day({day})",
    }[grain]


def interval_end(grain: str) -> str:
    """Last day that shares both the period and the month of `tran_date`.

    No window of any as-of date opens or closes inside such an interval, so
    the ledger can be summed by it without changing a result.
    """
    if grain == WEEK:
        return f"least({period_end('tran_date', grain)}, last_day(tran_date))"
    return period_end("tran_date", grain)


def interval_flows(rel: Relations, grain: str, start: date | None = None,
                   end: date | None = None) -> DataFrame:
    """(contract_id, tran_date, flow, amount): every flow by contract and interval.

    Only income and cost of the years that `start` and later dates ask for keep
    their contract; the rest has none.  Lines after `end` are not read.  The flow
    `lines` counts ledger lines, so an interval with lines has a row.

    The key columns pass through the generator, so that conditions on them stay
    above the shuffle and everything that is computed from the result reuses it.
    """
    lines = G.class_lines(rel).filter("tran_date IS NOT NULL")
    if end is not None:
        lines = lines.filter(f"tran_date <= {literal(end)}")
    keeps = "is_result AND is_pl"
    if start is not None:
        keeps += f" AND tran_date >= {literal(start.replace(month=1, day=1))}"
    cells = G.sum_cells(rel, lines.withColumns({
        "contract_id": F.expr(f"CASE WHEN {keeps} THEN contract_id END"),
        "tran_date": F.expr(interval_end(grain)),
    }), "contract_id", "tran_date")
    measures = [*G.FLOWS.values(), Measure("lines", "lines", "lines > 0")]
    sums = sum_measures(cells, measures, by=["contract_id", "tran_date"], prefilter=False)
    items = ", ".join(
        f"contract_id, tran_date, {literal(m.name)}, CAST({m.name} AS {_TOTAL})" for m in measures
    )
    return sums.selectExpr(
        f"stack({len(measures)}, {items}) AS (contract_id, tran_date, flow, amount)"
    ).filter("amount IS NOT NULL")


def company_flows(intervals: DataFrame) -> DataFrame:
    """(flow, tran_date, amount): at most one row per flow and calendar interval."""
    return intervals.groupBy("flow", "tran_date").agg(
        F.expr(f"CAST(sum(amount) AS {_TOTAL}) AS amount")
    )


def contract_flows(intervals: DataFrame) -> DataFrame:
    """Revenue, cost and in-staff labour per contract and interval, one flow a row."""
    kept = F.col("flow").isin(*_BY_CONTRACT) & F.col("contract_id").isNotNull()
    return intervals.filter(kept).select(
        "contract_id", "tran_date",
        *[F.when(F.col("flow") == flow, F.col("amount")).alias(flow) for flow in _BY_CONTRACT],
    )


def idc_by_interval(rel: Relations, grain: str, start: date | None = None,
                    end: date | None = None) -> DataFrame:
    """Indirect cost by interval, from the twelve complete months before `start` to `end`."""
    period = ["tran_date IS NOT NULL"]
    if start is not None:
        period.append(f"tran_date >= {literal(AsOf(start).start_12m)}")
    if end is not None:
        period.append(f"tran_date <= {literal(end)}")
    return (
        G.idc_lines(rel, " AND ".join(period))
        .groupBy(F.expr(interval_end(grain)).alias("tran_date"))
        .agg(F.expr(f"CAST(sum(tran_amount) AS {_TOTAL}) AS amount"))
        .withColumn("flow", F.lit("idc"))
    )


def as_of_dates(flows: DataFrame, grain: str, start: date | None = None,
                end: date | None = None) -> DataFrame:
    """The calendar as rows (as_of, wanted), dense from the start of the first year.

    Without `start` or `end` the calendar covers the intervals that have ledger
    lines.  Dates before `start` are only there to carry year-to-date sums.
    """
    if start is not None and end is not None:
        span = flows.sparkSession.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    else:
        span = flows.filter(F.col("flow") == "lines").agg(
            F.coalesce(F.lit(start), F.min("tran_date")).alias("first"),
            F.coalesce(F.lit(end), F.max("tran_date")).alias("last"),
        )
    if grain == MONTH:
        dates = ("transform(sequence(trunc(first, 'YEAR'), trunc(last, 'MM'), INTERVAL 1 MONTH),"
                 " m -> last_day(m))")
    else:
        opening, closing = period_end("trunc(first, 'YEAR')", grain), period_end("last", grain)
        dates = f"sequence({opening}, {closing}, INTERVAL {7 if grain == WEEK else 1} DAY)"
    last = "last" if end is not None else period_end("last", grain)
    return span.filter("first IS NOT NULL").selectExpr(
        "first", "last", f"explode({dates}) AS as_of"
    ).selectExpr("as_of", f"as_of BETWEEN first AND {last} AS wanted")


def windowed_sums(flows: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per wanted as-of date with every sum of `ledger.WINDOWED` and `idc_12m`.

    Intervals and as-of dates of one flow share a window partition, whose size is
    bounded by the calendar.  A frame over month numbers needs no month table:
    months -12..-1 are the last twelve complete ones, anything before month 0
    is the balance at the last month end.
    """
    wanted = {**G.WINDOWED, "idc_12m": ("idc", "last_12m")}
    names = sorted({flow for flow, _ in wanted.values()})
    marks = calendar.filter("wanted").select(
        F.col("as_of").alias("tran_date"),
        F.explode(F.array(*[F.lit(n) for n in names])).alias("flow"),
        F.lit(True).alias("is_mark"),
    )
    series = flows.filter(F.col("flow").isin(*names)).withColumn("is_mark", F.lit(False))
    series = series.unionByName(marks, allowMissingColumns=True).withColumn(
        "month", F.year("tran_date") * 12 + F.month("tran_date")
    )
    in_year = Window.partitionBy("flow", F.year("tran_date")).orderBy("tran_date")
    by_month = Window.partitionBy("flow").orderBy("month")
    amount, first, now = F.sum("amount"), Window.unboundedPreceding, Window.currentRow
    framed = series.withColumns({
        "ytd": amount.over(in_year.rangeBetween(first, now)),
        "last_month": amount.over(by_month.rangeBetween(-1, -1)),
        "last_12m": amount.over(by_month.rangeBetween(-12, -1)),
        "balance": amount.over(by_month.rangeBetween(first, -1)),
        "prior_balance": amount.over(by_month.rangeBetween(first, -2)),
    }).filter("is_mark")
    return framed.groupBy(F.col("tran_date").alias("as_of")).agg(*[
        F.max(F.when(F.col("flow") == flow, F.col(period))).alias(name)
        for name, (flow, period) in wanted.items()
    ])


def staff_minutes(rel: Relations, grain: str, start: date | None = None,
                  end: date | None = None) -> DataFrame:
    """Clock minutes of permanent staff per contract and period end of the year.

    A clock-in after midnight counts from the next day on, because the as-of
    date stands for its first instant.  Only the years that `start` and later
    dates ask for are read, up to the first instant of `end`.
    """
    clocked = rel.daily_time.filter("contract_id IS NOT NULL")
    if start is not None:
        # the last day before counts from the first day on
        opening = start.replace(month=1, day=1) - timedelta(days=1)
        clocked = clocked.filter(F.col("in_time") >= F.lit(opening).cast("timestamp_ntz"))
    if end is not None:
        clocked = clocked.filter(F.col("in_time") <= F.lit(end).cast("timestamp_ntz"))
    counted_from = (
        "date_add(CAST(in_time AS DATE),"
        " CASE WHEN in_time = CAST(in_time AS DATE) THEN 0 ELSE 1 END)"
    )
    closing = period_end(counted_from, grain)
    pairs = (
        clocked.filter(f"year(in_time) = year({closing})")
        .groupBy("contract_id", F.expr(closing).alias("as_of"), "employee_id")
        .agg(F.expr(f"sum({L.MINUTES}) AS minutes"))
    )
    staff = rel.employees.filter(L.IN_STAFF).select("employee_id")
    return pairs.join(staff, "employee_id", "left_semi").groupBy("contract_id", "as_of").agg(
        F.sum("minutes").alias("minutes")
    )


def contract_earnings(money: DataFrame, minutes: DataFrame, grain: str) -> DataFrame:
    """Ledger and clock sums per contract and period end of the year.

    A row whose period ends in the next year is never inside a year to date
    and is left out.
    """
    closing = period_end("tran_date", grain)
    money = money.filter(f"year(tran_date) = year({closing})").withColumn("as_of", F.expr(closing))
    return (
        money.drop("tran_date").unionByName(minutes, allowMissingColumns=True)
        .groupBy("contract_id", "as_of")
        .agg(*[F.sum(c).alias(c) for c in ("revenue", "cogs", "in_staff_labor", "minutes")])
    )


def hourly_rate_sums(earnings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sums behind the in-staff hourly rate for every as-of date.

    Which contracts count changes from date to date.  Each contract yields
    only the changes of its counted amounts, on the dates they happen; adding
    the changes up over the year gives the totals without a row per contract
    and date.
    """
    year = F.year("as_of")
    contract_year = Window.partitionBy("contract_id", year).orderBy("as_of")
    so_far = contract_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inputs = {"rate_labor": "in_staff_labor", "rate_cogs": "cogs",
              "rate_revenue": "revenue", "rate_minutes": "minutes"}
    running = earnings.withColumns(
        {name: F.sum(source).over(so_far) for name, source in inputs.items()}
    )
    counts = L.earns_with_staff("rate_revenue", "rate_labor", "rate_minutes")
    counted = running.selectExpr(
        "contract_id", "as_of",
        *[f"CASE WHEN {counts} THEN coalesce({c}, 0) ELSE 0 END AS {c}" for c in RATE_SUMS],
        f"CASE WHEN {counts} THEN 1 ELSE 0 END AS contracts",
    )
    totals = (*RATE_SUMS, "contracts")
    changes = counted.select(
        "as_of",
        *[(F.col(c) - F.coalesce(F.lag(c).over(contract_year), F.lit(0))).alias(c) for c in totals],
    ).groupBy("as_of").agg(*[F.sum(c).alias(c) for c in totals])
    by_year = Window.partitionBy(year).orderBy("as_of").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = calendar.join(changes, "as_of", "left").withColumns(
        {c: F.sum(c).over(by_year) for c in totals}
    )
    return summed.filter("wanted").select(
        "as_of", *[F.when(F.col("contracts") > 0, F.col(c)).alias(c) for c in RATE_SUMS]
    )


def snapshot(rel: Relations, grain: str, start: date | None = None, end: date | None = None,
             ) -> DataFrame:
    """(as_of, ordinal, metric, value) for every period end.

    The as-of date keeps its usual meaning: even on a month end, the last
    completed month is the month before.
    """
    intervals = interval_flows(rel, grain, start, end)
    flows = company_flows(intervals).unionByName(idc_by_interval(rel, grain, start, end))
    calendar = as_of_dates(flows, grain, start, end)
    earnings = contract_earnings(
        contract_flows(intervals), staff_minutes(rel, grain, start, end), grain
    )
    return to_long(
        windowed_sums(flows, calendar).join(hourly_rate_sums(earnings, calendar), "as_of"),
        [(m.ordinal, m.name, m.formula) for m in RESTATABLE],
        "as_of",
    )


def monthly_snapshot(rel: Relations, start: date | None = None, end: date | None = None) -> DataFrame:
    return snapshot(rel, MONTH, start, end)


def weekly_snapshot(rel: Relations, start: date | None = None, end: date | None = None) -> DataFrame:
    return snapshot(rel, WEEK, start, end)


def daily_snapshot(rel: Relations, start: date | None = None, end: date | None = None) -> DataFrame:
    return snapshot(rel, DAY, start, end)


def _grain(snapshots: DataFrame) -> list[str]:
    """Stored snapshots name their grain; a week's value is no predecessor of a month's."""
    return ["grain"] if "grain" in snapshots.columns else []


def wide(snapshots: DataFrame, periods: list[date]) -> DataFrame:
    """One row per metric (and grain) and one column `p_<year>_<month>_<day>` per period."""
    named = {p: f"p_{p:%Y_%m_%d}" for p in periods}
    labelled = snapshots.filter(F.col("as_of").isin(periods)).withColumn(
        "period", F.concat(F.lit("p_"), F.date_format("as_of", "yyyy_MM_dd"))
    )
    return labelled.groupBy(*_grain(snapshots), "ordinal", "metric").pivot("period", list(named.values())).agg(
        F.max("value")
    )


def trend(snapshots: DataFrame) -> DataFrame:
    """Each value with the previous period's, the change and the relative change."""
    series = Window.partitionBy(*_grain(snapshots), "metric").orderBy("as_of")
    previous = F.lag("value").over(series)
    change = F.col("value") - F.col("previous")
    return snapshots.withColumn("previous", previous).select(
        *_grain(snapshots), "as_of", "metric", "value", "previous",
        change.alias("change"),
        F.round(change / F.nullif(F.abs(F.col("previous")), F.lit(0.0)), 4).alias("change_ratio"),
    )
