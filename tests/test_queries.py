"""Every registered query against its SQL twin, and the plans behind them."""

import contextlib
import io
import math
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(rows, columns, order):
    return sorted(
        (tuple(_plain(row[columns.index(c)]) for c in order) for row in rows), key=repr
    )


#: queries that the corpus operators add have tests of their own
NAMES = sorted(set(entry.queries()) - set(entry._corpus_queries()))


def test_every_query_has_a_twin():
    assert set(NAMES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    frame = entry.queries()[name](spark, SMALL)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(columns)
    order = sorted(columns)
    assert _rows(frame.collect(), frame.columns, order) == _rows(result.fetchall(), columns, order)


def test_entry_has_all_metrics(spark):
    assert entry.entry(spark).count() == 36


def _plan(frame) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(NAMES) - {"snapshot_refresh"}))
def test_no_query_pairs_all_rows(spark, name):
    plan = _plan(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def _scans(plan: str) -> list[tuple[str, str]]:
    """File and columns read of every scan."""
    return re.findall(r"Location: InMemoryFileIndex \[(.*?)\].*?ReadSchema: (.*?)\n", plan, re.S)


def test_report_reads_the_ledger_once(spark):
    plan = _plan(entry.queries()["kpi_report"](spark, SMALL))
    # only the debit and credit ledger needs discount and account of a line
    ledger = [c for f, c in _scans(plan) if "lineitem" in f and "l_discount" in c]
    assert len(ledger) == 1


def test_single_metric_filters_the_scan_by_date(spark):
    plan = _plan(entry.queries()["net_income_last_month"](spark, SMALL))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]\n", plan)
    assert any("l_shipdate,2001-06-01" in p and "l_shipdate,2001-07-01" in p for p in pushed)


@pytest.mark.parametrize("name", ["weekly_snapshot", "monthly_snapshot", "kpi_wide"])
def test_snapshot_reads_the_ledger_once_for_any_number_of_dates(spark, name):
    # company sums, sums by contract and the calendar reuse one exchange
    frame = entry.queries()[name](spark, SMALL)
    frame.collect()
    plan = _plan(frame)
    final = plan.split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final
    details = dict(re.findall(r"^\((\d+)\) Scan parquet.*?ReadSchema: (.*?)$", plan, re.S | re.M))
    scans = [details[n] for n in re.findall(r"Scan parquet\s+\((\d+)\)", final)]
    assert sum("l_discount" in columns for columns in scans) == 1


def test_wide_report_pushes_its_range(spark):
    plan = _plan(entry.queries()["kpi_wide"](spark, SMALL))
    pushed = re.findall(r"PushedFilters: \[(.*?)\]\n", plan)
    assert any("LessThan(l_shipdate,2001-07-01" in p for p in pushed)
    assert any("GreaterThanOrEqual(l_shipdate,2000-01-01" in p for p in pushed)


@pytest.mark.parametrize("name", ["kpi_report", "monthly_snapshot", "department_performance"])
def test_generated_loops_can_be_compiled(spark, name):
    # the JVM interprets methods of more than 8000 bytes, many times slower
    frame = entry.queries()[name](spark, SMALL)
    frame.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000
