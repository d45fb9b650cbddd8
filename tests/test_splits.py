"""Predicates of database reads, and reads of what is new."""

from datetime import date

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from closebook.sources import splits
from closebook.streaming import rollup
from tests.conftest import values
from tests.test_snapshot import AsOf, report


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 12)), max_size=40),
       st.lists(st.integers(0, 12), max_size=8))
def test_every_row_is_in_one_part(rows, points):
    duck = duckdb.connect()
    duck.execute("CREATE TABLE t (k INTEGER)")
    if rows:
        duck.executemany("INSERT INTO t VALUES (?)", [[r] for r in rows])
    parts = splits.predicates("k", sorted(points))
    got = [r[0] for p in parts for r in duck.execute(f"SELECT k FROM t WHERE {p}").fetchall()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_a_hot_value_stands_alone(spark):
    keys = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 500 ELSE id END AS k")
    points = splits.split_points(keys, "k", 10)
    parts = splits.predicates("k", points)
    assert "k = 500" in parts
    sizes = {p: keys.filter(p).count() for p in parts}
    assert sum(sizes.values()) == 9000 and sizes["k = 500"] >= 3000
    assert max(n for p, n in sizes.items() if p != "k = 500") <= 1400


def test_literals():
    assert splits.predicates("d", [date(2001, 1, 2)]) == [
        "(d <= '2001-01-02') OR d IS NULL", "d > '2001-01-02'"]
    assert splits.predicates("t", ["o'x"])[1] == "t > 'o''x'"
    assert splits.predicates("k", []) == ["1 = 1"]
    with pytest.raises(TypeError):
        splits.predicates("k", [True])


def test_uneven_keys_give_even_parts(small):
    lines = small.gl_debit_credit
    parts = splits.predicates("account_id", splits.split_points(lines, "account_id", 6))
    sizes = [lines.filter(p).count() for p in parts]
    assert sum(sizes) == lines.count() and max(sizes) < 2 * sum(sizes) / 6


def test_the_rollup_gets_each_line_once(spark, small, tmp_path):
    """Lines arrive in date order; a failed batch comes again, and the report is the same."""
    path, today = str(tmp_path), AsOf(date(2001, 7, 15))
    for ledger in rollup.LEDGERS:
        mark = splits.HighWaterMark(spark, f"{path}/{ledger}/mark", "tran_date")

        def store(rows, batch, ledger=ledger):
            rollup.store_batch(ledger, rows, batch, path)

        def fail(rows, batch):
            store(rows, batch)
            raise RuntimeError("lost")
        table = small[ledger]
        assert mark.read_new(table.filter("tran_date < DATE'1997-01-01'"), store) == 0
        with pytest.raises(RuntimeError):
            mark.read_new(table.filter("tran_date < DATE'1999-01-01'"), fail)
        assert mark.last()[0] == 0
        assert mark.read_new(table, store) == 1
        assert mark.read_new(table, store) == -1
    kept = rollup.report_from_rollup(spark, path, small, today)
    assert values(kept) == values(report.kpi_report(small, today))
