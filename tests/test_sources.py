"""Readers, writers, SQL views and the unpivoted sheets."""

from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from closebook.operators import contracts, external, receivables, report, survey
from closebook.sources import readers, sql_views
from closebook.sources.schemas import SCHEMAS
from closebook.sources.relations import conform
from closebook.sources.shared import shared_folder
from closebook.streaming import rollup
from tests.conftest import at, day, money, values


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_columnar_tables_give_the_same_report(spark, small, as_of, tmp_path, fmt):
    for name in SCHEMAS:
        small[name].write.format(fmt).save(f"{tmp_path}/{name}")
    stored = readers.read_columnar(spark, str(tmp_path), fmt=fmt)
    assert set(stored) == set(SCHEMAS)
    for name, schema in SCHEMAS.items():
        assert [(f.name, f.dataType) for f in stored[name].schema] == [
            (f.name, f.dataType) for f in schema]
    assert values(report.kpi_report(stored, as_of)) == values(report.kpi_report(small, as_of))


def test_csv_sheet(spark, tmp_path):
    months = ",".join(f"m{m:02d}" for m in range(1, 13))
    (tmp_path / "sheet.csv").write_text(f"metric,{months}\nBacklog,1.50,,3" + "," * 9 + "\n")
    sheet = readers.read_csv(spark, "external_sheet", str(tmp_path / "sheet.csv"))
    rows = {(r["metric"], r["period"], r["value"]) for r in external.sheet_to_long(sheet, 2000).collect()}
    assert rows == {("Backlog", date(2000, 1, 31), 1.5), ("Backlog", date(2000, 3, 31), 3.0)}


def test_csv_with_wrong_values_fails(spark, tmp_path):
    (tmp_path / "survey.csv").write_text(
        "response_id,submitted_at,employee_id,department,score\n1,2001-01-01 10:00:00,1,North,high\n")
    with pytest.raises(Exception, match="high"):
        readers.read_csv(spark, "survey", str(tmp_path / "survey.csv")).collect()


def test_json_survey(spark, make, tmp_path):
    (tmp_path / "s.json").write_text(
        '{"response_id":1,"submitted_at":"2001-01-01T10:00:00","employee_id":1,'
        '"department":"North","score":4}\n')
    responses = readers.read_json(spark, "survey", str(tmp_path / "s.json"))
    rows = survey.morale_by_department(make().replace(survey=responses)).collect()
    assert {(r["grain"], r["responses"], r["avg_score"]) for r in rows} == {
        ("week", 1, 4.0), ("month", 1, 4.0)}


def test_morale_trend(make):
    answers = [(1, "2001-01-01", "North", 2), (2, "2001-01-31", "North", 3),
               (3, "2001-02-01", "North", 5), (4, "2001-02-01", "South", 1),
               (5, "2001-02-01", "South", None)]
    rel = make(survey=[(n, at(f"{d}T12:00"), n, dep, score) for n, d, dep, score in answers])
    rows = {(r["grain"], r["department"], r["period_start"].isoformat()):
            (r["responses"], r["avg_score"], r["change"])
            for r in survey.morale_by_department(rel).collect()}
    assert rows == {
        ("week", "North", "2001-01-01"): (1, 2.0, None),
        # one week across two months
        ("week", "North", "2001-01-29"): (2, 4.0, 2.0),
        ("week", "South", "2001-01-29"): (1, 1.0, None),
        ("month", "North", "2001-01-01"): (2, 2.5, None),
        ("month", "North", "2001-02-01"): (1, 5.0, 2.5),
        ("month", "South", "2001-02-01"): (1, 1.0, None),
    }


def test_month_folders_are_pruned(spark, small, tmp_path, capsys):
    path = str(tmp_path / "ledger")
    readers.write_month_partitioned(small.gl_debit_credit, path, files_per_month=2)
    stored = readers.read_month_partitioned(spark, "gl_debit_credit", path)
    first, last = date(2001, 6, 1), date(2001, 6, 30)
    june = readers.in_months(stored, first, last)
    june.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(month" in plan
    expected = small.gl_debit_credit.filter(f"tran_date BETWEEN DATE'{first}' AND DATE'{last}'")
    assert june.count() == expected.count() > 0
    assert stored.drop("month").exceptAll(small.gl_debit_credit).count() == 0
    assert stored.count() == small.gl_debit_credit.count()


def test_sql_functions_agree_with_the_operators(spark, small, as_of):
    sql_views.register(small)
    by_sql = {tuple(r) for r in spark.sql(
        f"SELECT contract_id, total_amount FROM wip_totals(DATE'{as_of.today}')").collect()}
    built = contracts.wip_totals(small, {"": as_of.today}).select("contract_id", "total_amount")
    assert by_sql == {tuple(r) for r in built.collect()}
    retained = spark.sql(
        f"SELECT sum(unpaid_retainage) AS r FROM ar_aging(DATE'{as_of.today}', DATE'{as_of.today}')")
    assert retained.first()["r"] == receivables.unbilled_retainage(small, as_of).first()["retainage"]
    # one call per calendar row
    lateral = spark.sql("""
        SELECT c.as_of, sum(w.total_amount) AS billed
        FROM VALUES (DATE'2000-12-31'), (DATE'2001-06-30') AS c(as_of),
             LATERAL wip_totals(c.as_of) AS w
        GROUP BY c.as_of""").collect()
    assert {r["as_of"]: r["billed"] for r in lateral} == {
        d: small.contract_activity.filter(f"tran_date <= DATE'{d}'")
        .selectExpr("sum(billed)").first()[0]
        for d in (date(2000, 12, 31), date(2001, 6, 30))
    }


class _Session:
    """As much of a session as the choice of folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master)


def test_results_go_to_the_shared_folder(spark):
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
    on_cluster = _Session("yarn", "hdfs://shared/checkpoints/")
    assert shared_folder(on_cluster, "x").startswith("hdfs://shared/checkpoints/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("yarn"), "x")


def test_relations_open_only_what_is_used(make):
    opened = []
    rel = make()
    lazy = rel.replace(gl=lambda: opened.append("gl") or make().gl)
    lazy.accounts.count()
    assert opened == []
    assert lazy.gl is lazy.gl and opened == ["gl"]
    with pytest.raises(AttributeError):
        lazy.unknown


def test_wip_totals_for_several_dates_at_once(make):
    rel = make(
        contract_values=[(1, money(5)), (2, None)],
        contract_activity=[(1, day("2001-01-01"), money(1), money(2)),
                           (1, day("2001-02-01"), None, money(4))],
    )
    rows = {r["contract_id"]: r.asDict() for r in contracts.wip_totals(
        rel, {"_a": day("2001-01-31"), "_b": day("2001-02-28")}).collect()}
    assert rows[1]["total_amount_a"] == 2 and rows[1]["total_amount_b"] == 6
    assert rows[1]["change_orders_b"] == 1 and rows[2]["total_amount_b"] is None


def _stored(rel, folder, **columns):
    """Write relations to files, ids of contracts and accounts as text if asked for."""
    for name in SCHEMAS:
        table = rel[name]
        for column, change in columns.items():
            if column in table.columns:
                table = table.withColumn(column, change(F.col(column)))
        table.write.parquet(f"{folder}/{name}")


def test_text_ids_give_the_same_report(spark, small, as_of, tmp_path):
    def text(column):
        return F.concat(F.lit("id-"), column.cast("string"))
    _stored(small, tmp_path, contract_id=text, account_id=text, cost_code_id=text)
    stored = readers.read_columnar(spark, str(tmp_path))
    assert dict(stored.accounts.dtypes)["account_id"] == "string"
    assert values(report.kpi_report(stored, as_of)) == values(report.kpi_report(small, as_of))
    sums = f"{tmp_path}/sums"
    for ledger in rollup.LEDGERS:
        rollup.store_batch(ledger, stored[ledger], 0, sums)
    kept = rollup.report_from_rollup(spark, sums, stored, as_of)
    assert values(kept) == values(report.kpi_report(small, as_of))
    sql_views.register(stored)
    first = spark.sql(f"SELECT * FROM wip_totals(DATE'{as_of.today}')").first()
    assert first["contract_id"].startswith("id-")


def test_readers_refuse_what_would_change_amounts(spark, make, tmp_path):
    _stored(make(), tmp_path)
    codes = spark.createDataFrame([(1, "a"), (1, "b")], SCHEMAS["cost_codes"])
    codes.write.mode("overwrite").parquet(f"{tmp_path}/cost_codes")
    with pytest.raises(ValueError, match="cost_codes: repeated"):
        readers.read_columnar(spark, str(tmp_path))
    assert "gl" in readers.read_columnar(spark, str(tmp_path), check_keys=False)
    with pytest.raises(ValueError, match="split_on is missing for gl"):
        readers.read_jdbc(spark, "jdbc:none", {"gl": "GL", "accounts": "Account"})

    def budget(amount, kind):
        rows = spark.createDataFrame([(1, amount)], f"contract_id long, amount {kind}")
        return conform(rows, "budget_items").first()["amount"]
    assert budget(0.25, "double") == money("0.25") and budget("7", "string") == 7
    assert budget(None, "double") is None
    assert budget(money("0.1234"), "decimal(18,4)") == money("0.1234")
    with pytest.raises(Exception, match="does not hold 0.125"):
        budget(0.125, "double")


def test_functions_of_a_date_replace_movements(spark, small, as_of):
    """The same metrics from totals that table functions return, asked once for all dates."""
    sql_views.register(small)
    asked = []
    totals = sql_views.given_function(spark, "wip_totals({day})")

    def counted(dates):
        asked.append(list(dates))
        return totals(dates)
    given = small.replace(
        contract_activity=small.contract_activity.limit(0), retainage=small.retainage.limit(0)
    ).with_functions(wip_totals=counted,
                     ar_aging=sql_views.given_function(spark, "ar_aging({day}, {day})"))
    for key in ("open_backlog", "budget_open_wip_eom", "wip_revised_value", "unbilled_retainage"):
        assert values(report.kpi(given, as_of, key)) == values(report.kpi(small, as_of, key))
    assert {r[0] for r in contracts.open_contracts(given, as_of.today).collect()} == {
        r[0] for r in contracts.open_contracts(small, as_of.today).collect()}
    asked.clear()
    assert values(report.kpi_report(given, as_of)) == values(report.kpi_report(small, as_of))
    assert asked == [[as_of.month_end, as_of.today]]
